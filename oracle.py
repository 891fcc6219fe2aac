"""SQL for the queries of :mod:`workload`, in DuckDB's dialect, over the same tables."""

from __future__ import annotations

from lumora import fixed_values as fv
from workload import DIM, LANGS

_BLANK = r"[\t\n\x0B\f\r\p{Z}\x{FEFF}]"
_PAD_LEFT = "chr(160) || chr(9)"
_PAD_RIGHT = "' ' || chr(65279)"


def _case(column, pairs, default="NULL"):
    return f"CASE {column} " + " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in pairs) + f" ELSE {default} END"


def _trim(x):
    return f"regexp_replace({x}, '\\A{_BLANK}+|{_BLANK}+\\z', '', 'g')"


def _digest(v):
    return f"round(list_sum(list_transform({v}, lambda x, i: x::DOUBLE * i)), 6)"


def _quantized(v):
    return f"list_transform({v}, lambda x: floor(x::DOUBLE * 100000.0 + 0.5) / 100000.0)"


_CATEGORY = _case("label", [(i, c) for i, (c, _) in enumerate(fv.CATEGORY_PLAN)])
_PROMPT = _case("category", fv.EVALUATION_PROMPTS)

_GALLERY = f"""
g AS (SELECT vec_id AS id, vec_id AS pos, label, {_CATEGORY} AS category,
             embedding::DOUBLE[] AS v FROM embeddings)"""

_PROTOTYPES = f"""
proto_sums AS (SELECT label, i, sum(v[i]) AS t FROM g, range(1, {DIM + 1}) r(i) GROUP BY label, i),
proto_norms AS (SELECT label, sqrt(sum(t * t)) AS n FROM proto_sums GROUP BY label),
q AS (SELECT s.label::BIGINT AS qid, any_value({_CATEGORY.replace('CASE label', 'CASE s.label')}) AS category,
             list(t / n ORDER BY i) AS v
      FROM proto_sums s JOIN proto_norms n ON s.label = n.label GROUP BY s.label)"""

_CENTRE = f"""
centre_sums AS (SELECT i, sum(v[i]) AS t FROM g, range(1, {DIM + 1}) r(i) GROUP BY i),
centre AS (SELECT list(t / n ORDER BY i) AS c FROM centre_sums, (SELECT sqrt(sum(t * t)) AS n FROM centre_sums))"""

_SCORED = """
scored AS (SELECT q.qid, q.category AS target, g.id, g.pos, g.category,
                  list_dot_product(g.v, q.v) AS score FROM g, q)"""

_RANKED = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pos) AS rnk FROM scored)"""


def _hashed(table, key, word_rows):
    """Unit vectors ``h(key, v)`` from rows (key, slot, value)."""
    return f"""
slots AS (SELECT {key}, slot, sum(value)::DOUBLE AS s FROM ({word_rows}) GROUP BY {key}, slot),
grid AS (SELECT t.{key}, b.b, coalesce(s.s, 0.0) AS s
         FROM {table} t CROSS JOIN range({DIM}) b(b)
         LEFT JOIN slots s ON s.{key} = t.{key} AND s.slot = b.b),
h AS (SELECT {key}, list_transform(w, lambda x: x / n) AS v
      FROM (SELECT {key}, list(s ORDER BY b) AS w,
                   CASE WHEN sum(s * s) = 0 THEN 1.0 ELSE sqrt(sum(s * s)) END AS n FROM grid GROUP BY {key}))"""


def _words(table, key, text):
    return f"""SELECT {key}, ('0x' || substr(m, 1, 2))::INT % {DIM} AS slot,
                      CASE WHEN ('0x' || substr(m, 3, 2))::INT < 128 THEN 1 ELSE -1 END AS value
               FROM (SELECT {key}, md5(w) AS m FROM (SELECT {key}, unnest(string_split({text}, ' ')) AS w FROM {table})
                     WHERE w <> '')"""


_DOCS = _hashed("documents", "doc_id", _words("documents", "doc_id", "text"))
_DOCS32 = _DOCS + """,
h32 AS (SELECT doc_id, list_transform(v, lambda x: x::FLOAT::DOUBLE) AS v,
               row_number() OVER (ORDER BY doc_id) AS n FROM h)"""

_HALVES = _DOCS32 + """,
halves AS (SELECT doc_id, v, doc_id % 2 AS half, row_number() OVER (PARTITION BY doc_id % 2 ORDER BY doc_id) AS k,
                  row_number() OVER (ORDER BY doc_id % 2, doc_id) AS m FROM h32)"""

_EXACT_STEPS = 3000      # enough for the power iteration to converge


def _pca(steps):
    return f"""
mean_rows AS (SELECT i, avg(v[i]) AS m FROM g, range(1, {DIM + 1}) r(i) GROUP BY i),
mean AS (SELECT list(m ORDER BY i) AS mu FROM mean_rows),
centred AS (SELECT id, list_transform(v, lambda x, i: x - mu[i]) AS x FROM g, mean),
cov AS (SELECT a.i, b.j, sum(x[a.i] * x[b.j]) AS c
        FROM centred, range(1, {DIM + 1}) a(i), range(1, {DIM + 1}) b(j) GROUP BY a.i, b.j),
cov_rows AS (SELECT i, list(c ORDER BY j) AS r FROM cov GROUP BY i),
m AS (SELECT list(r ORDER BY i) AS c FROM cov_rows),
seed_raw AS (SELECT list_transform(r, lambda x: x - trunc(x)) AS v FROM (SELECT list_transform(range(1, {DIM + 1}),
             lambda i: sin(i::DOUBLE * {fv.SEED_FREQUENCY}::DOUBLE) * {fv.SEED_AMPLITUDE}::DOUBLE) AS r)),
seed AS (SELECT list_transform(v, lambda x: x / sqrt(n)) AS v
         FROM (SELECT v, list_dot_product(v, v) AS n FROM seed_raw)),
step1(k, v) AS (
  SELECT 0, v FROM seed
  UNION ALL
  SELECT k + 1, list_transform(w, lambda x: x / n) FROM (
    SELECT k, w, sqrt(list_dot_product(w, w)) AS n FROM (
      SELECT k, list_transform(c, lambda r: list_dot_product(r, v)) AS w FROM step1, m
      WHERE k < {steps}))),
pc1 AS (SELECT v AS p FROM step1 WHERE k = {steps}),
step2(k, v) AS (
  SELECT 0, v FROM seed
  UNION ALL
  SELECT k + 1, list_transform(u, lambda x: x / n) FROM (
    SELECT k, u, sqrt(list_dot_product(u, u)) AS n FROM (
      SELECT k, list_transform(w, lambda x, i: x - a * p[i]) AS u FROM (
        SELECT k, w, p, list_dot_product(w, p) AS a FROM (
          SELECT k, p, list_transform(c, lambda r: list_dot_product(r, v)) AS w FROM step2, m, pc1
          WHERE k < {steps}))))),
pc2 AS (SELECT v AS p FROM step2 WHERE k = {steps})"""


_PCA = _pca(fv.POWER_ITERATIONS)

_METRICS = f"""
{_GALLERY}, {_PROTOTYPES}, {_SCORED}, {_RANKED},
flagged AS (SELECT *, (category = target)::INT AS rel FROM ranked),
hits AS (SELECT *, sum(rel) OVER (PARTITION BY qid ORDER BY rnk) AS h FROM flagged),
per_query AS (
  SELECT qid, any_value(target) AS category, sum(rel)::BIGINT AS n_rel,
         sum(CASE WHEN rnk <= 1 THEN rel ELSE 0 END) / 1.0 AS p1,
         sum(CASE WHEN rnk <= 3 THEN rel ELSE 0 END) / 3.0 AS p3,
         sum(CASE WHEN rnk <= 5 THEN rel ELSE 0 END) / 5.0 AS p5,
         coalesce(1.0 / min(CASE WHEN rel = 1 THEN rnk END), 0.0)::DOUBLE AS rr,
         coalesce(sum(CASE WHEN rel = 1 THEN h::DOUBLE / rnk END) / sum(rel), 0.0)::DOUBLE AS ap,
         string_agg(CASE WHEN rnk <= {fv.TOP_IDS} THEN id::VARCHAR END, ',' ORDER BY rnk) AS top_ids
  FROM hits GROUP BY qid)"""



def _fixed(x, digits):
    """Rounded by the exact binary value, of which the text has enough digits; ``round`` would lift values just below a tie."""
    return f"round(printf('%.36f', ({x})::DOUBLE)::DECIMAL(38, 36), {digits})::DOUBLE"


def _mean(x, digits):
    """Mean summed from left to right in query order, rounded by its exact binary value."""
    total = f"list_reduce([0.0::DOUBLE] || list(({x})::DOUBLE ORDER BY qid), lambda a, b: a + b)"
    return _fixed(f"({total} / count(*))", digits)


_AGGREGATE = f"""{_METRICS},
total AS (SELECT count(*)::BIGINT AS queries, (SELECT count(*) FROM g)::BIGINT AS gallery_size,
                 {_mean('round(ap, 3)', 3)} AS m_ap, {_mean('round(rr, 3)', 3)} AS mrr,
                 {_mean('p1', 3)} AS p1, {_mean('p3', 3)} AS p3, {_mean('p5', 3)} AS p5,
                 round(avg(ap), 6) AS ap_exact, round(avg(rr), 6) AS rr_exact FROM per_query)"""

_HITS = f"""
licensed AS (SELECT d.*, l.toxic, d.doc_id::VARCHAR AS k,
    CASE WHEN d.source = 'src5' THEN NULL WHEN n_chars < 500 THEN 'by-nc'
         WHEN n_chars < 2000 THEN 'by-sa' ELSE 'by' END AS license
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
hits AS (SELECT doc_id, lang AS category, n_chars AS length, license, toxic,
    CASE WHEN lang = 'en' THEN '' WHEN source = 'src1' THEN NULL ELSE 'thumb/' || k END AS thumbnail,
    CASE WHEN source <> 'src2' THEN 'https://' || source || '/' || k END AS url,
    CASE WHEN source = 'src3' THEN '  ' ELSE {_PAD_LEFT} || text || {_PAD_RIGHT} END AS title,
    CASE WHEN source <> 'src4' THEN ' ' || source || chr(65279) END AS creator,
    CASE WHEN source <> 'src5' THEN '2.0' END AS license_version,
    CASE WHEN source <> 'src6' THEN 'https://licence/' || k END AS license_url,
    CASE WHEN source <> 'src7' THEN 'https://landing/' || k END AS landing,
    CASE WHEN source <> 'src8' THEN source END AS provider,
    source <> 'src9' AS status_ok,
    CASE source WHEN 'src10' THEN 'text/html' WHEN 'src11' THEN 'Image/JPG; q=1' ELSE 'image/jpeg' END AS mime,
    doc_id AS pos
  FROM licensed),
usable AS (SELECT *, coalesce(nullif(thumbnail, ''), nullif(url, '')) AS src FROM hits),
valid AS (SELECT * FROM usable WHERE src IS NOT NULL AND status_ok
  AND regexp_matches(mime, '(?i)image/(jpe?g|png|webp)') AND length >= {fv.MIN_PAYLOAD_BYTES}),
eligible AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY pos) AS place FROM hits
  WHERE NOT coalesce(regexp_matches(license, '(?i)\\bnc\\b'), false) AND NOT coalesce(toxic = 1, false))
  WHERE place <= {fv.HITS_PER_CATEGORY}),
plan AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{c}')" for i, (c, _) in enumerate(LANGS))}) t(cat_pos, category)),
kept AS (SELECT * FROM (
  SELECT v.*, p.cat_pos, row_number() OVER (PARTITION BY v.category ORDER BY v.pos) AS rn
  FROM valid v JOIN plan p ON v.category = p.category
  JOIN eligible e ON e.doc_id = v.doc_id) WHERE rn <= {fv.ITEMS_PER_CATEGORY}),
clean AS (SELECT doc_id, category,
    coalesce(nullif(substring({_trim("coalesce(title, '')")}, 1, {fv.TITLE_LENGTH}), ''), '{fv.UNTITLED}') AS title,
    {_trim(f"coalesce(creator, '{fv.UNKNOWN_CREATOR}')")} AS creator,
    upper({_trim("coalesce(license, '') || ' ' || coalesce(license_version, '')")}) AS license,
    coalesce(license_url, '') AS licenseUrl, coalesce(landing, url, '') AS source,
    coalesce(provider, '') AS provider FROM hits)"""

_TAGS = """
sims AS (SELECT {source}.{id} AS id, q.qid AS label_pos, q.category AS label,
                list_dot_product({source}.v, q.v) AS s FROM {source}, q),
peaks AS (SELECT *, max(s) OVER (PARTITION BY id) AS peak FROM sims),
shares AS (SELECT *, exp((s - peak) * {t}) / sum(exp((s - peak) * {t})) OVER (PARTITION BY id) AS score,
           row_number() OVER (PARTITION BY id ORDER BY s DESC, label_pos) AS rank FROM peaks)"""


def _tags(source, key):
    return _TAGS.format(source=source, id=key, t=fv.SOFTMAX_TEMPERATURE)


_COLOUR = _case("category", fv.CATEGORY_COLOURS.items(), repr(fv.DEFAULT_COLOUR))

def _byte_vectors(table, payload):
    return _hashed(table, "page_id", f"""
        SELECT page_id, ('0x' || b)::INT % {DIM} AS slot, 1 AS value FROM (
          SELECT page_id, unnest(regexp_extract_all(hex(encode({payload})), '..')) AS b FROM {table})""")


_IMAGES = f"""
arrived AS (SELECT * FROM pages WHERE page_id % 3 <> 0 AND page_id % 7 <> 0), {_byte_vectors('arrived', 'html')},
numbered AS (SELECT printf('%012d.JPG', page_id) AS title, list_transform(v, lambda x: x::FLOAT::DOUBLE) AS v,
                    row_number() OVER (ORDER BY page_id DESC) AS n FROM h)"""

_JOB = f"""{_DOCS},
docs AS (SELECT d.doc_id AS id, d.lang AS category, {_quantized('h.v')} AS v FROM documents d JOIN h USING (doc_id)),
{_hashed('benchmark', 'item_id', _words('benchmark', 'item_id', 'text')).replace('slots', 'qslots')
 .replace('grid', 'qgrid').replace('h AS', 'qh AS')},
ranked AS (SELECT item_id AS qid, id, {_case('item_id % 5', enumerate(c for c, _ in LANGS))} AS target, category,
                  row_number() OVER (PARTITION BY item_id ORDER BY list_reduce([0.0::DOUBLE] || list_transform(docs.v, lambda x, i: x * qh.v[i]), lambda a, b: a + b) DESC, id) AS rnk FROM docs, qh),
hits AS (SELECT *, (category = target)::INT AS rel, sum((category = target)::INT) OVER (PARTITION BY qid ORDER BY rnk) AS h FROM ranked),
per_query AS (
  SELECT qid, any_value(target) AS category, sum(rel)::BIGINT AS n_rel,
         sum(CASE WHEN rnk <= 1 THEN rel ELSE 0 END) / 1.0 AS p1,
         sum(CASE WHEN rnk <= 3 THEN rel ELSE 0 END) / 3.0 AS p3,
         sum(CASE WHEN rnk <= 5 THEN rel ELSE 0 END) / 5.0 AS p5,
         {_fixed('coalesce(1.0 / min(CASE WHEN rel = 1 THEN rnk END), 0.0)', 3)} AS rr,
         {_fixed("CASE WHEN sum(rel) = 0 THEN 0.0 ELSE list_reduce([0.0::DOUBLE] || (list(h::DOUBLE / rnk ORDER BY rnk) FILTER (rel = 1)), lambda a, b: a + b) / sum(rel) END", 3)} AS ap,
         string_agg(CASE WHEN rnk <= {fv.TOP_IDS} THEN id::VARCHAR END, ',' ORDER BY rnk) AS top_ids
  FROM hits GROUP BY qid)"""

ORACLE = {
    "vector_profile": f"""WITH {_GALLERY}
        SELECT count(*)::BIGINT AS count, min(len(v))::BIGINT AS dim_min, max(len(v))::BIGINT AS dim_max,
               round(min(sqrt(list_dot_product(v, v))), 6) AS norm_min,
               round(max(sqrt(list_dot_product(v, v))), 6) AS norm_max FROM g""",
    "l2_normalize": f"""WITH {_GALLERY},
        t AS (SELECT id, list_transform(v, lambda x: x * 3.0) AS v FROM g),
        u AS (SELECT id, list_transform(v, lambda x: x / n) AS v
              FROM (SELECT id, v, sqrt(list_dot_product(v, v)) AS n FROM t))
        SELECT id, {_digest('v')} AS digest, round(sqrt(list_dot_product(v, v)), 6) AS norm FROM u""",
    "quantize_5dp": f"""WITH {_GALLERY}, u AS (SELECT id, {_quantized('v')} AS v FROM g)
        SELECT id, {_digest('v')} AS digest, list_min(v) AS low, list_max(v) AS high FROM u""",
    "narrow_float32": f"""WITH {_GALLERY},
        u AS (SELECT id, list_transform(v, lambda x: (x / 3.0)::FLOAT) AS v FROM g)
        SELECT id, {_digest('v')} AS digest, list_max(v)::DOUBLE AS high FROM u""",
    "pair_cosine": f"""WITH {_GALLERY}
        SELECT id, round(list_dot_product(v, v), 6) AS own,
               round(list_dot_product(v[1:{DIM // 2}], v[1:{DIM // 2}]), 6) AS half, 0.0::DOUBLE AS missing FROM g""",
    "clean_query_text": f"""WITH t AS (
          SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        c AS (SELECT kind, id, {_trim(f"{_PAD_LEFT} || text || {_PAD_RIGHT}")} AS x FROM t)
        SELECT kind, id, md5(x) AS md5, length(x)::BIGINT AS n FROM c WHERE length(x) > 0""",
    "label_prompts": f"""SELECT DISTINCT source AS label, '{fv.PROMPT_PREFIX}' || source AS prompt FROM documents""",
    "join_items_vectors": f"""WITH {_GALLERY}
        SELECT d.doc_id AS id, d.lang, coalesce(len(g.v), 0)::BIGINT AS dim,
               coalesce({_digest('list_transform(g.v, lambda x: -x)')}, 0.0) AS digest
        FROM documents d LEFT JOIN g ON d.doc_id = g.id""",
    "relevance_join": """SELECT e.vec_id AS id, CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS category,
               coalesce((l.quality = 1)::BIGINT, 0) AS rel
        FROM embeddings e LEFT JOIN labels l ON e.vec_id = l.doc_id""",
    "last_wins": """SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
        FROM events GROUP BY user_id""",
    "item_lookup": """SELECT doc_id AS id, lang, n_chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "category_colours": f"""WITH {_GALLERY},
        t AS (SELECT id, category FROM g UNION ALL SELECT doc_id, lang FROM documents)
        SELECT id, category, {_COLOUR} AS colour FROM t""",
    "dimension_lookup": f"""SELECT doc_id, {_case('lang', LANGS[:3], "'other'")} AS language FROM documents""",
    "score_gallery": f"""WITH {_GALLERY}, {_CENTRE}
        SELECT id, round(list_dot_product(v, c), 6) AS score FROM g, centre""",
    "search_ranked": f"""WITH {_GALLERY}, {_CENTRE},
        s AS (SELECT id, category, pos, list_dot_product(v, c) AS s FROM g, centre)
        SELECT id, category, round(s, 6) AS score, row_number() OVER (ORDER BY s DESC, pos) AS rank FROM s""",
    "search_topk": f"""WITH {_GALLERY}, {_CENTRE},
        s AS (SELECT id, pos, list_dot_product(v, c) AS s FROM g, centre)
        SELECT id, round(s, 6) AS score, row_number() OVER (ORDER BY s DESC, pos)::INT AS rank FROM s
        ORDER BY s DESC, pos LIMIT 10""",
    "batch_topk": f"""WITH {_GALLERY}, {_PROTOTYPES}, {_SCORED}, {_RANKED}
        SELECT qid, id, round(score, 6) AS score, rnk::INT AS rank FROM ranked WHERE rnk <= 10""",
    "batch_topk_blocks": f"""WITH {_GALLERY},
        s AS (SELECT t.id AS qid, g.id, g.pos, list_dot_product(g.v, t.v) AS score FROM g, g t WHERE t.id % 5 = 0 AND g.id <> t.id)
        SELECT qid, id, round(score, 6) AS score, rnk::INT AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pos) AS rnk FROM s) WHERE rnk <= 10""",
    "find_similar": f"""WITH {_GALLERY},
        covers AS (SELECT min(id) AS id FROM g GROUP BY category),
        s AS (SELECT t.id AS qid, g.id, g.pos, list_dot_product(g.v, t.v) AS score
              FROM g, (SELECT g.id, g.v FROM g JOIN covers c ON g.id = c.id) t WHERE g.id <> t.id)
        SELECT qid, id, round(score, 6) AS score, rnk::INT AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pos) AS rnk FROM s) WHERE rnk <= 5""",
    "search_text": f"""WITH {_DOCS},
        docs AS (SELECT doc_id AS id, {_quantized('v')} AS v FROM h),
        texts AS (SELECT item_id, {_trim(f"{_PAD_LEFT} || text || {_PAD_RIGHT}")} AS text FROM benchmark),
        {_hashed('texts', 'item_id', _words('texts', 'item_id', 'text')).replace('slots', 'qslots')
         .replace('grid', 'qgrid').replace('h AS', 'qh AS')},
        s AS (SELECT item_id AS qid, id, list_dot_product(docs.v, qh.v) AS score FROM docs, qh)
        SELECT qid, id, round(score, 9) AS score, rnk::INT AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rnk FROM s) WHERE rnk <= 5""",
    "browse": f"WITH {_GALLERY} SELECT id, category, 0.0::DOUBLE AS score FROM g",
    "relative_relevance": f"""WITH {_GALLERY}, {_PROTOTYPES}, {_SCORED},
        e AS (SELECT qid, min(score) AS low, CASE WHEN max(score) = min(score) THEN 1.0 ELSE max(score) - min(score) END AS span
              FROM scored GROUP BY qid)
        SELECT s.qid, id, round(score, 6) AS score, round((score - low) / span, 6) AS rel,
               score < low + span * {fv.DIM_BELOW} AS dim FROM scored s JOIN e ON s.qid = e.qid""",
    "attribution_lines": f"""WITH {_HITS}
        SELECT doc_id, md5(CASE WHEN category = 'fr' THEN '{fv.UPLOAD_CREDIT}' ELSE
                 '“' || title || '” by ' || creator || ' · ' || license || ' · ' ||
                 CASE WHEN source <> '' THEN 'source' ELSE '' END || ' (via {fv.CREDIT_SERVICE})' END) AS credit_md5,
               CASE WHEN category <> 'fr' AND licenseUrl <> '' THEN licenseUrl END AS "creditLicenseUrl",
               CASE WHEN category <> 'fr' AND source <> '' THEN source END AS "creditSource" FROM clean""",
    "zero_shot_tags": f"""WITH {_GALLERY}, {_PROTOTYPES}, {_tags('g', 'id')}
        SELECT id, label, round(score, 6) AS score, rank FROM shares WHERE rank <= {fv.TAGS_PER_ITEM}""",
    "mean_vector": f"""WITH {_GALLERY}
        SELECT i - 1 AS dim, round(avg(v[i]), 9) AS mean FROM g, range(1, {DIM + 1}) r(i) GROUP BY i""",
    "covariance_matrix": f"""WITH RECURSIVE {_GALLERY}, {_PCA}
        SELECT i - 1 AS i, j - 1 AS j, round(c, 6) AS value FROM cov""",
    "pca_axes": f"""WITH RECURSIVE {_GALLERY}, {_PCA}
        SELECT i - 1 AS dim, round(mu[i], 6) AS mean, round(pc1.p[i], 6) AS pc1, round(pc2.p[i], 6) AS pc2
        FROM mean, pc1, pc2, range(1, {DIM + 1}) r(i)""",
    "pca_axes_exact": f"""WITH RECURSIVE {_GALLERY}, {_pca(_EXACT_STEPS)}
        SELECT i - 1 AS dim, round(mu[i], 6) AS mean, round(pc1.p[i], 6) AS pc1, round(pc2.p[i], 6) AS pc2
        FROM mean, pc1, pc2, range(1, {DIM + 1}) r(i)""",
    "project_axes": f"""WITH RECURSIVE {_GALLERY}, {_PROTOTYPES}, {_PCA}
        SELECT id, round(list_dot_product(x, a.v), 6) AS x, round(list_dot_product(x, b.v), 6) AS y
        FROM centred, (SELECT v FROM q WHERE qid = 0) a, (SELECT v FROM q WHERE qid = 1) b""",
    "galaxy_map": f"""WITH RECURSIVE {_GALLERY}, {_PROTOTYPES}, {_PCA},
        pts AS (SELECT id, false AS isq, x AS v FROM centred UNION ALL
                SELECT qid, true, list_transform(v, lambda x, i: x - mu[i]) FROM q, mean),
        xy AS (SELECT id, isq, list_dot_product(v, pc1.p) AS x, list_dot_product(v, pc2.p) AS y FROM pts, pc1, pc2),
        e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM xy)
        SELECT id, isq AS "isQuery",
               round({fv.CANVAS_PADDING} + (x - x0) / (x1 - x0) * {fv.CANVAS_WIDTH - 2 * fv.CANVAS_PADDING}, 4) AS x,
               round({fv.CANVAS_PADDING} + (y - y0) / (y1 - y0) * {fv.CANVAS_HEIGHT - 2 * fv.CANVAS_PADDING}, 4) AS y
        FROM xy, e""",
    "category_legend": f"""WITH {_GALLERY}
        SELECT category, min(pos) AS first_pos, {_COLOUR} AS colour FROM g GROUP BY category""",
    "eval_per_query": f"""WITH {_METRICS}
        SELECT qid, {_PROMPT} AS query, category, n_rel AS "nRelevant", round(p1, 6) AS p1, round(p3, 6) AS p3,
               round(p5, 6) AS p5, round(rr, 3) AS rr, round(ap, 3) AS ap, round(rr, 6) AS rr_exact,
               round(ap, 6) AS ap_exact, top_ids FROM per_query""",
    "eval_aggregate": f"""WITH {_AGGREGATE}
        SELECT queries, gallery_size AS "gallerySize", m_ap AS "mAP", mrr, p1, p3, p5,
               ap_exact AS "mAP_exact", rr_exact AS mrr_exact FROM total""",
    "eval_report": f"""WITH {_AGGREGATE}
        SELECT 'mean AP' AS metric, printf('%.3f', m_ap) AS value FROM total
        UNION ALL SELECT 'MRR', printf('%.2f', mrr) FROM total
        UNION ALL SELECT 'Precision@1', printf('%.2f', p1) FROM total
        UNION ALL SELECT 'Precision@3', printf('%.2f', p3) FROM total""",
    "clean_metadata": f"""WITH {_HITS}
        SELECT doc_id, title, creator, license, licenseUrl AS "licenseUrl", source, provider FROM clean""",
    "eligible_hits": f"WITH {_HITS} SELECT doc_id, category, pos FROM eligible",
    "valid_hits": f"WITH {_HITS} SELECT doc_id, src FROM valid",
    "curate_items": f"""WITH {_HITS},
        n AS (SELECT doc_id, row_number() OVER (ORDER BY cat_pos, pos) - 1 AS id FROM kept)
        SELECT id, printf('{fv.FILE_NAME_FORMAT}', id) AS file, category, title, creator, license,
               licenseUrl AS "licenseUrl", source, provider FROM n JOIN clean USING (doc_id)""",
    "curation_fill_report": f"""WITH {_HITS}, n AS (SELECT category, count(*) AS c FROM kept GROUP BY category)
        SELECT p.cat_pos, p.category, coalesce(c, 0)::BIGINT AS kept,
               coalesce(c, 0) < {fv.ITEMS_PER_CATEGORY} AS under_filled FROM plan p LEFT JOIN n ON p.category = n.category""",
    "embed_texts": f"WITH {_DOCS} SELECT doc_id, len(v)::BIGINT AS dim, {_digest('v')} AS digest FROM h",
    "embed_images": f"""WITH {_hashed('pages', 'page_id', f'''
        SELECT page_id, ('0x' || b)::INT % {DIM} AS slot, 1 AS value FROM (
          SELECT page_id, unnest(regexp_extract_all(hex(encode(html)), '..')) AS b FROM pages)''')}
        SELECT page_id, len(v)::BIGINT AS dim, {_digest('v')} AS digest FROM h""",
    "embedding_header": f"""WITH {_DOCS}
        SELECT 'word-hash' AS model, 'float32' AS dtype, max(len(v))::BIGINT AS dim,
               min(abs(sqrt(list_dot_product(v, v)) - 1)) <= 0.01
               AND max(abs(sqrt(list_dot_product(v, v)) - 1)) <= 0.01 AS normalized, count(*)::BIGINT AS count FROM h""",
    "arrivals_topk": f"""WITH {_GALLERY}, {_PROTOTYPES}, {_DOCS32},
        pool AS (SELECT id, pos, id::VARCHAR AS item, v FROM g
                 UNION ALL SELECT -n, -4294967296 + n - 1, printf('%012d', doc_id), v FROM h32),
        s AS (SELECT qid, id, pos, item, list_dot_product(pool.v, q.v) AS score FROM pool, q)
        SELECT qid, rank, round(score, 6) AS score, item FROM (
          SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pos, id) AS rank FROM s) WHERE rank <= 10""",
    "arrivals_images": f"""WITH {_IMAGES}
        SELECT -n AS id, title, {_digest('v')} AS digest FROM numbered""",
    "arrivals_quarantine": """SELECT printf('in/%012d.JPG', page_id) AS path FROM pages
        WHERE page_id % 3 <> 0 AND page_id % 7 = 0""",
    "arrivals_batches": f"""WITH {_GALLERY}, {_PROTOTYPES}, {_DOCS32},
        pool AS (SELECT v FROM g UNION ALL SELECT v FROM h32),
        s AS (SELECT qid, list_dot_product(pool.v, q.v) AS score FROM pool, q)
        SELECT qid, rank, round(score, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC) AS rank FROM s) WHERE rank <= 10""",
    "arrivals_gallery": f"""WITH {_GALLERY}, {_DOCS32}
        SELECT id, pos, category, false AS "isUpload", '' AS title, {_digest('v')} AS digest FROM g
        UNION ALL SELECT -n, -4294967296 + n - 1, '{fv.UPLOAD_CATEGORY}', true, printf('%012d', doc_id), {_digest('v')}
        FROM h32""",
    "arrivals_tags": f"""WITH {_GALLERY}, {_PROTOTYPES}, {_DOCS32},
        u AS (SELECT -n AS id, v FROM h32), {_tags('u', 'id')}
        SELECT id, label, round(score, 6) AS score, rank FROM shares WHERE rank <= {fv.TAGS_PER_ITEM}""",
    "arrivals_mean": f"""WITH {_GALLERY}, {_DOCS32},
        pool AS (SELECT v FROM g UNION ALL SELECT v FROM h32)
        SELECT i - 1 AS dim, round(avg(v[i]), 6) AS mean FROM pool, range(1, {DIM + 1}) r(i) GROUP BY i""",
    "arrivals_query_change": f"""WITH {_GALLERY}, {_PROTOTYPES}, {_HALVES},
        pool AS (SELECT id, pos, id::VARCHAR AS item, v FROM g
                 UNION ALL SELECT -m, -(half + 1) * 4294967296 + k - 1, printf('%012d', doc_id), v FROM halves),
        asked AS (SELECT qid, v, qid >= 5 AS late FROM q WHERE qid IN (2, 4) OR qid >= 5
                  UNION ALL SELECT 3, v, true FROM g WHERE id = (SELECT min(id) FROM g WHERE label = 3)),
        s AS (SELECT qid, late, id, pos, item, list_dot_product(pool.v, asked.v) AS score FROM pool, asked)
        SELECT qid, rank, round(score, 6) AS score, item, late FROM (
          SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, pos, id) AS rank FROM s) WHERE rank <= 10""",
    "arrivals_galaxy": f"""WITH RECURSIVE {_GALLERY.replace('g AS (', 'g0 AS (')}, {_PROTOTYPES.replace('FROM g,', 'FROM g0,')}, {_HALVES},
        g AS (SELECT id, v FROM g0 UNION ALL SELECT -m, v FROM halves), {_PCA},
        pts AS (SELECT id, false AS isq, x AS v FROM centred UNION ALL
                SELECT qid, true, list_transform(v, lambda x, i: x - mu[i]) FROM q, mean),
        xy AS (SELECT id, isq, list_dot_product(v, pc1.p) AS x, list_dot_product(v, pc2.p) AS y FROM pts, pc1, pc2),
        e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM xy)
        SELECT id, isq AS "isQuery",
               round({fv.CANVAS_PADDING} + (x - x0) / (x1 - x0) * {fv.CANVAS_WIDTH - 2 * fv.CANVAS_PADDING}, 4) AS x,
               round({fv.CANVAS_PADDING} + (y - y0) / (y1 - y0) * {fv.CANVAS_HEIGHT - 2 * fv.CANVAS_PADDING}, 4) AS y
        FROM xy, e""",
    "arrivals_failing": f"""WITH arrived AS (SELECT * FROM pages WHERE page_id % 2 = 0), {_byte_vectors('arrived', 'html')},
        numbered AS (SELECT printf('%012d.png', page_id) AS title, list_transform(v, lambda x: x::FLOAT::DOUBLE) AS v,
                            row_number() OVER (ORDER BY page_id) AS n FROM h)
        SELECT -n AS id, title, {_digest('v')} AS digest, true AS failed FROM numbered""",
    "originals_count": "SELECT count(*)::BIGINT AS originals FROM embeddings",
    "manifest_roundtrip": f"""WITH {_HITS}
        SELECT doc_id AS pos, doc_id AS id, printf('{fv.FILE_NAME_FORMAT}', doc_id) AS file, category, title, creator,
               license, licenseUrl AS "licenseUrl", source, provider, (SELECT count(*) FROM hits)::BIGINT AS count
        FROM clean""",
    "embeddings_roundtrip": f"""WITH {_GALLERY}, u AS (SELECT id, pos, {_quantized('v')} AS v FROM g)
        SELECT id, pos, {_digest('v')} AS digest, {DIM}::BIGINT AS dim, true AS normalized,
               (SELECT count(*) FROM g)::BIGINT AS count FROM u""",
    "evaluation_roundtrip": f"""WITH {_AGGREGATE}
        SELECT qid, {_PROMPT} AS query, category, n_rel AS "nRelevant", round(rr, 3) AS rr, round(ap, 3) AS ap, top_ids,
               'prototypes' AS model, queries, gallery_size AS "gallerySize", m_ap AS mean_ap FROM per_query, total""",
    "curation_job": f"""WITH {_HITS},
        n AS (SELECT doc_id, row_number() OVER (ORDER BY cat_pos, pos) - 1 AS id FROM kept)
        SELECT id AS pos, id, printf('{fv.FILE_NAME_FORMAT}', id) AS file, category, title, source,
               (SELECT count(*) FROM n)::BIGINT AS count FROM n JOIN clean USING (doc_id)""",
    "embedding_job": f"""WITH {_byte_vectors('pages', 'html || chr(10)')}, u AS (SELECT page_id, {_quantized('v')} AS v FROM h)
        SELECT page_id AS id, {_digest('v')} AS digest, 'byte-histogram' AS model, {DIM}::BIGINT AS dim, true AS normalized,
               (SELECT count(*) FROM pages)::BIGINT AS count FROM u""",
    "evaluation_job": f"""WITH {_JOB}
        SELECT qid, category, n_rel AS "nRelevant", round(p1, 6) AS p1, round(p3, 6) AS p3, round(p5, 6) AS p5, rr, ap,
               top_ids, 'word-hash' AS model, n AS queries, (SELECT count(*) FROM documents)::BIGINT AS "gallerySize",
               m_ap AS mean_ap, mrr, mp1, mp3, mp5
        FROM per_query, (SELECT count(*)::BIGINT AS n, {_mean('ap', 3)} AS m_ap, {_mean('rr', 3)} AS mrr, {_mean('p1', 3)} AS mp1,
                                {_mean('p3', 3)} AS mp3, {_mean('p5', 3)} AS mp5 FROM per_query)""",
    "gallery_load": f"""WITH {_AGGREGATE}, u AS (SELECT id, pos, category, {_quantized('v')} AS v FROM g),
        w AS (SELECT id, pos, category, list_transform(v, lambda x: x::FLOAT::DOUBLE) AS v FROM u)
        SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos, category, 'no. ' || id AS title,
               'img/' || printf('{fv.FILE_NAME_FORMAT}', id) AS src, false AS "isUpload", {_digest('v')} AS digest,
               {DIM}::BIGINT AS dim, (SELECT count(*) FROM g)::BIGINT AS count, m_ap AS mean_ap, queries AS evaluated
        FROM w, total""",
    "landed_hits": f"""WITH {_HITS}
        SELECT category, row_number() OVER (PARTITION BY category, doc_id // 50 ORDER BY doc_id) - 1 AS pos,
               coalesce(url, '') AS url, md5(title) AS title_md5, toxic = 1 AS mature, length FROM hits""",
    "mean_vector_with_gaps": f"""WITH {_GALLERY}
        SELECT i - 1 AS dim, round(avg(v[i]), 6) AS mean FROM g JOIN documents d ON d.doc_id = g.id, range(1, {DIM + 1}) r(i)
        GROUP BY i""",
}
# all landed hits instead of the first ones of each category
ORACLE["curate_all_hits"] = ORACLE["curate_items"].replace(f"  WHERE place <= {fv.HITS_PER_CATEGORY})", ")")
ORACLE["pca_axes_matrix_free"] = ORACLE["pca_axes"]
ORACLE["relevance_blocks"] = ORACLE["relative_relevance"]

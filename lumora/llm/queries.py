"""The registered queries of this package: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumora.llm import bpe, decontaminate, exact_dedup, hard_negatives, language, lm_score, minhash, pii, prefix_trie, quality, secret_scan, sharding, token_counts
from lumora.llm.common import table


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_lm_score(spark, sf_dir):
    return lm_score.score_texts(table(spark, sf_dir, "documents")).drop("rid")


def op2_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85).drop("rid")


def op3_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer())


def op4_secret_scan(spark, sf_dir):
    return secret_scan.find_secrets(table(spark, sf_dir, "documents")).drop("rid")


def op5_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii(spark, sf_dir):
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("rid")


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("rid")


def op8_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer())


def op9_decontamination(spark, sf_dir):
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"),
                        F.col("hits.item_id").alias("item_ids"), F.col("hits.distance").alias("distances"))


def op10_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_language_id(spark, sf_dir):
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", F.coalesce("nearest", F.lit(language.UNKNOWN)).alias("lang_pred"), "score",
                        "rejected", "centroid")


def op12_hard_negatives(spark, sf_dir):
    found = hard_negatives.mine(table(spark, sf_dir, "embeddings"))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_lm_score, op2_minhash, op3_bpe, op4_secret_scan, op5_quality, op6_pii, op7_exact_dedup, op8_token_counts, op9_decontamination,
                                    op10_sharding, op11_language_id, op12_hard_negatives, op13_prefix_trie)}

def _best(names: str, weights: list[float], of: str) -> str:
    """The place of the child with the largest draw, as in sharding.draw."""
    draws = ", ".join(f"ln((('0x' || substr(md5({of} || '/' || {names.format(k)}), 1, {sharding.DIGITS}))::BIGINT + 1)"
                      f" / {16 ** sharding.DIGITS}.0) / {w}" for k, w in enumerate(weights))
    return f"list_position([{draws}], list_max([{draws}])) - 1"


ORACLE = {
    "op2_minhash": """
        WITH RECURSIVE w AS (
          SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE
                list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
        e AS (SELECT doc_id, unnest(s) AS g FROM s),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
                  WHERE 100 * k >= 85 * (len(x.s) + len(y.s) - k)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION
                  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(reach.b) AS component_id, s.doc_id = min(reach.b) AS kept
        FROM s JOIN reach ON reach.a = s.doc_id GROUP BY s.doc_id, s.s""",
    "op10_sharding": f"""
        WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
                     CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        b AS (SELECT doc_id, doc_id::VARCHAR AS k, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                     lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
        c AS (SELECT doc_id, k, (len(b) + 8)::BIGINT AS size, xor(list_reduce([4294967295::BIGINT] || b,
                     lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM b, t),
        r AS (SELECT *, {_best("'region{0}'", [8.0] * 3, "k")} AS region, {_best("'region{0}'", [8.0] * 3 + [1.0], "k")} AS grown FROM c),
        h AS (SELECT *, {_best("'region' || region || '/rack{0}'", [4.0] * 2, "k")} AS rack FROM r),
        p AS (SELECT *, ((region * 2 + rack) * 4 +
              {_best("'shard' || ((region * 2 + rack) * 4 + {0})", [1.0] * 4, "k")})::INT AS shard FROM h)
        SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
               CASE WHEN grown = 3 THEN 24 ELSE shard END AS grown_shard FROM p""",
    "op12_hard_negatives": """
        WITH r AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.rid, a.vec_id AS anchor_id, a.label = b.label AS same, b.rid AS other, b.vec_id,
                     list_dot_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0),
        p AS (SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, other AS positive FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.rid, p.positive ORDER BY s.score DESC, s.vec_id, s.other)::INT AS rank
              FROM p JOIN s ON p.rid = s.rid AND NOT s.same
               AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op13_prefix_trie": """
        WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        d AS (SELECT conv_id, turn, substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest,
                     strlen(coalesce(text, '')) AS bytes FROM conversations WHERE conv_id IS NOT NULL),
        k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k FROM d),
        c AS (SELECT conv_id, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                     lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM d), crc),
        u AS (SELECT c.conv_id, 0 AS part, k.k, digest, bytes FROM c JOIN k ON k.conv_id = c.conv_id - c.conv_id % 5 AND k.k <= h
              UNION ALL SELECT c.conv_id, 1, k.k, digest, bytes FROM c JOIN k ON k.conv_id = c.conv_id AND k.k > h),
        p AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS prefix, bytes FROM u
              WINDOW w AS (PARTITION BY conv_id ORDER BY part, k ROWS UNBOUNDED PRECEDING)
              UNION ALL SELECT conv_id, 0, '', 0 FROM c),
        n AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY depth, prefix),
        kids AS (SELECT substr(prefix, 1, 32 * (depth - 1)) AS prefix, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
        m AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids ON kids.prefix = n.prefix),
        below AS (SELECT substr(prefix, 1, 32 * a) AS prefix, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved
                  FROM (SELECT *, unnest(range(depth + 1)) AS a FROM m) GROUP BY 1),
        last AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
        ends AS (SELECT p.prefix, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids FROM p JOIN last USING (conv_id, depth) GROUP BY p.prefix)
        SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved AS saved_tokens,
               sha256(coalesce(ids, '')) AS ends_sha256
        FROM m JOIN below USING (prefix) LEFT JOIN ends USING (prefix)
        LEFT JOIN n up ON up.depth = m.depth - 1 AND up.prefix = substr(m.prefix, 1, 32 * (m.depth - 1))""",
    "op7_exact_dedup": """
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS h
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM n""",
}

"""Language identification against a slow version and on held-out texts."""

import math
import random
import re
import tracemalloc
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from data import awkward as rows_of, frame
from pyspark.sql import functions as F

from lumora.llm import language, queries

SF = "/root/testdata/sf0.001"
PARTS = {"a": "an be con der ing the tion".split(), "b": "ço ñada lé que ès ión".split(), "c": "日 本 語 の は".split()}


def text(lang, n, seed):
    r = random.Random(f"{lang}{n}{seed}")
    return " ".join("".join(r.choice(PARTS[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def slow_counts(t):
    """Buckets of 2- and 3-byte grams with their counts, one gram after the other."""
    x = pc.utf8_lower(t or "").as_py().encode()
    x = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in x)
    x = b"  " + x + b"  "
    out = Counter()
    for i in range(len(x) - 2):
        if x[i:i + 2] == b"  ":
            continue
        code = (x[i] * 257 + x[i + 1]) % 2**32
        out[(code * 0x9E3779B1) % 2**32 >> (32 - language.BITS)] += 1
        out[((code * 257 + x[i + 2] + 1) * 0x85EBCA77) % 2**32 >> (32 - language.BITS)] += 1
    return out


def slow_vector(t, idf):
    v = {k: (1 + math.log(c)) * float(idf[k]) for k, c in slow_counts(t).items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / norm for k, x in v.items()}


@pytest.mark.parametrize("slab", [64, 1 << 20])
def test_counts(monkeypatch, slab):
    monkeypatch.setattr(language, "SLAB", slab)
    texts = [t for _, t in rows_of() if t is None or len(t) < 5000] + [text("c", 300, 1), "a", "", " b", "Ä" * 65, "x" * 127, "x" * 128, "x" * 129, "x" * 191]
    got = np.zeros((len(texts), language.BUCKETS), np.int64)
    for i, j, counts in language.gram_counts(pa.array(texts, pa.string())):
        got[i:j] = counts
    for row, t in zip(got, texts):
        assert {int(k): int(row[k]) for k in np.flatnonzero(row)} == dict(slow_counts(t))


def test_nearest_centroid_is_the_slow_one(spark):
    rows = [(i, text(lang, 5 + i % 30, i), lang) for i, lang in enumerate("abcaab" * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.fit(docs.select("lang", "text"))
    assert model.langs == ["a", "b", "c"] and 3 <= len(model.rows) <= 3 * language.CLUSTERS and len(set(model.of)) == 3
    assert np.allclose(np.linalg.norm(model.rows, axis=1), 1, atol=1e-5)
    seen = Counter(k for _, t, _ in rows for k in slow_counts(t))
    assert np.allclose(model.idf, [math.log((len(rows) + 1) / (seen[k] + 1)) + 1 for k in range(language.BUCKETS)])
    for _, t, _ in rows[::7]:
        v = slow_vector(t, model.idf)
        cosine = [sum(x * float(c[k]) for k, x in v.items()) for c in model.rows]
        counts = next(language.gram_counts(pa.array([t])))[2]
        best, score = model.nearest(language.unit_vectors(counts, model.idf))
        assert cosine[best[0]] == pytest.approx(max(cosine), abs=1e-5) and score[0] == pytest.approx(max(cosine), abs=1e-5)


def test_held_out_accuracy_and_rejection(spark):
    """Learned languages are told apart; texts of none of them are too far from every centroid."""
    rows = [(i, text(lang, 20 + i % 30, i), lang) for i, lang in enumerate("abc" * 200)]
    alien = [(10_000 + i, " ".join(chr(0x0410 + (i * 7 + k * k) % 32) * 3 for k in range(30)), None) for i in range(20)]
    docs = spark.createDataFrame(rows + alien, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(got[i].nearest == lang for i, _, lang in rows)
    assert sum(got[i].rejected for i, _, _ in rows) <= 0.05 * len(rows)
    assert all(got[i].rejected and got[i].lang == "und" for i, _, _ in alien)
    assert {i % 2**32 for i in got} and {r.held_out for r in got.values()} == {True, False}


def test_languages_never_seen_in_training_rows_are_not_learned(spark):
    rows = [(i, text("a" if i % 2 else "b", 30, i), "a" if i % 2 else "b") for i in range(40)]
    held = [r.doc_id for r in spark.range(40).filter(F.crc32(F.col("id").cast("string")) % 4 == 2).select(F.col("id").alias("doc_id")).collect()]
    docs = [(i, t, "only" if i in held else lang) for i, t, lang in rows]
    got = language.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert held and {r.nearest for r in got} == {"a", "b"} and {r.doc_id for r in got if r.held_out} == set(held)


def test_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = queries.op11_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(lang) and {r.lang_pred for r in got} <= {*lang.values(), "und"} and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_awkward_rows(spark, awkward, nothing):
    got = language.identify(awkward.withColumn("__rid", F.lit("x")).withColumn("centroid", F.lit("y"))).collect()
    assert len(got) == len(rows_of())                       # no row of these has a language
    assert {(r.lang, r.nearest, r.score) for r in got} == {("und", None, 0.0)}
    assert language.identify(nothing).count() == 0
    some = frame(spark, rows_of()).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "x").otherwise("y"))
    got = language.identify(some).collect()
    assert len(got) == len(rows_of())
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    letters = {i for i, t in rows_of() if any(unicodedata.category(c)[0] == "L" for c in t or "")}
    for i, t in rows_of():
        if i is not None:
            assert all((r.nearest in ("x", "y")) == (i in letters) and (i in letters or r.score == 0) for r in by[i])
    assert by[22][0] == by[22][1] and re.fullmatch("[xy]", by[16][0].nearest)


@pytest.mark.parametrize("piece", [1, 100, 1 << 16])
def test_counts_in_pieces(monkeypatch, piece):
    """Texts of a block are counted a few at a time: the same counts, in a fraction of the memory."""
    monkeypatch.setattr(language, "PIECE", piece)
    texts = [None, "", "1  2", "a", "a  b   c 12", "  ", "Ä" * 65, "é1", *[text(lang, 5 + i % 40, i) for i, lang in enumerate("abc" * 40)], "x" * 300, None]
    blocks = list(language.gram_counts(pa.array(texts, pa.string())))
    assert [b[:2] for b in blocks] == [(0, len(texts))]
    for row, t in zip(blocks[0][2], texts):
        assert {int(k): int(row[k]) for k in np.flatnonzero(row)} == dict(slow_counts(t))


def test_counting_needs_little_memory_beside_the_counts():
    texts = pa.array([text("a", 500, i) for i in range(240)])
    assert 0.7e6 < texts.nbytes < 1e6
    tracemalloc.start()
    blocks = [(i, j) for i, j, _ in language.gram_counts(texts)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert blocks == [(0, 240)] and peak < 2 * 240 * language.BUCKETS * 4


def test_letters_are_looked_for_at_the_start_first(spark):
    texts = [None, "", "1", "a", "é", "1" * 63 + "a", "1" * 64 + "a", "1" * 64, "🎉" * 70, "🎉" * 70 + "日", "\n" * 100 + "ß", " ", "ª", "²", "́" * 65 + "x"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = docs.select("doc_id", language.has_letter("text").alias("has"))
    assert [r.has for r in found.orderBy("doc_id").collect()] == [any(unicodedata.category(c)[0] == "L" for c in t or "") for t in texts]
    assert "substring(text" in found._jdf.queryExecution().optimizedPlan().toString()

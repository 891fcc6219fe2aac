"""The pipeline against a brute-force version, stage by stage."""

import re

import corpus_pipeline
import pytest
from data import SPACE, awkward as rows_of, frame, near_components

from lumora.llm import decontaminate, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    assert [len(stages), *[after.columns == before.columns for before, after in stages[:-1]]] == [5, True, True, True, True]


def test_quality_stage(spark, stages):
    before, after = stages[0]
    good = quality.score(before, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1")
    assert ids(after) == ids(good) and 0 < after.count() < before.count()


def test_exact_stage(stages):
    before, after = stages[1]
    least = {}
    for r in before.collect():
        key = re.sub(SPACE, " ", r.text or "")
        least[key] = min(least.get(key, r.doc_id), r.doc_id)
    assert ids(after) == sorted(least.values())


def test_near_stage(stages):
    before, after = stages[2]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    component, _ = near_components([t for _, t in rows], 5, 80)
    assert ids(after) == [rows[k][0] for k in sorted(set(component))]


def test_decontamination_stage(spark, stages):
    before, after = stages[3]
    items = [decontaminate.normal_text(r.text or "") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in before.collect() if not any(
        decontaminate.distance(i, decontaminate.normal_text(r.text or ""), decontaminate.edits(len(i))) <= decontaminate.edits(len(i))
        for i in items)]
    assert ids(after) == sorted(clean) and after.count() < before.count()


def test_encoding_stage_and_run(spark, stages):
    before, after = stages[4]
    assert ids(after) == ids(before)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(corpus_pipeline.run(spark, SF)) == key(after)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_awkward_and_no_rows(spark, k):
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, frame(spark, []), SF).count() == 0
    some = stage(spark, frame(spark, rows_of()), SF).collect()
    assert 0 < len(some) <= len(rows_of())

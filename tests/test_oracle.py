"""Every registered query against its SQL, on the given tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


def test_every_query_has_sql():
    assert set(contract.queries()) - set(contract.LLM) == set(contract.oracle_sql()) - set(contract.LLM)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert len(got)
    expected = duck.execute(contract.oracle_sql()[name]).fetch_df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) == len(expected)
    pd.testing.assert_frame_equal(normal(got), normal(expected), check_dtype=False, rtol=0, atol=2e-6)


@pytest.mark.parametrize("name", ["eval_aggregate", "evaluation_job"])
def test_means_on_more_rows(spark, name):
    """Means next to a tie show only on some tables."""
    larger = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{larger}/{t}.parquet'")
    got = contract.queries()[name](spark, larger).toPandas()
    expected = con.execute(contract.oracle_sql()[name]).fetch_df()
    pd.testing.assert_frame_equal(normal(got), normal(expected), check_dtype=False, rtol=0, atol=1e-9)

"""A corpus pipeline over ``documents``: every stage calls one operator of ``lumora.llm``.

A stage gets what its predecessor kept and returns the rows it keeps, with the columns of
``documents``; the last one returns the encoded documents.  Rows are told apart by numbers of their
own, so repeated ids and NULLs in any column pass through; an empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumora.llm import bpe, decontaminate, exact_dedup, minhash, quality
from lumora.llm.common import numbered, table, without
from lumora.llm.queries import tokenizer
from lumora.plans.freeze import new_dir
from lumora.session import ship


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels, doesn't reject."""
    return quality.accepted(docs, table(ship(spark), sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space apart, the row with the smallest id."""
    docs = numbered(docs)
    return without(docs, exact_dedup.exact_dedup(docs).filter("NOT kept"))


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on sets of five words, the row with the smallest id."""
    docs = numbered(docs)
    return without(docs, minhash.near_duplicates(docs, width=5, percent=80).filter("NOT kept"))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, up to its edit distance."""
    docs = numbered(docs)
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.filter(F.size("hits") > 0))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return bpe.encode_decode(docs, tokenizer())


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", dissimilar_documents),
    ("decontamination", clean_documents),
    ("bpe", encoded_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again by the next."""
    docs = table(ship(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = new_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained classifier and BPE can't be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None

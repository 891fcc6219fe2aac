"""Explicit schemas: nothing in this library infers a schema from data."""

from pyspark.sql import types as T

ITEM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("file", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("creator", T.StringType()),
    T.StructField("license", T.StringType()),
    T.StructField("licenseUrl", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("provider", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("builtAt", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("items", T.ArrayType(ITEM)),
])

VECTOR = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("v", T.ArrayType(T.DoubleType())),
])

EMBEDDING_HEADER = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("dim", T.LongType()),
    T.StructField("normalized", T.BooleanType()),
    T.StructField("count", T.LongType()),
])

EMBEDDINGS = T.StructType(
    EMBEDDING_HEADER.fields + [T.StructField("embeddings", T.ArrayType(VECTOR))]
)

_P_AT = T.MapType(T.StringType(), T.DoubleType())

AGGREGATE = T.StructType([
    T.StructField("queries", T.LongType()),
    T.StructField("gallerySize", T.LongType()),
    T.StructField("mAP", T.DoubleType()),
    T.StructField("mrr", T.DoubleType()),
    T.StructField("pAt", _P_AT),
])

PER_QUERY = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("nRelevant", T.LongType()),
    T.StructField("pAt", _P_AT),
    T.StructField("rr", T.DoubleType()),
    T.StructField("ap", T.DoubleType()),
    T.StructField("topIds", T.ArrayType(T.LongType())),
])

EVALUATION = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("evaluatedAt", T.StringType()),
    T.StructField("aggregate", AGGREGATE),
    T.StructField("perQuery", T.ArrayType(PER_QUERY)),
])

# A search hit as landed by whatever collected it, with the outcome of its download.
CANDIDATE = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("thumbnail", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("creator", T.StringType()),
    T.StructField("license", T.StringType()),
    T.StructField("license_version", T.StringType()),
    T.StructField("license_url", T.StringType()),
    T.StructField("foreign_landing_url", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("mature", T.BooleanType()),
    T.StructField("status_ok", T.BooleanType()),
    T.StructField("mime", T.StringType()),
    T.StructField("length", T.LongType()),
])

# One page of hits per landed document, hits in rank order.
CANDIDATE_PAGE = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("results", T.ArrayType(T.StructType(CANDIDATE.fields[2:]))),
])

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

"""What the operators of this package share: reading, row numbers, flat text, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumora.plans.freeze import freeze

U64 = np.uint64
#: Texts are worked on in pieces of about this many bytes, so that numpy's working arrays stay small.
CHUNK_BYTES = 1 << 19
#: Bytes of a word that are hashed by place.
SHORT = 64
#: Odd multiplier of the polynomial word hash (modulo 2**64).
BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_NUMBER = "lumora.row_number"


def _number(docs: DataFrame) -> str | None:
    """The column with row numbers of :func:`numbered`, known by its metadata: a user's column of that name isn't."""
    return next((f.name for f in docs.schema.fields if (f.metadata or {}).get(_NUMBER)), None)


def rows(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text): a number for each row, and NULL texts as empty ones.

    ``rid`` is the number that ``docs`` have from :func:`numbered`; else it is only stable
    once the result is frozen or used within one job."""
    name = _number(docs)
    number = F.col(name) if name else F.monotonically_increasing_id()
    return docs.select(number.alias("rid"), F.col("doc_id").cast("long"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row in a column that they don't have, written, so that the numbers stay."""
    name, taken = "__rid", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return freeze(docs.select("*", F.monotonically_increasing_id().alias(name, metadata={_NUMBER: True})))


def without(docs: DataFrame, gone: DataFrame, few: int = 1_000_000) -> DataFrame:
    """Numbered ``docs`` without the rows whose numbers are in ``gone`` (rid); at most ``few`` numbers
    (8 bytes each) are broadcast, more are shuffled."""
    name = _number(docs)
    gone = freeze(gone.select(F.col("rid").alias(name)))
    side = F.broadcast(gone) if gone.count() <= few else gone
    return docs.join(side, name, "left_anti").drop(name)


def in_train(doc_id: str, folds: int) -> Column:
    """True where crc32 of the id as text leaves a remainder; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds != 0


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, NULL as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets): runs of whole texts of about ``limit`` bytes."""
    data, offsets = flat(texts)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers = np.ones(1, U64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 64, 2 * len(_powers)), BASE, dtype=U64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=U64)
    return _powers


def words(data: np.ndarray, offsets: np.ndarray):
    """(start, end, doc, hash) of every maximal run of bytes outside 0x20 and 0x09-0x0D.

    The hash is a polynomial of the word's bytes with its length, mixed, in 64 bits; runs end
    where a document ends.  No Python object is made for a word."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    n = len(data)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    first[edges] = solid[edges]
    start = np.flatnonzero(first)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64)
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    stop = np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return start, stop, doc, mix(_polynomials(data, start, stop - start) ^ mix((stop - start).astype(U64)))


def _polynomials(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each word's bytes, each plus one: one place at a time in all words that reach it, the longest words first; what
    is beyond ``SHORT`` bytes is added up by word."""
    power, short = powers(int(size.max())), np.minimum(size, SHORT).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    at, sums = start.take(order), np.zeros(len(start), U64)
    reach = len(start) - np.cumsum(np.bincount(short))
    for k, m in enumerate(reach[:-1]):
        sums[:m] += (data.take(at[:m] + k).astype(U64) + U64(1)) * power[k]
    total = np.empty_like(sums)
    total[order] = sums
    rest = np.flatnonzero(size > SHORT)
    if len(rest):
        n = size[rest] - SHORT
        first = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(first, n) + SHORT
        total[rest] += np.add.reduceat((data[np.repeat(start[rest], n) + place].astype(U64) + U64(1)) * power[place], first)
    return total


def spans_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)

"""Read the array of a large JSON envelope in many tasks.

An envelope is an object with a few header fields and one long array of objects, often a
single line.  Spark's text reader cuts a file into splits and, with ``}`` as line
separator, gives fragments of it in order; what a fragment means depends on
whether it starts inside a string and how deep.  So the file is read twice:

1. Every split is summed up for both cases, start outside or inside a string: whether the
   number of quotes is odd, how depth changes, and which container was opened last on each level.
   Quotes and brackets are told from those inside strings, and escapes are skipped.  Folding the
   summaries from left to right gives the state each split starts in.
2. Knowing that, tasks cut out the objects of the array.  One that crosses a split comes in pieces, at most two a
   split, which are put together in Spark.  Objects are numbered in file order, and parsed by
   ``from_json`` with an explicit schema.  What is outside the array is the header.

Several files, or several envelopes in a file, count as one in the order of their names and places.
Driver and closures hold one row per split; nothing holds the array.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumora.plans.freeze import freeze

_TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)
_SUMMARY = ("file string, block long, odd boolean, outside int, inside int, opened string, bytes long, size long, blank boolean")
_PIECE = "file string, block long, seq long, kind int, text string"
_WHOLE, _OPEN, _MORE, _HEADER = range(4)


class BrokenEnvelope(ValueError):
    """The text is not a complete envelope."""


@dataclass
class _Summary:
    """A split under both assumptions; ``depth[0]`` and ``opened[0]`` if it starts outside a string, [1] if inside."""

    odd: int = 0
    bytes: int = 0
    size: int = 0
    blank: bool = True

    def __post_init__(self) -> None:
        self.depth = [0, 0]
        self.opened: tuple[dict, dict] = ({}, {})

    def add(self, text: str, size: int) -> None:
        self.bytes += len(text.encode())
        self.size = size
        self.blank = not text[:-1].strip()
        before = last = -1
        odd, depth = self.odd, self.depth
        for m in _TOKEN.finditer(text):
            c = m.group()
            if c == '"':
                odd ^= 1
                before, last = last, m.start()
            elif c in "{[":
                # outside a string under one assumption, inside under the other
                key = text[before + 1:last] if before >= 0 else None
                self.opened[odd][depth[odd]] = (c, key)
                depth[odd] += 1
            elif c in "}]":
                depth[odd] -= 1
        self.odd = odd


def _by_split(batches, start, each, end):
    """Run ``each(state, text, size)`` over the fragments of every split; ``start(file, block)`` makes its state."""
    key, state = None, None
    for batch in batches:
        for file, block, size, text in zip(*[c.to_pylist() for c in batch.columns]):
            if (file, block) != key:
                if key is not None:
                    yield end(key, state)
                key, state = (file, block), start(file, block)
            each(state, text + "}", size)
    if key is not None:
        yield end(key, state)


def _summaries(batches):
    import pyarrow as pa

    def end(key, s):
        opened = json.dumps([{str(k): v for k, v in o.items()} for o in s.opened])
        return (*key, bool(s.odd), s.depth[0], s.depth[1], opened, s.bytes, s.size, s.blank)

    rows = list(_by_split(batches, lambda file, block: _Summary(), _Summary.add, end))
    names = [f.split()[0] for f in _SUMMARY.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _starts(rows) -> dict[tuple[str, int], tuple[int, int, tuple | None]]:
    """(in string, depth, container on level 1) at the start of every split."""
    out, file, state = {}, None, (0, 0, None)
    ends: dict[str, tuple] = {}
    lengths: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            file, state = r["file"], (0, 0, None)
        inside, depth, container = state
        out[file, r["block"]] = state
        opened = json.loads(r["opened"])[inside].get(str(1 - depth))
        container = tuple(opened) if opened else container
        depth += r["inside"] if inside else r["outside"]
        state = (inside ^ r["odd"], depth, container)
        ends[file] = (state, r["blank"])
        seen = lengths.setdefault(file, [0, r["size"]])
        seen[0] += r["bytes"]
    for file, ((inside, depth, _), blank) in ends.items():
        read, size = lengths[file]
        # the separator added to a blank last fragment closes nothing
        if inside or depth != (-1 if blank and read > size else 0) or (read > size and not blank):
            raise BrokenEnvelope(f"malformed: {file} ends within its text")
    return out


class _Cutter:
    """Cuts the objects of ``array`` out of a split's fragments."""

    def __init__(self, array: str, state: tuple[int, int, tuple | None]) -> None:
        self.array = array
        self.inside, self.depth, self.container = state
        self.started = 0                    # objects that start in this split
        self.rows: list[tuple[int, int, str]] = []
        self.within = self._wanted() and self.depth >= 2
        self.held: list[str] | None = [] if self.within and self.depth >= 3 else None
        self.carried = self.held is not None
        self.header: list[str] = []

    def _wanted(self) -> bool:
        return self.container is not None and tuple(self.container) == ("[", self.array)

    def add(self, text: str, size: int) -> None:
        if self.depth == 0 and not text[:-1].strip():
            return                          # after the end of the last envelope
        before = last = -1
        mark = 0                            # from here on text belongs to the object or the header
        for m in _TOKEN.finditer(text):
            c = m.group()
            if c == '"':
                self.inside ^= 1
                before, last = last, m.start()
            elif self.inside or c[0] == "\\":
                continue
            elif c in "{[":
                if self.depth == 1:
                    self.container = (c, text[before + 1:last] if before >= 0 else None)
                    if self._wanted():
                        self.header.append(text[mark:m.end()])
                        self.within, mark = True, m.end()
                elif self.depth == 2 and self.within:
                    self._between(text[mark:m.start()])
                    if c != "{":
                        raise BrokenEnvelope(f"{self.array} holds something other than objects")
                    self.held, mark = [], m.start()
                self.depth += 1
            else:
                self.depth -= 1
                if self.within and self.depth == 2:
                    self.held.append(text[mark:m.end()])
                    whole = "".join(self.held)
                    if self.carried:
                        self.rows.append((-1, _MORE, whole))
                        self.carried = False
                    else:
                        self.rows.append((self.started, _WHOLE, whole))
                        self.started += 1
                    self.held, mark = None, m.end()
                elif self.within and self.depth == 1:
                    self._between(text[mark:m.start()])
                    self.within, mark = False, m.start()
        if self.held is not None:
            self.held.append(text[mark:])
        elif self.within:
            self._between(text[mark:])
        else:
            self.header.append(text[mark:])

    def _between(self, text: str) -> None:
        if text.strip(", \t\r\n"):
            raise BrokenEnvelope(f"{self.array} holds something other than objects")

    def end(self) -> list[tuple[int, int, str]]:
        if self.held is not None:
            self.rows.append((-1, _MORE, "".join(self.held)) if self.carried else (self.started, _OPEN, "".join(self.held)))
        if self.header:
            self.rows.append((-2, _HEADER, "".join(self.header)))
        return self.rows


def read_array(spark: SparkSession, path: str, array: str, element: T.StructType, header: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(objects of ``array`` with their ``pos`` in file order, header rows): of one or more envelopes.

    Runs jobs when called: the file is read twice, and the objects' texts are written once."""
    fragments = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), "value")
    starts = _starts(fragments.mapInArrow(_summaries, _SUMMARY).collect())
    if not starts:
        raise BrokenEnvelope(f"malformed: {path} is empty")

    def cut(batches):
        import pyarrow as pa

        def end(key, cutter):
            return [(*key, *row) for row in cutter.end()]

        for rows in _by_split(batches, lambda file, block: _Cutter(array, starts[file, block]), _Cutter.add, end):
            for at in range(0, len(rows), 10_000):
                columns = list(zip(*rows[at:at + 10_000]))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _PIECE.split(", ")])

    pieces = freeze(fragments.mapInArrow(cut, _PIECE))
    # objects in more than one split: each piece belongs to the last one opened before it
    order = Window.partitionBy("file").orderBy("block", "seq")
    opened = F.last(F.when(F.col("kind") == _OPEN, F.col("block")), ignorenulls=True).over(order)
    apart = pieces.filter(F.col("kind").isin(_OPEN, _MORE)).withColumn("owner", F.when(F.col("kind") == _OPEN, F.col("block")).otherwise(opened))
    joined = (apart.groupBy("file", F.col("owner").alias("block"))
              .agg(F.max("seq").alias("seq"), F.sort_array(F.collect_list(F.struct("block", "seq", "text"))).alias("parts")))
    joined = joined.select("file", "block", "seq", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    found = pieces.filter(F.col("kind") == _WHOLE).select("file", "block", "seq", "text").unionByName(joined)
    # numbers in file order: a running count over the splits
    counts = pieces.filter(F.col("kind").isin(_WHOLE, _OPEN)).groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = freeze(counts.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    parsed = F.from_json("text", element, {"mode": "FAILFAST"})
    rows = found.join(offsets, ["file", "block"]).select((F.col("before") + F.col("seq")).cast("long").alias("pos"), parsed.alias("e"))
    return rows.select("pos", "e.*"), _header(spark, pieces, header)


def _header(spark: SparkSession, pieces: DataFrame, schema: T.StructType) -> DataFrame:
    texts = pieces.filter(F.col("kind") == _HEADER).orderBy("file", "block").select("file", "text").collect()
    by_file: dict[str, str] = {}
    for r in texts:
        by_file[r["file"]] = by_file.get(r["file"], "") + r["text"]
    documents, decoder = [], json.JSONDecoder()
    for text in by_file.values():
        rest = text.strip()
        while rest:
            try:
                _, end = decoder.raw_decode(rest)
            except ValueError as error:
                raise BrokenEnvelope(f"malformed header: {error}") from error
            documents.append((len(documents), rest[:end]))
            rest = rest[end:].strip()
    raw = spark.createDataFrame(documents, "part int, text string")
    return raw.select("part", F.from_json("text", schema, {"mode": "FAILFAST"}).alias("h")).select("part", "h.*")

"""Small numpy helpers that run inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CELLS = 2_000_000      # score cells held at once: 16 MB of doubles


def equal_length_blocks(column: pa.Array, max_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Split a list column into (row numbers, float64 matrix) of one vector length.

    NULL vectors come out as length zero.  The usual column, all vectors of one
    length and none NULL, is reshaped without a copy per row.
    """
    lengths = np.asarray(
        pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for at in range(0, len(rows), max_rows):
            part = rows[at:at + max_rows]
            if length == 0:
                yield part, np.zeros((len(part), 0))
            elif len(rows) == len(lengths):
                first = starts[part[0]]
                flat = values[first:first + len(part) * length]
                yield part, flat.reshape(len(part), length).astype(np.float64)
            else:
                yield part, values[starts[part][:, None] + np.arange(length)].astype(np.float64)


def map_vectors(column: pa.Array, fn) -> pa.Array:
    """``fn`` over matrices of equal-length vectors; lengths and NULLs stay as they are."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0)
    for rows, x in equal_length_blocks(column, 65_536):
        if x.shape[1] and rows[-1] - rows[0] + 1 == len(rows):      # neighbours: one slice
            out[ends[rows[0]] - x.shape[1]:ends[rows[-1]]] = fn(x).ravel()
        elif x.shape[1]:
            at = (ends[rows] - x.shape[1])[:, None] + np.arange(x.shape[1])
            out[at] = fn(x)
    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(out), mask=column.is_null())


def sequential_dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """All dot products of rows of ``x`` and ``q``, each summed left to right.

    The order is fixed so equal vectors score equally in every batch, partition
    and engine; BLAS gives no such promise.  Lengths are cut to the shorter one.
    """
    d = min(x.shape[1], q.shape[1])
    out = np.zeros((x.shape[0], q.shape[0]))
    columns = np.ascontiguousarray(x[:, :d].T)
    for j in range(d):
        out += np.multiply.outer(columns[j], q[:, j])
    return out


def paired_dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Dot products of matching rows, summed left to right."""
    d = min(x.shape[1], q.shape[1])
    out = np.zeros(x.shape[0])
    for j in range(d):
        out += x[:, j] * q[:, j]
    return out


def list_array(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as an Arrow list column."""
    n, d = matrix.shape
    offsets = pa.array(np.arange(0, n * d + 1, d, dtype=np.int32) if d
                       else np.zeros(n + 1, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


class QueryVectors:
    """A bounded set of query vectors, grouped by length."""

    def __init__(self, qids, vectors, excludes=None):
        self.qids = np.asarray(qids, dtype=np.int64)
        vectors = [np.asarray(v if v is not None else [], dtype=np.float64) for v in vectors]
        lengths = np.array([len(v) for v in vectors], dtype=np.int64)
        self.groups = []
        for length in np.unique(lengths):
            index = np.flatnonzero(lengths == length)
            self.groups.append(
                (index, np.array([vectors[i] for i in index]).reshape(len(index), length)))
        self.excludes = None if excludes is None else np.array(
            [np.iinfo(np.int64).min if e is None else e for e in excludes], dtype=np.int64)
        self.has_exclude = None if excludes is None else np.array(
            [e is not None for e in excludes], dtype=bool)

    def __len__(self) -> int:
        return len(self.qids)

    @property
    def block_rows(self) -> int:
        return max(1, min(65_536, _CELLS // max(1, len(self))))

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((x.shape[0], len(self)))
        for index, q in self.groups:
            out[:, index] = sequential_dots(x, q)
        return out


class TopK:
    """Running best ``k`` rows per query: score descending, position ascending.

    Wide query sets are screened with one matrix product per block; whatever may
    reach the current k-th score, allowing for the product's rounding, is scored
    again in sequential order.  The result therefore equals full scoring.
    """

    SCREEN_FROM = 8     # queries; below this sequential scoring is as fast

    def __init__(self, queries: QueryVectors, k: int):
        self.queries, self.k = queries, k
        self.floor = np.full(len(queries), -np.inf)
        none = np.zeros(0, dtype=np.int64)
        self.q, self.id, self.pos, self.score = none, none, none, np.zeros(0)

    def update(self, ids: np.ndarray, pos: np.ndarray, vectors: pa.Array) -> None:
        for rows, x in equal_length_blocks(vectors, self.queries.block_rows):
            for index, q in self.queries.groups:
                self._block(ids[rows], pos[rows], x, index, q)

    def _block(self, ids, pos, x, index, q) -> None:
        d = min(x.shape[1], q.shape[1])
        screened = len(index) >= self.SCREEN_FROM and d > 0
        with np.errstate(invalid="ignore", over="ignore"):
            if screened:
                s = x[:, :d] @ q[:, :d].T
                scale = np.sqrt((x[:, :d] ** 2).sum(1).max() * (q[:, :d] ** 2).sum(1))
                slack = 8.0 * d * np.finfo(np.float64).eps * scale
                slack = np.where(np.isfinite(slack), slack, np.inf)
            else:
                s = sequential_dots(x, q)
                slack = np.zeros(len(index))
        s[np.isnan(s)] = -np.inf
        skip = None
        if self.queries.excludes is not None:
            skip = (ids[:, None] == self.queries.excludes[index]) & self.queries.has_exclude[index]
            s[skip] = -np.inf
        floor = self.floor[index]
        if len(ids) > self.k:
            kth = np.partition(s, len(ids) - self.k, axis=0)[len(ids) - self.k]
            floor = np.maximum(floor, kth - slack)
        floor = floor - slack
        keep = s >= np.where(np.isnan(floor), -np.inf, floor)
        if skip is not None:
            keep &= ~skip
        r, c = np.nonzero(keep)
        if screened:
            score = np.empty(len(r))
            step = max(1, _CELLS // d)
            for at in range(0, len(r), step):
                part = slice(at, at + step)
                score[part] = paired_dots(x[r[part]], q[c[part]])
            score[np.isnan(score)] = -np.inf
        else:
            score = s[r, c]
        self._merge(index[c], ids[r], pos[r], score)

    def _merge(self, q, ids, pos, score) -> None:
        q = np.concatenate((self.q, q))
        ids = np.concatenate((self.id, ids))
        pos = np.concatenate((self.pos, pos))
        score = np.concatenate((self.score, score))
        order = np.lexsort((ids, pos, -score, q))
        q, ids, pos, score = q[order], ids[order], pos[order], score[order]
        first = np.searchsorted(q, q)           # q is sorted: start of each group
        place = np.arange(len(q)) - first
        keep = place < self.k
        self.q, self.id, self.pos, self.score = q[keep], ids[keep], pos[keep], score[keep]
        last = np.flatnonzero(place[keep] == self.k - 1)
        self.floor[self.q[last]] = self.score[last]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.queries.qids[self.q]), pa.array(self.id), pa.array(self.pos),
             pa.array(self.score, mask=np.isneginf(self.score))],
            names=["qid", "id", "pos", "score"])

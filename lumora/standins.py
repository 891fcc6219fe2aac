"""Deterministic encoders for tests and demonstrations, in place of a real model.

They have no idea what a text or an image means; retrieval quality measured with them
says nothing about any model.
"""

from __future__ import annotations

import hashlib

import numpy as np

from lumora.operators.embed import Encoder

_CACHE = 200_000


class _Slots(dict):
    """Word to 2 * slot + (1 if it counts negatively), remembered for frequent words."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        h = hashlib.md5(word.encode()).digest()
        code = 2 * (h[0] % self.dim) + (h[1] >= 128)
        if len(self) < _CACHE:
            self[word] = code
        return code


def _word_counts(dim: int):
    slots = _Slots(dim)

    def run(texts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, text in enumerate(texts):
            codes = [slots[w] for w in (text or "").split(" ") if w]
            counts = np.bincount(np.array(codes, dtype=np.int64), minlength=2 * dim)
            out[i] = counts[::2] - counts[1::2]
        return out

    return run


def word_hash(dim: int = 64) -> Encoder:
    """Signed counts of words between single spaces, by the MD5 of the word."""
    return Encoder("word-hash", "float32", dim, lambda: _word_counts(dim))


def _byte_counts(dim: int):
    def run(payloads: np.ndarray) -> np.ndarray:
        out = np.zeros((len(payloads), dim), dtype=np.float32)
        for i, payload in enumerate(payloads):
            if payload:
                out[i] = np.bincount(np.frombuffer(payload, np.uint8) % dim, minlength=dim)
            else:
                out[i] = np.nan
        return out

    return run


def byte_histogram(dim: int = 64) -> Encoder:
    """Counts of byte values modulo ``dim``; an empty payload cannot be decoded."""
    return Encoder("byte-histogram", "float32", dim, lambda: _byte_counts(dim))

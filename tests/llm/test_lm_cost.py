"""The faster ways of the language model, against slow ones."""

import time

import numpy as np
import pyarrow as pa
import pytest

from lumora.llm import lm_score
from lumora.llm.common import U64, mix, powers, words


def best(f, times=7):
    """The least CPU time of some runs."""
    taken = []
    for _ in range(times):
        began = time.process_time()
        f()
        taken.append(time.process_time() - began)
    return min(taken)


def text(n, seed=4):
    r = np.random.default_rng(seed)
    return np.frombuffer(b" ".join(bytes(r.integers(97, 123, k).astype(np.uint8)) for k in r.integers(1, 11, n)), np.uint8)


def hashed_by_byte(data, offsets):
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = solid[edges]
    start = np.flatnonzero(first)
    stop = np.append(start[1:], len(data))
    filled = np.add.reduceat(solid, start, dtype=np.int64)
    at = np.arange(len(data))
    at[:start[0]] = 0
    at[start[0]:] -= np.repeat(start, stop - start)
    values = (data.astype(U64) + U64(1)) * powers(int((stop - start).max()) + 1)[at]
    values[~solid] = 0
    return start, start + filled, mix(np.add.reduceat(values, start) ^ mix(filled.astype(U64)))


def test_words_are_hashed_as_byte_by_byte_in_less_time():
    odd = b"a " + b"x" * 63 + b"\t" + b"x" * 64 + b"\n" + b"x" * 65 + b"\xff\xff " + b"y" * 70_000 + b"z"
    for data, offsets in ((np.frombuffer(odd, np.uint8), np.array([0, 1, 1, 40, len(odd)])), (text(40_000), np.array([0, 7, 90_000, len(text(40_000))]))):
        start, stop, _, h = words(data, offsets)
        for got, want in zip((start, stop, h), hashed_by_byte(data, offsets)):
            assert np.array_equal(got, want)
    assert best(lambda: words(data, offsets)) < 0.9 * best(lambda: hashed_by_byte(data, offsets))


def test_frequent_tokens_are_found_as_by_binary_search_in_less_time():
    r = np.random.default_rng(5)
    head = np.unique(np.concatenate([r.integers(0, 2 ** 64, 100_000, U64), np.array([0, 2 ** 64 - 1], U64)]))
    h = np.concatenate([r.permutation(head), r.integers(0, 2 ** 64, 150_000, U64), np.array([1, 2 ** 64 - 2], U64)])
    for some in (head, head[1:-1], head[:1], head[-1:]):
        own = np.where(np.arange(len(some)) % 3 == 0, np.arange(len(some)), -1)
        known = lm_score.Vocabulary(1, len(some), some, np.ones(len(some)), own, np.zeros(256), np.ones(256) / 256, 128, np.zeros(0, int), np.zeros(0))
        code, at = known.look_up(h, np.zeros(len(h), int))
        want = np.minimum(np.searchsorted(some, h), len(some) - 1)
        hit = some[want] == h
        assert np.array_equal(at, np.where(hit, want, -1))
        assert np.array_equal(code, np.where(hit & (own[want] >= 0), own[want], 128))
        if len(some) == len(head):
            assert best(lambda: known.look_up(h, np.zeros(len(h), int))) < 0.9 * best(lambda: np.searchsorted(some, h))


@pytest.mark.parametrize("kind", [np.uint16, np.int32])
def test_codes_are_written_as_bytes(kind):
    size, codes = np.array([3, 0, 1, 2]), np.arange(6).astype(kind)
    column = lm_score._packed(size, codes)
    assert column.type == pa.binary() and len(column[0].as_py()) == 3 * codes.itemsize
    got, sizes = lm_score._sequence(column, kind, 9)
    assert list(sizes) == list(size) and list(got) == [9] * 4 + [0, 1, 2] + [9] * 8 + [3] + [9] * 4 + [4, 5]
    got, sizes = lm_score._sequence(column.slice(2, 2), kind, 9)
    assert list(sizes) == [1, 2] and list(got) == [9] * 4 + [3] + [9] * 4 + [4, 5]


def model_of(scale=0.5):
    model, r = lm_score.LogBilinear(np.array([0.4, 0.3, 0.2, 0.1]), np.array([2, 2, 3]), np.array([5.0, 2.0, 3.0]), np.full(4, 1.0)), np.random.default_rng(6)
    return model.load(r.normal(0, scale, len(model.flat())))


def slow_step(model, codes, random):
    """The parameters after a step, token by token."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    g = {k: np.zeros_like(v) for k, v in p.items()}
    other = np.searchsorted(model.up_to, random.random(lm_score.NOISE)).clip(0, 3)
    tokens = [(row[i - 4:i][::-1], row[i]) for row in codes for i in range(4, len(row))]
    inside = [c for _, c in tokens if model.place[c] >= 0]
    drawn = dict(enumerate(random.random((len(inside), 1))[:, 0]))
    n, met = sum(c < model.start for _, c in tokens), 0
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for context, c in tokens:
        r, dr = sum(p["R"][x] * d for x, d in zip(context, p["D"])), np.zeros(lm_score.VECTOR)
        cls = model.top[c]
        for j, real in [(cls, 1), *((j, 0) for j in other)] if c < model.start else []:
            e = sigmoid(p["Q"][j] @ r + p["b"][j] - model.log_k[j]) - real
            dr += e * p["Q"][j]
            g["Q"][j] += e * r / n
            g["b"][j] += e / n
        if model.place[c] >= 0:
            noise = int(np.searchsorted(model.inner_up_to, model.order[cls] + drawn[met]))
            noise = min(max(noise, model.first[cls]), model.first[cls] + model.width[cls] - 1)
            met += 1
            for j, real in ((model.place[c], 1), (noise, 0)):
                e = sigmoid(p["S"][j, :-1] @ r + p["S"][j, -1] - model.inner_log_k[j]) - real
                dr += e * p["S"][j, :-1]
                g["S"][j] += e * np.append(r, 1) * lm_score.INNER_WEIGHT
        for k, x in enumerate(context):
            g["D"][k] += dr * p["R"][x] / n
            g["R"][x] += dr * p["D"][k] * (1 / n if x < 4 or x == model.start else lm_score.INNER_WEIGHT)
    square = {k: model.square[k] + g[k] ** 2 for k in g}
    return {k: p[k] - lm_score.RATE * g[k] / np.sqrt(square[k]) for k in p}


def test_a_step_equals_a_slow_one():
    r = np.random.default_rng(7)
    model = model_of()
    for _ in range(3):
        codes = r.integers(0, model.start + 1, (5, 24)).astype(np.int32)
        want = slow_step(model, codes, np.random.default_rng(8))
        model.step(codes, np.random.default_rng(8))
        for k, v in want.items():
            assert np.allclose(model.p[k], v, atol=2e-4), k


@pytest.mark.parametrize("scale", [0.5, 4, 8])
def test_scores_of_any_size_are_normalised(scale):
    """Also where powers of the scores would be beyond what a float holds."""
    model, r = model_of(scale), np.random.default_rng(9)
    codes = np.concatenate([np.full(4, model.start), r.integers(0, model.start, 1500)])
    got, p = model.log10_along(codes), {k: v.astype(np.float64) for k, v in model.p.items()}

    def share(z, i):
        return (z[i] - z.max() - np.log(np.exp(z - z.max()).sum())) / np.log(10)

    for i in range(4, len(codes), 7):
        v, c = sum(p["R"][codes[i - 1 - k]] * p["D"][k] for k in range(4)), model.top[codes[i]]
        want = share(p["Q"] @ v + p["b"], c)
        if model.width[c]:
            places = slice(model.first[c], model.first[c] + model.width[c])
            want += share(p["S"][places, :-1] @ v + p["S"][places, -1], model.place[codes[i]] - model.first[c])
        assert abs(got[i - 4] - want) < 2e-5 * max(1, scale ** 3)

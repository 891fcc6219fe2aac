"""Near-duplicates and decontamination against brute force."""

import pickle
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from data import awkward as rows_of, frame, near_components, prose

from lumora.llm import decontaminate, minhash
from lumora.llm.components import components


def family(seed, n, words, edits):
    """Copies of one text, each with some words replaced."""
    r, base, out = random.Random(seed), prose(seed, words).split(), []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check(got, rows, width, percent):
    texts = [t for _, t in rows]
    component, sets = near_components(texts, width, percent)
    rank = [(i is None, i if i is not None else 0) for i, _ in rows]
    least = {}
    for k, c in enumerate(component):
        least[c] = min(least.get(c, (True, 0)), rank[k])
    # rows with equal sets are one node, whose rows are linked; empty sets are linked with nothing
    want = sorted((rank[k], len(sets[k]), least[c][1] if not least[c][0] else None) for k, c in enumerate(component))
    have = sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id) for r in got)
    assert [repr(x) for x in have] == [repr(x) for x in want]
    assert all(r.component_id == r.doc_id for r in got if r.kept)


@pytest.mark.parametrize("width,percent,small,held", [(3, 85, 4, 4096), (5, 80, 1, 3)])
def test_near_duplicates(spark, monkeypatch, width, percent, small, held):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "HELD", held)
    rows = rows_of()
    # families whose copies are just above and just below the threshold, and one of many copies
    for seed, (n, words, edits) in enumerate([(40, 150, 6), (60, 300, 9), (12, 40, 2), (150, 120, 1)], start=50):
        rows += [(seed * 1000 + k, t) for k, t in enumerate(family(seed, n, words, edits))]
    shared = prose(77, 400)
    rows += [(200_000 + k, shared + " " + prose(1000 + k, 120)) for k in range(40)]
    got = minhash.near_duplicates(frame(spark, rows).repartition(4), width=width, percent=percent).collect()
    check(got, rows, width, percent)
    kept = [r for r in got if r.kept]
    assert len({(r.component_id if r.component_id is not None else ("none", r.rid)) for r in kept}) == len(kept)


def test_no_documents(nothing):
    assert minhash.near_duplicates(nothing).count() == 0


def test_tables_for_the_threshold():
    for similarity in (0.8, 0.85, 0.95):
        m = minhash.keys_a_side(similarity)
        assert 1 - (1 - (1 - similarity**minhash.HALF) ** m) ** 2 <= minhash.MISS


def test_minhashes_estimate_similarity():
    a, b = np.unique(minhash.mix(np.arange(3000, dtype=np.uint64))), np.unique(minhash.mix(np.arange(600, 3600, dtype=np.uint64)))
    s = minhash.signatures(np.array([0, 3000, 6000]), np.concatenate([a, b]), 256)
    assert abs((s[0] == s[1]).mean() - 2400 / 3600) < 0.12


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(200, 201 + k) for k in range(50)] + [(400 + r.randrange(60), 400 + r.randrange(60)) for _ in range(50)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {x.u: x.label for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}


def sellers(item, text):
    """Least edit distance of item to any part of text."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item, start=1):
        new = np.empty_like(row)
        new[0] = i
        for j, d in enumerate(text, start=1):
            new[j] = min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def edited(r, text, n):
    t = bytearray(text)
    for _ in range(n):
        at, kind = r.randrange(len(t)), r.randrange(3)
        t[at:at + (kind != 1)] = [] if kind == 2 else [r.choice(b"abcdefgh")]
    return bytes(t)


def test_distance():
    r = random.Random(6)
    for _ in range(60):
        item = prose(r.random(), 8).encode()
        text = prose(r.random(), 6).encode() + b" " + edited(r, item, r.randrange(8)) + b" " + prose(r.random(), 5).encode()
        assert decontaminate.distance(item, text, 99) == sellers(item, text)


def test_find_items(spark, awkward, nothing):
    r = random.Random(8)
    items = [(k, prose(300 + k, r.randint(15, 40))) for k in range(12)] + [(12, None), (13, "short"), (14, prose(300, 20).upper())]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, used = rows_of(), [(k, decontaminate.normal_text(t or "")) for k, t in items]
    used = [(k, t) for k, t in used if len(t) >= 2 * decontaminate.SEED]
    for n in range(90):
        k, t = used[n % len(used)]
        most = decontaminate.edits(len(t))
        noisy = edited(r, t, (0, 1, most // 2, most, most + 3, 3 * most + 9)[n % 6]).decode("utf-8", "replace")
        rows.append((10_000 + n, f"{prose(n, 20)}. {noisy.title() if n % 2 else noisy}! {prose(n + 1, 20)}"))
    got = {(x.doc_id, h.item_id): h.distance for x in
           decontaminate.find_items(frame(spark, rows), benchmark).collect() for h in x.hits}
    want = {}
    for i, t in rows:
        if t and len(t) < 3000:
            body = decontaminate.normal_text(t)
            for k, item in used:
                d = decontaminate.distance(item, body, decontaminate.edits(len(item)))
                if d <= decontaminate.edits(len(item)):
                    want[i, k] = d
    assert set(got) <= set(want) and len(want) > 45
    assert len(set(want) - set(got)) <= 1          # recall is a chance close to 1
    assert all(d == want[x] for x, d in got.items())
    assert [len(x.hits) for x in decontaminate.find_items(awkward, benchmark.limit(0)).collect()] == [0] * len(rows_of())
    assert decontaminate.find_items(nothing, benchmark).count() == 0
    blocks = decontaminate.find_items(frame(spark, rows), benchmark, block_items=4).collect()
    assert {(x.doc_id, h.item_id) for x in blocks for h in x.hits} >= {x for x, d in want.items() if d == 0}


def test_windows_cut_at_the_ends():
    item = prose(1, 30)
    block = decontaminate.Block([(1, item)])
    found = block.search(pa.array([item, item[3:], item[:-3], "", None, "x", prose(2, 30)]))
    assert {k: v for k, v in found.items()} == {0: {0: 0}, 1: {0: 3}, 2: {0: 3}}


def test_short_items_are_found_verbatim(spark):
    items = [(1, "2 + 2 = 4 today?"), (2, "今天天气很好"), (3, "yes"), (4, "long live"), (5, "a very short one")]
    texts = ["so: 2+2=4, TODAY it is", "2 2 4 todayish", "我说今天天气很好。", "yes", "as long lived", "long-live the", "a very short on", None, ""]
    found = decontaminate.find_items(frame(spark, list(enumerate(texts))), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: [(h.item_id, h.distance) for h in r.hits] for r in found.collect()}
    assert got == {0: [(1, 0)], 1: [], 2: [(2, 0)], 3: [], 4: [], 5: [(4, 0)], 6: [], 7: [], 8: []}


def test_windows_meet_in_tables_by_length_and_exactly_beyond():
    """The tables alone keep nine of ten windows edited at the bound in every class of lengths; where
    they can't reach the target all are checked."""
    r = random.Random(12)
    items = [(k, prose(700 + k, n)) for k, n in enumerate([5, 6, 12, 13, 30, 31, 70, 71, 160])]
    block = decontaminate.Block(items)
    assert len(block.tables) >= 4
    for i, t in enumerate(block.texts):
        tables = block.tables[int(block.octave[i])]
        windows = {(n, i, 0): (edited(r, t, block.most[i])[:len(t)], 0) for n in range(40)}
        assert block._meets(sorted(windows), windows, tables).mean() >= 0.9
    strict = decontaminate.Block(items, recall=1.0, most_tables=8)
    assert set(strict.tables.values()) == {0}
    texts = [edited(r, t, block.most[k % len(items)] // 2).decode("utf-8", "replace") for k, t in enumerate(block.texts * 3)]
    want = {n: d for n, x in enumerate(texts) if (d := decontaminate.distance(
        block.texts[n % len(items)], decontaminate.normal_text(x), block.most[n % len(items)])) <= block.most[n % len(items)]}
    found = strict.search(pa.array(texts))
    assert {n: found[n][n % len(items)] for n in want} == want and len(want) > 20


def test_one_long_item_costs_little_memory():
    item = prose(9, 3500)
    assert len(item) > 20_000
    tracemalloc.start()
    block = decontaminate.Block([(1, item)])
    found = block.search(pa.array([prose(10, 50) + " " + item[:9000] + "x" + item[9003:] + " tail", item[1000:]]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {0: {0: 3}, 1: {0: 1000}} and peak < 50 << 20 and len(pickle.dumps(block)) < 10 << 20

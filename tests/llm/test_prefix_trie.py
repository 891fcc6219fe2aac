"""The prefix trie against brute force, with blocks so small that most nodes cross their edges."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumora.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:prefix_trie.DIGITS]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    turns = {c: [t[3] for t in sorted(x)] for c, x in own.items()}
    members, seqs = defaultdict(list), {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        seqs[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(seqs[c]) + 1):
            members[seqs[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(c for c in m if len(seqs[c]) == len(node))).encode()).hexdigest())
                  for node, m in members.items())


def built(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("__rid", "turns", "block", "key", "node", "h", "base", "bytes")})
    out = prefix_trie.prefix_trie(df.repartition(3))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in out.collect())


def conversations(n, seed, longest=6, words=2, hot=0.35):
    """Conversations with few different turns; a third of them are copies of one."""
    r, rows = random.Random(seed), []
    for c in range(n):
        turns = [("user", "hello"), ("assistant", "é" * 5), ("user", "")] if r.random() < hot else [
            (r.choice(["user", "assistant"]), "w" * r.randint(0, words)) for _ in range(r.randint(1, longest))]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("turns", [1_000_000, 40, 3])
def test_equals_brute_force(spark, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", turns)
    rows = conversations(90, turns)
    assert built(spark, rows) == brute(rows)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 8)
    rows = [(1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "x", None), (1, None, None, "y"), (2, 5, None, None),
            (2, -5, "", ""), (3, 1, "r", "t" * 10_000), (None, 0, "user", "lost"), (None, None, None, None), (-3, 0, "user", "a"), (-4, 0, "us", "era"),
            (0, 0, "user", "a"), (2**40, 0, "user", "a"), (2**40 + 1, 9, "user", "é🎉"), (7, 0, "a", "b")]
    rows += [(100 + i, 0, "user", "alone") for i in range(30)]      # those without base and with h > 0 become turnless
    rows += [(200, k, "user", str(k % 3)) for k in range(400)]      # a long one
    assert built(spark, rows) == brute(rows)
    assert any(n[1] == 0 and n[7] != hashlib.sha256(b"").hexdigest() for n in brute(rows))


def test_only_turnless_and_no_rows(spark):
    assert built(spark, []) == [] and built(spark, [(None, 1, "a", "b")]) == []
    lonely = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(lonely, 0, "user", "a")]
    assert built(spark, rows) == brute(rows) == [(lonely, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lonely).encode()).hexdigest())]


def test_range_minima():
    x = np.random.default_rng(0).integers(-1, 9, 200)
    m = prefix_trie.Minima(x)
    pairs = [(a, b) for a in range(0, 200, 3) for b in range(a, 200, 7)]
    low, high = (np.array(c) for c in zip(*pairs))
    assert m.over(low, high).tolist() == [x[a:b + 1].min() for a, b in pairs]
    p, d = np.repeat(np.arange(200), 10), np.tile(np.arange(10), 200)
    left, right = m.first_from(p, d), m.last_to(p, d)
    for k in range(0, len(p), 11):
        a = b = p[k]
        while a > 0 and x[a] >= d[k]:
            a -= 1
        while b < 199 and x[b + 1] >= d[k]:
            b += 1
        assert (left[k], right[k]) == (a, b)


def test_query_on_given_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in queries.op13_prefix_trie(spark, sf).collect()) == brute(rows)

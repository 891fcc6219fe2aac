"""Operators with exact results: dedup, sharding, token counts, BPE."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from data import SPACE, awkward as rows_of, frame, prose
from pyspark.sql import functions as F

from lumora.llm import bpe, exact_dedup, sharding, token_counts


def ordered(pairs):
    return sorted(pairs, key=repr)


@pytest.mark.parametrize("shard_digests", [3, 32_768])
def test_exact_dedup(awkward, shard_digests):
    got = exact_dedup.exact_dedup(awkward, shard_digests=shard_digests).collect()
    groups = collections.defaultdict(list)
    for i, t in rows_of():
        groups[re.sub(SPACE, " ", t or "")].append(i)
    want = []
    for t, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        want += [(i, least, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(want)
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("history", ["true", "false", "doc_id > 15"])
def test_any_history_gives_the_same_groups(awkward, history):
    key = lambda r: (r.doc_id, r.keep_id, r.group_size, r.kept)
    want = ordered(key(r) for r in exact_dedup.exact_dedup(awkward).collect())
    assert ordered(key(r) for r in exact_dedup.exact_dedup(awkward, F.expr(history)).collect()) == want


def test_perfect_hash():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    hashed = exact_dedup.PerfectHash(digests[:4000])
    assert sorted(hashed(digests[:4000])) == list(range(4000))
    assert hashed(digests[4000:]).max() < 4000
    assert len(exact_dedup.PerfectHash(digests[:0])(digests[:0])) == 0


def brute_shard(key, tree):
    def best(children):
        def draw(c):
            u = (int(hashlib.md5(f"{key}/{c[0]}".encode()).hexdigest()[:13], 16) + 1) / 16.0**13
            return np.log(u) / c[1]
        return max(range(len(children)), key=lambda i: draw(children[i]))
    weigh = lambda rack: sum(w for _, w in rack)
    i = best([(f"region{i}", sum(map(weigh, r))) for i, r in enumerate(tree.regions)])
    j = best([(f"region{i}/rack{j}", weigh(r)) for j, r in enumerate(tree.regions[i])])
    return tree.regions[i][j][best([(f"shard{s}", w) for s, w in tree.regions[i][j]])][0]


def test_sharding(spark, awkward):
    docs = awkward.unionByName(frame(spark, [(1000 + i, prose(i, 5)) for i in range(3000)]))
    got = sharding.shard_documents(docs).collect()
    tree = sharding.Tree.even()
    sizes = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows_of())
    assert len(got) == 3000 + len(rows_of())
    assert not sizes - collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.law == "key" and r.shard == brute_shard(key, tree)
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.grown_shard == 24 for r in got) / len(got)
    assert 0.02 < moved < 0.06


def test_a_weight_moves_only_its_own_subtree(spark):
    tree = sharding.Tree.even()
    region = tree.regions[0]
    heavy = sharding.Tree((((*region[0][:3], (3, 5.0)), region[1]), *tree.regions[1:]))
    df = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    rows = sharding.place(sharding.place(df, F.col("k"), tree, "a"), F.col("k"), heavy, "b").filter("a <> b").collect()
    assert rows
    for r in rows:      # into the region that grew; within it into the rack, and within that into the shard
        assert r.b < 8 if r.a >= 8 else r.b < 4 if r.a >= 4 else r.b == 3


def test_even_slots_with_one_id_on_a_third_of_rows(spark):
    docs = frame(spark, [(5, "same")] * 400 + [(i, "t") for i in range(100, 900)])
    got = sharding.shard_documents(docs).collect()
    one = [r for r in got if r.doc_id == 5]
    assert len({r.shard for r in one}) == 1 and len({r.slot for r in one}) == 400


@pytest.mark.parametrize("operator", [exact_dedup.exact_dedup, sharding.shard_documents])
def test_nothing(nothing, operator):
    assert operator(nothing).count() == 0


def library(vocabulary):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary)
    t.no_truncation()
    t.no_padding()
    return t


def test_token_counts(spark, awkward, nothing, vocabulary):
    t = library(vocabulary)
    got = token_counts.count_tokens(awkward, vocabulary, limit=20).collect()
    want = [(i, len((x or "").encode()), n, n > 20) for i, x in rows_of() for n in [len(t.encode(x or "", add_special_tokens=False))]]
    assert ordered(tuple(r) for r in got) == ordered(want)
    assert token_counts.count_tokens(nothing, vocabulary).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_of_tokenizers_that_keep_white_space(name):
    from lumora.llm.queries import tokenizer
    texts = ["", "a  b\n c", prose(1, 50), "don't <s> é"]
    path = tokenizer(name)
    counter = token_counts.Counter(path)
    assert not counter.split
    if name.endswith(".model"):
        import sentencepiece
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        want = [len(x) for x in library(path).encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts) == want


def test_counts_do_not_depend_on_memory(monkeypatch, vocabulary):
    texts = [prose(i, 80) for i in range(30)]
    want = token_counts.Counter(vocabulary).count(texts)
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    monkeypatch.setattr(token_counts, "GROUP_BYTES", 300)
    monkeypatch.setattr(token_counts, "REST", 7)
    assert token_counts.Counter(vocabulary).count(texts) == want


def test_bpe(awkward, nothing, vocabulary):
    t = library(vocabulary)
    got = bpe.encode_decode(awkward, vocabulary, keep_texts=True).collect()
    want = []
    for i, x in rows_of():
        ids = t.encode(x or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest(), ids, text))
    assert ordered(tuple(r) for r in got) == ordered(want)
    assert bpe.encode_decode(nothing, vocabulary).count() == 0


def test_bpe_on_all_low_characters_and_random_words(vocabulary):
    import random
    r = random.Random(0)
    texts = [f"a{chr(i)}b {chr(i)}{chr(i + 1)} 1{chr(i)}2" for i in range(0x600)]
    texts += ["".join(r.choice("aeinorst") for _ in range(r.randint(1, 90))) for _ in range(2000)]
    texts += ["a" * n for n in range(1, 60)] + ["ΑΣ́ <|startoftext|><|endoftext|>", "<| x <|endoftext|"]
    t, codec = library(vocabulary), bpe.Codec(vocabulary)
    for x, ids in zip(texts, codec.encode_texts(texts)):
        want = t.encode(x, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), x
        assert codec.decode(ids) == t.decode(want, skip_special_tokens=False)


def test_both_encoders_of_the_automaton_agree(vocabulary):
    codec = bpe.Codec(vocabulary)
    words = [w.encode() for w in set(prose(9, 3000).split())] + [bytes([b]) * n for b in range(256) for n in (1, 3)]
    assert [codec.automaton.encode(w) for w in words] == codec.automaton.encode_many(words)


def test_automaton_accepts_only_correct_tokenizations():
    """On a small alphabet: every token sequence the automaton accepts is what applying merges in order gives."""
    import itertools
    symbols = bpe.byte_symbols()
    merges = [("a", "a"), ("a", "b"), ("aa", "ab"), ("b", "a</w>"), ("aa", "a</w>")]
    names = symbols + [s + "</w>" for s in symbols] + [x + y for x, y in merges]
    a = bpe.Automaton({t: i for i, t in enumerate(names)}, merges, "</w>")
    for n in range(1, 8):
        for word in itertools.product("ab", repeat=n):
            seq = [*word[:-1], word[-1] + "</w>"]
            for x, y in merges:
                out, i = [], 0
                while i < len(seq):
                    both = seq[i:i + 2] == [x, y]
                    out.append(x + y if both else seq[i])
                    i += 2 if both else 1
                seq = out
            assert [names[t] for t in a.encode("".join(word).encode())] == seq
            assert a.emit(a.encode_many(["".join(word).encode()])[0]) == seq

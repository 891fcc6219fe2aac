"""Operators with a trained model: rules against brute force, models by what they must do on held-out rows."""

import collections
import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from data import awkward as rows_of, frame, prose, tokens

from lumora.llm import lm_score, pii, quality, secret_scan
from lumora.llm.common import flat, spans_text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def digits(t):
    return re.sub("[^0-9]", "", t)


def brute_pii(t):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def brute_secrets(t):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, t, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def test_rules_on_random_strings():
    r = random.Random(1)
    parts = ["1", "25", "300", ".", ".", ".", "@", "a", "bc-", "+", " ", "-", "(", ")", "é", "\n", "_%", "4111111111111111", ".com", "007"]
    names = ["password", "PassWd", "secret", "TOKEN", "api_key", '"', "'", " ", ":", "=", "abcdef", "0123456789abcdef", "AKIA",
             "ABCDEFGH123", "\n", "é", "ſecret", "x", "/+_"]
    for _ in range(8000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(1, 25)))
        assert pii.base_spans(t) == brute_pii(t), t
        t = "".join(r.choice(names) for _ in range(r.randrange(1, 18)))
        assert secret_scan.base_spans(t) == brute_secrets(t), t


@pytest.mark.parametrize("find,brute,kinds", [(pii.find_personal_data, brute_pii, pii.KINDS),
                                              (secret_scan.find_secrets, brute_secrets, secret_scan.KINDS[:3])])
def test_rules_stay(spark, documents, awkward, nothing, find, brute, kinds):
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    for docs, rows in ((documents, texts), (awkward, [x for x in rows_of() if x[1] is None or len(x[1]) < 50_000 or x[0] != 18])):
        want = collections.Counter()
        for i, t in rows:
            spans = brute(t or "")
            want[i, hashlib.sha256(spans_text(spans).encode()).hexdigest(), *(sum(s[2] == k for s in spans) for k in kinds)] += 1
        got = find(docs).collect()
        assert collections.Counter((r.doc_id, r.base_sha256, *(r[f"n_{k}"] for k in kinds)) for r in got) == want
        by_id = {i: t or "" for i, t in rows}
        for r in got:
            base = {spans_text([s]) for s in brute(by_id[r.doc_id])} if r.doc_id is not None else set()
            assert base <= set(r.spans.split(","))
            starts = [int(s.split(":")[1]) for s in r.spans.split(",") if s]
            assert starts == sorted(starts) and len(starts) == sum(r[f"n_{k}"] for k in kinds) + r.n_added
    assert find(nothing).count() == 0


def test_network_learns_what_a_secret_looks_like(spark):
    r = random.Random(4)
    random_word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    rows = [(i, f"{prose(i, 15)} secret = {random_word(32)} {prose(i + 1, 10)} " + "".join(prose(i + 2, 9).split())) for i in range(500)]
    bare = [(1000 + i, f"{prose(i, 12)} {random_word(32)} {prose(i + 5, 12)}") for i in range(60)]
    words = [(2000 + i, f"{prose(i, 12)} {''.join(prose(i + 9, 8).split())} {prose(i, 5)}") for i in range(60)]
    got = {x.doc_id: x for x in secret_scan.find_secrets(frame(spark, rows + bare + words)).collect()}
    assert sum(got[i].n_added for i, _ in bare) >= 40
    assert sum(got[i].n_added for i, _ in words) <= 3
    assert all(got[i].n_assign == 1 for i, _ in rows)


def test_short_values_after_other_names(spark):
    """Values of 6 to 15 characters, with punctuation too, where the name is on no list."""
    r = random.Random(6)
    value = lambda n, more="": "".join(r.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789" + more) for _ in range(n))
    known = [(i, f"{prose(i, 10)} {r.choice(['password', 'token', 'secret'])}{r.choice([': ', ' = ', '='])}{value(r.randint(8, 15))} "
                 f"{prose(i + 1, 8)} note: {prose(i + 7, 12)} kind = {''.join(prose(i + 3, 4).split())}") for i in range(500)]
    other = [(1000 + i, f"{prose(i, 10)} pwd: {value(12)} {prose(i + 2, 9)}") for i in range(30)]
    marks = [(2000 + i, f"{prose(i, 10)} pass_phrase={value(5)}!{value(3)}#{value(4)} {prose(i + 2, 9)}") for i in range(30)]
    words = [(3000 + i, f"{prose(i, 10)} remark: {''.join(prose(i + 90, 5).split())} {prose(i + 2, 9)}") for i in range(60)]
    got = {x.doc_id: x for x in secret_scan.find_secrets(frame(spark, known + other + marks + words)).collect()}
    assert sum(got[i].n_added for i, _ in other) >= 24
    assert sum(got[i].n_added for i, _ in marks) >= 24
    assert sum(got[i].n_added for i, _ in words) <= 6


def test_threshold_keeps_its_recall_where_findings_are_mixed():
    network, r = secret_scan.Network(), random.Random(8)
    x = np.concatenate([secret_scan.tiles("", prose(i, 2), "") for i in range(400)])
    y = np.array([float(r.random() < 0.5) for _ in range(400)], np.float32)
    network.calibrate(x, y)
    kept = network.scores(x) >= network.threshold
    assert kept[y > 0].mean() >= secret_scan.RECALL and network.precision == (y[kept] > 0).mean()


def test_overlapping_candidates():
    assert secret_scan.best_apart([(0.9, 0, 30), (0.95, 10, 20), (0.9, 20, 30), (0.9, 22, 28)]) == [(10, 20), (20, 30)]
    spans = [x[:2] for x in secret_scan.candidates("url: https://x?key=Ab3$5678z. end", [])]
    assert (5, 28) in spans and (19, 28) in spans


def test_long_candidates_are_seen_whole():
    x = secret_scan.tiles("left", "a" * 150, "right")
    assert x.shape[0] == 3 and (x[2, secret_scan.CONTEXT:secret_scan.CONTEXT + 22] == ord("a")).all()


def slow_features(text, before, after, n):
    digits, letters, at = len(digits_of(text)), sum(c.isalpha() for c in text), text.count("@")
    plain = text.replace(" ", "").replace("-", "")
    check = sum(d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for k, d in enumerate(ord(c) - 48 for c in reversed(plain)))
    local = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    return [True, at == 1, at == 1 and "." in text[text.find("@"):], at == 1 and text[0] in local and " " not in text, at > 1,
            digits == 0, 1 <= digits < 4, 4 <= digits < 10, 10 <= digits < 14, 14 <= digits < 20, digits >= 20,
            letters > 0, letters > 0 and digits > letters, text[0] == "+", text[0] == "(", text[0].isalnum(), text[-1].isalnum(),
            " " in text, text.count(".") == 3 and digits + 3 == len(text), text.count(".") > 3, plain.isdigit(),
            plain.isdigit() and check % 10 == 0, before[-1:].isalnum(), after[:1].isalnum(), before[-1:] in tuple("@._-+"),
            after[:1] in ("@", "-", "_"), after[:1] == "." and after[1:2].isalnum(), after[:1] in (" ", "-") and after[1:2].isdigit(),
            any(c in "=\"'<>/\\|" for c in text), n == 1, 2 <= n < 6, n >= 12]


def digits_of(text):
    return re.sub("[^0-9]", "", text)


def slow_segments(text, lead, tail):
    body = text[lead:len(text) - tail]
    tokens = [m.span() for m in re.finditer("[A-Za-z]+|[0-9]+|[^A-Za-z0-9]", body)]
    out = {}
    for i, (a, _) in enumerate(tokens):
        for j in range(i + 1, min(len(tokens), i + pii.LONGEST) + 1):
            b = tokens[j - 1][1]
            if not body[a].isspace() and body[b - 1].isalnum() and any(body[x] in "0123456789@" for x, _ in tokens[i:j]):
                out[i, j] = slow_features(body[a:b], text[:lead + a], text[lead + b:], j - i)
    return out


def test_segments_equal_those_written_out(monkeypatch):
    r = random.Random(5)
    parts = ["1", "25", "4111111111111111", "a", "Bc", "é", "²", "@", ".", "-", "+", "(", ")", " ", " ", "=", "/", "\xa0", "_", "\0", "🎉"]
    for n in range(120):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 60)))
        lead, tail = r.randrange(min(4, len(text))), 0 if n % 3 else min(2, len(text) // 4)
        s, want = pii.Segments(text, lead, tail), slow_segments(text, lead, tail)
        assert s.at == sorted(want) and np.array_equal(s.whole[1].astype(bool), np.array([want[x] for x in s.at]).reshape(-1, pii.FEATURES))
        model = pii.SemiMarkov()
        model.w = np.random.default_rng(n).normal(0, 1, model.w.shape)
        monkeypatch.setattr(pii, "BLOCK_TOKENS", 1024)
        best = model.best(s, 0.5)
        monkeypatch.setattr(pii, "BLOCK_TOKENS", 3)
        assert model.best(s, 0.5) == best
        # the best segmentation's worth, by a table over all segments
        value, top = [0.0] * (s.n + 1), s.scores(model.w).max(1, initial=-np.inf)
        for j in range(1, s.n + 1):
            value[j] = max([value[j - 1]] + [value[s.at[k][0]] + top[k] for k in s.ends[j]])
        score = {(int(s.tokens[i][0]), int(s.tokens[j - 1][1])): x for (i, j), x in zip(s.at, s.scores(model.w))}
        assert abs(sum(score[a, b][k] for a, b, k in model.best(s, 0.0)) - value[s.n]) < 1e-9


def test_an_island_may_be_long():
    """A megabyte of numbers is one island of three million segments."""
    text = " ".join(str(k) for k in range(100_000, 250_000))
    model = pii.SemiMarkov()
    tracemalloc.start()
    started, ours = time.process_time(), pii.Segments(f"{text} 4111111111111111 ", 0, 1)
    model.w[21, 2] = 5.0                           # a card is what passes Luhn
    model.w[10, 2] = model.w[8, 2] = model.w[7, 2] = model.w[6, 2] = -9.0
    assert ours.n > 250_000 and (len(text) + 1, len(text) + 17, 2) in model.best(ours, 0.0)
    peak, spent = tracemalloc.get_traced_memory()[1], time.process_time() - started
    tracemalloc.stop()
    assert peak < 200 << 20 and spent < 60


def test_semi_markov_gradient_and_marginals():
    """Marginals equal those of all segmentations written out."""
    s = pii.Segments("a 12.5@b c", 0, 0)
    model = pii.SemiMarkov()
    model.w = np.random.default_rng(0).normal(0, 1, model.w.shape)
    score, total, mass = s.scores(model.w), 0.0, np.zeros((len(s.at), len(pii.KINDS)))

    def walk(i, weight, used):
        nonlocal total
        if i == s.n:
            total += math.exp(weight)
            for k, y in used:
                mass[k, y] += math.exp(weight)
            return
        walk(i + 1, weight, used)
        for k, (a, b) in enumerate(s.at):
            if a == i:
                for y in range(len(pii.KINDS)):
                    walk(b, weight + score[k, y], [*used, (k, y)])

    walk(0, 0.0, [])
    assert np.allclose(model.marginals(s), mass / total)


def test_the_best_tile_of_a_candidate_counts(monkeypatch):
    network, r = secret_scan.Network(), random.Random(3)
    some = [(prose(i, 3), "".join(r.choice("abcXYZ019+/=") for _ in range(r.choice((6, 64, 65, 400)))), prose(i + 1, 3)) for i in range(60)]
    want = [network.logits(secret_scan.tiles(*x)).max() for x in some]
    assert np.allclose(network.highest(some), want)
    monkeypatch.setattr(secret_scan, "TILES", 5)
    assert np.allclose(network.highest(iter(some)), want) and len(network.highest([])) == 0


def test_secrets_longer_than_a_tile(spark):
    """Long findings teach by any of their tiles and are judged by the best one, as are held-back ones."""
    r = random.Random(14)
    value = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    known = [(i, f"{prose(i, 10)} secret = {value(r.choice((24, 90, 200)))} {prose(i + 1, 8)} {''.join(prose(i + 3, 60).split())}") for i in range(400)]
    bare = [(1000 + i, f"{prose(i, 12)} {value(100)} {prose(i + 5, 9)}") for i in range(40)]
    late = [(3000 + i, f"{prose(i, 12)} {''.join(prose(i + 7, 40).split())}{value(100)} {prose(i + 5, 9)}") for i in range(40)]
    words = [(2000 + i, f"{prose(i, 12)} {''.join(prose(i + 9, 90).split())} {prose(i, 5)}") for i in range(40)]
    got = {x.doc_id: x for x in secret_scan.find_secrets(frame(spark, known + bare + words + late)).collect()}
    assert sum(got[i].n_added for i, _ in bare) >= 30 and sum(got[i].n_added for i, _ in words) <= 4
    assert sum(got[i].n_added for i, _ in late) >= 10      # their first tiles are words and show nothing


def test_semi_markov_finds_the_rules_spans(documents):
    found = pii.find(documents)
    model, right, wrong = pii.train(found), 0, 0
    for r in found.collect():
        base = {(b["start"], b["end"], b["kind"]) for b in r.base}
        for i in r.islands:
            s = pii.Segments(i["text"], i["lead"], i["tail"])
            got = {(a + i["start"], b + i["start"], k) for a, b, k in model.best(s, 0.0)}
            right += len(got & base)
            wrong += len(got - base)
    assert right >= 0.9 * sum(len(r.base) for r in found.select("base").collect()) and wrong <= 0.05 * right


def card(r):
    body = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def beside(r, n):
    """Documents with findings the rules see, and two kinds where a rule's longest run hides shorter ones."""
    number = lambda: f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"
    ip = lambda: ".".join(str(r.randrange(1, 255)) for _ in range(4))
    plain = [(i, f"{prose(i, 12)} {r.choice([card, lambda _: number(), lambda _: ip(), lambda _: str(r.randrange(10 ** 6))])(r)} "
                 f"{prose(i + 1, 8)} {r.randrange(3000)} {prose(i + 2, 4)}") for i in range(n)]
    cards = [(n + i, f"{prose(i, 9)} {card(r)} {card(r)} {prose(i + 3, 6)}") for i in range(8)]
    phones = [(n + 8 + i, f"{prose(i, 9)} {number()} {ip()} {prose(i + 3, 6)}") for i in range(8)]
    return plain, cards, phones


def test_findings_side_by_side(spark):
    """Two cards, and a phone before an IP address: the rules drop the whole run for its digit count."""
    plain, cards, phones = beside(random.Random(12), 600)
    got = {x.doc_id: x for x in pii.find_personal_data(frame(spark, plain + cards + phones)).collect()}
    assert all(got[i].n_card == 0 and got[i].n_added == 2 for i, _ in cards)
    assert all(got[i].n_phone == 0 and got[i].n_added == 1 and "phone:" in got[i].spans for i, _ in phones)
    assert sum(got[i].n_added for i, _ in plain) <= 3


def test_dropped_runs_are_no_negatives():
    a, b = card(random.Random(1)), card(random.Random(2))
    assert pii.dropped(f"x {a} {b} y") == [(2, 2 + 33)]
    assert pii.dropped("x +1 (826) 555-4081 190.137.223.204") == [(2, 35)]
    assert pii.dropped(f"{a}, +1 (555) 555-5555, {a[:-1]}, {'1' * 40}") == []


def test_quality(spark, documents, awkward, nothing):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in quality.score(documents, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == documents.count()
    held = [i for i in known if zlib.crc32(str(i).encode()) % quality.FOLDS == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % quality.FOLDS == 0) for i in got)
    assert held and sum(got[i].predicted == known[i] for i in held) >= 0.9 * len(held)
    assert all((r.predicted == 1) == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    assert quality.score(awkward, labels).count() == len(rows_of())
    assert quality.score(nothing, labels).count() == 0
    assert {r.score for r in quality.score(awkward, labels.limit(0)).collect()} == {0.5}
    assert quality.accepted(awkward, labels).columns == awkward.columns


def slow_quality(model, text):
    """The score of one text by the definition, passage by passage."""
    data = text.encode()
    kind = [7 if c >= 128 else 0 if chr(c).islower() else 1 if chr(c).isupper() else 2 if chr(c).isdigit() else 3 if c == 32 else
            4 if 9 <= c <= 13 else 5 if chr(c) in ".,;:'?" else 6 for c in data]
    found = list(re.finditer(rb"[^\x20\x09-\x0d]+", data))
    rows = []
    for k in range(max(1, -(-len(found) // quality.PASSAGE))):
        mine = found[k * quality.PASSAGE:(k + 1) * quality.PASSAGE]
        if not mine:
            rows.append([0.0] * quality.FEATURES)
            continue
        after = found[(k + 1) * quality.PASSAGE].start() if (k + 1) * quality.PASSAGE < len(found) else len(data)
        pairs = collections.Counter((kind[at], kind[at + 1]) for at in range(0 if k == 0 else mine[0].start(), min(after, len(data) - 1)))
        all_, w = max(1, sum(pairs.values())), [m[0] for m in mine]
        first = [math.sqrt(pairs[x, y] / all_) for x in range(8) for y in range(8)]
        rows.append(first + [sum(x == y for x, y in zip(w, w[1:])) / len(w), sum(x == y for x, y in zip(w, w[2:])) / len(w),
                             1 - len(set(w)) / len(w), sum(map(len, w)) / len(w) / 10, sum(len(x) == 1 for x in w) / len(w),
                             math.log1p(len(w)) / 4])
    p, x = model.p, (np.array(rows) - model.mean) / model.scale
    h = [np.maximum(row @ p["W"] + p["b"], 0) for row in x]
    gate = np.array([float((np.tanh(v @ p["V"]) / (1 + np.exp(-(v @ p["U"])))) @ p["a"][:, 0]) for v in h])
    weight = np.exp(gate - gate.max()) / np.exp(gate - gate.max()).sum()
    z = sum(a * v for a, v in zip(weight, h))
    return 1 / (1 + math.exp(-float(z @ p["w"][:, 0] + p["c"][0])))


def test_quality_scores_equal_slow_ones(spark, documents):
    """Of every row, whatever rows stand beside it."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    some = [(r.doc_id, r.text) for r in documents.limit(60).collect()]
    rows = some + [(90_000 + i, f" \n {t} \n ") for i, t in some if t] + [(i + 95_000, t) for i, t in rows_of() if i and 0 < i < 100]
    docs = frame(spark, rows).select("doc_id", "text")
    every = documents.select("doc_id", "text").union(docs.filter("doc_id >= 90000"))
    model, texts = quality.fit(every, labels), dict(rows)
    for parts in (1, 7):
        got = {r.doc_id: r.score for r in quality.score(every.repartition(parts), labels).collect() if r.doc_id in texts}
        assert len(got) == len(texts)
        assert all(abs(got[i] - slow_quality(model, t or "")) < 1e-4 for i, t in texts.items())


def test_quality_sample_is_bounded_and_the_same_every_time(spark, documents, monkeypatch):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    twice = documents.select("doc_id", "text").union(documents.select("doc_id", F.lower("text").alias("text")))
    one, two = (quality.fit(x, labels).p for x in (twice.repartition(5), twice.repartition(3)))
    assert all(np.array_equal(one[k], two[k]) for k in one)
    monkeypatch.setattr(quality, "ALL_PASSAGES", 300)
    few = quality.fit(documents, labels)
    assert any(not np.array_equal(few.p[k], one[k]) for k in one)


def test_quality_gradient():
    r = np.random.default_rng(1)
    model = quality.Bags(5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, bounds, y = r.normal(0, 1, (9, 5)), np.array([0, 2, 5, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x, bounds)[-1]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = model.gradient(x, bounds, y)
    for k, v in model.p.items():
        for at in list(np.ndindex(v.shape))[:4]:
            old, e = v[at], 1e-5
            v[at] = old + e
            up = loss()
            v[at] = old - e
            down = loss()
            v[at] = old
            assert abs((up - down) / (2 * e) - g[k][at]) < 1e-4


def brute_unigrams(rows):
    texts = [tokens(t) + [0] for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    c = collections.Counter(w for t, h in zip(texts, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
            for (i, _), h, t in zip(rows, held, texts)]


@pytest.mark.parametrize("head", [20, 131_072])
def test_base_scores(awkward, head):
    got = sorted(([r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score] for r in
                  lm_score.score_texts(awkward, head=head).collect()), key=repr)
    want = sorted(map(list, brute_unigrams(rows_of())), key=repr)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=lambda x: repr(x[:5])), sorted(want, key=lambda x: repr(x[:5]))):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5]))


def test_no_texts_to_score(nothing):
    assert lm_score.score_texts(nothing).count() == 0


def test_class_probabilities_sum_to_one():
    model = lm_score.LogBilinear(np.full(40, 1 / 40))
    context = np.array([[40, 40, 40, 40], [3, 1, 39, 40], [0, 0, 0, 0]])
    for c in context:
        p = 10 ** model.log10(np.repeat(c[None], 40, 0), np.arange(40))
        assert abs(p.sum() - 1) < 1e-6


def test_model_beats_counts_on_held_out_texts(spark):
    """Two kinds of text with words of their own: the words before say which words come."""
    r = random.Random(9)
    kinds = [[f"{k}{i}" for i in range(60)] for k in ("ab", "xy")]
    rows = [(i, " ".join(r.choice(kinds[i % 2]) for _ in range(200))) for i in range(1200)]
    got = [x for x in lm_score.score_texts(frame(spark, rows)).collect() if x.held_out]
    gain = sum(x.score - x.base_score for x in got) / sum(x.n_tokens for x in got)
    assert gain > 0.15                             # knowing the kind is worth log10(2) = 0.3 a token


def test_members_add_up_to_their_class():
    """With and without members, all codes' probabilities after a context add up to one."""
    member, count = np.array([3, 3, 3, 5]), np.array([4.0, 2.0, 1.0, 6.0])
    model = lm_score.LogBilinear(np.full(8, 1 / 8), member, count, np.full(8, 2.0))
    r = np.random.default_rng(1)
    model.load(r.normal(0, 1, len(model.flat())))
    for context in ([12, 12, 12, 12], [3, 8, 11, 12], [0, 7, 9, 10]):
        p = 10 ** model.log10(np.repeat([context], 12, 0), np.arange(12))
        assert abs(p.sum() - 1) < 1e-5
    text = np.array([12, 12, 12, 12, 3, 8, 11, 0, 5, 9])
    one_by_one = [model.log10(text[None, i - 4:i][:, ::-1], text[i:i + 1])[0] for i in range(4, 10)]
    assert np.allclose(model.log10_along(text), one_by_one, atol=1e-5)


def test_a_step_follows_the_gradient():
    """Contexts, classes and members each learn what follows what."""
    member = np.array([2, 2, 3, 3])
    model, r = lm_score.LogBilinear(np.full(4, 1 / 4), member, np.full(4, 5.0), np.full(4, 1.0)), np.random.default_rng(2)
    follow = {4: 7, 5: 6, 6: 4, 7: 5, 0: 1, 1: 0}
    for _ in range(2500):
        rows = []
        for _ in range(8):
            x = [int(r.integers(0, 2)) if r.random() < 0.5 else int(r.integers(4, 8))]
            while len(x) < 12:
                x.append(follow[x[-1]])
            rows.append(x)
        model.step(np.array(rows, np.int32), r)
    back = {b: a for a, b in follow.items()}
    context = np.array([[a, back[a], back[back[a]], back[back[back[a]]]] for a in follow])
    assert (10 ** model.log10(context, np.array(list(follow.values()))) > 0.9).all()


def slow_score(model, known, counts, text):
    total, before = 0.0, [model.start] * lm_score.ORDER
    for word in [*tokens(text), None]:
        data = np.frombuffer((word or "").encode(), np.uint8)
        _, h, bucket = lm_score.tokens(data, np.array([0, len(data)]))
        code = int(known.look_up(h[:1], bucket[:1])[0][0])
        p = {k: v.astype(np.float64) for k, v in model.p.items()}
        r = sum(p["R"][c] * p["D"][k] for k, c in enumerate(before))
        z = p["Q"] @ r + p["b"]
        cls = int(model.top[code])
        total += (z[cls] - np.log(np.exp(z).sum())) / math.log(10)
        if model.width[cls]:
            place = range(int(model.first[cls]), int(model.first[cls] + model.width[cls]))
            z = p["S"][place, :-1] @ r + p["S"][place, -1]
            total += (z[int(model.place[code]) - place[0]] - np.log(np.exp(z).sum())) / math.log(10)
        if known.words <= code < known.classes:
            total += math.log10(counts[word or 0] + 0.1) - known.mass[code]
        before = [code, *before[:-1]]
    return total


def test_scores_equal_slow_ones(spark, documents, monkeypatch):
    """Of whole texts, with frequent tokens sent along or joined."""
    kept, train = [], lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda *x: kept.append((train(*x), x[1])) or kept[-1][0])
    docs = documents.select("doc_id", "text").union(frame(spark, [(i + 90_000, t) for i, t in rows_of() if i and i < 100]).select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts = collections.Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 10 for w in [*tokens(t), 0])
    got = {r.doc_id: r.score for r in lm_score.score_texts(docs, head=3000).collect()}
    model, known = kept[0]
    assert len(known.member) == int(lm_score.MEMBERS * len(counts) ** 0.5)
    for i, t in rows[:12] + [x for x in rows if x[0] > 90_000 and len(x[1] or "") < 5000]:
        assert abs(got[i] - slow_score(model, known, counts, t or "")) < 1e-3 * max(1, abs(got[i]))


def test_the_vocabulary_of_the_model_grows(spark, monkeypatch):
    """Two kinds of text with 2,500 words each, some of them far more frequent than others."""
    r = random.Random(10)
    kinds = [[f"{k}{i}" for i in range(2500)] for k in ("ab", "xy")]
    weights = [1 / (i + 5) for i in range(2500)]
    rows = [(i, " ".join(r.choices(kinds[i % 2], weights, k=200))) for i in range(1200)]

    def gain():
        got = [x for x in lm_score.score_texts(frame(spark, rows).coalesce(2)).collect() if x.held_out]
        return sum(x.score - x.base_score for x in got) / sum(x.n_tokens for x in got)

    grown = gain()
    monkeypatch.setattr(lm_score, "MEMBERS", 0)
    assert grown > 0.1 and grown > gain() + 0.05


def test_every_candidate_teaches_the_secret_network(spark, monkeypatch):
    """All distinct candidates that are not held back, whatever the number of tasks, and a threshold from all that are."""
    r = random.Random(5)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    rows = [(i, f"{prose(i, 6)} secret = {word(32)} {prose(i + 1, 5)} " + "".join(prose(i + 2, 9).split())) for i in range(300)]
    bare = [(1000 + i, f"{prose(i, 12)} {word(32)} {prose(i + 5, 12)}") for i in range(30)]
    found = secret_scan.find(frame(spark, rows + bare))
    z = []
    over = secret_scan.Network.calibrate_over
    monkeypatch.setattr(secret_scan.Network, "calibrate_over", lambda self, held: z.append(held.collect()) or over(self, held))
    network = secret_scan.train(found, 300)
    good = sorted(x.z for x in z[0] if x.found)
    bad = [x.z for x in z[0] if not x.found]
    at = good[int((1 - secret_scan.RECALL) * len(good))]
    below = max((v for v in bad if v < at), default=at)
    assert network.threshold == pytest.approx(float(network.probability(np.float64((at + below) / 2))))
    assert len(good) > 40 and network.steps > 6
    part = [(h, h % 2 == 0, "l", f"s{h}", "r", True) for h in range(1, 5001)]
    assert len({x[0] for x in secret_scan._lesson(part, 2)}) == 4000


def test_only_texts_that_may_hold_a_candidate_are_looked_at():
    """Runs of byte strings are those of the pattern, also next to other texts and after characters of several bytes."""
    r = random.Random(12)
    bits = ["password", "TOKEN", '"', " ", ":", "=", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMNOPQRST", "é", "漢", "😀", "\0", "/", ".", "Z9",
            "x" * 15, "ſ", "٣", "²"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 20))) for _ in range(3000)] + ["", "a" * 15, "a" * 15, "b" * 16, "", "c" * 40, "plain text"]
    data, offsets = flat(pa.array(texts))
    seen = {d: (text, runs) for d, text, runs in secret_scan.suspects(data, offsets)}
    for d, t in enumerate(texts):
        runs = [m.span() for m in secret_scan._RUN.finditer(t)]
        assert seen.get(d, (t, [])) == (t, runs) and (d in seen) == (bool(runs) or ":" in t or "=" in t)
        assert secret_scan.base_spans(t, runs) == brute_secrets(t)
    assert not list(secret_scan.suspects(data[:0], offsets[:1])) and not list(secret_scan.suspects(data[:0], np.zeros(3, np.int64)))


def slow_secret_gradient(network, x, y):
    """Each window's characters side by side, times the filters; gradients added up one by one."""
    p, (n, length) = network.p, x.shape
    width, vector, filters = secret_scan.WIDTH, secret_scan.VECTOR, secret_scan.FILTERS
    windows = np.lib.stride_tricks.sliding_window_view(np.pad(x, ((0, 0), (width // 2, width // 2))), width, axis=1)
    flat_ = (p["E"][windows] * (windows > 0)[..., None]).reshape(n * length, width * vector)
    r = np.where((x > 0)[..., None], np.maximum(flat_ @ p["C"] + p["b"], 0).reshape(n, length, filters), 0)
    best = [r[:, a:b].argmax(1) + a for a, b in secret_scan._PARTS]
    size = (x[:, secret_scan.CONTEXT:secret_scan.CONTEXT + secret_scan.TILE] > 0).sum(1, keepdims=True) / secret_scan.TILE
    h = np.concatenate([*(np.take_along_axis(r, at[:, None], 1)[:, 0] for at in best), size], axis=1).astype(np.float32)
    logit = (h @ p["w"])[:, 0] + p["c"][0]
    e = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)[:, None]
    g = {"w": h.T @ e, "c": e.sum(0), "E": np.zeros_like(p["E"]), "C": np.zeros_like(p["C"]), "b": np.zeros_like(p["b"])}
    for k, at in enumerate(best):
        d = (e @ p["w"].T * (h > 0))[:, k * filters:(k + 1) * filters].reshape(-1)
        rows = (np.arange(n)[:, None] * length + at).reshape(-1)
        one = np.zeros((len(d), filters), np.float32)
        one[np.arange(len(d)), np.tile(np.arange(filters), n)] = d
        g["C"] += flat_[rows].T @ one
        g["b"] += one.sum(0)
        np.add.at(g["E"], windows.reshape(-1, width)[rows].reshape(-1), (one @ p["C"].T).reshape(-1, vector))
    g["E"][0] = 0
    return g, logit


def best(f, times=9):
    taken = []
    for _ in range(times):
        began = time.process_time()
        f()
        taken.append(time.process_time() - began)
    return min(taken)


def test_the_secret_network_learns_the_same_in_less_time():
    r = np.random.default_rng(14)
    size = r.integers(0, 70, 256)
    x = np.concatenate([secret_scan.tiles(prose(i, 6)[:i % 40], "".join(map(chr, r.integers(33, 140, n))), prose(i + 1, 6)[:i % 31])[:1] for i, n in enumerate(size)])
    y, network = (np.arange(256) % 3 == 0).astype(np.float32), secret_scan.Network()
    network.fit(x, y, 2)
    got, (want, logit) = network._gradient(x, y), slow_secret_gradient(network, x, y)
    for k, g in got.items():
        assert g.dtype == want[k].dtype and np.abs(g - want[k]).max() < 1e-5, k
    assert np.abs(network.logits(x) - logit).max() < 1e-4
    assert best(lambda: network._gradient(x[:64], y[:64])) < 0.7 * best(lambda: slow_secret_gradient(network, x[:64], y[:64]))


def test_each_part_is_one_lesson_of_a_task_of_its_own(spark):
    rows = [(h, h % 3 == 0, f"l{h}", f"s{h}" * 9, "right", True, h // 7 % 5) for h in range(200)]
    samples = spark.createDataFrame(rows, "h long, found boolean, left string, span string, right string, sure boolean, part int").repartition(3)
    lessons = secret_scan._lessons(samples, 5, (0, 2))
    got = lessons.withColumn("file", F.input_file_name()).collect()
    assert len(got) == 10 and len({r.file for r in got}) == 5
    want = {(k, secret_scan._first_tiles(some).tobytes(), bytes(r[1] for r in some))
            for p in range(5) for k in (0, 2) for some in [secret_scan._lesson(sorted(r[:6] for r in rows if r[6] == p), k)]}
    assert {(r.k, bytes(r.x), bytes(r.y)) for r in got} == want


def test_codes_are_made_for_all_samples_at_once(monkeypatch):
    """One conversion for many samples, whatever their characters, and steps that move all parameters together as one by one."""
    calls, codes = [], secret_scan._codes
    monkeypatch.setattr(secret_scan, "_codes", lambda texts: calls.append(len(texts)) or codes(texts))
    r = random.Random(5)
    word = lambda n: "".join(r.choice("aZ09:=\0\1\x7f\x80é好🎉") for _ in range(n))
    some = [(h, h % 2 == 0, word(r.randint(0, 30)), word(r.choice((0, 1, 30, 63, 64, 65, 128, 200))), word(r.randint(0, 30))) for h in range(300)]
    code = lambda t: [min(max(ord(c), 1), 128) for c in t]
    pad = lambda t, n: [*code(t[:n]), *[0] * (n - len(t[:n]))]
    row = lambda a, part, b: [*[0] * (secret_scan.CONTEXT - len(a[-secret_scan.CONTEXT:])), *code(a[-secret_scan.CONTEXT:]),
                              *pad(part, secret_scan.TILE), *pad(b, secret_scan.CONTEXT)]
    x = secret_scan._first_tiles(some)
    assert x.tolist() == [row(a, s, b) for _, _, a, s, b in some] and calls == [300]
    for _, _, a, s, b in some:
        assert secret_scan.tiles(a, s, b).tolist() == [row(a, s[i:i + secret_scan.TILE], b) for i in range(0, max(1, len(s)), secret_scan.TILE)]
    network, y = secret_scan.Network(), np.array([f for _, f, *_ in some], np.float32)
    calls.clear()
    assert np.allclose(network.highest(s[2:] for s in some), [network.logits(secret_scan.tiles(*s[2:])).max() for s in some], atol=1e-5) and calls[0] > 300

    slow, (m, v), order = secret_scan.Network(), [{k: np.zeros_like(p) for k, p in network.p.items()} for _ in range(2)], np.random.default_rng(13).permutation(300)
    for step, at in enumerate(range(0, 300, 64), 1):
        g = slow._gradient(x[order[at:at + 64]], y[order[at:at + 64]])
        for k in slow.p:
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * v[k] + 0.001 * g[k] ** 2
            slow.p[k] -= 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    network.fit(x, y, 1)
    assert all((network.p[k] == slow.p[k]).all() and (network.moments[1][k] == v[k]).all() for k in slow.p) and network.steps == 5


def test_only_the_largest_responses_are_set_to_zero_below_it():
    """Responses stay as they are, the largest of each part counts as 0 below 0: parts without a positive response teach nothing."""
    r = random.Random(6)
    x = secret_scan._first_tiles([(0, True, prose(i, 4)[:i % 30], "".join(r.choice("aZ09:=é") for _ in range(i % 70)), prose(i, 4)[:i % 9]) for i in range(64)])
    y, network = (np.arange(64) % 2).astype(np.float32), secret_scan.Network()
    network.p["b"] -= 1
    responses = network._forward(x)[-1]
    assert (responses < 0).any() and (responses[x == 0] == 0).all()
    most = [responses[:, a:b].max(1) for a, b in secret_scan._PARTS]
    assert any((m < 0).any() for m in most) and (network._out(x, most)[0] >= 0).all()
    got, (want, logit) = network._gradient(x, y), slow_secret_gradient(network, x, y)
    assert all(np.abs(g - want[k]).max() < 1e-5 for k, g in got.items()) and np.abs(network.logits(x) - logit).max() < 1e-4
    network.p["b"] -= 100
    assert not any(network._gradient(x, y)[k].any() for k in ("E", "C", "b"))

"""Hand-made documents with every awkward case, and brute-force versions of what operators must return."""

from __future__ import annotations

import collections
import random
import re

SPACE = "[\x20\x09-\x0d]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def tokens(text):
    return [w for w in re.split(SPACE, lower(text)) if w]


def prose(seed, n):
    r = random.Random(seed)
    parts = "an be con de er for ing hat lo men ne or per re st tion un ver wi".split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def awkward():
    """(doc_id, text) with NULLs, empty and very long texts, ties, repeated rows."""
    near = prose(3, 200)
    return [
        (10, prose(1, 60)), (11, prose(1, 60).replace(" ", " \t\n")), (12, prose(1, 60).upper()), (13, None), (14, ""),
        (15, " \n\t "), (16, prose(2, 40_000)), (17, "x" * 60_000), (18, "1" * 5_000 + "." * 50), (None, prose(4, 30)), (None, None),
        (19, near), (20, near + " tail"), (21, near.replace("an", "AN")), (22, near), (22, near), (23, "one"), (24, "two words"),
        (25, "ſt İ ΑΣ é 你好 🎉 <|endoftext|> don't \x1c\x85　 x"), (2**40, prose(5, 30)), (-7, prose(5, 30)),
        (26, 'token = "0123456789abcdef0123456789abcdef" mail a.b@c.example.com +1 (555) 555-5555 10.0.0.1 4111111111111111'),
    ]


def frame(spark, rows):
    """The rows as documents, with NULLs in other columns and columns whose names operators use inside."""
    full = [(i, t, None, "src", None if t is None else len(t), 1, "x", 2.0, 3, f"row {i}") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                 "rid int, key string, score double, label int, __rid string")


def shingles(text, width):
    w = tokens(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def near_components(texts, width, percent):
    """For each text the smallest index of its component."""
    sets = [shingles(t, width) for t in texts]
    where = collections.defaultdict(list)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in where[g])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            where[g].append(i)
    return [root(i) for i in range(len(sets))], sets

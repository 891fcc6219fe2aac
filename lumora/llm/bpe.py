"""BPE encoding and decoding by a tokenization automaton.

After Berglund, Martens and van der Merwe, "Constructing a BPE tokenization DFA" (2024): start with
the automaton of all symbol sequences and apply one gadget per merge, in order.  For the merge
``u v -> w`` of rank k the gadget takes the arc ``v`` out of the state behind ``u``, and gives every
state that had ``u`` followed by ``v`` an arc ``w`` to the state behind ``v``.  As all arcs with one
label lead to one state, a state is named by its label: the gadget makes the state ``w`` a copy of
the state ``v`` as it was at time k, notes the arc taken from ``u``, and the parts whose path makes
the arc ``w``.  The automaton accepts exactly the correct tokenizations, so it is kept as those four
tables (its arcs written out would be some 10**9), and an arc is looked up once and remembered.

A word is encoded by composing it with the automaton from left to right: a prefix of the word has
one correct tokenization, which is that of a shorter prefix followed by a token whose arc exists.
Decoding emits the labels of the arcs.

NULL texts count as empty and have no tokens; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumora.llm.common import BASE, mix
from lumora.llm.token_counts import GROUP_BYTES, fragments

NEVER = 1 << 60
#: Texts without white space, and words, whose ids are remembered in a worker.
REMEMBERED, WORDS = 700_000, 400_000
#: Bytes of the longest word that is encoded together with others.
TOGETHER = 48
#: Arcs remembered for encoding words together.
MEMO = 1 << 20
#: Below this code point normalising and splitting use Python's tables; other texts use the library's.
PLAIN = 0x500


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class Automaton:
    """The tokenization automaton of a list of merges; states and labels are token ids."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str) -> None:
        self.label = {i: t for t, i in vocabulary.items()}
        n = max(vocabulary.values(), default=-1) + 1
        self.born = [-1] * n                    # the gadget that made the state; -1: a symbol of the start
        self.head = [-1] * n                    # the first part of the path that became the label
        self.copied = [-1] * n                  # the second part, whose state the gadget copied
        self.taken: dict[int, int] = {}         # (state, label) -> the gadget that took the arc
        self.made = [False] * n                 # whether some state has an arc with the label
        for i in self.label:
            self.made[i] = True
        for left, right in merges:
            self.made[vocabulary[left + right]] = False
        self.n = n
        self.arcs: dict[int, bool] = {}
        for k, (left, right) in enumerate(merges):
            self.gadget(k, vocabulary[left], vocabulary[right], vocabulary[left + right])
        byte = {s: b for b, s in enumerate(byte_symbols())}
        self.tokens = {(bytes(byte[c] for c in t.removesuffix(end)), t.endswith(end)): i for t, i in vocabulary.items()}
        self.widest = max(len(t) for t, _ in self.tokens)
        if not all((bytes([b]), final) in self.tokens for b in range(256) for final in (False, True)):
            raise ValueError("the vocabulary must have every byte, inside words and at their end")
        self.compile()

    def gadget(self, k: int, u: int, v: int, w: int) -> None:
        if self.born[u] >= k or self.born[v] >= k or self.born[w] >= 0:
            raise ValueError(f"merge {k} is out of order")
        if not (self.made[u] and self.made[v] and self.had(u, v, k)):
            return                                        # no path has u before v any more
        self.taken[u * self.n + v] = k
        self.made[w] = True
        self.born[w], self.head[w], self.copied[w] = k, u, v

    def had(self, state: int, label: int, time: int) -> bool:
        """Whether the state had the arc just before the gadget ``time``."""
        while True:
            if self.taken.get(state * self.n + label, NEVER) < time:
                return False
            if self.born[label] >= time:
                return False
            if self.born[state] > self.born[label]:       # copied with the arc, if it was there
                time, state = self.born[state], self.copied[state]
            elif self.born[label] < 0:
                return True
            elif state == self.head[label] == self.copied[label]:
                return False                              # the gadget took the arc that the path would need
            else:                                         # made by the label's gadget from the arc of its first part
                time, label = self.born[label], self.head[label]

    def arc(self, state: int, label: int) -> bool:
        key = state * self.n + label
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) > 4_000_000:
                self.arcs.clear()
            found = self.arcs[key] = self.had(state, label, NEVER)
        return found

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one word: for each prefix the token that ends it, looked up from the longest."""
        n, ids, made = len(word), self.tokens, self.made
        last, back = [-1] * n, [-1] * n
        for i in range(1, n + 1):
            for j in range(max(0, i - self.widest), i):
                token = ids.get((word[j:i], i == n))
                if token is not None and made[token] and (j == 0 or last[j - 1] >= 0 and self.arc(last[j - 1], token)):
                    last[i - 1], back[i - 1] = token, j
                    break
        out, i = [], n
        while i > 0:
            out.append(last[i - 1])
            i = back[i - 1]
        return out[::-1]

    def compile(self) -> None:
        """The tables as arrays, for many words at once."""
        self.born_, self.head_, self.copied_ = (np.array(x, np.int64) for x in (self.born, self.head, self.copied))
        self.taken_keys = np.array(sorted(self.taken), np.int64)
        self.taken_time = np.array([self.taken[k] for k in self.taken_keys.tolist()], np.int64)
        usable = [(key, token) for key, token in self.tokens.items() if self.made[token]]
        hashes = np.array([self.hash_of(*key) for key, _ in usable], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.hashed = hashes[order], np.array([t for _, t in usable], np.int64)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two tokens share a hash")
        self.memo_key = np.full(MEMO, -1, np.int64)
        self.memo_arc = np.zeros(MEMO, bool)

    @staticmethod
    def hash_of(token: bytes, final: bool) -> int:
        h = 0
        for b in token:
            h = (h * BASE + b + 1) % (1 << 64)
        return (h * BASE + 1 + final) % (1 << 64)

    def had_many(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """``had(state, label, NEVER)`` for many arcs."""
        out = np.zeros(len(state), bool)
        time, left = np.full(len(state), NEVER, np.int64), np.arange(len(state))
        state, label = state.copy(), label.copy()
        while len(left):
            key = state * self.n + label
            at = np.minimum(np.searchsorted(self.taken_keys, key), len(self.taken_keys) - 1)
            taken = np.where(self.taken_keys[at] == key, self.taken_time[at], NEVER) if len(self.taken_keys) else NEVER
            made, born = self.born_[label], self.born_[state]
            copy = born > made
            off = (taken < time) | (made >= time)
            out[left[~off & ~copy & (made < 0)]] = True
            twin = (state == self.head_[label]) & (state == self.copied_[label])
            go = ~off & (copy | (made >= 0) & ~twin)
            time = np.where(copy, born, made)[go]
            state, label = np.where(copy, self.copied_[state], state)[go], np.where(copy, label, self.head_[label])[go]
            left = left[go]
        return out

    def arcs_many(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """``arc`` for many arcs; a table of fixed size remembers the last ones."""
        key = state * self.n + label
        at = (mix(key.astype(np.uint64)) % np.uint64(MEMO)).astype(np.int64)
        new = np.flatnonzero(self.memo_key[at] != key)
        out = self.memo_arc[at]
        if len(new):
            out[new] = self.had_many(state[new], label[new])
            self.memo_key[at[new]], self.memo_arc[at[new]] = key[new], out[new]
            slot = at[new]
            wrong = self.memo_key[slot] == key[new]
            self.memo_arc[slot[wrong]] = out[new][wrong]
        return out

    def encode_many(self, words: list[bytes]) -> list[list[int]]:
        """The tokens of each word; short words go through the tables together."""
        out: list[list[int]] = [[] for _ in words]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(lengths > TOGETHER):
            out[i] = self.encode(words[i])
        order = np.flatnonzero((lengths > 0) & (lengths <= TOGETHER))
        order = order[np.argsort(-lengths[order], kind="stable")]
        if not len(order):
            return out
        size, longest = lengths[order], int(lengths[order[0]])
        text = np.zeros((len(order), longest), np.uint64)
        text[np.arange(longest) < size[:, None]] = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
        text += np.uint64(1)
        last = np.full((len(order), longest), -1, np.int64)
        back = np.full((len(order), longest), -1, np.int64)
        base = np.uint64(BASE)
        rows = np.searchsorted(-size, -np.arange(1, longest + 1), "right")     # words of at least that length
        part = np.zeros((len(order), longest), np.uint64)                      # hash of the bytes from each start so far
        for i in range(longest):
            m = rows[i]
            lo = max(0, i + 1 - self.widest)
            part[:m, lo:i + 1] = part[:m, lo:i + 1] * base + text[:m, i:i + 1]
            final = np.uint64(1) + (size[:m] == i + 1).astype(np.uint64)
            left = np.arange(m)
            for j in range(lo, i + 1):
                h = part[left, j] * base + final[left]
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                fits = self.hashes[at] == h
                if j:
                    fits &= last[left, j - 1] >= 0
                hit = np.flatnonzero(fits)
                token = self.hashed[at[hit]]
                if j and len(hit):
                    follows = self.arcs_many(last[left[hit], j - 1], token)
                    hit, token = hit[follows], token[follows]
                if len(hit):
                    last[left[hit], i], back[left[hit], i] = token, j
                    keep = np.ones(len(left), bool)
                    keep[hit] = False
                    left = left[keep]
                    if not len(left):
                        break
        for r, (i, n) in enumerate(zip(order.tolist(), size.tolist())):
            tokens, to, fro = [], last[r].tolist(), back[r].tolist()
            while n > 0:
                tokens.append(to[n - 1])
                n = fro[n - 1]
            out[i] = tokens[::-1]
        return out

    def emit(self, tokens: list[int]) -> list[str]:
        return [self.label[t] for t in tokens]


class Codec:
    """Encodes and decodes texts as the tokenizer file says; made once per Python worker."""

    def __init__(self, path: str) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"] + "|\n")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.byte = {s: b for b, s in enumerate(byte_symbols())}
        names = self.automaton.label | {i: t for t, i in self.special.items()}
        self.names = {str(i): t for i, t in names.items()}
        self.words: dict[bytes, str] = {}      # word -> its ids, each after a space
        self.known: dict[str, str] = {}        # text without white space -> its ids, each after a space

    def split(self, texts: list[str]) -> list[list[bytes]]:
        """The pre-split words of texts without white space."""
        joined = "\n".join(texts)
        if joined.isascii() or ord(max(joined)) < PLAIN and "İ" not in joined:
            out: list[list[bytes]] = [[]]
            for x in self.pattern.findall(unicodedata.normalize("NFC", joined).replace("Σ", "σ").lower()):
                if x == "\n":
                    out.append([])
                else:
                    out[-1].append(x.encode())
            return out
        if len(texts) > 1:
            return [x for text in texts for x in self.split([text])]
        return [[bytes(self.byte[c] for c in x)
                 for x, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(joined))]]

    def learn(self, texts: list[str]) -> None:
        """Put the ids of texts without white space into ``known``."""
        if not texts:
            return
        spaced: list[list[bytes | str]] = []
        plain = [x for x in texts if "<" not in x]
        spaced += self.split(plain) if plain else []
        marked = [x for x in texts if "<" in x]
        for text in marked:
            parts, at = [], 0
            for m in self.specials.finditer(text):
                parts += [*self.split([text[at:m.start()]])[0], m[0]]
                at = m.end()
            spaced.append(parts + self.split([text[at:]])[0])
        new = list({w for parts in spaced for w in parts if isinstance(w, bytes)}.difference(self.words))
        for word, ids in zip(new, self.automaton.encode_many(new)):
            self.words[word] = "".join([f" {i}" for i in ids])
        for text, parts in zip(plain + marked, spaced):
            self.known[text] = "".join([self.words[w] if isinstance(w, bytes) else f" {self.special[w]}" for w in parts])

    def encode_texts(self, texts: list[str]) -> list[str]:
        """The ids of each text in decimal, joined by a space."""
        out, group, size = [], [], 0
        for i, text in enumerate(texts):
            group.append(fragments(text))
            size += len(text)
            if size >= GROUP_BYTES or i == len(texts) - 1:
                for memory, most in ((self.known, REMEMBERED), (self.words, WORDS)):
                    if len(memory) > most:
                        memory.clear()
                self.learn(list(set().union(*group).difference(self.known)))
                out += ["".join([self.known[x] for x in parts])[1:] for parts in group]
                group, size = [], 0
        return out

    def decode(self, ids: str) -> str:
        """The labels of the arcs, joined by a space; the vocabulary has no decoder of its own."""
        return " ".join(map(self.names.__getitem__, ids.split(" "))) if ids else ""


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, path: str, keep_texts: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per row of ``docs``.

    With ``keep_texts`` also ``ids`` (array<int>) and ``decoded``."""

    def run(batches):
        coder = codec(path)
        for batch in batches:
            ids_hash, text_hash, n, ids, decoded = [], [], [], [], []
            for a in coder.encode_texts(batch.column(1).to_pylist()):
                b = coder.decode(a)
                n.append(a.count(" ") + 1 if a else 0)
                ids_hash.append(hashlib.sha256(a.encode()).hexdigest())
                text_hash.append(hashlib.sha256(b.encode()).hexdigest())
                if keep_texts:
                    ids.append(list(map(int, a.split())))
                    decoded.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                + ([pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())] if keep_texts else []),
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if keep_texts else []))
        coder.known.clear()         # the worker may go on to other work
        coder.words.clear()

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + (", ids array<int>, decoded string" if keep_texts else ""))

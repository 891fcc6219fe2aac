"""Token counts by the tokenizer's own library, lengths only.

Texts reach the library in batches of about equal bytes.  Where the tokenizer drops white space
before its merges, no token crosses a space, tab or line break: such texts are split there, which
bounds a batch whatever the length of a text, and the count of a fragment that comes again is
remembered (the memory is emptied at a fixed size; that changes time, not counts).
Other tokenizers get whole texts.

NULL and empty texts have 0 tokens; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text given to the library at once.
BATCH_BYTES = 1 << 17
#: Counts remembered in a worker.
REMEMBERED = 300_000
#: Characters of texts whose new fragments are encoded together.
GROUP_BYTES = 1 << 20
#: Fragments in a string of those not remembered.
REST = 1000
LIMIT = 2048
_SAFE = re.compile("[^ \t\n\r]+")
_ODD = "\x1c\x1d\x1e\x1f"


def fragments(text: str) -> list[str]:
    """The text's parts between white space; separator controls are no white space to the library."""
    if any(c in text for c in _ODD):
        return _SAFE.findall(text)
    return text.split()


def drops_white_space(path: str) -> bool:
    """Whether the file's pre-tokenizer removes all that its pattern, which excludes white space, doesn't match."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f).get("pre_tokenizer") or {}
    for part in spec.get("pretokenizers", [spec]):
        if part.get("type") == "Split" and part.get("behavior") == "Removed" and part.get("invert"):
            return "\\s" not in part["pattern"].get("Regex", "\\s").replace("[^\\s", "")
    return False


class Counter:
    """Counts tokens of texts; made once per Python worker."""

    def __init__(self, path: str) -> None:
        self.split = drops_white_space(path)
        self.known: dict[str, int] = {}
        self.seen: set[str] = set()
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.encode = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]

    def batches(self, texts: Iterable[str]) -> Iterator[list[str]]:
        batch, size = [], 0
        for text in texts:
            batch.append(text)
            size += len(text) + 16
            if size >= BATCH_BYTES:
                yield batch
                batch, size = [], 0
        if batch:
            yield batch

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        if not self.split:
            return [n for batch in self.batches(texts) for n in self.encode(batch)]
        out, group, size = [], [], 0
        for i, text in enumerate(texts):
            group.append(fragments(text))
            size += len(text)
            if size >= GROUP_BYTES or i == len(texts) - 1:
                out += self.count_fragments(group)
                group, size = [], 0
        return out

    def count_fragments(self, group: list[list[str]]) -> list[int]:
        """Counts of texts given as fragments.

        A fragment seen before is counted by itself and remembered; those seen for the first
        time are encoded as one string per text, as they may well not come again."""
        for memory in (self.known, self.seen):
            if len(memory) > REMEMBERED:
                memory.clear()
        wanted = set().union(*group).difference(self.known)
        again = sorted(wanted & self.seen)
        for batch in self.batches(again):
            self.known.update(zip(batch, self.encode(batch)))
        self.seen |= wanted
        self.seen.difference_update(again)
        get, strings, owner, out = self.known.get, [], [], []
        for i, parts in enumerate(group):
            counts = [get(x) for x in parts]
            if None in counts:
                rest = [x for x, n in zip(parts, counts) if n is None]
                for at in range(0, len(rest), REST):
                    strings.append(" ".join(rest[at:at + REST]))
                    owner.append(i)
                counts = [n for n in counts if n is not None]
            out.append(sum(counts))
        at = 0
        for batch in self.batches(strings):
            for n in self.encode(batch):
                out[owner[at]] += n
                at += 1
        return out


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``."""

    def lengths(batches):
        counts = counter(path).count
        for batch in batches:
            texts = batch.column(1)
            n = pa.array(counts(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        lengths, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Token counts of a byte-level BPE vocabulary, without encoding what is a token by itself.

Offline, every vocabulary string is encoded alone; those that come out as one token are proven whole.
A document's pre-tokens that are whole count as one; only the others are merged, once per worker and
pre-token.

The vocabulary is a ``tokenizers`` file with a ``ByteLevel`` pre-tokenizer, no normalizer and plain
merges; anything else is refused. As that library does by default, the strings of added special tokens are one
token each wherever a text holds them, and split the text.

Defined results: null and empty texts have 0 bytes and 0 tokens. Texts are taken whole; a pre-token of any
length is merged in n log n steps. Repeated rows count alike; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import fields, ship

#: Pre-tokens that a worker remembers, and the longest that it does.
MEMO_SIZE, MEMO_CHARS = 800_000, 48


def byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# Letters and numbers that Unicode 16 added to what Python's own tables may still lack.
ADDED = {
    "L": "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 "
         "11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0",
    "N": "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA",
}


@lru_cache
def char_class(kind: str) -> str:
    """Ranges of all characters whose general category begins with ``kind``, for a class of ``re``, which lacks ``\\p``."""
    points = [p for p in range(sys.maxunicode + 1) if unicodedata.category(chr(p))[0] == kind]
    starts = [p for i, p in enumerate(points) if i == 0 or points[i - 1] != p - 1]
    ends = [p for i, p in enumerate(points) if i + 1 == len(points) or points[i + 1] != p + 1]
    added = [(int(r.split("-")[0], 16), int(r.split("-")[-1], 16)) for r in ADDED[kind].split()]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in [*zip(starts, ends, strict=True), *added])


@lru_cache
def pre_token_pattern() -> re.Pattern:
    """The split of byte-level BPE: contractions, letters, numbers, other marks, white space."""
    letter, number = char_class("L"), char_class("N")
    # The characters of Unicode's White_Space property.
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class TokenCounter:
    """Counts tokens; goes to the executors as one broadcast value (the vocabulary's size bounds it)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take more than their own string are not supported")
        letters = byte_letters()
        ids = model["vocab"]
        self.bytes = [0] * 256
        for letter, byte in letters.items():
            self.bytes[byte] = ids[letter]
        self.merges = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.whole = set()
        for token in ids:
            if all(c in letters for c in token):
                raw = bytes(letters[c] for c in token)
                if len(merged(raw, self.bytes, self.merges)) == 1:
                    try:
                        self.whole.add(raw.decode())
                    except UnicodeDecodeError:  # part of a character: never a pre-token
                        pass
        self.setup()

    def setup(self) -> None:
        special = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, special))).split if special else lambda text: [text]
        self.findall = pre_token_pattern().findall
        self.memo = _Memo(self)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("bytes", "merges", "special", "whole")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.setup()

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.split(text)
        tokens = self.memo.__getitem__
        return len(parts) - 1 + sum(sum(map(tokens, self.findall(part))) for part in parts)


class _Memo(dict):
    """Tokens of a pre-token: 1 for whole tokens, found by merging for the rest."""

    def __init__(self, counter: TokenCounter):
        super().__init__(dict.fromkeys(counter.whole, 1))
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        n = len(merged(piece.encode(), self.counter.bytes, self.counter.merges))
        if len(piece) <= MEMO_CHARS:
            if len(self) > MEMO_SIZE + len(self.counter.whole):
                self.clear()
                self.update(dict.fromkeys(self.counter.whole, 1))
            self[piece] = n
        return n


def merged(raw: bytes, byte_ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Token ids of ``raw``: the pair of lowest rank is merged first, the leftmost of equals."""
    ids = [byte_ids[b] for b in raw]
    if len(ids) > 32:
        return _merged_by_heap(ids, merges)
    none = (1 << 60, 0)
    ranks = [merges.get(pair, none) for pair in zip(ids, ids[1:], strict=False)]
    while ranks:
        best = min(ranks)
        if best is none:
            break
        i = ranks.index(best)
        ids[i : i + 2] = [best[1]]
        del ranks[i]
        if i:
            ranks[i - 1] = merges.get((ids[i - 1], ids[i]), none)
        if i < len(ranks):
            ranks[i] = merges.get((ids[i], ids[i + 1]), none)
    return ids


def _merged_by_heap(ids: list[int], merges: dict) -> list[int]:
    after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
    heap = [(*merges[pair], i, pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if pair in merges]
    heap = [(rank, i, new, pair) for rank, new, i, pair in heap]
    heapq.heapify(heap)
    while heap:
        _, i, new, pair = heapq.heappop(heap)
        j = after[i]
        if ids[i] != pair[0] or j < 0 or ids[j] != pair[1]:
            continue  # one of the two has been merged meanwhile
        ids[i], ids[j], after[i] = new, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (found := merges.get((ids[a], ids[b]))):
                heapq.heappush(heap, (found[0], a, found[1], (ids[a], ids[b])))
    return [i for i in ids if i >= 0]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row."""
    ship(docs.sparkSession)
    counter = docs.sparkSession.sparkContext.broadcast(TokenCounter(vocabulary))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter.value.count
        for batch in batches:
            n = pa.array((tokens(t.as_py()) for t in batch.column(2)), pa.int64(), size=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["id", "n_bytes", "n_tokens"])

    sized = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    return sized.mapInArrow(count, fields(sized, "id", and_="n_bytes long, n_tokens long")).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one left-to-right pass.

At each position the automaton's output links give all pieces that end there; the best way to that position
is relaxed over them. What "best" means is the model's:

* unigram models: the highest sum of scores (Viterbi);
* BPE models: their scores are merge ranks, and the highest sum is not what merging gives (on the shipped model
  it often takes other pieces). The pass then keeps, for each position, the one piece that can stand last:
  the piece before it and itself must come out unchanged when merged alone. Local agreement of neighbours is
  what makes a sequence the merge result, so the pass gives the merges' pieces exactly. Runs of blanks, whose
  merges have equal scores and depend on their place, are merged outright.

Characters without a piece become byte pieces (or the unknown piece). Only identity normalisation is
supported; anything else is refused. Encoding is memoised per worker for chunks that no piece can cross.

Defined results: null and empty texts have no ids and decode to an empty text. Texts are taken whole. Decoding
gives the text back, except that U+2581, the model's sign for a blank, becomes a blank. Repeated rows
encode alike; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import fields, ship

BLANK = "▁"
#: Model types and piece types of the SentencePiece format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Chunks that a worker remembers, and the longest that it does.
MEMO_SIZE, MEMO_CHARS = 600_000, 48
#: Pairs of neighbouring pieces that a worker remembers.
AGREE_SIZE = 1_000_000


def messages(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message; fixed-width values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class PieceCodec:
    """A model's pieces and their automaton; goes to the executors as one broadcast value (bounded by the model)."""

    def __init__(self, model: str):
        with open(model, "rb") as file:
            self._read(file.read())
        self._index()

    def _read(self, data: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        self.model_type, normalizer = UNIGRAM, {}
        for field, value in messages(data):
            if field == 1:
                piece = dict(messages(value))
                self.pieces.append((piece[1].decode(), float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]), piece.get(3, NORMAL)))
            elif field == 2:
                self.model_type = dict(messages(value)).get(3, UNIGRAM)
            elif field == 3:
                normalizer = dict(messages(value))
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1) or not normalizer.get(5, 1):
            raise ValueError("only identity normalisation with a leading blank is supported")
        if self.model_type not in (UNIGRAM, BPE) or any(kind == USER_DEFINED for _, _, kind in self.pieces):
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")

    def _index(self) -> None:
        kinds = [kind for _, _, kind in self.pieces]
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.scores = [score for _, score, _ in self.pieces]
        self.unknown = kinds.index(UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.lowest = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        self.raw = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else b" \xe2\x81\x87 " if kind == UNKNOWN else p.replace(BLANK, " ").encode() for p, _, kind in self.pieces]
        #: No piece goes on past a word into the next blank: chunks can then be encoded one by one.
        self.cuts = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.memo: dict[str, tuple[int, ...]] = _Memo(self)
        self.agree: dict[int, bool] = {}
        self.width = len(self.pieces) + 1
        if {c for p in self.ids for c in p} - self.ids.keys():
            raise ValueError("a piece holds a character that has no piece of its own")

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("pieces", "model_type")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._index()

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        text = text.replace(BLANK, " ")
        if not self.cuts:
            return list(self._passed(BLANK + text.replace(" ", BLANK)))
        words = text.split(" ")
        if "" in words:
            words = re.findall(" *[^ ]+| +", " " + text)
            return list(chain.from_iterable(map(self.memo.__getitem__, (w[1:] for w in words))))
        return list(chain.from_iterable(map(self.memo.__getitem__, words)))

    def _passed(self, text: str) -> tuple[int, ...]:
        """The single pass over ``text``, blanks already replaced."""
        if self.model_type == UNIGRAM:
            back = self._best_path(text)
        elif BLANK * 2 in text:
            return tuple(chain.from_iterable(self._known(self.ids.get(p, -1), p) for p in self.merged(text)))
        else:
            back = self._last_pieces(text)
        out, at = [], len(text)
        while at:
            size, i = back[at]
            out.append((i,) if i >= 0 else self._known(i, text[at - size : at]))
            at -= size
        ids = chain.from_iterable(reversed(out))
        return tuple(ids) if self.byte_ids else tuple(self._joined(ids))

    def _known(self, i: int, part: str) -> tuple[int, ...]:
        return (i,) if i >= 0 else tuple(self.byte_ids[b] for b in part.encode()) if self.byte_ids else (self.unknown,)

    def _joined(self, ids: Iterable[int]) -> Iterator[int]:
        """Neighbouring unknown characters are one unknown piece."""
        last = None
        for i in ids:
            if i != self.unknown or i != last:
                yield i
            last = i

    def _best_path(self, text: str) -> list[tuple[int, int]]:
        """(length, id) of the last piece on the best path to each position."""
        best, back = [0.0], [(0, -1)]
        for at in range(len(text)):  # so far a way by unknown characters only
            best.append(-1e300)
            back.append((1, -1))
        reached = 0

        def unknown_up_to(position: int) -> None:
            nonlocal reached
            for at in range(reached + 1, position + 1):
                if best[at - 1] + self.lowest > best[at]:
                    best[at], back[at] = best[at - 1] + self.lowest, (1, -1)
            reached = max(reached, position)

        for end, (length, i) in self.automaton.iter(text):
            unknown_up_to(end)
            new = best[end + 1 - length] + self.scores[i]
            if new > best[end + 1]:
                best[end + 1], back[end + 1] = new, (length, i)
        return back

    def _last_pieces(self, text: str) -> list[tuple[int, int]]:
        """(length, id) of the one piece that ends the merge result of each beginning of ``text``."""
        back = [(0, -1)] + [(1, -1)] * len(text)
        settled, agree, width = 0, self.agree, self.width
        for end, (length, i) in self.automaton.iter(text):  # the longest piece first
            if end < settled:
                continue
            key = back[end + 1 - length][1] * width + i
            fits = agree.get(key)
            if fits is None:
                fits = self._neighbours(back[end + 1 - length][1], i, key)
            if fits:
                back[end + 1] = (length, i)
                settled = end + 1
        return back

    def _neighbours(self, left: int, right: int, key: int) -> bool:
        """Whether merging the two pieces together gives the two; -1 stands for the text's begin or an unknown character."""
        if len(self.agree) > AGREE_SIZE:
            self.agree.clear()
        pair = ([self.pieces[left][0]] if left >= 0 else []) + [self.pieces[right][0]]
        fits = self.agree[key] = self.merged("".join(pair)) == pair
        return fits

    def merged(self, text: str) -> list[str]:
        """Merges by score, the leftmost of equals first; for runs of blanks and pairs of pieces."""
        parts, after, before = [*text], [*range(1, len(text)), -1], [*range(-1, len(text) - 1)]
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.ids.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-self.scores[found], i, parts[i], parts[j]))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = left + right, "", after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids))
        return text.removeprefix(b" ").decode("utf-8", "replace")


class _Memo(dict):
    """Ids of a chunk, given without its leading blank."""

    def __init__(self, codec: PieceCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.codec._passed(BLANK + word.replace(" ", BLANK))
        if len(word) <= MEMO_CHARS:
            if len(self) > MEMO_SIZE:
                self.clear()
            self[word] = ids
        return ids


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_tokens``, ``token_ids`` and ``round_trip`` (the ids decode to the text) of every row."""
    ship(docs.sparkSession)
    codec = docs.sparkSession.sparkContext.broadcast(PieceCodec(model))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = codec.value
        for batch in batches:
            flat, offsets, same = [], [0], []
            for text in batch.column(1):
                text = text.as_py()
                ids = coded.encode(text)
                flat.append(np.array(ids, np.int32))
                offsets.append(offsets[-1] + len(ids))
                same.append(coded.decode(ids) == (text or "").replace(BLANK, " "))
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            n = pa.array(np.diff(offsets), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, ids, pa.array(same, pa.bool_())], ["id", "n_tokens", "token_ids", "round_trip"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(encode, fields(texts, "id", and_="n_tokens long, token_ids array<int>, round_trip boolean")).withColumnRenamed("id", id_col)


def decode_texts(coded: DataFrame, model: str, ids_col: str = "token_ids", out: str = "text") -> DataFrame:
    """``coded`` with the text of its ids in column ``out``; null ids give an empty text."""
    ship(coded.sparkSession)
    codec = coded.sparkSession.sparkContext.broadcast(PieceCodec(model))

    @F.pandas_udf("string")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in parts:
            yield ids.map(lambda i: codec.value.decode(i) if i is not None else "")

    return coded.withColumn(out, decode(ids_col))

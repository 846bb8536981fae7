"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax output.

Training runs numpy stochastic gradient descent over a bounded sample of labelled documents: at most
``SAMPLE`` of them, those with the smallest hash of their id, so the choice is the same at every run. The
executors turn sampled texts into hashed features; only bounded feature counts (``FEATURES`` slots at most per document)
reach the driver. Whole texts are used in training and in scoring.

Features of a word: the word, its character n-grams of 3 to 5 bytes (with word ends marked), and its shape (letter
classes and marks, runs shortened); of two neighbours: whether the second repeats the first. The average of
vectors and the layer above are both linear, so for scoring each word has one number, its vectors' share of
the logit; a document's logit is the mean over its words. Workers remember words' numbers.

Defined results: a text without words (null, empty, blanks) has no features and scores the sample's share of good
documents. Labels that are null are not learnt from. Without any label all scores are 0.5. Documents with
several labels count once per label. Repeated rows score alike. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import LOWER, fields, ship

#: Hash slots, vector length, sampled documents, passes, learning rate, seed; words that a worker remembers.
FEATURES, SIZE, SAMPLE, EPOCHS, RATE, SEED = 1 << 16, 8, 4000, 4, 0.5, 11
MEMO_SIZE, MEMO_BYTES = 800_000, 64
#: n-gram lengths in bytes, and the multiplier of their polynomial hash.
GRAMS, BASE = (3, 4, 5), 0x100000001B3
#: Words looked up at once.
CHUNK_WORDS = 200_000
#: Byte classes of a word's shape: capitals, digits, letters; marks stand for themselves.
CLASSES = np.frombuffer(bytes(65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 97 if 97 <= b <= 122 or b > 127 else b for b in range(256)), np.uint8)


def _slot(values: np.ndarray, kind: int) -> np.ndarray:
    """Hash slots of polynomial hashes; ``kind`` keeps the kinds of features apart."""
    mixed = (values + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(40)) % np.uint64(FEATURES)


def _hashes(symbols: np.ndarray, owner: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """A hash of each word's symbols; ``place`` is a symbol's number within its word."""
    powers = np.cumprod(np.full(int(place.max()) + 1, BASE, np.uint64))
    out = np.zeros(n, np.uint64)
    np.add.at(out, owner, (symbols.astype(np.uint64) + np.uint64(1)) * powers[place])
    return out


def word_slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(slots, number of the word) of all features: the words, their shapes, and their n-grams with ``<`` and ``>`` at the ends."""
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    plain, marked = b"".join(words), b"<" + b"><".join(words).translate(LOWER) + b">"
    owner = np.repeat(np.arange(n), lengths)
    starts = np.cumsum(lengths) - lengths
    classes = CLASSES[np.frombuffer(plain, np.uint8)]
    fresh = np.concatenate(([True], (classes[1:] != classes[:-1]) | (owner[1:] != owner[:-1]))) | ~np.isin(classes, (65, 48, 97))
    rank = np.cumsum(fresh) - 1
    shape_place = rank - rank[starts][owner]
    lowered = np.frombuffer(plain.translate(LOWER), np.uint8)
    slots = [
        _slot(_hashes(lowered, owner, np.arange(len(owner)) - starts[owner], n), 1),
        _slot(_hashes(classes[fresh], owner[fresh], shape_place[fresh], n), 2),
    ]
    owners = [np.arange(n), np.arange(n)]
    symbols, of = np.frombuffer(marked, np.uint8).astype(np.uint64), np.repeat(np.arange(n), lengths + 2)
    value = symbols
    for size in range(2, max(GRAMS) + 1):
        value = value[:-1] * np.uint64(BASE) + symbols[size - 1 :] if len(value) > 1 else value[:0]
        if size in GRAMS and len(value):
            inside = of[: len(value)] == of[size - 1 :]
            slots.append(_slot(value[inside], size))
            owners.append(of[: len(value)][inside])
    return np.concatenate(slots).astype(np.int64), np.concatenate(owners)


REPEAT = int(_slot(np.array([0], np.uint64), 9)[0])


def document_slots(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights that sum to one): each word counts 1, shared by its features; a repetition of the word before counts 1 more."""
    words = (text or b"").split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    counts = Counter(words)
    slots, owner = word_slots([*counts])
    share = np.fromiter(counts.values(), np.float64, len(counts)) / np.bincount(owner, minlength=len(counts))
    weights = np.bincount(slots, share[owner], FEATURES)
    weights[REPEAT] += sum(map(bytes.__eq__, words, words[1:]))
    used = np.flatnonzero(weights)
    return used.astype(np.int32), (weights[used] / weights.sum()).astype(np.float32)


class Model:
    """Vectors per slot and the softmax layer; ``logits`` is what both come to per slot."""

    def __init__(self, vectors: np.ndarray, layer: np.ndarray, prior: float):
        self.vectors, self.layer, self.prior = vectors, layer, prior
        self.logits = (vectors @ (layer[1] - layer[0])).astype(np.float64)
        self.memo: dict[bytes, float] = {}

    def __getstate__(self):
        return {"logits": self.logits, "prior": self.prior, "memo": {}}

    def scores(self, texts: Iterable[bytes | None]) -> list[float]:
        """The probability of class 1 of each text."""
        out: list[float] = []
        held: list[list[bytes]] = []
        size = 0
        for text in texts:
            held.append((text or b"").split())
            size += len(held[-1])
            if size >= CHUNK_WORDS:
                out += self._scores(held)
                held, size = [], 0
        return out + self._scores(held)

    def _scores(self, documents: list[list[bytes]]) -> list[float]:
        memo = self.memo
        if len(memo) > MEMO_SIZE:
            memo.clear()
        new = [*set().union(*documents).difference(memo)]
        if new:
            slots, owner = word_slots(new)
            shares = np.bincount(owner, self.logits[slots]) / np.bincount(owner)
            memo.update(zip(new, shares.tolist(), strict=True))
        repeat, out = float(self.logits[REPEAT]), []
        for words in documents:
            if not words:
                out.append(self.prior)
                continue
            repeats = sum(map(bytes.__eq__, words, words[1:]))
            logit = (sum(map(memo.__getitem__, words)) + repeat * repeats) / (len(words) + repeats)
            out.append(float(1 / (1 + np.exp(-min(max(logit, -30.0), 30.0)))))
        for word in [w for w in new if len(w) > MEMO_BYTES]:
            del memo[word]
        return out


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Stochastic gradient descent, a document at a time; ``samples`` are (slots, weights that sum to one, label)."""
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / SIZE, 1 / SIZE, (FEATURES, SIZE)).astype(np.float32)
    layer = np.zeros((2, SIZE), np.float32)
    steps, done = max(1, epochs * len(samples)), 0
    for _ in range(epochs):
        for k in random.permutation(len(samples)):
            slots, weights, label = samples[k]
            hidden = weights @ vectors[slots]
            out = layer @ hidden
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[label] -= 1
            step = rate * (1 - done / steps)
            back = error @ layer
            layer -= step * np.outer(error, hidden)
            vectors[slots] -= (step * SCALE) * np.outer(weights, back)
            done += 1
    good = sum(label for *_, label in samples)
    return Model(vectors, layer, good / len(samples) if samples else 0.5)


#: The vectors' rate against the layer's: a document's weights sum to one, so each slot's own step is small.
SCALE = 40.0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from at most ``sample`` labelled rows of ``docs``."""
    ship(docs.sparkSession)
    marks = labels.select(F.col("doc_id").alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
    # The bound comes before the texts: ids first, then their texts alone.
    chosen = marks.orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [document_slots(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "label": batch.column("label"),
                "slots": pa.array([s.tobytes() for s, _ in rows], pa.binary()), "weights": pa.array([w.tobytes() for _, w in rows], pa.binary()),
            })

    # Rows that share an id would exceed the bound together, so the smallest text stands for them.
    single = texts.groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = single.mapInArrow(slots, fields(single, "id", and_="label int, slots binary, weights binary")).orderBy("id", "label").toLocalIterator()
    samples = []
    for row in rows:
        if row.slots:
            samples.append((np.frombuffer(row.slots, np.int32), np.frombuffer(row.weights, np.float32), row.label))
    return fit(samples)


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` (of class 1) and ``predicted`` (1 from ``threshold`` on) of every row."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return scored(texts, model).select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``id, score`` of rows with ``id`` and ``text``."""
    ship(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = sent.value.scores(t.as_py() for t in batch.column("text").cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values, pa.float64())], ["id", "score"])

    return rows.mapInArrow(score, fields(rows, "id", and_="score double"))


def good_documents(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; all columns stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("id"), F.col(text_col).alias("text"))
    return scored(rows, model).where(F.col("score") >= threshold).select("id.*")

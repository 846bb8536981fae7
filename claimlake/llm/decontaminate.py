"""Benchmark decontamination: a broadcast hash set of test windows, scanned over every document.

Words are runs of ASCII letters and digits (A-Z lower-cased) and non-ASCII characters. A benchmark item's
windows are its runs of ``window`` words; an item with fewer, but not none, is one window. Windows of word
numbers are hashed in one rolling pass over a batch of documents; every hash hit is verified word by
word. Documents come out with the words hit, the items found and, on request, their spans.

A benchmark of at most ``MAX_BYTES`` is broadcast whole, which bounds its windows. A larger one stays in Spark: its
windows are made by tasks and stored, and a bit array of their hashes, of fixed size, is broadcast. Document windows that the
array lets through are joined with the stored ones by hash and word for word; equal texts are
joined once. Both ways give the same rows; no case is dropped.

Defined results: null and empty texts have no words and are not hit; null or empty items have no windows;
an item without an id is scanned, hits words, and is left out of the item list. Items with the same id
count once. Repeated rows are judged alike. An empty benchmark hits nothing. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import fields, ship, stored

#: Bytes of a benchmark that is broadcast (its windows take some fifty times as much), and words scanned at once.
MAX_BYTES, SCAN_WORDS = 3_000_000, 2_000_000
#: Bits of the array of window hashes that is broadcast for larger benchmarks, in pieces of what Spark's bitmaps hold.
PIECE = 32_768
FILTER_BITS = 4_096 * PIECE
#: Bytes outside words become blanks, A-Z become lower case.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Numbers(dict):
    """Word numbers from 1 on; 0 for words that the benchmark lacks."""

    def __missing__(self, word: bytes) -> int:
        return 0


class WindowSet:
    """Hashed windows of some benchmark items, with the words to verify a hit."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.numbers = Numbers()
        found: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, words in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1):
                found[size][tuple(ids[start : start + size])].add(item)
        self.windows = {size: dict(of) for size, of in found.items()}
        self.hashes = {size: np.unique(rolled(np.array(list(of), np.uint64).reshape(-1), size)[::size]) for size, of in found.items()}

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """(first word, number of words, items) of every window in a run of word numbers; 0 is no benchmark word."""
        inside = np.concatenate(([0], np.cumsum(ids != 0)))
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            maybe = np.flatnonzero(inside[size:] - inside[:-size] == size)
            values = rolled(ids, size)[maybe]
            at = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
            known = self.windows[size]
            for start in maybe[hashes[at] == values]:
                items = known.get(tuple(ids[start : start + size].tolist()))
                if items is not None:
                    yield int(start), size, items


def rolled(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive numbers, mixed so that order counts."""
    n = len(ids) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        out = out * BASE + ids[k : k + n]
        out ^= out >> np.uint64(29)
    return out


def _scanned(windows, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Adds the hits: ``mask`` has a byte per word (compressed), ``items`` the ids found."""
    found: WindowSet = windows.value
    texts = batch.column("text").cast(pa.binary())
    masks: list[bytes | None] = [None] * batch.num_rows
    items: list[list[str]] = [[] for _ in range(batch.num_rows)]
    counts = [0] * batch.num_rows
    number = found.numbers.__getitem__
    pending: list[tuple[int, int, int]] = []  # row, first word, words
    ids: list[int] = []

    def flush() -> None:
        hits = np.zeros(len(ids), np.uint8)
        got: dict[int, set] = defaultdict(set)
        starts = np.array([start for _, start, _ in pending])
        for start, size, of in found.scan(np.array(ids, np.uint64)):
            hits[start : start + size] = 1
            got[int(np.searchsorted(starts, start, "right")) - 1] |= of
        for k, of in got.items():
            row, start, n = pending[k]
            masks[row] = zlib.compress(hits[start : start + n].tobytes(), 1)
            items[row] = sorted(i for i in of if i is not None)
        pending.clear()
        ids.clear()

    for row, text in enumerate(texts):
        words = words_of(text.as_py())
        counts[row] = len(words)
        if words:
            pending.append((row, len(ids), len(words)))
            ids.extend(map(number, words))
            ids.append(0)  # no window goes from one document into the next
        if len(ids) > SCAN_WORDS:
            flush()
    if pending:
        flush()
    columns = {name: batch.column(name) for name in batch.schema.names}
    columns |= {"n_words": pa.array(counts, pa.int64()), "mask": pa.array(masks, pa.binary()), "items": pa.array(items, pa.list_(pa.string()))}
    return pa.RecordBatch.from_pydict(columns)


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text``, ``n_words``, ``mask`` and ``items`` of every row; ``mask`` is null where nothing is hit."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where(F.length("text") > 0)
    size = items.agg(F.sum(F.length("text") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0]
    return _scan_broadcast(docs, items, window) if (size or 0) <= MAX_BYTES else _scan_joined(docs, items, window)


def _scan_broadcast(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    with_words = ((row.item, words_of(bytes(row.text))) for row in items.collect())
    windows = WindowSet([(item, words) for item, words in with_words if words], window)
    known = docs.sparkSession.sparkContext.broadcast(windows)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _scanned(known, batch)

    return docs.mapInArrow(scan, fields(docs, "id", and_="text string, n_words long, mask binary, items array<string>"))


class WordHashes(dict):
    """Hashes of words, made once each; emptied where it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORD_HASHES = WordHashes()


def _chunked(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a bounded number."""
    for some in batched(rows, 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """``size, hash, words, item`` of every benchmark window."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                size = min(window, len(words))
                hashes = rolled(WORD_HASHES.of(words), size).view(np.int64).tolist() if size else []
                for start, value in enumerate(hashes):
                    yield size, value, b" ".join(words[start : start + size]), item

    schema = pa.schema([("size", pa.int32()), ("hash", pa.int64()), ("words", pa.binary()), ("item", pa.string())])
    return items.mapInArrow(lambda batches: _chunked(made(batches), schema), "size int, hash long, words binary, item string")


def _hash_filter(windows: DataFrame) -> dict[int, np.ndarray]:
    """Per size of window the bits of its hashes; as many bytes as ``FILTER_BITS`` has at most for each."""
    slot = F.pmod("hash", F.lit(FILTER_BITS)) + 1
    pieces = windows.groupBy("size", F.bitmap_bucket_number(slot).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    found: dict[int, np.ndarray] = {}
    for row in pieces.toLocalIterator():
        bits = found.setdefault(row["size"], np.zeros(FILTER_BITS // 8, np.uint8))
        at = (row["piece"] - 1) * PIECE // 8
        bits[at : at + PIECE // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return found


def _scan_joined(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Document windows meet benchmark windows in a join; rows are told apart by their text, so equal ones are joined once."""
    windows = stored(_item_windows(items, window), "benchmark-windows")
    known = docs.sparkSession.sparkContext.broadcast(_hash_filter(windows))
    docs = docs.withColumn("key", F.sha2(F.col("text").cast("binary"), 256))

    def passing(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                words = words_of(text.cast(pa.binary()).as_py())
                hashed = WORD_HASHES.of(words)
                for size, bits in known.value.items():
                    values = rolled(hashed, size)
                    slots = (values.view(np.int64) % FILTER_BITS).astype(np.int64)
                    for start in np.flatnonzero(bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).tolist():
                        yield key, start, size, int(values[start].view(np.int64)), b" ".join(words[start : start + size])

    schema = pa.schema([("key", pa.string()), ("start", pa.int32()), ("size", pa.int32()), ("hash", pa.int64()), ("words", pa.binary())])
    rows = docs.where(F.length("text") > 0).select("key", "text")
    maybe = rows.mapInArrow(lambda batches: _chunked(passing(batches), schema), "key string, start int, size int, hash long, words binary")
    hits = maybe.distinct().join(windows.distinct(), ["size", "hash", "words"])
    # Both lists are bounded by the text: spans by its words, items by the windows that it holds.
    found = hits.groupBy("key").agg(F.collect_set(F.struct("start", "size")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    joined = docs.join(found, "key", "left").select("id", "text", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))

    def masked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, masks = [], []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                counts.append(len(words_of(text.cast(pa.binary()).as_py())))
                mask = np.zeros(counts[-1], np.uint8)
                for span in spans or ():
                    mask[span["start"] : span["start"] + span["size"]] = 1
                masks.append(zlib.compress(mask.tobytes(), 1) if spans else None)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "text": batch.column("text"), "n_words": pa.array(counts, pa.int64()),
                "mask": pa.array(masks, pa.binary()), "items": batch.column("items"),
            })

    return joined.mapInArrow(masked, fields(joined, "id", and_="text string, n_words long, mask binary, items array<string>"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: words, words hit, items found and a digest of their ids (sorted as strings)."""
    scanned = scan_documents(docs, benchmark, window, id_col, text_col)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [sum(zlib.decompress(m)) if m else 0 for m in batch.column("mask").to_pylist()]
            items = batch.column("items").to_pylist()
            sha = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "n_words": batch.column("n_words"), "n_hit": pa.array(hit, pa.int64()),
                "n_items": pa.array(map(len, items), pa.int64()), "items_sha256": pa.array(sha, pa.string()),
            })

    schema = fields(scanned, "id", and_="n_words long, n_hit long, n_items long, items_sha256 string")
    return scanned.drop("text").mapInArrow(digest, schema).withColumnRenamed("id", id_col).withColumn("contaminated", F.col("n_hit") > 0)


def without_spans(text: bytes, mask: np.ndarray) -> str:
    """The text without its hit words; what stands between two hit words goes with them."""
    letters = np.frombuffer(text.translate(WORD_BYTES), np.uint8) != 32
    word = np.cumsum(letters & ~np.concatenate(([False], letters[:-1])))  # the last word begun, from 1 on
    hit = np.concatenate(([0], mask, [0])).astype(bool)
    cut = hit[word] & (letters | hit[word + 1])
    return np.frombuffer(text, np.uint8)[~cut].tobytes().decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows (``remove="documents"``) or without their hit words (``"spans"``).

    All columns of ``docs`` stay, whatever their names; rows are judged by their own text, so repeated ids do no harm.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: {remove}")
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{text_col}`"].alias("text"))
    scanned = scan_documents(whole, benchmark, window, "row", "text")
    if remove == "documents":
        return scanned.where(F.col("mask").isNull()).select("id.*")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks = batch.column("text").to_pylist(), batch.column("mask").to_pylist()
            clean = [without_spans(t.encode(), np.frombuffer(zlib.decompress(m), np.uint8)) if m else t for t, m in zip(texts, masks, strict=True)]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "text": pa.array(clean, pa.string())})

    clean = scanned.mapInArrow(cut, fields(scanned, "id", and_="text string"))
    return clean.select(F.col("id").withField(f"`{text_col}`", F.col("text")).alias("id")).select("id.*")

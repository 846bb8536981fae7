"""Mixing sources to target weights: fixed-length blocks of words, dealt to output shards.

Words are maximal runs without ASCII white space. The words of a source's documents, in the order of (id, hash of the
text), are one stream, cut into blocks of ``BLOCK`` words; a block may hold the end of one document and the beginning
of the next, and a source's last block may be short. Places in the stream come from a range partitioning by (source,
id, hash) and running sums within its partitions, so a source with a third of all rows is spread over many tasks.

A source's target is its share of all words by weight, at most ``MOST`` times its own words; what goes beyond that is
shared anew by weight. A target is met exactly (to a whole word): it fixes how often a source's blocks are passed over
in whole, and how many slots are drawn in one pass more, the last slot being cut to length.

Output shards have ``SHARD`` slots. How many slots of a shard each source gets is a multinomial draw without
replacement. Independent draws would leave a source some sqrt(slots) off its target, and beyond the bound; so the draws
are conditioned on the totals: the slots of all shards are halved again and again, and each half's counts are drawn
from what the two have in common (multivariate hypergeometric, seeded by the half). A task follows the halves down to
its shards and needs no other task. Halves of more than ``DRAWN`` slots are split in proportion. The k-th slot of a
source takes, in its pass ``k // blocks``, the block that a keyed pseudorandom permutation of the block numbers (a
Feistel network that walks its cycles) gives for ``k % blocks``: no block comes twice in a pass, and nothing
is shuffled to draw it. Slots and blocks are joined by (source, block number).

Only one row per source comes to the driver; more than ``SOURCES`` sources are refused. Results depend on the rows and
``SEED`` only, whatever the partitions, files or lost executors.

Defined results: a null text has no words; null sources are one source, the last one; documents without words get
nothing. Rows with equal ids are rows of their own; equal rows get equal or different shares, as their places fall. An empty
table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake.llm.common import MASK, fields, ship, stored

#: Words of a block, slots of a shard, times a source may be repeated, sources, slots up to which halves are drawn, seed.
BLOCK, SHARD, MOST, SOURCES, DRAWN, SEED = 256, 1024, 3, 100_000, 500_000_000, 11
#: Weights of the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
ROW = ["no", "id", "h1", "h2"]


def n_words(text: bytes | None) -> int:
    data = np.frombuffer(text or b"", np.uint8)
    white = WHITE[data]
    return int(np.count_nonzero(~white[1:] & white[:-1])) + int(len(data) > 0 and not white[0])


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[float]:
    """Shares of all words by weight, none above ``most`` times its size; the excess is shared anew by weight."""
    held = [False] * len(sizes)
    while True:
        rest = sum(sizes) - sum(most * s for s, h in zip(sizes, held, strict=True) if h)
        weight = sum(w for w, h in zip(weights, held, strict=True) if not h)
        above = [not h and w * rest > most * s * weight for s, w, h in zip(sizes, weights, held, strict=True)]
        if not any(above):
            return [float(most * s) if h else w * rest / weight for s, w, h in zip(sizes, weights, held, strict=True)]
        held = [h or a for h, a in zip(held, above, strict=True)]


class Permutation:
    """A keyed permutation of 0 to n - 1, computed number by number."""

    def __init__(self, n: int, key: int) -> None:
        self.n, self.half = n, max(1, -(-max(n - 1, 1).bit_length() // 2))
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [np.uint64((key * 4 + k) * 0x9E3779B97F4A7C15 & MASK) for k in range(4)]

    def _round(self, half: np.ndarray, key: np.uint64) -> np.ndarray:
        mixed = (half + key) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (mixed ^ (mixed >> np.uint64(32))) & self.mask

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return left << np.uint64(self.half) | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in reversed(self.keys):
            left, right = right ^ self._round(left, key), left
        return left << np.uint64(self.half) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(x, np.uint64))
        while (outside := out >= self.n).any():
            out[outside] = step(out[outside])
        return out.astype(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self._forward)

    def place(self, value: int) -> int:
        """Where ``value`` comes."""
        return int(self._walk(np.array([value]), self._backward)[0])


@dataclass(frozen=True)
class Source:
    """A source's number, key of its permutations, words, target, slots, and words of its last slot that are not taken."""

    no: int
    key: int
    size: int
    target: float
    slots: int
    over: int

    @property
    def blocks(self) -> int:
        return -(-self.size // BLOCK)

    @staticmethod
    def aimed(no: int, key: int, size: int, target: float) -> Source:
        words, blocks = int(target), -(-size // BLOCK)
        if not size:
            return Source(no, key, size, target, 0, 0)
        passes, rest = divmod(words, size)
        short = blocks * BLOCK - size
        place = Permutation(blocks, key + passes).place(blocks - 1)  # of the short block in the pass that is cut off
        slots = -(-rest // BLOCK)
        if slots > place:
            slots = -(-(rest + short) // BLOCK)
        over = slots * BLOCK - (short if slots > place else 0) - rest
        return Source(no, key, size, target, passes * blocks + slots, over)


def _halved(first: int, shards: int, slots: tuple[int, ...]) -> tuple[int, ...]:
    """Of ``slots`` per source in ``shards`` shards from ``first`` on, those of the first half of the shards."""
    counts, want = np.array(slots, np.int64), shards // 2 * SHARD
    total = int(counts.sum())
    if total <= DRAWN:
        return tuple(np.random.default_rng([SEED, first, shards]).multivariate_hypergeometric(counts, want, method="marginals").tolist())
    parts = [int(c) * want // total for c in slots]
    rest = want - sum(parts)
    for k in sorted(range(len(parts)), key=lambda k: (-(slots[k] * want % total), k))[:rest]:
        parts[k] += 1
    return tuple(parts)


class Shards:
    """The slots of every shard, found by halving."""

    def __init__(self, sources: list[Source]) -> None:
        self.sources = sources
        self.total = tuple(s.slots for s in sources)
        self.shards = -(-sum(self.total) // SHARD)
        self.half = lru_cache(4096)(_halved)

    def __getstate__(self) -> list[Source]:
        return self.sources

    def __setstate__(self, sources: list[Source]) -> None:
        self.__init__(sources)

    def counts(self, shard: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Slots of each source before this shard, and in it."""
        first, shards, slots, before = 0, self.shards, self.total, [0] * len(self.total)
        while shards > 1:
            left = self.half(first, shards, slots)
            if shard < first + shards // 2:
                shards, slots = shards // 2, left
            else:
                before = [b + n for b, n in zip(before, left, strict=True)]
                slots = tuple(s - n for s, n in zip(slots, left, strict=True))
                first, shards = first + shards // 2, shards - shards // 2
        return tuple(before), slots

    def slots(self, shard: int) -> pa.RecordBatch:
        before, counts = self.counts(shard)
        order = np.random.default_rng([SEED, 1, shard]).permutation(sum(counts))
        cells: list[tuple[np.ndarray, ...]] = []
        for source, first, n in zip(self.sources, before, counts, strict=True):
            if not n:
                continue
            k = np.arange(first, first + n)
            passes, place = k // source.blocks, k % source.blocks
            block = np.empty(n, np.int64)
            for p in np.unique(passes):
                block[passes == p] = Permutation(source.blocks, source.key + int(p))(place[passes == p])
            words = np.minimum(BLOCK, source.size - block * BLOCK) - np.where(k == source.slots - 1, source.over, 0)
            cells.append((np.full(n, source.no), passes, block, words))
        no, passes, block, words = (np.concatenate(c) for c in zip(*cells, strict=True))
        return pa.RecordBatch.from_pydict({
            "shard": np.full(len(no), shard), "slot": order.astype(np.int32), "no": no.astype(np.int32),
            "pass": passes.astype(np.int32), "block": block, "words": words.astype(np.int32),
        })


def measured(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``id, source, h1, h2, size`` of every row."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"),
        text.cast("binary").alias("text"),
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([n_words(t.as_buffer() if t.is_valid else None) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "source", "h1", "h2")] + [sizes], ["id", "source", "h1", "h2", "size"])

    return rows.mapInArrow(count, fields(rows, "id", "source", "h1", "h2", and_="size long"))


def placed(rows: DataFrame) -> DataFrame:
    """``no, id, h1, h2, size, start``: the first word's place in its source, of all rows that have words."""
    dealt = rows.where("size > 0").select(*ROW, "size").repartitionByRange(*ROW).sortWithinPartitions(*ROW)

    def running(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            no, size = batch.column("no").to_numpy(), batch.column("size").to_numpy()
            start = np.cumsum(size) - size
            firsts = np.flatnonzero(np.concatenate(([True], no[1:] != no[:-1])))
            base = -start[firsts]
            if len(no) and no[0] == last:
                base[0] += total
            start = start + np.repeat(base, np.diff([*firsts, len(no)]))
            if len(no):
                last, total = no[-1], start[-1] + size[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(start, pa.int64()), pa.array(np.full(len(no), part, np.int32))], [*batch.schema.names, "start", "part"]
            )

    runs = stored(dealt.mapInArrow(running, fields(dealt, *ROW, "size", and_="start long, part int")), "word-places")
    sums = runs.groupBy("no", "part").agg(F.sum("size").alias("words"))  # a row per source and partition
    before = Window.partitionBy("no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("no", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    return runs.join(bases, ["no", "part"]).select(*ROW, "size", (F.col("start") + F.col("base")).alias("start"))


@dataclass(frozen=True)
class Mix:
    """``rows`` (``no, id, h1, h2, size``), ``places`` of those with words, ``slots``, and ``sources`` (``no, source, source_size, target``)."""

    rows: DataFrame
    places: DataFrame
    slots: DataFrame
    sources: DataFrame


def plan(docs: DataFrame, weights: Iterable[int] = WEIGHTS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> Mix:
    spark = docs.sparkSession
    ship(spark)
    rows = stored(measured(docs, id_col, source_col, text_col), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("size"), F.xxhash64("source").alias("key"))
    found = sums.orderBy(F.col("source").asc_nulls_last()).limit(SOURCES + 1).collect()
    if len(found) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    weights = list(weights)
    aims = targets([r["size"] for r in found], [weights[k % len(weights)] for k in range(len(found))])
    sources = [Source.aimed(k, (r["key"] & MASK) >> 3, r["size"], t) for k, (r, t) in enumerate(zip(found, aims, strict=True))]
    schema = fields(rows, "source", and_="no int, source_size long, target double")
    known = spark.createDataFrame([(r["source"], s.no, s.size, s.target) for r, s in zip(found, sources, strict=True)], schema)
    names = F.broadcast(known.select("no", F.col("source").alias("name")))
    numbered = rows.join(names, F.col("source").eqNullSafe(F.col("name"))).select(*ROW, "size")
    return Mix(numbered, placed(numbered), slots_of(spark, Shards(sources)), F.broadcast(known))


def slots_of(spark: SparkSession, shards: Shards) -> DataFrame:
    """``shard, slot, no, pass, block, words``: which block every slot takes, and how many of its words.

    Spark takes a row for a shard when it sizes this up, so the hint keeps it from broadcasting the slots.
    """

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                yield shards.slots(shard)

    return spark.range(shards.shards).mapInArrow(draw, "shard long, slot int, no int, pass int, block long, words int").hint("merge")


def _blocks(start: Column, size: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / BLOCK), F.floor((start + size - 1) / BLOCK))).alias("block")


def mix_report(docs: DataFrame, weights: Iterable[int] = WEIGHTS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, size, source_size, target`` (both of its source) and ``taken``, the words of it that the mix holds, repeats counted."""
    mix = plan(docs, weights, id_col, source_col, text_col)
    pieces = mix.places.select("no", "start", "size", _blocks(F.col("start"), F.col("size")))
    first = F.greatest(F.col("start") - F.col("block") * BLOCK, F.lit(0))
    last = F.least(F.col("start") + F.col("size") - F.col("block") * BLOCK, F.lit(BLOCK))
    used = pieces.join(mix.slots, ["no", "block"]).groupBy("no", "start").agg(
        F.sum(F.least(last, "words") - F.least(first, "words")).cast("long").alias("taken")
    )
    with_words = mix.places.join(used, ["no", "start"], "left").select("no", "id", "size", "taken")
    without = mix.rows.where("size = 0").select("no", "id", "size", F.lit(0).cast("long").alias("taken"))
    return with_words.unionByName(without).join(mix.sources, "no").select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix_texts(docs: DataFrame, weights: Iterable[int] = WEIGHTS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: ``shard, slot, source, pass, block, words, text``, a row per slot; a block's words are joined by blanks."""
    mix = plan(docs, weights, id_col, source_col, text_col)
    text = F.col(text_col)
    texts = docs.select(
        F.col(id_col).alias("did"), F.col(source_col).alias("dsource"), F.xxhash64(text).alias("dh1"), F.xxhash64(F.lit("second"), text).alias("dh2"), text.alias("text")
    ).where("text is not null").dropDuplicates(["did", "dsource", "dh1", "dh2"])
    held = mix.places.join(mix.sources, "no")
    same = F.col("dh1").eqNullSafe(F.col("h1")) & (F.col("dh2") == F.col("h2")) & F.col("did").eqNullSafe(F.col("id")) & F.col("dsource").eqNullSafe(F.col("source"))
    rows = held.join(texts, same).select("no", "start", "text")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, start, text in zip(*(batch.column(c).to_pylist() for c in ("no", "start", "text")), strict=True):
                words = text.encode().split()
                begin = start - start % BLOCK
                ends = [max(a - start, 0) for a in range(begin, start + len(words), BLOCK)] + [len(words)]
                pieces = [b" ".join(words[a:b]).decode() for a, b in zip(ends, ends[1:], strict=False)]
                blocks = np.arange(len(pieces)) + begin // BLOCK
                yield pa.RecordBatch.from_pydict({
                    "no": np.full(len(pieces), no, np.int32), "block": blocks, "first": np.array(ends[:-1], np.int64) + start, "text": pa.array(pieces, pa.string()),
                })

    pieces = rows.mapInArrow(cut, "no int, block long, first long, text string")
    blocks = pieces.groupBy("no", "block").agg(F.array_sort(F.collect_list(F.struct("first", "text"))).alias("pieces"))  # BLOCK words
    whole = blocks.select("no", "block", F.array_join(F.transform("pieces", lambda p: p["text"]), " ").alias("text"))
    # A slot that is cut takes the first words; the words of a block stand between single blanks.
    taken = F.when(F.col("words") < BLOCK, F.expr("substring_index(text, ' ', words)")).otherwise(F.col("text"))
    return whole.join(mix.slots, ["no", "block"]).join(mix.sources, "no").select(
        "shard", "slot", "source", "pass", "block", "words", taken.alias("text")
    )

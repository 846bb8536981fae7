"""Phrase collocation mining over suffix subtrees, with vertical partitioning by memory budget.

A document's text, A-Z in lower case, is cut at ``BREAKS`` into pieces and these at blanks and tabs into words. Everything is
counted per language. The suffixes of a piece are the words from each place on, five at most: the tree of all suffixes has
a node per phrase of up to five words, and a node's count is the sum of the leaves below it.

Four passes over the texts, each counting in a bounded table before anything is shuffled:

1. words and their counts. A word goes on as a number, 63 bits of a hash of language and word.
2. pairs of neighbours that both occur ``min_count`` times; these counts are the nodes of two words.
3. phrases of three to five words, of such pairs only, not one by one but by buckets of their hashes (Park, Chen and Yu): a bucket
   counts at least what any phrase in it does, so phrases of a bucket below ``min_count`` are rare. There is a bucket for each
   ``LOAD`` pairs counted.
4. suffixes of three words at least, cut where a phrase from their first word on falls in such a bucket: no candidate begins with
   one, so no node that counts is lost, and few leaves remain. Equal leaves are added up.

Which words and pairs are frequent, and longer phrases may be, is asked of bit tables of bounded size (``WORD_BITS``, ``PAIR_BITS``
and at most ``PHRASE_BITS`` numbers), the only things that are broadcast. A rare phrase that passes by a collision costs a leaf and
changes nothing, as all counts are taken from the pairs and leaves, whole number by whole number.

Vertical partitioning: a prefix of one word whose leaves exceed the budget of ``LEAVES`` is split by two words, and so on; the
prefixes are dealt to groups of about that many leaves. Each group is sorted and its subtree built in one
task, on its own, by comparing neighbouring leaves; heavy prefixes' counts are sums over the groups that hold their children.

Cuts, containment and ranks are joins and group-bys over nodes that occur ``min_count`` times; texts of words are only
joined to the phrases that may be among the first ``top`` of a language.

Defined results: a null language is ``und``; null and empty texts have no words; rows with equal ids count each; a word
may be as long as the text. Two words of a corpus of 10^8 frequent ones share a number with a probability of some
5e-4. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from claimlake.llm.common import ship, stored

BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Stands for a break; no UTF-8 text holds this byte.
BREAK = b"\xff"
FOLD = bytes.maketrans(string.ascii_uppercase.encode() + BREAKS, string.ascii_lowercase.encode() + BREAK * len(BREAKS))
DEPTH = 5
PLACES = [f"w{k}" for k in range(1, DEPTH + 1)]
#: Numbers of the bit tables' places as powers of two: 8 MB for words, 16 MB for pairs and at most for longer phrases.
WORD_BITS, PAIR_BITS, PHRASE_BITS = 26, 27, 27
#: Counted pairs for a bucket of longer phrases, and buckets (a power of two) that are added up together.
LOAD, BLOCK_BITS = 16, 16
#: Distinct words, pairs or leaves a task counts, words it looks at together, leaves of a group, heavy prefixes at each depth, bytes cut at a time,
#: rows passed on at a time.
COUNTED, TOGETHER, LEAVES, HEAVY, BYTES, PASSED = 500_000, 1 << 19, 250_000, 50_000, 1 << 20, 1 << 16


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words, and ``BREAK`` between pieces, part by part; a part ends between words."""
    begin = 0
    while begin < len(text):
        end = begin + BYTES
        while end < len(text) and text[end] > 0x20:
            end += 1
        yield text[begin:end].translate(FOLD).replace(BREAK, b" " + BREAK + b" ").split()
        begin = end


def word_number(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=xxhash.xxh32_intdigest(lang.encode())) >> 1 or 1


def pair_numbers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) + np.uint64(0xD1B54A32D192ED03))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(1)).astype(np.int64)


class Bits:
    """Which numbers of 63 bits may be in a set: a bit for their leading ``size`` bits."""

    def __init__(self, table: np.ndarray, size: int) -> None:
        self.table, self.shift = table, 63 - size

    def has(self, numbers: np.ndarray) -> np.ndarray:
        place = numbers >> self.shift
        return (self.table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)

    def has_one(self, number: int) -> bool:
        place = number >> self.shift
        return bool(self.table[place >> 3] >> (place & 7) & 1)

    @staticmethod
    def blocks(parts: DataFrame, size: int) -> Bits:
        """From ``part, bits``: the bits of each block of buckets that has any."""
        table = np.zeros((1 << size) // 8, np.uint8)
        length = 1 << BLOCK_BITS - 3
        for part, bits in parts.toLocalIterator():
            table[part * length : (part + 1) * length] = np.frombuffer(bits, np.uint8)
        return Bits(table, size)

    @staticmethod
    def of(numbers: DataFrame, column: str, size: int) -> Bits:
        """Built by Spark in pieces of 4 KB; 2^size bits in all come to the driver, whatever the rows."""
        place = F.shiftright(column, 63 - size) + 1
        parts = numbers.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
        table = np.zeros((1 << size) // 8, np.uint8)
        for part, bits in parts.groupBy("part").agg(F.bitmap_construct_agg("bit")).toLocalIterator():
            table[(part - 1) * 4096 : part * 4096] = np.frombuffer(bits, np.uint8)
        return Bits(table, size)


class Numbers(dict):
    """Numbers of a language's words, 0 for those that are rare (or a break)."""

    def __init__(self, lang: str, frequent: Bits) -> None:
        self.lang, self.frequent = lang, frequent

    def __missing__(self, word: bytes) -> int:
        number = 0 if word == BREAK else word_number(self.lang, word)
        if number and not self.frequent.has_one(number):
            number = 0
        if len(self) >= COUNTED:
            self.clear()
        self[word] = number
        return number


def texts_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text")
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, id, word, n``; the row of a language without a word has the count of all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter[bytes]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in seen.items():
                counts.pop(BREAK, None)
                words = [*counts, None]
                ids = [word_number(lang, w) for w in counts] + [0]
                n = [*counts.values(), sum(counts.values())]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(n), pa.string()), "id": pa.array(ids, pa.int64()), "word": pa.array(words, pa.binary()), "n": pa.array(n, pa.int64()),
                })
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts = seen.setdefault(lang, Counter())
                for part in tokens(text):
                    counts.update(part)
            if sum(map(len, seen.values())) >= COUNTED:
                yield from flush()
        yield from flush()

    parts = texts.mapInArrow(run, "lang string, id long, word binary, n long")
    return parts.groupBy("lang", "id", "word").agg(F.sum("n").alias("n"))


def added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of ``keys`` sorted, equal ones once with the sum of their ``n``."""
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(n)), bool), (keys[:, 1:] != keys[:, :-1]).any(0))))
    return keys[:, starts], np.add.reduceat(n[order], starts) if len(n) else n


def _runs(
    texts: DataFrame, frequent, keys_of: Callable[[np.ndarray], np.ndarray], rows_of: Callable[[np.ndarray, np.ndarray], pa.RecordBatch], schema: str
) -> DataFrame:
    """Rows that ``rows_of`` makes of keys, sorted, and how often each occurs, column by column of what ``keys_of`` gives for the numbers of
    many texts in a row, with zeros for rare words and breaks, also between texts. A task holds some ``COUNTED`` keys before it passes them on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Numbers] = {}
        held, n = [], 0
        counted: list[tuple[np.ndarray, np.ndarray]] = []

        def count() -> None:
            keys = keys_of(np.concatenate(held))
            held.clear()
            counted.append(added(keys, np.ones(keys.shape[1], np.int64)))
            if len(counted) > 1 and sum(len(c[1]) for c in counted) > COUNTED:
                merge()

        def merge() -> None:
            keys, sums = added(np.concatenate([c[0] for c in counted], 1), np.concatenate([c[1] for c in counted]))
            counted[:] = [(keys, sums)]

        def flush() -> Iterator[pa.RecordBatch]:
            merge()
            rows = rows_of(*counted.pop())
            for begin in range(0, rows.num_rows, PASSED):
                yield rows.slice(begin, PASSED)

        for batch in batches:
            for lang, text in ((a.as_py(), b.as_py()) for a, b in zip(batch.column("lang"), batch.column("text"), strict=True)):
                if lang not in known:
                    if len(known) >= 64:
                        known.clear()
                    known[lang] = Numbers(lang, frequent.value)
                number = known[lang].__getitem__
                for part in tokens(text):
                    held.append(np.fromiter(map(number, part), np.int64, len(part)))
                    n += len(part)
                held.append(np.zeros(1, np.int64))
                if n >= TOGETHER:
                    count()
                    n = 0
                    if len(counted[0][1]) > COUNTED:
                        yield from flush()
        if held:
            count()
        if counted:
            yield from flush()

    return texts.mapInArrow(run, schema)


def _sums(texts: DataFrame, frequent, names: list[str], keys_of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``names, n``: how often each key occurs."""

    def rows(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(sums)], [*names, "n"])

    parts = _runs(texts, frequent, keys_of, rows, ", ".join(f"{p} long" for p in [*names, "n"]))
    return parts.groupBy(*names).agg(F.sum("n").alias("n"))


def pair_counts(texts: DataFrame, frequent) -> DataFrame:
    """``w1, w2, n`` of neighbours that are both frequent."""

    def pairs_of(ids: np.ndarray) -> np.ndarray:
        a = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        return np.stack((ids[a], ids[a + 1]))

    return _sums(texts, frequent, PLACES[:2], pairs_of)


def pair_bits(counts: DataFrame) -> Bits:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pair_numbers(batch.column("w1").to_numpy(), batch.column("w2").to_numpy()))], ["pair"])

    return Bits.of(counts.select("w1", "w2").mapInArrow(run, "pair long"), "pair", PAIR_BITS)


def phrase_numbers(ids: np.ndarray, pairs: Bits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For three, four and five words: places where only frequent pairs follow one another, and the phrases' numbers."""
    a = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    numbers = pair_numbers(ids[a], ids[a + 1])
    frequent = pairs.has(numbers)
    at, numbers = a[frequent], numbers[frequent]
    goes_on = np.zeros(len(ids) + DEPTH, bool)
    goes_on[at] = True
    for size in range(3, DEPTH + 1):
        more = goes_on[at + size - 2]
        at, numbers = at[more], numbers[more]
        numbers = pair_numbers(numbers, ids[at + size - 1])
        yield at, numbers


def phrase_bits(texts: DataFrame, frequent, pairs, size: int, min_count: int) -> Bits:
    """The buckets of 2^``size`` whose phrases of three to five words occur ``min_count`` times, all together.

    A task passes on the buckets it has met block by block, as places in the block and counts of ``min_count`` at most.
    """

    kind = np.min_scalar_type(min_count)

    def buckets_of(ids: np.ndarray) -> np.ndarray:
        return np.concatenate([numbers for _, numbers in phrase_numbers(ids, pairs.value)])[None, :] >> 63 - size

    def rows(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        block, place = keys[0] >> BLOCK_BITS, (keys[0] & (1 << BLOCK_BITS) - 1).astype(np.uint16)
        counts = np.minimum(sums, min_count).astype(kind)
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        spans = list(zip(starts, [*starts[1:], len(block)], strict=False))
        packed = [pa.array([values[a:b].tobytes() for a, b in spans], pa.binary()) for values in (place, counts)]
        return pa.RecordBatch.from_arrays([pa.array(block[starts].astype(np.int32)), *packed], ["part", "places", "counts"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(1 << BLOCK_BITS, np.int64)

        def bits() -> pa.RecordBatch:
            table = np.packbits(total >= min_count, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([table], pa.binary())], ["part", "bits"])

        for batch in batches:
            for part, places, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "places", "counts")), strict=True):
                if part != now:
                    if now is not None:
                        yield bits()
                    now = part
                    total[:] = 0
                total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, kind)
        if now is not None:
            yield bits()

    met = _runs(texts, frequent, buckets_of, rows, "part int, places binary, counts binary")
    sums = met.repartition("part").sortWithinPartitions("part").mapInArrow(add, "part int, bits binary")
    return Bits.blocks(stored(sums, "phrase-buckets"), size)


def leaves(texts: DataFrame, frequent, pairs, phrases) -> DataFrame:
    """``w1`` to ``w5`` (0 beyond a suffix's end) and ``n``: the leaves of all subtrees, of three words at least."""

    def suffixes(ids: np.ndarray) -> np.ndarray:
        length = np.zeros(len(ids), np.int64)
        for size, (at, numbers) in enumerate(phrase_numbers(ids, pairs.value), 3):
            at = at[phrases.value.has(numbers)]
            length[at if size == 3 else at[length[at] == size - 1]] = size
        at = np.flatnonzero(length)
        suffix = np.zeros((DEPTH, len(at)), np.int64)
        for k in range(DEPTH):
            more = length[at] > k
            suffix[k, more] = ids[at[more] + k]
        return suffix

    return _sums(texts, frequent, PLACES, suffixes)


def grouped(rows: DataFrame, total: int) -> DataFrame:
    """The leaves with ``cut`` (length of the prefix they are dealt by) and ``bin`` (group).

    A prefix is lengthened while its leaves exceed the budget; there are at most ``HEAVY`` such prefixes of a length.
    """
    budget = max(LEAVES, total // HEAVY)
    marked = rows.withColumn("cut", F.lit(1))
    for depth in range(1, DEPTH):
        prefix = PLACES[:depth]
        heavy = marked.where(F.col("cut") == depth).groupBy(*prefix).agg(F.count(F.lit(1)).alias("leaves")).where(F.col("leaves") > budget)
        known = heavy.drop("leaves").collect()
        if not known:
            break
        table = F.broadcast(rows.sparkSession.createDataFrame(known, ", ".join(f"{p} long" for p in prefix)).withColumn("more", F.lit(1)))
        marked = marked.join(table, prefix, "left").withColumn("cut", F.col("cut") + F.coalesce("more", F.lit(0))).drop("more")
    key = F.xxhash64(*[F.when(F.col("cut") > k, F.col(p)) for k, p in enumerate(PLACES)])
    return marked.withColumn("bin", F.pmod(key, F.lit(-(-total // budget) or 1)).cast("int"))


def subtree(suffix: np.ndarray, n: np.ndarray, cut: np.ndarray, min_count: int) -> pa.RecordBatch:
    """``words, a``: nodes of a group's sorted leaves. Those above a prefix have part of their count here and all stay."""
    cells: list[tuple[pa.Array, np.ndarray]] = []
    new = np.ones(suffix.shape[1], bool)
    new[1:] = False
    for depth in range(1, DEPTH + 1):
        new[1:] |= suffix[depth - 1, 1:] != suffix[depth - 1, :-1]
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(n, starts)
        stays = (suffix[depth - 1, starts] > 0) & ((counts >= min_count) | (depth < cut[starts]))
        if depth > 2:
            words = suffix[:depth, starts[stays]].T
            offsets = np.arange(len(words) + 1, dtype=np.int32) * depth
            cells.append((pa.ListArray.from_arrays(offsets, np.ascontiguousarray(words).ravel()), counts[stays]))
    return pa.RecordBatch.from_arrays([pa.concat_arrays([c[0] for c in cells]), pa.array(np.concatenate([c[1] for c in cells]))], ["words", "a"])


def nodes(dealt: DataFrame, min_count: int) -> DataFrame:
    """``words, a`` of all phrases of three to five words that occur ``min_count`` times."""
    order = ["bin", *PLACES]
    rows = dealt.repartition("bin").sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def build() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            return subtree(np.stack([table.column(p).to_numpy() for p in PLACES]), table.column("n").to_numpy(), table.column("cut").to_numpy(), min_count)

        for batch in batches:
            groups = batch.column("bin").to_numpy()
            starts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            for a, b in zip(starts, starts[1:], strict=False):
                if a == b:
                    continue
                if held and groups[a] != now:
                    yield build()
                now = groups[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield build()

    parts = rows.mapInArrow(run, "words array<long>, a long")
    return parts.groupBy("words").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)


def cuts(candidates: DataFrame, known: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """``words, lang, a, k, l, r, n, score`` of each candidate's lowest-scoring cut, of equal ones that with the smallest k."""
    parts = candidates.select("words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    parts = parts.select(
        "*", F.slice("words", F.lit(1), F.col("k")).alias("first"), F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest")
    )
    sides = parts.join(known.select(F.col("words").alias("first"), F.col("a").alias("l")), "first")
    sides = sides.join(known.select(F.col("words").alias("rest"), F.col("a").alias("r")), "rest")
    langs = words.select(F.col("id").alias("head"), "lang")
    sides = sides.withColumn("head", F.col("words")[0]).join(langs, "head").join(totals, "lang")
    # Sizes up to 10^13 words: 1000 a n stays below 10^38.
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    exact = sides.withColumn("up", wide["a"] * wide["n"] * F.lit(1000)).withColumn("down", wide["l"] * wide["r"])
    scored = exact.withColumn("score", F.expr("up div down"))
    return scored.groupBy("words", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("least")).select("words", "lang", "a", "n", "least.*")


def contained(candidates: DataFrame, percent: int) -> DataFrame:
    """``words`` of candidates inside a longer one that occurs ``percent`` of their times."""
    long = candidates.where(F.size("words") > 2)
    size = F.col("size")
    inner = (
        long.select("words", "a", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
        .select("words", "a", "size", F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("at"))
        .select(F.slice("words", F.col("at"), size).alias("words"), "a").groupBy("words").agg(F.max("a").alias("longer"))
    )
    return candidates.join(inner, "words").where(100 * F.col("longer") >= percent * F.col("a")).select("words")


def collocations(
    docs: DataFrame, top: int = 2000, min_count: int = 100, percent: int = 100, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases by score."""
    spark = docs.sparkSession
    ship(spark)
    texts = texts_of(docs, text_col, lang_col)
    counted = stored(word_counts(texts).where((F.col("n") >= min_count) | F.col("word").isNull()), "phrase-words")
    words = counted.where("word is not null")
    totals = counted.where("word is null").select("lang", "n")
    frequent = spark.sparkContext.broadcast(Bits.of(words, "id", WORD_BITS))
    met = Observation()
    often = pair_counts(texts, frequent).where(F.col("n") >= min_count).observe(met, F.sum("n").alias("pairs"))
    often = stored(often, "phrase-pairs")
    pairs = spark.sparkContext.broadcast(pair_bits(often))
    size = min(max(((met.get.get("pairs") or 0) // LOAD).bit_length(), BLOCK_BITS), PHRASE_BITS)
    phrases = spark.sparkContext.broadcast(phrase_bits(texts, frequent, pairs, size, min_count))
    seen = Observation()
    tree = stored(leaves(texts, frequent, pairs, phrases).observe(seen, F.count(F.lit(1)).alias("leaves")), "phrase-leaves")
    longer = nodes(grouped(tree, seen.get.get("leaves") or 0), min_count)
    candidates = stored(longer.unionByName(often.select(F.array("w1", "w2").alias("words"), F.col("n").alias("a"))), "phrase-nodes")
    known = candidates.unionByName(words.select(F.array("id").alias("words"), F.col("n").alias("a")))
    scored = cuts(candidates, known, words, totals).join(contained(candidates, percent), "words", "left_anti")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    first = stored(scored.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place"), "phrase-first")
    spelled = (
        first.select("words", F.posexplode("words").alias("at", "id")).join(words.select("id", F.col("word").cast("string").alias("word")), "id")
        .groupBy("words").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
        .select("words", F.array_join(F.transform("parts", lambda p: p["word"]), " ").alias("phrase"))
    )
    ranks = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = first.join(spelled, "words").withColumn("rank", F.row_number().over(ranks).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

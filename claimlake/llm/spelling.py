"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the form each stands for.

Words are maximal runs of ``LETTERS``, A-Z in lower case, of at least ``MIN_CHARS`` code points that occur ``MIN_COUNT``
times in all. Tasks count them in a bounded table before anything is shuffled. (As the driver's documents have few
misspellings, a run may lose a code point by a rule of its document's id first, see ``misspelt``.)

Two words are near if common prefix and common suffix together reach the longer one's length less one. A word is in
the bucket of its own length L and of L + 1, the length of words with one more. The place of the edit, the common
prefix's length, lies in one of two windows [a, b) of the L places; near words agree before a and in the L - b last code
points, so they meet in the bucket of that window, and the pair counts there only. A bucket with more members
than ``MEMBERS`` gets two windows of half the width, and so on: at width one, its members differ in one place only,
so there are no more of them than letters. No bucket is large whatever the words, and rows grow with the words.

Within a task, buckets become padded matrices of code points, left- and right-aligned, of 2, 4, 8, ... rows, and
blocks of such matrices are compared as a whole: leading and trailing equal columns of every two rows. Only a count and the
best near word go on from there, no pairs. A word's form is the near word of largest count, if that is ``TIMES`` its
own. Forms have ever larger counts, so roots come by doubling steps, each a written table.

Defined results: null and empty texts have no words. A null id counts as an empty one. Rows with equal ids count each.
Very long runs are words as any other; blocks get smaller instead. An empty table gives no words. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimlake.llm.common import LOWER, ship, stored

LETTERS = "A-Za-zÀ-ÿ"
#: Code points and occurrences of a word, how many times more often a form is, one in so many runs loses a code point.
MIN_CHARS, MIN_COUNT, TIMES, MISSPELT = 6, 5, 5, 199
#: Words a task counts before it passes them on, members of a bucket, code points compared at a time.
COUNTED, MEMBERS, CELLS = 500_000, 256, 1 << 22
BUCKET = ["size", "a", "b", "key"]


def misspelt(run: str, head: int) -> str:
    """``run``, less one code point if the CRC of its document's id (whose CRC is ``head``) and itself says so."""
    h = zlib.crc32(run.encode(), head)
    if h % MISSPELT:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of words with ``MIN_CHARS`` code points and ``MIN_COUNT`` occurrences."""
    runs = re.compile(f"[{LETTERS}]{{{MIN_CHARS},}}")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for head, text in zip(batch.column("head").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for run, n in Counter(runs.findall(text.translate(LOWER).decode())).items():
                    seen[misspelt(run, head)] += n
                if len(seen) >= COUNTED:
                    yield flush()
        if seen:
            yield flush()

    head = F.crc32(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).cast("binary")).alias("head")
    rows = docs.where(F.col(text_col).isNotNull()).select(head, F.col(text_col).cast("binary").alias("text"))
    parts = rows.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= MIN_COUNT) & (F.char_length("word") >= MIN_CHARS))


def _windowed(rows: DataFrame, *windows: tuple[Column, Column]) -> DataFrame:
    """``word, n, size, a, b, key`` per window; ``key`` stands for what lies outside it."""
    both = F.inline(F.array(*[F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")) for a, b in windows]))
    cut = rows.select("word", "n", "size", both)
    tail = F.col("size") - F.col("b")
    return cut.withColumn("key", F.xxhash64(F.substring("word", F.lit(1), F.col("a")), F.substring("word", F.char_length("word") - tail + 1, tail)))


def buckets(words: DataFrame) -> DataFrame:
    """``word, n, size, a, b, key``: all words in buckets of at least two, none of them large."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("size"))
    middle = F.ceil(F.col("size") / 2)
    rows = _windowed(rows, (F.lit(0), middle), (middle, F.col("size")))
    done = None
    while True:
        # A bucket needs two members, one of them of full length; very long words make smaller buckets.
        most = F.greatest(F.least(F.lit(MEMBERS), F.floor(F.lit(CELLS) / F.col("size"))), F.lit(2))
        counts = rows.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("members"), F.max(F.char_length("word")).alias("longest"))
        counts = counts.where("members > 1 and longest = size").select(*BUCKET, ((F.col("members") > most) & (F.col("b") - F.col("a") > 1)).alias("large"))
        seen = Observation()
        marked = stored(rows.join(counts, BUCKET).observe(seen, F.count_if("large").alias("large")), "spelling-buckets")
        small = marked.where("not large").drop("large")
        done = small if done is None else done.unionByName(small)
        if not seen.get.get("large"):
            return done
        wide = marked.where("large").withColumnsRenamed({"a": "from", "b": "to"})
        middle = F.floor((F.col("from") + F.col("to")) / 2)
        rows = _windowed(wide, (F.col("from"), middle), (middle, F.col("to")))


def padded(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points left-aligned, right-aligned and reversed, with zeros; and lengths."""
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    if len(points) and points.max() < 256:
        points = points.astype(np.uint8)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.zeros((len(words), width), points.dtype)
    left[row, column] = points
    right = np.zeros_like(left)
    right[row, np.repeat(lengths, lengths) - 1 - column] = points
    return left, right, lengths


def _leading(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading equal columns of every row of ``a`` with every row of ``b``: (..., r, w) and (..., s, w) give (..., r, s)."""
    differ = a[..., :, None, :] != b[..., None, :, :]
    return np.where(differ.any(-1), differ.argmax(-1), a.shape[-1])


def compare(words: list[str], counts: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near words of each row within its bucket, and the first one of them (a row number; -1 for none).

    Buckets begin at ``starts`` and have their words by falling count, so the first near word is the one sought.
    """
    members = np.diff([*starts, len(words)])
    links, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
    rows_of = 1 << np.ceil(np.log2(members)).astype(int)
    for height in np.unique(rows_of):
        for width in np.unique(size[starts[rows_of == height]]):
            chosen = starts[(rows_of == height) & (size[starts] == width)]
            held = members[(rows_of == height) & (size[starts] == width)]
            at_once = max(1, CELLS // int(height * height * width))
            for k in range(0, len(chosen), at_once):
                first, n = chosen[k : k + at_once], held[k : k + at_once]
                place = first[:, None] + np.arange(height)
                real = np.arange(height) < n[:, None]
                place = np.where(real, place, first[:, None])
                left, right, lengths = padded([words[p] for p in place.ravel().tolist()], int(width))
                shape = (len(first), int(height), int(width))
                left, right, full = left.reshape(shape), right.reshape(shape), lengths.reshape(shape[:2]) == width
                block = max(1, CELLS // int(len(first) * height * width))
                for i in range(0, int(height), block):
                    prefix = _leading(left[:, i : i + block], left)
                    suffix = _leading(right[:, i : i + block], right)
                    rows = np.arange(i, min(i + block, int(height)))
                    near = (prefix + suffix >= width - 1) & (full[:, rows, None] | full[:, None, :]) & real[:, rows, None] & real[:, None, :]
                    near &= (prefix >= a[first][:, None, None]) & (prefix < b[first][:, None, None])
                    near &= rows[:, None] != np.arange(int(height))
                    g, r = np.nonzero(near.any(-1))
                    links[place[g, rows[r]]] = near[g, r].sum(-1)
                    best[place[g, rows[r]]] = place[g, near[g, r].argmax(-1)]
    return links, best


def near_counts(rows: DataFrame) -> DataFrame:
    """``word, links, best``: near words of each word in its buckets; ``best`` is (falling count, word)."""
    order = [*BUCKET, F.col("n").desc(), "word"]
    dealt = rows.select(*BUCKET, "n", "word").repartition(*BUCKET).sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows that may belong to a bucket that goes on
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            starts = _starts(table)
            held = table.slice(starts[-1])
            if len(starts) > 1:
                yield work(table.slice(0, starts[-1]), starts[:-1])
        if held is not None and held.num_rows:
            yield work(held, _starts(held))

    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        links, best = compare(words, n, *(table.column(c).to_numpy() for c in ("size", "a", "b")), starts)
        found = np.flatnonzero(links)
        return pa.RecordBatch.from_pydict({
            "word": pa.array([words[k] for k in found], pa.string()), "links": links[found],
            "best_n": n[best[found]], "best": pa.array([words[k] for k in best[found]], pa.string()),
        })

    return dealt.mapInArrow(run, "word string, links long, best_n long, best string")


def _starts(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in BUCKET:
        column = table.column(c).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the last form reached. Steps double; forms never run in a circle."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        seen = Observation()
        further = now.select(F.col("word").alias("w"), F.col("root").alias("far"))
        step = now.join(further, F.col("root") == F.col("w"), "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        now = stored(step.observe(seen, F.count_if("moved").alias("moved")), "roots").drop("moved")
        if not seen.get.get("moved"):
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: ``word, form, root, n, n_near, form_n``."""
    ship(docs.sparkSession)
    words = stored(word_counts(docs, id_col, text_col), "words")
    found = near_counts(buckets(words)).groupBy("word").agg(
        F.sum("links").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("near")
    )
    form_n = -F.col("near.less")
    is_form = F.coalesce(form_n >= TIMES * F.col("n"), F.lit(False))
    judged = stored(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near.form")).alias("form"), F.when(is_form, form_n).alias("form_n"),
    ), "variants")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

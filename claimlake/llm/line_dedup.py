"""Line dedup: lines that several documents share stay in the first document only.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. A key of at least
``min_chars`` code points that at least two documents hold loses all its lines outside the smallest document.

Keys travel as 128-bit hashes with their document and line number, never as text. They are stored, range-partitioned
by (hash, document, line) and sorted within, so a key that a third of all lines share is spread over many
partitions. Each partition streams its rows: the first document of a hash keeps its lines, the others' lines are
dropped. Only the first run of a partition may continue a hash of the partition before; its first
document is undecided. Each partition reports at most two such run ends, and one small aggregation over these
decides them. Dropped line numbers come together per document as a compressed keep bitmap, and the text
is only read again to apply it.

Defined results: a null or empty text is one empty line. Rows with one id are one document, judged row by
row (their lines are told apart by a hash of their text, so equal rows fare alike). Rows without an id are
one document that comes last. Other columns are neither read nor lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import ascii_lower, fields, ship, stored

#: The bytes 0x09 to 0x0D and the blank.
BLANKS = "\t\n\x0b\x0c\r "
#: Rows of sorted hashes that a task holds while it streams.
RUN = ("h1", "h2")


def line_hashes(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``h1, h2, last, id, text_hash, line``: a row per line whose key has ``min_chars`` code points."""
    lines = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line", "key")
    ).withColumn("key", ascii_lower(F.btrim("key", F.lit(BLANKS))))
    return lines.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), F.col("id").isNull().alias("last"), "id", "text_hash", "line"
    )


def dropped_lines(hashes: DataFrame) -> DataFrame:
    """``id, text_hash, line`` of every line to drop."""
    order = ["h1", "h2", "last", "id", "text_hash", "line"]
    hashes = stored(hashes, "line-hashes")  # the ranges are found by a pass of their own, which would split and hash all texts again
    dealt = hashes.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = fields(dealt, *order, and_="state byte, part int")

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """State 0: to drop. State 1: the first document of the first run, undecided. State 2: the first document of the last run."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        run = first = None  # the hash that is being streamed, and its first document
        leading = True
        tail: list[pa.RecordBatch] = []  # a row of the first document of the last run, if that run began here
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in RUN]
            starts = np.flatnonzero(np.concatenate(([True], (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]))))
            if run == (keys[0][0], keys[1][0]):
                starts = starts[1:]
            elif run is not None:
                leading = False
            ids = batch.column("id").to_pylist()
            state = np.zeros(batch.num_rows, np.int8)
            bounds = [0, *starts.tolist(), batch.num_rows]
            for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if a == b:
                    continue
                if k:  # a new run
                    leading = leading and run is None
                    run, first = (keys[0][a], keys[1][a]), ids[a]
                    tail = [] if leading else [batch.slice(a, 1)]
                n = a
                while n < b and ids[n] == first:
                    n += 1
                state[a:n] = 1 if leading else -1
            chosen = state >= 0
            if chosen.any():
                out = batch.filter(pa.array(chosen))
                yield _stated(out, state[chosen], part)
        if tail:
            yield _stated(tail[0], np.full(1, 2, np.int8), part)

    found = stored(dealt.mapInArrow(stream, schema), "line-runs")
    open_rows = found.where("state > 0")
    # Of the runs of one hash, the one that begins mid-partition (state 2), or else the earliest partition's, has the first document.
    begins = open_rows.groupBy(*RUN).agg(F.min(F.struct("part", "last", "id")).alias("begin"))
    later = (
        open_rows.where("state = 1").join(begins, list(RUN))
        .where((F.col("part") > F.col("begin.part")) & ~F.col("id").eqNullSafe(F.col("begin.id")))
    )
    columns = ["id", "text_hash", "line"]
    return found.where("state = 0").select(*columns).unionByName(later.select(*columns))


def _stated(batch: pa.RecordBatch, state: np.ndarray, part: int) -> pa.RecordBatch:
    arrays = [*batch.columns, pa.array(state, pa.int8()), pa.array(np.full(batch.num_rows, part, np.int32))]
    return pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "state", "part"])


def keep_bitmaps(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, keep``: compressed keep bits (up to the last dropped line; later lines stay) of documents that lose lines."""
    ship(docs.sparkSession)
    dropped = dropped_lines(line_hashes(docs, min_chars, id_col, text_col)).distinct()
    lists = dropped.groupBy("id", "text_hash").agg(F.collect_list("line").alias("lines"))  # no longer than the text they come from

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for lines in batch.column("lines").to_pylist():
                keep = np.ones(-(-(max(lines) + 1) // 8) * 8, bool)  # whole bytes: lines after the last dropped one stay
                keep[lines] = False
                bits.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], ["id", "text_hash", "keep"])

    return lists.mapInArrow(pack, fields(lists, "id", "text_hash", and_="keep binary"))


def kept_lines(text: str | None, bits: bytes | None) -> tuple[list[str], int]:
    """The lines that stay, and how many there were."""
    lines = (text or "").split("\n")
    if bits is None:
        return lines, len(lines)
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8)).astype(bool).tolist()
    return [line for k, line in enumerate(lines) if k >= len(keep) or keep[k]], len(lines)


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str, row) -> DataFrame:
    """``row, text, keep``: every document with its bitmap, if it has one."""
    side = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    marks = bitmaps.select(F.col("id").alias("bid"), F.col("text_hash").alias("bhash"), "keep")
    return side.join(marks, F.col("id").eqNullSafe(F.col("bid")) & (F.col("text_hash") == F.col("bhash")), "left").select("row", "text", "keep")


def line_report(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``n_lines`` before, ``n_dropped``, and ``kept_sha256`` of the lines that stay, joined by line feeds."""
    marked = _with_bitmaps(docs, keep_bitmaps(docs, min_chars, id_col, text_col), id_col, text_col, F.col(id_col))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [kept_lines(t.as_py(), k.as_py()) for t, k in zip(batch.column("text"), batch.column("keep"), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "n_lines": pa.array((n for _, n in kept), pa.int64(), size=len(kept)),
                "n_dropped": pa.array((n - len(lines) for lines, n in kept), pa.int64(), size=len(kept)),
                "kept_sha256": pa.array([hashlib.sha256("\n".join(lines).encode()).hexdigest() for lines, _ in kept], pa.string()),
            })

    return marked.mapInArrow(digest, fields(marked, "row", and_="n_lines long, n_dropped long, kept_sha256 string")).withColumnRenamed("row", id_col)


def dedup_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their kept lines as text; a null text stays null. All columns stay."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = _with_bitmaps(docs, keep_bitmaps(docs, min_chars, id_col, text_col), id_col, text_col, whole)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if k is None else "\n".join(kept_lines(t, k)[0]) for t, k in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "text": pa.array(texts, pa.string())})

    return marked.mapInArrow(cut, fields(marked, "row", and_="text string")).select(
        *[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )

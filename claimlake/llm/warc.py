"""WARC archives and their two-level capture index.

Writing. Every page becomes one WARC/1.1 record: a ``response`` with an HTTP block and the page's HTML, or, where an
equal payload of at least ``min_bytes`` bytes belongs to a page with a smaller id, a ``revisit`` that refers to
it. Records are built of Spark expressions and written by Spark's text writer, whose line separator is the
blank line that ends a record: the files are plain WARC, and any store that Spark writes will do.

Reading. Files come back as ``binaryFile`` rows; records are cut by their Content-Length, with file, offset and length,
and digests are computed anew from the payloads read. A file has as many records as make ``FILE_BYTES`` at the table's mean
payload; where longer pages lie together it gets larger.

Index. A capture line has the URL key (host labels reversed, ``net,example)/path``), page id, file, offset and length.
Lines are range-partitioned and sorted by key, cut into blocks of ``BLOCK_LINES`` lines, and each block is
compressed. The sparse directory holds one row per block: its first and last key. ``lookup`` searches the directory
by bisection, reads only the blocks it names, searches these by bisection, and ``read_captures`` then reads the
byte ranges of the records from the files named. A directory beyond ``DIRECTORY_ROWS`` rows is searched in
pieces of that size, one after the other.

Defined results: null HTML is an empty payload; a null URL has no target URI and an empty key. Pages without an
id are written without one, and revisit a page that has one. Of pages that share the smallest id, all
are responses. CR and LF in URLs are percent-encoded in headers. An empty table writes no record.
Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimlake.llm.common import ascii_lower, scratch, ship, stored

CRLF = "\r\n"
#: Fixed value: the WARC standard's profile of a revisit whose payload is equal.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes of one archive file, lines of an index block, rows of a directory piece; shared payloads (some 150 bytes
#: each) and byte ranges (16 bytes each) in one broadcast.
FILE_BYTES, BLOCK_LINES, DIRECTORY_ROWS, BROADCAST_SHARED, BROADCAST_RANGES = 64 << 20, 2000, 200_000, 100_000, 500_000
RECORD = "file string, offset long, length long, record_type string, page_id {id}, url string, refers_to {id}, refers_to_url string, payload_digest string, payload_bytes long"
CAPTURE = "url_key string, page_id {id}, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """Host labels reversed and joined by commas, ``)``, then the rest of the URL; scheme and fragment are left out."""
    host = ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    return F.when(url.isNull() | ~F.contains(url, F.lit("://")), F.coalesce(url, F.lit(""))).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(")"), rest)
    )


def with_revisits(pages: DataFrame, min_bytes: int) -> tuple[DataFrame, int]:
    """``page_id, url, html, bytes, digest, first`` (the response's id and URL; null for responses), and the mean payload's bytes."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("bytes", F.octet_length("html").cast("long"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    seen = Observation("payloads")
    # Payloads that several pages share, and their smallest page: pre-aggregated, so a hot payload is one row per task.
    shared = (
        rows.observe(seen, F.avg("bytes").alias("mean")).where(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("first").isNotNull() & (F.col("n") > 1)).select("digest", "first")
    )
    shared = stored(shared, "shared-payloads")
    if shared.limit(BROADCAST_SHARED + 1).count() <= BROADCAST_SHARED:
        shared = F.broadcast(shared)  # else both sides are shuffled, and adaptive execution splits a hot digest
    itself = F.col("page_id").eqNullSafe(F.col("first.page_id"))
    marked = rows.join(shared, "digest", "left").withColumn("first", F.when(~itself, F.col("first")))
    return marked, int(seen.get["mean"] or 0)


def record_text() -> Column:
    """One record up to, and without, the blank line that ends it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    urn = lambda column: F.concat(F.lit("<urn:page:"), column.cast("string"), F.lit(">"))
    maybe = lambda column, text: F.when(column.isNotNull(), text).otherwise(F.lit(""))
    safe = lambda url: F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    first, first_url = F.col("first.page_id"), F.col("first.url")
    revisit = first.isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        maybe(F.col("page_id"), line("WARC-Record-ID", urn(F.col("page_id")))),
        maybe(F.col("url"), line("WARC-Target-URI", safe(F.col("url")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        maybe(first, F.concat(line("WARC-Refers-To", urn(first)), F.lit(f"WARC-Profile: {PROFILE}{CRLF}"))),
        maybe(first_url, line("WARC-Refers-To-Target-URI", safe(first_url))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block,
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 100) -> None:
    """Writes a record per page to plain WARC files of some ``FILE_BYTES`` on average below ``path``; pages are not shuffled for it."""
    rows, mean = with_revisits(pages, min_bytes)
    per_file = max(1, FILE_BYTES // max(mean, 1))
    rows.select(record_text().alias("value")).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", per_file).text(path)


def _records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of each record."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at) + 4
        headers = dict(line.split(": ", 1) for line in data[at:head_end].decode().split(CRLF)[1:] if line)
        end = head_end + int(headers["Content-Length"])
        body = data.index(b"\r\n\r\n", head_end, end) + 4
        yield at, end + 4 - at, headers, data[body:end]
        at = end + 4


def _urn(value: str | None, kind: pa.DataType):
    if value is None:
        return None
    text = value.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if pa.types.is_integer(kind) else text


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Every record: place, headers, and the length and SHA-256 of the payload found there (0 bytes in a revisit)."""
    ship(spark)
    schema = RECORD.format(id=id_type)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.int64() if id_type in ("bigint", "int", "long") else pa.string()
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = [
                    (file.as_py(), at, size, head["WARC-Type"], _urn(head.get("WARC-Record-ID"), kind), head.get("WARC-Target-URI"),
                     _urn(head.get("WARC-Refers-To"), kind), head.get("WARC-Refers-To-Target-URI"), hashlib.sha256(body).hexdigest() if head["WARC-Type"] == "response" else head["WARC-Payload-Digest"][7:], len(body))
                    for at, size, head, body in _records(content.as_py())
                ]
                columns = list(zip(*rows, strict=True)) or [()] * 10
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), kind, pa.string(), kind, pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in schema.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(parse, schema)


def read_captures(spark: SparkSession, captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest`` of the records at the captures' byte ranges; only files they name are read."""
    ship(spark)
    ranges = stored(captures.groupBy("file").agg(F.collect_set(F.struct("offset", "length", "page_id")).alias("ranges")), "ranges")  # no more than the file has records
    files = [row.file for row in ranges.select("file").toLocalIterator()]
    id_type = captures.schema["page_id"].dataType.simpleString()
    schema = f"page_id {id_type}, payload_bytes long, payload_digest string"
    if not files:
        return spark.createDataFrame([], schema)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, asked in zip(batch.column("content"), batch.column("ranges"), strict=True):
                data, rows = memoryview(content.as_buffer()), []
                for r in asked.as_py():
                    _, _, _, body = next(_records(bytes(data[r["offset"] : r["offset"] + r["length"]])))
                    rows.append((r["page_id"], len(body), hashlib.sha256(body).hexdigest()))
                kind = batch.schema.field("ranges").type.value_type.field("page_id").type
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (kind, pa.int64(), pa.string()), strict=True)], ["page_id", "payload_bytes", "payload_digest"])

    if ranges.agg(F.sum(F.size("ranges"))).first()[0] <= BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    content = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file"), "content")
    return content.join(ranges, "file").mapInArrow(read, schema)


def build_index(records: DataFrame, path: str) -> None:
    """Writes ``path/blocks`` (compressed blocks of capture lines) and ``path/directory`` (first and last key of each)."""
    id_type = records.schema["page_id"].dataType.simpleString()
    lines = records.select(url_key(F.col("url")).alias("url_key"), "page_id", "file", "offset", "length")
    order = ["url_key", "page_id", "file", "offset"]  # the later ones split a URL that was captured very often

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId(), 0, []
        block = lambda rows: pa.RecordBatch.from_pydict({
            "block": pa.array([f"{part:06d}-{number:08d}"]), "first_key": pa.array([rows[0]["url_key"]]), "last_key": pa.array([rows[-1]["url_key"]]),
            "lines": pa.array([len(rows)], pa.int32()), "content": pa.array([zlib.compress("\n".join(json.dumps(list(r.values())) for r in rows).encode())], pa.binary()),
        })
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= BLOCK_LINES:
                yield block(held[:BLOCK_LINES])
                held, number = held[BLOCK_LINES:], number + 1
        if held:
            yield block(held)

    blocks = lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, "block string, first_key string, last_key string, lines int, content binary")
    # Small row groups: a filter on the block's name then reads that range of the file only.
    blocks.write.option("parquet.block.size", 1 << 20).parquet(f"{path}/blocks")
    spark = records.sparkSession
    spark.read.parquet(f"{path}/blocks").drop("content").withColumn("id_type", F.lit(id_type)).write.parquet(f"{path}/directory")


def lookup(spark: SparkSession, path: str, urls: DataFrame) -> DataFrame:
    """Captures of the URLs in column ``url``: ``url_key, page_id, file, offset, length``, each capture once."""
    ship(spark)
    directory = spark.read.parquet(f"{path}/directory").select("first_key", "last_key", "block", "id_type")
    wanted = urls.select(url_key(F.col("url")).alias("url_key")).distinct()
    id_type, named, piece = "bigint", None, []
    for row in directory.orderBy("block").toLocalIterator():
        id_type = row.id_type
        piece.append((row.first_key, row.last_key, row.block))
        if len(piece) == DIRECTORY_ROWS:
            named = _named_blocks(spark, wanted, piece, named)
            piece = []
    named = _named_blocks(spark, wanted, piece, named)
    blocks = spark.read.parquet(f"{path}/blocks").select("block", "content")
    asked = named.groupBy("block").agg(F.collect_set("url_key").alias("keys"))  # no more keys than the block has lines
    kind = pa.int64() if id_type in ("bigint", "int", "long") else pa.string()

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, keys in zip(batch.column("content"), batch.column("keys"), strict=True):
                lines = [json.loads(x) for x in zlib.decompress(content.as_py()).decode().split("\n")]
                at = [line[0] for line in lines]
                hits = [line for key in keys.as_py() for line in lines[bisect.bisect_left(at, key) : bisect.bisect_right(at, key)]]
                columns = list(zip(*hits, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), kind, pa.string(), pa.int64(), pa.int64()), strict=True)], ["url_key", "page_id", "file", "offset", "length"])

    return blocks.join(asked, "block").mapInArrow(search, CAPTURE.format(id=id_type))


def _named_blocks(spark: SparkSession, wanted: DataFrame, piece: list[tuple], so_far: DataFrame | None) -> DataFrame:
    """``url_key, block`` for all blocks of a directory piece that may hold a key; blocks are in key order."""
    sent = spark.sparkContext.broadcast(piece)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sent.value
        firsts, lasts = [r[0] for r in rows], [r[1] for r in rows]
        for batch in batches:
            pairs = [(key, rows[k][2]) for key in batch.column(0).to_pylist() for k in range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["url_key", "block"])

    found = wanted.mapInArrow(search, "url_key string, block string")
    return found if so_far is None else so_far.unionByName(found)


def archive_report(pages: DataFrame, path: str | None = None, min_bytes: int = 100) -> DataFrame:
    """Writes the pages' archives and index below ``path``, reads them back, and returns what they hold: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to, file, offset, length``. Revisits are resolved by looking their target up in the index."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_archives(pages, f"{path}/archives", min_bytes)
    records = stored(read_archives(spark, f"{path}/archives", pages.schema["page_id"].dataType.simpleString()), "records")
    build_index(records, f"{path}/index")
    revisits = records.where("record_type = 'revisit'")
    targets = revisits.select(F.col("refers_to").alias("page_id"), F.col("refers_to_url").alias("url")).distinct()
    captures = lookup(spark, f"{path}/index", targets)
    # Of the captures of those URLs, the ones referred to; a page that was written twice has the payload at either place.
    found = read_captures(spark, captures.join(targets.select("page_id").distinct(), "page_id")).distinct()
    found = found.select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("found_bytes"), F.col("payload_digest").alias("payload_digest"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset", "length"]
    resolved = revisits.join(found, ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.col("found_bytes"))
    return records.where("record_type = 'response'").select(*columns).unionByName(resolved.select(*columns))

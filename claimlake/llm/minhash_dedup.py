"""MinHash near-dedup with min-max signatures.

A document's set holds its distinct word shingles as 64-bit hashes. Under each permutation both the smallest and
the largest value are kept, so half as many hash evaluations give as many signature values. Bands of the values
are bucket keys.

Documents of equal sets are one node (a 126-bit digest of the set), whatever their number. Only nodes are
banded. In each bucket all nodes are first compared with one centre, not with each other. Links confirmed on the full
sets give components; a bucket whose nodes are all in one component needs nothing more, since further links
change nothing. In the others, each node outside the bucket's largest component is compared with every node of
another component, in tiles of bounded size that give linked components, not pairs. So every pair that shares a
bucket is either compared or already connected, and no group is gathered in one task. Pairs are first judged by size and by the share
of equal signature values (a pair at the threshold falls 6 standard errors short once in a billion), then on the full sets.

Sets of similarity 0.8 agree in one of 32 bands of 5 with probability 1 - 3e-6; the miss rate falls steeply above.

Defined results: texts without words (null, empty, blanks) have an empty set and link with nothing. Rows
with equal ids are rows of their own. A row without an id is never the smallest; a component without any id has
a null ``component_id``, and its rows are kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import LOWER, decimals, fields, matrix, per_tile, ship, stored
from claimlake.llm.components import components

#: Bands, values in a band, seed; shingles permuted at once; bytes of a text hashed at once; words whose hashes a worker keeps.
BANDS, ROWS, SEED, CHUNK, BLOCK, WORDS = 32, 5, 5, 512, 1 << 20, 500_000
#: Nodes in a tile's side, and what tells tiles apart.
TILE, TILE_KEY = 512, ["largest", "chunk_a", "chunk_b"]
#: Standard errors by which a pair's estimate may fall short before the pair is left out.
ERRORS = 6.0
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes (xxh3) of words, A-Z in lower case. A worker keeps those of ``WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word, seed=SEED)
        return number

    def of(self, text: bytes) -> np.ndarray:
        """A number for every word of a text. Texts go in blocks that end between words."""
        out, at = [], 0
        while at < len(text):
            end = at + BLOCK
            while end < len(text) and text[end] > 0x20:
                end += 1
            words = text[at:end].translate(LOWER).split()
            out.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
            at = end
        return np.concatenate(out)


HASHES = WordHashes()


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``size`` words; of fewer words, the whole sequence is one."""
    hashes = HASHES.of(text) if text else np.zeros(0, np.uint64)
    if not len(hashes):
        return hashes
    k = min(size, len(hashes))
    out = np.full(len(hashes) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - k + 1 + i])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


class Signer:
    """Permutations of 32-bit numbers, and band keys of sets under them."""

    def __init__(self, bands: int, rows: int):
        random = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        n = -(-bands // 2) * rows
        self.a = random.integers(0, 1 << 32, (n, 1), np.uint32) | np.uint32(1)
        self.b = random.integers(0, 1 << 32, (n, 1), np.uint32)

    def signature(self, of: np.ndarray) -> np.ndarray:
        """The smallest, then the largest value of the set under each permutation."""
        numbers = (of >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        high = np.zeros(len(self.a), np.uint32)
        for start in range(0, len(numbers), CHUNK):
            values = self.a * numbers[None, start : start + CHUNK]
            values += self.b
            np.minimum(low, values.min(1), out=low)
            np.maximum(high, values.max(1), out=high)
        return np.concatenate((low, high))

    def keys(self, signatures: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(band keys, 16 bits of each value), a row per set. Half of the bands hold minima, half maxima."""
        values = np.stack(signatures).reshape(len(signatures), -1, self.rows)[:, : self.bands]
        values = _mixed(values.astype(np.uint64) + np.uint64(SEED))
        out = np.broadcast_to(np.arange(self.bands, dtype=np.uint64), values.shape[:2])
        for k in range(self.rows):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
        return out.view(np.int64), values.reshape(len(values), -1).astype(np.uint16)


def may_be_similar(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the share of equal signature values, an unbiased estimate of the similarity, comes near ``percent``.

    Rows are signatures. Values that agree in their 16 bits by chance raise the estimate, never lower it.
    """
    share = percent / 100
    return (a == b).mean(1) >= share - ERRORS * np.sqrt(share * (1 - share) / a.shape[1])


def sign(docs: DataFrame, size: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``id, text_hash, n_shingles, node, keys, signature`` of every row; the last three are null for empty sets."""
    signer = docs.sparkSession.sparkContext.broadcast(Signer(bands, rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes, signatures = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                of = shingle_set(text.as_py(), size)
                n.append(len(of))
                nodes.append(xxhash.xxh3_128_intdigest(of.tobytes()) >> 2 if len(of) else None)
                if len(of):
                    signatures.append(signer.value.signature(of))
            keys, values = signer.value.keys(signatures) if signatures else ([], [])
            rows = iter(range(len(signatures)))
            at = [next(rows) if size else None for size in n]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "text_hash": batch.column("text_hash"), "n_shingles": pa.array(n, pa.int64()),
                "node": decimals(nodes), "keys": pa.array([None if k is None else keys[k] for k in at], pa.list_(pa.int64())),
                "signature": pa.array([None if k is None else values[k].tobytes() for k in at], pa.binary()),
            })

    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, fields(texts, "id", "text_hash", and_="n_shingles long, node decimal(38,0), keys array<long>, signature binary"))


class NearDuplicates:
    """One run over ``docs``: nodes, buckets, confirmed links."""

    def __init__(self, docs: DataFrame, size: int, percent: int, bands: int, rows: int, id_col: str, text_col: str):
        self.docs, self.size, self.percent, self.id_col, self.text_col = docs, size, percent, id_col, text_col
        self.signed = stored(sign(docs, size, bands, rows, id_col, text_col), "signed")
        nodes = self.signed.where("n_shingles > 0").select("node", "keys").dropDuplicates(["node"])
        keyed = nodes.select(F.explode("keys").alias("key"), "node")
        several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = stored(keyed.join(several, "key"), "met")
        # A bucket's centre is the node that meets the most others: of many noisy copies, the one nearest to all.
        meets = met.join(met.groupBy("node").agg(F.sum("n").alias("meets")), "node")
        centres = meets.groupBy("key").agg(F.max_by("node", F.struct("meets", "node")).alias("centre"))
        self.shared = stored(met.select("key", "node").join(centres, "key"), "shared")
        self.sets = stored(self._sets(), "sets")

    def _sets(self) -> DataFrame:
        """``node, n, signature, shingles``: the full set of every node that shares a bucket, made from one of its texts."""
        size, asked = self.size, self.shared.select("node").distinct()
        chosen = self.signed.select("node", "signature", "n_shingles", "id", "text_hash").join(asked, "node")
        chosen = chosen.groupBy("node").agg(F.min(F.struct("id", "text_hash", "n_shingles", "signature")).alias("row"))
        chosen = chosen.select("node", F.col("row.n_shingles").alias("n"), "row.signature", F.col("row.id").alias("cid"), F.col("row.text_hash").alias("chash"))
        texts = self.docs.select(F.col(self.id_col).alias("id"), F.xxhash64(self.text_col).alias("text_hash"), F.col(self.text_col).alias("text"))
        found = texts.join(chosen, F.col("id").eqNullSafe(F.col("cid")) & (F.col("text_hash") == F.col("chash"))).dropDuplicates(["node"])

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [shingle_set(t.as_py(), size).tobytes() for t in batch.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "n": batch.column("n"), "signature": batch.column("signature"), "shingles": pa.array(sets, pa.binary())})

        found = found.select("node", "n", "signature", "text")
        return found.mapInArrow(run, fields(found, "node", "n", "signature", and_="shingles binary"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose sets have the similarity.

        Pairs whose sizes or signatures rule it out are left out; the rest are confirmed on the full sets.
        """
        percent = self.percent
        side = lambda x, *names: self.sets.select(F.col("node").alias(x), *[F.col(n).alias(n + x) for n in names])

        def rough(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("signaturea", "signatureb"))
                    yield batch.select(["a", "b"]).filter(pa.array(may_be_similar(a, b, percent)))

        def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for a, b in zip(batch.column("shinglesa"), batch.column("shinglesb"), strict=True):
                    a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                    common = int((b[at] == a).sum())
                    keep.append(100 * common >= percent * (len(a) + len(b) - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        near = pairs.join(side("a", "n", "signature"), "a").join(side("b", "n", "signature"), "b")
        near = near.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "signaturea", "signatureb")
        near = near.mapInArrow(rough, fields(pairs, "a", "b"))
        return near.join(side("a", "shingles"), "a").join(side("b", "shingles"), "b").select("a", "b", "shinglesa", "shinglesb").mapInArrow(confirm, fields(pairs, "a", "b"))

    def find(self) -> DataFrame:
        """``node, root`` of all nodes that link with another one."""
        ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        pairs = self.shared.where("node <> centre").select(*ordered("node", "centre")).distinct()
        roots = stored(components(stored(self.links(pairs), "links")), "roots")
        more = stored(self.joined_roots(roots), "links")
        if more.isEmpty():
            return roots
        return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    def joined_roots(self, roots: DataFrame) -> DataFrame:
        """``a, b``: components that have a link between them which no centre has shown.

        Buckets with nodes of several components are gathered by their largest component. Its nodes there are
        the major ones, the others minor; each minor node is compared with every major and every other minor one. Both
        are dealt in chunks, each two chunks are a tile, and a tile gives only which components are linked.
        """
        rooted = self.shared.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        counts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
        open_keys = counts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.count(F.lit(1)).alias("roots"))
        open_rows = rooted.join(open_keys.where("roots > 1"), "key")
        nodes = stored(open_rows.groupBy("largest", "node", "root").agg(F.lit(1).alias("one")).select("largest", "node", "root", (F.col("root") != F.col("largest")).alias("minor")), "open-nodes")
        chunks = nodes.groupBy("largest").agg(F.ceil(F.count_if("minor") / TILE).alias("minors"), F.ceil(F.count_if(~F.col("minor")) / TILE).alias("majors"))
        # Chunks of minor nodes are numbered from 0 on, those of major ones after them; a tile's first chunk is a minor one.
        number = F.when(F.col("minor"), F.pmod(F.xxhash64("node"), F.col("minors"))).otherwise(F.col("minors") + F.pmod(F.xxhash64("node"), F.greatest("majors", F.lit(1))))
        numbered = nodes.join(chunks, "largest").withColumn("chunk", number)
        others = F.when(F.col("minor"), F.sequence(F.lit(0), F.col("minors") + F.col("majors") - 1)).otherwise(F.sequence(F.lit(0), F.col("minors") - 1))
        dealt = numbered.withColumn("other", F.explode(others)).select(
            "largest", F.least("chunk", "other").alias("chunk_a"), F.greatest("chunk", "other").alias("chunk_b"), "chunk", "node", "root"
        )
        sets = self.sets.select("node", "signature", "shingles")
        dealt = dealt.join(sets, "node").repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
        percent = self.percent

        def work(table: pa.Table) -> pa.RecordBatch | None:
            chunk = table.column("chunk").to_numpy()
            left, right = (np.flatnonzero(chunk == table.column(c)[0].as_py()) for c in ("chunk_a", "chunk_b"))
            names = table.column("root").to_pylist()
            number = {name: k for k, name in enumerate(dict.fromkeys(names))}
            root = np.array([number[name] for name in names])
            signature = matrix(table.column("signature"), np.uint16)
            shingles = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in shingles])
            found = set()
            for x in left:
                near = right[root[right] != root[x]]
                near = near[100 * np.minimum(sizes[near], sizes[x]) >= percent * np.maximum(sizes[near], sizes[x])]
                if len(near):
                    near = near[may_be_similar(signature[near], signature[x], percent)]
                if not len(near):
                    continue
                own, theirs = shingles[x], np.concatenate([shingles[k] for k in near])
                equal = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                common = np.add.reduceat(equal.astype(np.int64), np.cumsum(sizes[near]) - sizes[near])
                linked = near[100 * common >= percent * (sizes[near] + sizes[x] - common)]
                found.update((int(root[x]), int(r)) for r in root[linked])
            if not found:
                return None
            column = table.column("root").combine_chunks()
            first = {r: k for k, r in reversed(list(enumerate(root.tolist())))}
            return pa.RecordBatch.from_arrays([column.take(pa.array([first[r] for r in side])) for side in zip(*sorted(found), strict=True)], ["a", "b"])

        linked = dealt.mapInArrow(per_tile(work, TILE_KEY), "a decimal(38,0), b decimal(38,0)")
        return linked.distinct()


def rooted(docs: DataFrame, size: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``id, text_hash, n_shingles, node, root`` of every row; equal roots make a component, and empty sets have none."""
    ship(docs.sparkSession)
    run = NearDuplicates(docs, size, percent, bands, rows, id_col, text_col)
    roots = run.find()
    found = run.signed.select("id", "text_hash", "n_shingles", "node").join(roots.withColumnRenamed("root", "linked"), "node", "left")
    return found.select("id", "text_hash", "n_shingles", "node", F.coalesce("linked", "node").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``text_hash``, ``n_shingles``, ``component_id`` (the smallest id reachable) and ``kept``."""
    rows_ = rooted(docs, size, percent, bands, rows, id_col, text_col)
    smallest = rows_.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    return rows_.join(smallest, "root", "left").select(
        F.col("id").alias(id_col), "text_hash", "n_shingles",
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull()))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", repeats: bool = True) -> DataFrame:
    """``docs`` with the rows of the smallest id of each component; all columns stay.

    With ``repeats`` every row that has this id stays, and every row of a component without any id. Without, one row
    of each component stays: of the smallest id's texts (a null id is the largest) the one with the smallest hash, and any one
    of its equal rows. Rows without words are in no component and stay.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))

    def matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("id").alias("key_id"), F.col("text_hash").alias("key_hash"))
        return rows.join(keys, F.col("id").eqNullSafe(F.col("key_id")) & (F.col("text_hash") == F.col("key_hash")), how)

    if repeats:
        found = near_duplicates(docs, size, percent, id_col=id_col, text_col=text_col)
        gone = found.where(~F.col("kept")).select(F.col(id_col).alias("id"), "text_hash").distinct()
        return matching(rows, gone, "left_anti").select("row.*")
    texts = rooted(docs, size, percent, BANDS, ROWS, id_col, text_col).where("root is not null")
    texts = texts.groupBy("root", "id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = texts.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"))
    judged = texts.join(first, "root").select("id", "text_hash", "n", (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))).alias("stays"))
    marked = stored(judged.where("not stays or n > 1").select("id", "text_hash", "stays"), "marked")
    kept = matching(rows, marked, "left_anti")
    twice = marked.where("stays")
    if not twice.isEmpty():
        kept = kept.unionByName(matching(rows, twice, "left_semi").dropDuplicates(["id", "text_hash"]))
    return kept.select("row.*")

"""Embedding near-dedup with randomised-rotation binary codes.

Vectors are compared within a label only. A vector, scaled to length one and turned by a random rotation, is
stored as the signs of its components (a binary code), the code's inner product with the turned vector (the
correction factor), and the turned vector in 8-bit steps. The inner product of one vector's code with
another's turned vector, divided by the factor, is an unbiased estimate of their cosine, with a known
error; pairs whose upper confidence bound is below the threshold need no more work. All others are
computed anew, in double precision, from the stored vectors.

Which pairs are estimated at all: signs under further rotations are cut into keys; vectors that share a key under a
label meet in a bucket. The bits of a key, and with them the number of keys (bands) that keeps the probability of a pair at the
threshold to miss all buckets at ``MISS``, are chosen per label from its counted buckets: each number of bits
costs ``bands * (1 + members / TILE)`` rows a vector, ``members`` being those of the bucket a vector meets, and the least
cost wins. For evenly spread vectors of one label, at 0.93, that is 21 bands of 8 bits up to some 65,000 vectors, and 114 of 20 bits at
10^8: rows a vector grow with the fourth root of the table. Codes only (some 100 bytes a row) go to the
buckets; whole vectors follow for those that have a pair left there. A pair counts in the first band in which it meets.

Equal vectors of a label are one node, whatever their number. A bucket of more than ``TILE`` nodes is cut into chunks, and
each two chunks are a task's work: no bucket is ever in one task, and no pair is emitted as a row, only counts per
node and, per tile, a spanning forest of its links.

Defined results: vectors that are null, empty or zero, hold null or non-finite components, or have no label link with
nothing. Vectors of different length do not link. Rows of equal ids are rows of their own, linked if close. A row
without an id is never the smallest. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import decimals, fields, matrix, per_tile, ship, stored
from claimlake.llm.components import components

#: Most bits of a bucket key, bands that are always worth having, probability to miss a pair at the threshold.
WIDEST, FEW_BANDS, MISS = 24, 21, 1e-4
#: Nodes in a tile's side, standard errors of the confidence bound, seed.
TILE, ERRORS, SEED = 512, 5.0, 3
TILE_KEY = ["label", "dim", "band", "key", "chunk_a", "chunk_b"]


def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix; number 0 makes the code, the further ones the bits of the bucket keys."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diagonal(r))


def bands_for(bits: int, threshold: float) -> int:
    """Keys of ``bits`` bits that a vector needs, so that a pair at ``threshold`` shares none with probability ``MISS``."""
    meets = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    if meets >= 1 - MISS:
        return 1
    return math.ceil(math.log(MISS) / math.log1p(-meets)) if meets > 1e-9 else 1 << 31


def bit_choices(threshold: float) -> list[int]:
    """Numbers of bits to choose from: the most that ``FEW_BANDS`` allow, and more in steps of two."""
    least = max(b for b in range(WIDEST + 1) if bands_for(b, threshold) <= FEW_BANDS)
    return [b for b in range(least, WIDEST + 1, 2) if b == least or bands_for(b, threshold) <= 1_000]


class Coder:
    """Codes and bucket keys of vectors of length one, by their length."""

    def __init__(self) -> None:
        self.known: dict[tuple[int, int], np.ndarray] = {}

    def turn(self, units: np.ndarray, number: int) -> np.ndarray:
        place = units.shape[1], number
        if place not in self.known:
            self.known[place] = rotation(*place)
        return units @ self.known[place]

    def __call__(self, units: np.ndarray) -> dict[str, np.ndarray]:
        turned = self.turn(units, 0)
        step = np.maximum(np.abs(turned).max(1), 1e-30) / 127
        return {
            "sketch": self.keys(units, WIDEST, 1)[:, 0],
            "code": np.packbits(turned > 0, axis=1),
            "factor": (np.abs(turned).sum(1) / np.sqrt(units.shape[1])).astype(np.float32),
            "steps": np.rint(turned / step[:, None]).astype(np.int8),
            "step": step.astype(np.float32),
        }

    def keys(self, units: np.ndarray, bits: int, bands: int) -> np.ndarray:
        """A row of ``bands`` numbers of ``bits`` bits per vector."""
        if not bits:
            return np.zeros((len(units), bands), np.int32)
        count = -(-bits * bands // units.shape[1])
        signs = np.concatenate([self.turn(units, 1 + k) > 0 for k in range(count)], 1)[:, : bits * bands]
        return (signs.reshape(len(units), bands, bits) @ (1 << np.arange(bits)[::-1])).astype(np.int32)


CODER = Coder()


def coded(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, node, label, dim, vector, sketch, code, factor, steps, step`` of every row; all but the id null for vectors that cannot link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            cells = {c: [None] * n for c in ("node", "dim", "vector", "sketch", "code", "factor", "steps", "step")}
            labels = batch.column("label").to_pylist()
            by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
            for k, vector in enumerate(batch.column("vector")):
                values = vector.values if vector.is_valid else None
                if labels[k] is None or values is None or not len(values) or values.null_count:
                    continue
                raw = values.to_numpy().astype(np.float64)
                if np.isfinite(raw).all() and raw.any():
                    by_dim.setdefault(len(raw), []).append((k, raw + 0.0))  # + 0.0: no negative zeros
            for dim, found in by_dim.items():
                raws = np.stack([v for _, v in found])
                scaled = raws / np.abs(raws).max(1, keepdims=True)  # squares of very large or small numbers stay finite
                units = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
                codes = CODER(units)
                for row, (k, raw) in enumerate(found):
                    data = raw.tobytes()
                    cells["node"][k] = xxhash.xxh3_128_intdigest(data + repr(labels[k]).encode()) >> 2
                    cells["dim"][k], cells["vector"][k] = dim, units[row].tobytes()
                    cells["sketch"][k] = int(codes["sketch"][row])
                    for name in ("code", "steps"):
                        cells[name][k] = codes[name][row].tobytes()
                    for name in ("factor", "step"):
                        cells[name][k] = float(codes[name][row])
            types = {"dim": pa.int32(), "sketch": pa.int32(), "factor": pa.float32(), "step": pa.float32()}
            columns = {c: pa.array(v, types.get(c, pa.binary())) for c, v in cells.items() if c != "node"}
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "label": batch.column("label"), "node": decimals(cells["node"]), **columns})

    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, fields(rows, "id", "label", and_="node decimal(38,0), dim int, vector binary, sketch int, code binary, factor float, steps binary, step float"))


def key_bits(nodes: DataFrame, threshold: float) -> DataFrame:
    """``label, dim, bits`` from all ``nodes`` (label, dim, sketch): the bits whose buckets cost the fewest rows.

    A sketch's leading bits are a key of as many bits, so one count by sketch gives the buckets of every choice.
    """
    counts = nodes.groupBy("label", "dim", "sketch").agg(F.count(F.lit(1)).alias("n"))
    choices = bit_choices(threshold)
    bands = F.element_at(F.create_map(*[F.lit(x) for b in choices for x in (b, bands_for(b, threshold))]), F.col("bits"))
    buckets = counts.select("label", "dim", "sketch", "n", F.explode(F.array(*map(F.lit, choices))).alias("bits"))
    buckets = buckets.groupBy("label", "dim", "bits", F.expr(f"shiftright(sketch, {WIDEST} - bits)").alias("key")).agg(F.sum("n").alias("n"))
    members = buckets.groupBy("label", "dim", "bits").agg((F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n")).alias("members"))
    cost = bands * (1 + F.col("members") / TILE)
    return members.groupBy("label", "dim").agg(F.min(F.struct(cost.alias("cost"), "bits")).getField("bits").alias("bits"))


def keyed(nodes: DataFrame, threshold: float) -> DataFrame:
    """``nodes`` (with ``bits`` and ``vector``) and their bucket keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list[np.ndarray | None] = [None] * batch.num_rows
            together: dict[tuple[int, int], list[int]] = {}
            for k, place in enumerate(zip(batch.column("dim").to_pylist(), batch.column("bits").to_pylist(), strict=True)):
                together.setdefault(place, []).append(k)
            vectors = batch.column("vector")
            for (dim, bits), rows in together.items():
                units = np.frombuffer(b"".join(vectors[k].as_py() for k in rows), np.float64).reshape(-1, dim)
                for k, keys in zip(rows, CODER.keys(units, bits, bands_for(bits, threshold)), strict=True):
                    cells[k] = keys
            yield batch.append_column("keys", pa.array(cells, pa.list_(pa.int32())))

    return nodes.mapInArrow(run, fields(nodes, *nodes.columns, and_="keys array<int>"))


def tiles(rows: DataFrame) -> DataFrame:
    """Rows ``label, dim, band, key, node, ...`` dealt to tiles: chunk pairs of their bucket, ``chunk_a <= chunk_b``."""
    bucket = TILE_KEY[:4]
    large = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    large = large.select(*bucket, F.ceil(F.col("members") / TILE).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = rows.join(large, bucket).withColumn("chunk", chunk)  # nodes alone in their bucket are gone
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.select("*", other.alias("other")).select(
        *[c for c in rows.columns], "chunk", F.least("chunk", "other").cast("int").alias("chunk_a"), F.greatest("chunk", "other").cast("int").alias("chunk_b")
    )
    return dealt.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "node")


def sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the tile's two chunks, and whether they are one."""
    chunk = table.column("chunk").to_numpy()
    a, b = table.column("chunk_a")[0].as_py(), table.column("chunk_b")[0].as_py()
    return np.flatnonzero(chunk == a), np.flatnonzero(chunk == b), a == b


def may_link(codes: np.ndarray, factors: np.ndarray, turned: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the upper confidence bound of (row's code, column's turned vector) reaches ``threshold``.

    The error of the estimate is that of the code's part which is orthogonal to its vector, met by the other vector's
    part which is orthogonal too. It is taken at the threshold, where it is largest for pairs that link.
    """
    dim = turned.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    estimate = signs @ turned.T / factors[:, None]
    error = np.sqrt(np.maximum(1 - factors**2, 0)) / factors / np.sqrt(max(dim - 1, 1)) * np.sqrt(1 - threshold**2)
    rounding = np.float32(0.02)  # of the 8-bit steps
    return estimate + (ERRORS * error + rounding)[:, None] >= threshold


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: ``id_col``, ``n_links`` (other rows linked directly), ``component_id`` (smallest id reachable) and ``kept``."""
    ship(vectors.sparkSession)
    rows = stored(coded(vectors, id_col, vector_col, label_col), "coded")
    nodes = rows.where("node is not null")
    bits = stored(key_bits(nodes.select("label", "dim", "sketch", "node").distinct(), threshold), "bits")  # small: a row per label
    nodes = stored(keyed(nodes.drop("id", "sketch").dropDuplicates(["node"]).join(bits, ["label", "dim"]), threshold), "nodes")
    codes = nodes.select("label", "dim", "node", "code", "factor", "steps", "step", F.posexplode("keys").alias("band", "key"))

    def undecided(table: pa.Table) -> pa.RecordBatch | None:
        """Nodes of a tile that have a pair whose bound reaches the threshold."""
        left, right, same = sides(table)
        code, factor = matrix(table.column("code"), np.uint8), table.column("factor").to_numpy()
        turned = matrix(table.column("steps"), np.int8).astype(np.float32) * table.column("step").to_numpy()[:, None]
        maybe = may_link(code[left], factor[left], turned[right], threshold)
        if same:
            maybe &= ~np.eye(len(left), dtype=bool)
        keep = np.union1d(left[maybe.any(1)], right[maybe.any(0)])
        return table.select([*TILE_KEY, "chunk", "node"]).take(keep).combine_chunks().to_batches()[0] if len(keep) else None

    dealt = tiles(codes)
    open_rows = dealt.mapInArrow(per_tile(undecided, TILE_KEY), fields(dealt, *TILE_KEY, "chunk", "node"))
    copies = rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    whole = open_rows.join(nodes.select("node", "vector", "keys"), "node").join(copies, "node")
    whole = whole.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "node")

    def exact(table: pa.Table) -> pa.RecordBatch | None:
        """Links in double precision: per node the rows linked in this tile, and the smallest node connected here."""
        left, right, same = sides(table)
        unit = matrix(table.column("vector"), np.float64)
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)  # one label, so as many each
        linked = unit[left] @ unit[right].T >= threshold
        if same:
            linked &= ~np.eye(len(left), dtype=bool)
        a, b = np.nonzero(linked)
        if not len(a):
            return None
        band = table.column("band")[0].as_py()
        first = ~(keys[left[a], :band] == keys[right[b], :band]).any(1)  # counted in the first band in which they meet
        weight = table.column("copies").to_numpy()
        links = np.zeros(table.num_rows, np.int64)
        np.add.at(links, left[a[first]], weight[right[b[first]]])
        if not same:
            np.add.at(links, right[b[first]], weight[left[a[first]]])
        root = np.arange(table.num_rows)  # nodes are sorted, so a smaller row number is a smaller node
        while True:
            least = root.copy()
            np.minimum.at(least, left[a], root[right[b]])
            np.minimum.at(least, right[b], root[left[a]])
            if (least == root).all():
                break
            root = least
        keep = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
        node = table.column("node").combine_chunks()
        return pa.RecordBatch.from_arrays([node.take(pa.array(keep)), node.take(pa.array(root[keep])), pa.array(links[keep])], ["node", "root", "links"]) if len(keep) else None

    found = stored(whole.mapInArrow(per_tile(exact, TILE_KEY), "node decimal(38,0), root decimal(38,0), links long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()), "roots")
    full = (
        rows.select("id", "node").join(links, "node", "left").join(roots, "node", "left").join(copies, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = full.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    return full.join(smallest, "root", "left").select(
        F.col("id").alias(id_col), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull()))

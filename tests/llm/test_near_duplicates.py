from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimlake.llm import embedding_dedup, minhash_dedup
from claimlake.llm.components import components
from claimlake.llm.embedding_dedup import Coder, may_link, near_vectors
from claimlake.llm.minhash_dedup import near_duplicates, without_near_duplicates

BLANKS = " \t\n\x0b\x0c\r"


def grouped(n, linked):
    """Root of each of n rows by union of the linked pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def smallest_ids(ids, roots, alone):
    """(component_id, kept) per row; ``alone`` rows stand for themselves."""
    out = []
    for i, r in enumerate(roots):
        group = [ids[k] for k in range(len(ids)) if roots[k] == r and ids[k] is not None]
        low = ids[i] if i in alone else min(group, default=None)
        out.append((low, low is None or ids[i] == low))
    return out


def test_components(spark):
    pick = random.Random(8)
    for edges in ([(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)], [(pick.randrange(120), pick.randrange(120)) for _ in range(70)], []):
        found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        roots = grouped(120, edges)
        assert found == {n: roots[n] for e in edges if e[0] != e[1] for n in e}


def shingles(text, size):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in BLANKS:
        w = w.replace(blank, " ")
    w = [x for x in w.split(" ") if x]
    k = min(size, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    ids = [i for i, _ in rows]
    groups = smallest_ids(ids, grouped(len(rows), linked), {k for k, s in enumerate(sets) if not s})
    return sorted(((i, len(s), *g) for i, s, g in zip(ids, sets, groups, strict=True)), key=repr)


def copies(pick, n_bases=25):
    """Texts with exact copies, chains of ever further copies, and texts just beside the threshold."""
    rows = []
    for _ in range(n_bases):
        words = [f"v{pick.randrange(400)}" for _ in range(pick.choice([1, 2, 4, 12, 60, 200]))]
        for _ in range(pick.choice([1, 2, 6, 12])):
            rows.append(" ".join(words))
            if pick.random() < 0.7:
                for _ in range(max(1, len(words) // pick.choice([12, 25, 60]))):
                    words[pick.randrange(len(words))] = f"v{pick.randrange(400)}"
    pick.shuffle(rows)
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_against_all_pairs(spark, rows_of, size):
    rows = copies(random.Random(size)) + [(900, None), (901, ""), (902, " \t"), (None, "a b c d e f"), (None, "A b  c d e\nf"), (None, None), (3, "a b c d e f"), (903, "lone"), (904, "LONE")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, node int, component_id string")
    assert rows_of(near_duplicates(docs, size, 80).drop("text_hash")) == brute(rows, size, 80)


def test_minhash_with_few_bands_settles_open_buckets(spark, rows_of):
    """Wide buckets: all texts share keys, so most links are found only by the later comparisons."""
    rows = copies(random.Random(9), 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_duplicates(docs, 2, 80, bands=40, rows=1).drop("text_hash")) == brute(rows, 2, 80)


def test_minhash_tells_patterned_words_apart(spark, rows_of):
    """Words whose sums of weighed bytes are equal for every odd base modulo 2^64 (Thue-Morse words and their complements)."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"{word} x y"), (4, f"{other} x y"), (5, word), (6, f"{other} X y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(near_duplicates(docs, 2, 80).drop("text_hash"))
    assert got == brute(rows, 2, 80) and [r[2] for r in got] == [1, 2, 3, 4, 1, 4]


def test_minhash_edges(edge_docs, edge_rows, no_docs, rows_of):
    short = [r[:2] for r in edge_rows if len(r[1] or "") < 1000]
    got = rows_of(near_duplicates(edge_docs, 2, 80).drop("text_hash"))
    assert [r for r in got if r[1] < 100 and r[0] not in (7, 8)] == brute(short, 2, 80)
    assert [r for r in got if r[0] in (7, 8)] == [(7, 4, 7, True), (7, 4, 7, True), (8, 5, 7, False)]
    assert near_duplicates(no_docs).collect() == []
    kept = without_near_duplicates(edge_docs, 2, 80)
    assert kept.schema == edge_docs.schema
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [1, 2, 3, 4, 5, 6, 7, 7, 9, 10, None, None]))
    assert without_near_duplicates(no_docs).collect() == []


def test_pipeline_keeps_one_row_of_each_group(spark, edge_docs, no_docs):
    """Equal rows, near copies under one id, groups with some and with only null ids; rows without words stay."""
    base = [f"w{k}" for k in range(60)]
    near = [" ".join([*base[:59], f"x{k}"]) for k in range(3)]
    rows = [(7, near[0]), (7, near[0]), (7, near[1]), (8, near[2]), (None, near[2]), (None, "a b c d e f"), (None, "a b c d e f"), (None, "A b c  d e f"),
            (5, "lone words only here now"), (None, None), (None, None), (6, ""), (6, "")]
    docs = spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, other map<string,int>")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.schema == docs.schema
    got = [(r.doc_id, shingles(r.text, 5)) for r in got.collect()]
    assert len(got) == 7 and sorted(repr(i) for i, s in got if not s) == ["6", "6", "None", "None"]
    assert sorted(map(repr, (i for i, s in got if s))) == ["5", "7", "None"] and (None, shingles("a b c d e f", 5)) in got
    kept = without_near_duplicates(edge_docs, 2, 80, repeats=False)
    assert kept.schema == edge_docs.schema
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [1, 2, 3, 4, 5, 6, 7, 9, 10, None, None]))
    assert corpus_pipeline.drop_near_duplicates(spark, no_docs, "").collect() == []


def vector_rows():
    random = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, 2):
        for _ in range(60):
            base = random.standard_normal(32)
            for _ in range(int(random.choice([1, 1, 3, 8]))):
                rows.append((n, (base + random.standard_normal(32) * random.choice([0, 0.2, 0.3, 0.36])).astype(np.float32).tolist(), label))
                n += 1
    rows += [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 32, 1), (9003, [float("nan")] + [1.0] * 31, 1), (9004, [None] + [1.0] * 31, 1), (9005, [float("inf")] * 32, 1)]
    rows += [(9006, rows[0][1], None), (9007, rows[0][1][:5], 0), (9008, rows[0][1], 0), (9008, rows[0][1], 0), (None, rows[0][1], 0), (9009, [x * 1e30 for x in rows[0][1]], 0)]
    return rows


def brute_vectors(rows, threshold):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) if label is not None else None for _, v, label in rows]
    linked = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold
    ]
    counts = [0] * len(rows)
    for a, b in linked:
        counts[a] += 1
        counts[b] += 1
    ids = [i for i, _, _ in rows]
    groups = smallest_ids(ids, grouped(len(rows), linked), {k for k, u in enumerate(units) if u is None})
    return sorted(((i, c, *g) for i, c, g in zip(ids, counts, groups, strict=True)), key=repr)


def test_vectors_against_all_pairs(spark, rows_of, monkeypatch):
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, node int, dim string")
    want = brute_vectors(rows, 0.93)
    assert sum(r[1] for r in want) > 300
    assert rows_of(near_vectors(frame)) == want
    assert near_vectors(frame.limit(0)).collect() == []
    monkeypatch.setattr(embedding_dedup, "TILE", 2)  # buckets in many tiles, and keys of more bits
    assert rows_of(near_vectors(frame)) == want


def test_bits_follow_the_counted_buckets(spark):
    pick = random.Random(3)
    rows = [("even", 64, pick.randrange(1 << 24), k) for k in range(60_000)] + [("copies", 64, 5, k) for k in range(60_000)]
    rows += [("few", 64, pick.randrange(1 << 24), k) for k in range(500)]
    nodes = spark.createDataFrame(rows, "label string, dim int, sketch int, node long")

    def chosen(tile):
        embedding_dedup.TILE, before = tile, embedding_dedup.TILE
        try:
            return {r.label: r.bits for r in embedding_dedup.key_bits(nodes, 0.93).collect()}
        finally:
            embedding_dedup.TILE = before

    assert chosen(512) == {"even": 8, "copies": 8, "few": 8}
    assert chosen(8) == {"even": 14, "copies": 8, "few": 8}  # copies meet under any number of bits, so more would not help
    rows_a_vector = lambda n, tile=512: min(embedding_dedup.bands_for(b, 0.93) * (1 + n / 2**b / tile) for b in embedding_dedup.bit_choices(0.93))
    assert rows_a_vector(10**9) / rows_a_vector(10**7) < 100**0.25  # far from the square
    assert embedding_dedup.bit_choices(1.0) == [24] and embedding_dedup.bands_for(24, 1.0) == 1
    assert all(embedding_dedup.bit_choices(t) for t in (-1.0, 0.0, 0.3, 0.99))


def test_estimates_are_unbiased_and_bounded():
    random = np.random.default_rng(1)
    base = random.standard_normal((1, 64))
    units = np.concatenate([base + s * random.standard_normal((300, 64)) for s in (0.0, 0.2, 0.38, 3.0)])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    codes = Coder()(units)
    turned = codes["steps"].astype(np.float32) * codes["step"][:, None]
    signs = (np.unpackbits(codes["code"], axis=1).astype(float) * 2 - 1) / 8
    error = signs @ turned.T / codes["factor"][:, None] - units @ units.T
    assert abs(error.mean()) < 0.01
    maybe = may_link(codes["code"], codes["factor"], turned, 0.93)
    near = units @ units.T >= 0.93
    assert maybe[near].all() and maybe[units @ units.T < 0.6].mean() < 0.001


def test_keys_meet_as_often_as_stated():
    random = np.random.default_rng(2)
    a = random.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.standard_normal((20_000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    coder = Coder()
    for bits in embedding_dedup.bit_choices(0.93)[:5]:
        bands = embedding_dedup.bands_for(bits, 0.93)
        assert (coder.keys(a, bits, bands) == coder.keys(c, bits, bands)).any(1).mean() > 0.999
        assert (coder(a)["sketch"] >> 24 - bits == coder.keys(a, bits, bands)[:, 0]).all()

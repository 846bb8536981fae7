from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from claimlake.llm import collocations as c
from claimlake.llm.collocations import collocations, tokens


def slow(docs, top, min_count, percent=100):
    counts: dict = {}
    for lang, text in docs:
        seen = counts.setdefault(lang or "und", Counter())
        lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            seen.update(tuple(words[i : i + k]) for i in range(len(words)) for k in range(1, 6) if i + k <= len(words))
    out = []
    for lang, seen in counts.items():
        n = sum(v for g, v in seen.items() if len(g) == 1)
        often = {g: a for g, a in seen.items() if len(g) > 1 and a >= min_count}
        inside = Counter()
        for g, a in often.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i : i + k]] = max(inside[g[i : i + k]], a)
        rows = []
        for g, a in often.items():
            if 100 * inside[g] >= percent * a and inside[g]:
                continue
            score, k = min((1000 * a * n // (seen[g[:k]] * seen[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), seen[g[:k]], seen[g[k:]], n))
        out += [(lang, j, p.decode(), -a, left, r, n, -s) for j, (s, a, p, left, r, n) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def texts(seed, docs=60):
    random = np.random.default_rng(seed)
    words = np.array("a b c d ä É日 the THE of x-y   1".split(" "))
    marks = np.array([" "] * 9 + ["\t", ". ", "\n", "  ", "!?", ",", "\r"])
    out = []
    for _ in range(docs):
        n = int(random.integers(0, 200))
        picked = words[(random.pareto(0.8, n) * 1.2).astype(int) % len(words)]
        out.append(("".join(x for pair in zip(picked, random.choice(marks, n)) for x in pair), [None, "en", "de", "und"][int(random.integers(4))]))
    return out


@pytest.mark.parametrize(("seed", "top", "count", "percent", "leaves"), [(1, 2000, 3, 100, 250_000), (2, 7, 2, 100, 40), (3, 50, 5, 60, 3)])
def test_against_brute_force(spark, monkeypatch, seed, top, count, percent, leaves):
    monkeypatch.setattr(c, "LEAVES", leaves)  # small: heavy prefixes are split at every depth
    rows = texts(seed)
    got = collocations(spark.createDataFrame(rows, "text string, lang string").repartition(5), top, count, percent)
    assert sorted(tuple(r) for r in got.collect()) == slow([(lang, t) for t, lang in rows], top, count, percent)


def test_prefixes_are_split_by_budget(spark, monkeypatch):
    monkeypatch.setattr(c, "LEAVES", 10)
    rows = [(1, k, m, 0, 0, 1) for k in range(1, 6) for m in range(1, 8)] + [(2, 1, 0, 0, 0, 9)] + [(3, 3, 3, k, 0, 1) for k in range(1, 30)]
    dealt = c.grouped(spark.createDataFrame(rows, "w1 long, w2 long, w3 long, w4 long, w5 long, n long"), len(rows)).collect()
    assert {(r.w1, r["cut"]) for r in dealt} == {(1, 2), (2, 1), (3, 4)}
    bins = {}
    for r in dealt:
        bins.setdefault((r.w1, r.w2, r.w3, r.w4)[: r["cut"]], set()).add(r.bin)
    assert all(len(b) == 1 for b in bins.values()) and max(b for s in bins.values() for b in s) < -(-len(rows) // 10)


@pytest.mark.parametrize(("bits", "block"), [(4, 4), (9, 4)])
def test_phrases_that_share_buckets(spark, monkeypatch, bits, block):
    """Few buckets hold many phrases each, and tasks pass on little at a time: nothing is lost."""
    for name, value in {"PHRASE_BITS": bits, "BLOCK_BITS": block, "LOAD": 1, "COUNTED": 40, "TOGETHER": 100}.items():
        monkeypatch.setattr(c, name, value)
    rows = texts(4)
    got = collocations(spark.createDataFrame(rows, "text string, lang string").repartition(3), 2000, 20)
    assert sorted(tuple(r) for r in got.collect()) == slow([(lang, t) for t, lang in rows], 2000, 20)


def test_rare_triples_of_frequent_pairs_make_no_leaves(spark, monkeypatch):
    """Of 12 words at random every pair is frequent and no triple, but for those of a phrase that is put in."""
    made = {}

    def counted(df, name):
        made[name] = (out := stored(df, name)).count()
        return out

    stored = c.stored
    monkeypatch.setattr(c, "stored", counted)
    random = np.random.default_rng(6)
    rows = [(" ".join([*random.choice(list("abcdefghijkl"), 200), "a b c d e"]), "en") for _ in range(120)]
    got = collocations(spark.createDataFrame(rows, "text string, lang string").repartition(4), 2000, 100)
    assert sorted(tuple(r) for r in got.collect()) == slow([(lang, t) for t, lang in rows], 2000, 100)
    assert 0 < made["phrase-leaves"] <= 20


def test_equal_keys_are_added():
    random = np.random.default_rng(5)
    keys, n = random.integers(0, 3, (2, 500)), random.integers(1, 9, 500)
    want = Counter()
    for a, b, k in zip(*keys.tolist(), n.tolist()):
        want[a, b] += k
    got, sums = c.added(keys, n)
    assert list(zip(zip(*got.tolist()), sums.tolist())) == sorted(want.items())
    assert c.added(np.zeros((2, 0), np.int64), np.zeros(0, np.int64))[1].tolist() == []


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(c, "BYTES", 7)
    text = "aa bbb,cc\tdddddddddddddddd ee. F\n g"
    assert [w for part in tokens(text.encode()) for w in part] == [b"aa", b"bbb", c.BREAK, b"cc", b"d" * 16, b"ee", c.BREAK, b"f", c.BREAK, b"g"]
    assert list(tokens(b"")) == []


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = sorted(tuple(r) for r in collocations(edge_docs, 2000, 2).collect())
    assert got == slow([(lang, t) for _, t, lang, *_ in edge_rows], 2000, 2) and got
    assert collocations(no_docs).collect() == []


def test_large_numbers(spark):
    """Products beyond 64 bits stay exact."""
    phrases = spark.createDataFrame([([1, 2], 3_000_000_001)], "words array<long>, a long")
    known = spark.createDataFrame([([1], 3_000_000_007), ([2], 4_000_000_009)], "words array<long>, a long")
    words = spark.createDataFrame([(1, "en"), (2, "en")], "id long, lang string")
    row = c.cuts(phrases, known, words, spark.createDataFrame([("en", 9_999_999_999_999)], "lang string, n long")).first()
    assert row.score == 1000 * 3_000_000_001 * 9_999_999_999_999 // (3_000_000_007 * 4_000_000_009)

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from claimlake.llm import spelling
from claimlake.llm.spelling import compare, misspelt, variants


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def slow(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if distance_one(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize(("seed", "members"), [(1, 256), (2, 4), (3, 2)])
def test_against_brute_force(spark, monkeypatch, seed, members):
    monkeypatch.setattr(spelling, "MEMBERS", members)  # small: buckets are cut down to single places
    random = np.random.default_rng(seed)
    stems = ["".join(random.choice(list("abÀÿ×"), k)) for k in (5, 6, 6, 7, 9, 12)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = stems[int(random.integers(len(stems)))]
            for _ in range(int(random.integers(3))):
                k = int(random.integers(len(w)))
                w = w[:k] + str(random.choice(["", "a", "b", "É", w[k] * 2])) + w[k + 1 :]
            words += [w.upper() if random.random() < 0.2 else w] * int(random.choice([1, 1, 1, 7]))
        docs.append((i, " ".join(words) + ".-Ā"))
    got = result(variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)))
    assert got == slow(docs) and any(r[1] for r in got) and any(r[4] > 4 for r in got)


def test_forms_are_followed(spark):
    docs = [(1, "spellinq " * 5 + "spelling " * 30 + "spellings " * 200 + "pellings " * 1001)]
    got = {r[0]: r for r in result(variants(spark.createDataFrame(docs, "doc_id long, text string")))}
    assert got == {r[0]: r for r in slow(docs)}
    assert [got[w][2] for w in ("spellinq", "spelling", "spellings")] == ["pellings"] * 3


def test_misspelt_rule():
    run = next(w for w in (f"{chr(97 + k // 26)}{chr(97 + k % 26)}abcdef" for k in range(676)) if zlib.crc32(f"7:{w}".encode()) % 199 == 0)
    place = zlib.crc32(f"7:{run}".encode()) % len(run)
    assert misspelt(run, zlib.crc32(b"7:")) == run[:place] + run[place + 1 :]


@pytest.mark.parametrize("members", [2, 3, 40, 300])
def test_dense_comparison(members):
    random = np.random.default_rng(members)
    words = sorted({"".join(random.choice(list("ab"), int(k))) for k in random.integers(8, 10, 3 * members)})[:members]
    links, best = compare(words, np.ones(len(words)), np.full(len(words), 9), np.zeros(len(words), int), np.full(len(words), 9), np.array([0]))
    for k, w in enumerate(words):
        near = [j for j, v in enumerate(words) if distance_one(w, v) and max(len(w), len(v)) == 9]
        assert (links[k], best[k]) == (len(near), near[0] if near else -1)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    assert result(variants(edge_docs)) == slow([(i, t) for i, t, *_ in edge_rows])
    assert variants(no_docs).collect() == []
    long = "x" * 200_000
    docs = [(1, f"{long} {long}y {long[1:]} " * 6 + f"{long} " * 40)]
    assert result(variants(spark.createDataFrame(docs, "doc_id long, text string"))) == slow(docs)

from __future__ import annotations

import hashlib
import random
import re

import pytest

from claimlake.llm import decontaminate
from claimlake.llm.decontaminate import contamination
from claimlake.llm.decontaminate import decontaminate as clean

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    out = []
    for i, text in rows:
        w, hit, got = words(text), set(), set()
        for item, item_text in items:
            iw = words(item_text)
            size = min(window, len(iw))
            for k in range(len(iw) - size + 1 if size else 0):
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == iw[k : k + size]:
                        hit |= set(range(p, p + size))
                        got |= {str(item)} - {"None"}
        out.append((i, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def cases(spark):
    pick = random.Random(6)
    vocabulary = [*(f"w{n}" for n in range(9)), "Ünder", "日本", "X1"]
    items = [(n, " ".join(pick.choices(vocabulary, k=pick.choice([0, 1, 3, 9, 10, 11, 14])))) for n in range(25) if n != 7] + [(None, "w1 w2 w3 none w4"), (40, None), (41, " .,"), (3, "again the same id")]
    rows = [(n, ", ".join(pick.choices(vocabulary, k=30))) for n in range(40)] + [(50, items[4][1].upper().replace(" ", "\n--")), (51, None), (52, ""), (None, items[2][1]), (50, "w1")]
    rows += [(60 + n, f"before {items[n][1]} after") for n in range(20)]
    docs = spark.createDataFrame([(*r, 1, "m") for r in rows], "doc_id long, text string, items int, mask string")
    return rows, items, docs, spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(cases, rows_of):
    rows, items, docs, benchmark = cases
    assert rows_of(contamination(docs, benchmark)) == brute(rows, items)
    assert contamination(docs.limit(0), benchmark).collect() == []
    assert not any(r.contaminated for r in contamination(docs, benchmark.limit(0)).collect())


def test_scan_in_pieces(cases, rows_of, monkeypatch):
    rows, items, docs, benchmark = cases
    monkeypatch.setattr(decontaminate, "SCAN_WORDS", 50)
    assert rows_of(contamination(docs, benchmark)) == brute(rows, items)


@pytest.mark.parametrize("bits", [decontaminate.PIECE, decontaminate.FILTER_BITS])
def test_large_benchmarks_are_joined(cases, rows_of, monkeypatch, bits):
    """Also where the filter lets nearly everything through."""
    rows, items, docs, benchmark = cases
    monkeypatch.setattr(decontaminate, "MAX_BYTES", 0)
    monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
    assert rows_of(contamination(docs, benchmark)) == brute(rows, items)
    assert contamination(docs.limit(0), benchmark).collect() == []


def test_joined_as_broadcast_on_whole_tables(spark, rows_of, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    want = rows_of(contamination(docs, benchmark))
    kept = rows_of(clean(docs, benchmark, remove="spans").select("doc_id", "text"))
    monkeypatch.setattr(decontaminate, "MAX_BYTES", 0)
    assert rows_of(contamination(docs, benchmark)) == want and any(r[-1] for r in want)
    assert rows_of(clean(docs, benchmark, remove="spans").select("doc_id", "text")) == kept


def test_removal(spark):
    benchmark = spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Keep: w1, w2 - w3. And w1 w2!", 5), (2, "w1 w2", 6), (3, None, 7)], "doc_id long, text string, id int")
    assert sorted(map(tuple, clean(docs, benchmark).collect())) == [(2, "w1 w2", 6), (3, None, 7)]
    spans = clean(docs, benchmark, remove="spans")
    assert spans.schema == docs.schema
    assert sorted(map(tuple, spans.collect())) == [(1, "Keep: . And w1 w2!", 5), (2, "w1 w2", 6), (3, None, 7)]


def test_long_texts(edge_docs, edge_rows, spark, rows_of):
    items = [(1, "delta alpha beta gamma delta alpha beta gamma delta alpha beta"), (2, "gamma delta epsilon")]
    short = [(r[0], r[1]) for r in edge_rows if len(r[1] or "") < 1000]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(contamination(edge_docs, benchmark))
    assert [r for r in got if r[1] < 1000] == brute(short, items)
    assert [r[:4] for r in got if r[1] > 1000] == [(7, 120_000, 119_998, 1)] * 2 + [(8, 120_001, 120_001, 2)]

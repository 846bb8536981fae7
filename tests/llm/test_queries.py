"""Every query against its SQL, and the pipeline against a brute-force run of its stages."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from claimlake.llm.decontaminate import words_of
from claimlake.llm.oracles import ORACLES
from claimlake.llm.queries import QUERIES
from tests.llm.test_line_dedup import key
from tests.llm.test_near_duplicates import grouped, shingles
from tests.oracle import run_duckdb, run_spark

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, con, name):
    got, want = run_spark(QUERIES[name](spark, SF)), run_duckdb(con, ORACLES[name])
    assert got == want and got[1]


def test_pipeline(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "minhash near-dedup", "benchmark decontamination", "sentencepiece encoding"]
    kept = corpus_pipeline.keep_quality(spark, docs, SF)
    assert kept.schema == docs.schema
    bad = {r[0] for r in con.execute("select doc_id from labels where quality = 0").fetchall()}
    good = {r[0] for r in con.execute("select doc_id from labels where quality = 1").fetchall()}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert good <= ids and len(bad & ids) <= len(bad) // 20
    texts = dict(kept.select("doc_id", "text").collect())
    first: dict = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(key(line), i)
    texts = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == i) for i, t in texts.items()}
    order = sorted(texts)
    sets = [shingles(texts[i], 5) for i in order]
    links = [(a, b) for a in range(len(order)) for b in range(a) if sets[a] and 100 * min(len(sets[a]), len(sets[b])) >= 80 * max(len(sets[a]), len(sets[b])) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    texts = {order[k]: texts[order[k]] for k, r in enumerate(grouped(len(order), links)) if k == r}
    windows = set()
    for (text,) in con.execute("select text from benchmark").fetchall():
        w = words_of(text.encode())
        windows |= {tuple(w[k : k + min(10, len(w))]) for k in range(max(1, len(w) - 9)) if w}
    sizes = {len(x) for x in windows}
    clean = {i for i, t in texts.items() if not any(tuple(w[k : k + n]) in windows for w in [words_of(t.encode())] for n in sizes for k in range(len(w) - n + 1))}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == clean and len(out) == len(clean) and all(r.round_trip for r in out)
    assert 0 < len(clean) < len(texts) < len(ids) < docs.count()


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, query in {**QUERIES, "pipeline": corpus_pipeline.run}.items():
        assert query(spark, str(tmp_path)).collect() == [], name

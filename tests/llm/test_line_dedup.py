from __future__ import annotations

import hashlib
import random

from claimlake.llm.line_dedup import dedup_lines, line_report

BLANKS = "\t\n\x0b\x0c\r "


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_chars=10):
    """(id, lines, dropped, digest) of (id, text) rows."""
    rank = lambda i: (i is None, i)
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), rank(i)), rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or first[key(x)] == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edges(edge_docs, edge_rows, no_docs, rows_of):
    assert rows_of(line_report(edge_docs)) == brute([r[:2] for r in edge_rows])
    assert line_report(no_docs).collect() == []
    assert dedup_lines(no_docs).columns == edge_docs.columns


def test_hot_lines_over_many_partitions(spark, rows_of):
    pick = random.Random(5)
    lines = ["a line that a third of all documents hold", "another line", "ANOTHER LINE\t", "too short", "", "  ", *(f"line number {n} of many" for n in range(40))]
    rows = [(pick.randint(1, 900), "\n".join(["a line that a third of all documents hold"] * pick.randint(0, 3) + pick.choices(lines, k=pick.randint(0, 14)))) for _ in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(line_report(docs)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts_keep_their_columns(edge_docs, edge_rows):
    out = dedup_lines(edge_docs)
    assert out.schema == edge_docs.schema
    texts = {r.doc_id: r.text for r in out.collect() if r.doc_id}
    assert texts[1] == edge_rows[0][1] and texts[2] == "other words of the second" and texts[3] == "third"
    assert texts[4] is None and texts[5] == "" and texts[9] == edge_rows[9][1]

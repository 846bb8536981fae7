"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest

from workload.queries import QUERIES, bi_fact_claims_enriched, mart_plan_month, recent_events

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_pairing(spark, name):
    """All work stays in built-in expressions, all joins are on keys."""
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapIn"):
        assert operator not in text


@pytest.mark.parametrize("name", list(QUERIES))
def test_nothing_whole_in_one_partition(spark, name):
    """What is brought to one place is partial aggregates, or the counts per key prefix."""
    lines = plan(QUERIES[name](spark, SF_DIR)).split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[i + 1:i + 3])
            assert "functions=[partial" in below or "functions=[merge" in below or "__prefix" in below, below


def test_dimensions_are_broadcast(spark):
    text = plan(bi_fact_claims_enriched(spark, SF_DIR))
    assert len(re.findall(r"BroadcastHashJoin \[\w+_key#\d+\], \[\w+_key#\d+\], LeftOuter, BuildRight", text)) == 8


def test_only_needed_columns_are_read(spark):
    text = plan(mart_plan_month(spark, SF_DIR))
    (lineitem,) = [line for line in text.split("\n") if "/lineitem.parquet" in line]
    assert "l_shipdate" not in lineitem and "l_returnflag" not in lineitem
    assert "/part.parquet" not in text and "/supplier.parquet" not in text


def test_top_rows_are_not_fully_sorted(spark):
    text = plan(recent_events(spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in text

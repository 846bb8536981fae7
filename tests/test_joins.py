"""Joins to dimensions of any size, with skewed keys, against a plain join."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from claimlake.functions.columns import stable_key
from claimlake.operators import dimensions as D
from claimlake.operators import facts, joins


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows on one key, a tenth without a key, some without a match, full copies."""
    return spark.range(4000).selectExpr(
        "case when id % 2 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 300) end as key",
        "id % 7 as value")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(250).selectExpr("concat('k', id) as key", "id as attribute").union(
        spark.sql("select 'hot', -1L")).union(spark.sql("select cast(null as string), -2L"))


def rows(df):
    return sorted(map(str, df.select("key", "value", "attribute").collect()))


def test_sizes_are_observed_and_bounded(spark, dim):
    (size,) = dim.agg(F.count(F.lit(1)), F.sum(joins.row_bytes(dim))).collect()
    size = joins.Size(*size)
    assert size.rows == 252 and size.bytes > 252 * 64
    assert size.fits(joins.JoinLimits())
    assert not size.fits(joins.JoinLimits(broadcast_rows=251))
    assert not size.fits(joins.JoinLimits(broadcast_bytes=1000))


def test_known_small_dimension_is_broadcast(skewed, dim):
    joined = joins.star_join(skewed, [("key", dim)], sizes={"key": joins.Size(252, 20_000)})
    assert "BroadcastHashJoin" in plan_of(joined) and "Exchange hashpartitioning" not in plan_of(joined)
    assert rows(joined) == rows(skewed.join(dim, "key", "left"))


def test_broadcasts_have_a_total(spark, dim):
    fact = spark.range(50).selectExpr("cast(id as string) as a", "cast(id as string) as b")
    dims = [(k, dim.select(F.col("key").alias(k), F.col("attribute").alias(f"{k}_attribute")).hint("x")) for k in "ab"]
    sizes = {"a": joins.Size(252, 900), "b": joins.Size(252, 800)}
    plan = joins.star_join(fact, dims, joins.JoinLimits(broadcast_total=1000), sizes)._jdf.queryExecution().analyzed().toString()
    assert plan.count("strategy=broadcast") == 1


def jobs(spark, build):
    """Number of jobs that ``build`` runs."""
    group = f"build-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "plan building")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_join_runs_no_job(spark, skewed, dim):
    assert jobs(spark, lambda: skewed.count()) > 0
    assert jobs(spark, lambda: joins.star_join(skewed, [("key", dim)], sizes={"key": joins.Size(10**9, 10**12)})) == 0


def test_adaptive_execution_splits_the_hot_key_and_the_null_key(spark):
    """A dimension too large to broadcast: the partitions of hot keys are read by several tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(400_000, numPartitions=8).selectExpr(
            "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 5000) end as key", "uuid() as value")
        large = spark.range(5000).selectExpr("concat('k', id) as key", "id as attribute").union(spark.sql("select 'hot', -1L"))
        joined = joins.star_join(fact, [("key", large)])
        assert joined.count() == 400_000
        matched = joined.agg(F.count("attribute"), F.max("value"))
        assert matched.collect()[0][0] > 133_000
        assert "skew=true" in plan_of(matched)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_joins_that_may_shuffle_come_before_broadcasts(spark, skewed, dim):
    fact = skewed.withColumn("small_key", F.col("value").cast("string"))
    small = spark.range(7).selectExpr("cast(id as string) as small_key", "id * 2 as twice")
    joined = joins.star_join(fact, [("small_key", small), ("key", dim.hint("merge"))], sizes={"small_key": joins.Size(7, 700)})
    assert joined.count() == fact.count()
    assert joined.filter("twice <> value * 2").isEmpty()
    assert plan_of(joined).index("BroadcastHashJoin") < plan_of(joined).index("hashpartitioning(key")


def test_plans_are_numbered_in_key_order(spark):
    plans = spark.range(500).select(stable_key("id").alias("plan_key"))
    with_copies = plans.union(plans).union(spark.sql("select cast(null as string)"))
    numbered = {r["plan_key"]: r["plan_number"] for r in D.plan_numbers(with_copies).collect()}
    assert numbered == {k: i for i, k in enumerate(sorted(r[0] for r in plans.collect()))}


def test_every_member_gets_one_plan(spark):
    members = spark.range(2000).select(stable_key("id").alias("member_key"), F.lit("old").alias("plan_key"))
    plans = spark.range(7).select(stable_key("id").alias("plan_key"))
    out = D.assign_plans(members, plans)
    assert out.count() == out.select("member_key").distinct().count() == 2000
    expected = sorted(r[0] for r in plans.collect())
    assert all(r["plan_key"] == expected[int(r["member_key"][:8], 16) % 7] for r in out.collect())
    assert out.groupBy("plan_key").count().agg(F.min("count")).first()[0] > 200
    assert D.assign_plans(members.withColumn("member_key", F.lit(None).cast("string")), plans).count() == 0
    with pytest.raises(Exception, match="no plan_key"):
        D.assign_plans(members, plans.filter("plan_key is null")).collect()


def test_null_id_joins_the_null_id_row(spark):
    claims = spark.sql("""select '1' claim_id, '2' member_id, date '2024-01-01' admission_date,
        cast(null as string) place_of_service_std_id""")
    fact = facts.fact_claims(facts.apply_rules(claims))
    places = D.build_dim(
        spark.sql("select cast(null as string) Place_of_Service_Code, 'Worksite' Place_of_Service_Name"),
        D.PLACES_OF_SERVICE)
    assert fact.join(places, "place_of_service_key").first()["Place_of_Service_Name"] == "Worksite"


def test_mart_sums_to_the_fact(spark):
    claims = spark.sql("""select cast(id % 50 as string) claim_id, cast(id % 9 as string) member_id,
        date_add(date '2024-01-01', cast(id % 90 as int)) admission_date, cast(id % 3 as string) plan_id,
        cast(case when id % 5 > 0 then id end as decimal(18,2)) line_allowed,
        cast(id * 2 as decimal(18,2)) line_charge from range(1000)""")
    fact = facts.fact_claims(facts.apply_rules(claims))
    mart = facts.mart_plan_month(fact)
    sums = mart.agg(F.sum("paid_amount"), F.sum("billed_amount")).first()
    assert tuple(sums) == tuple(fact.agg(F.sum("line_allowed"), F.sum("line_charge")).first())
    assert dict(mart.dtypes)["paid_amount"] == "decimal(28,2)"


CLAIMS = """select if(id % 7 = 0, null, cast(id % 50 as string)) claim_id, if(id % 11 = 0, null, cast(id % 9 as string)) member_id,
    cast(id % 4 as string) service_line_number, if(id % 5 = 0, null, date_add(date '2024-01-01', cast(id % 90 as int))) admission_date,
    cast(id % 3 as string) plan_id, if(id % 3 = 0, '', cast(id % 20 as string)) procedure_code, 'rx' claim_type, cast(id as decimal(18,2)) line_charge
    from range(300)"""


@pytest.mark.parametrize("line_id", [False, True])
def test_keys_hashed_late_are_those_of_the_fact(spark, line_id):
    """Also where ids are null or empty, and where the line's id is the grain."""
    claims = spark.sql(CLAIMS)
    ruled = facts.apply_rules(claims.selectExpr("*", "concat('l', uuid()) claim_line_id").localCheckpoint() if line_id else claims)
    fact, by_text = facts.fact_claims(ruled), facts.fact_claims(ruled, hashed=False)
    assert facts.FACT_KEY not in by_text.columns
    late = facts.hash_keys(by_text).select(*fact.columns)
    assert sorted(map(str, late.collect())) == sorted(map(str, fact.collect()))
    dims = {
        "member_key": D.build_dim(spark.sql("select cast(id as string) member_id, id member_age from range(8) union all select null, -1"), D.MEMBERS),
        "plan_key": D.build_dim(spark.sql("select id plan_id, concat('plan ', id) plan_name from range(2)"), D.PLANS),
    }
    wide = facts.wide_claims(by_text, dims)
    assert wide.columns == facts.wide_claims(fact, dims).columns
    assert sorted(map(str, wide.collect())) == sorted(map(str, facts.wide_claims(fact, dims).collect()))
    assert wide.filter("member_age = -1").count() == claims.filter("member_id is null").count() > 0


def test_rows_of_the_wide_table_move_without_hashes(spark):
    """No hash is computed below a shuffle, and the first join is that to the members, not one to a few plans."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_text = facts.fact_claims(facts.apply_rules(spark.sql(CLAIMS)), hashed=False)
        dims = {s.key: D.build_dim(spark.sql(f"select cast(id as string) {s.id} from range(9)"), s) for s in (D.PLANS, D.PROCEDURE_CODES, D.MEMBERS)}
        text = plan_of(facts.wide_claims(by_text, dims))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = text.index("Exchange hashpartitioning")
    assert "sha2" in text[:moved] and "sha2" not in text[moved:]
    joins_down = [line.split("[")[1].split("#")[0] for line in text.split("\n") if "SortMergeJoin [" in line]
    assert joins_down == ["plan_key", "procedure_code_key", "member_key"]


def test_lines_are_joined_to_orders_that_have_their_customers(spark):
    """The lines move for parts and orders, not for customers."""
    from workload.source import raw_claims

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = raw_claims(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.split("\n")
    (at,) = [k for k, line in enumerate(lines) if "SortMergeJoin [o_custkey" in line]
    assert "/lineitem.parquet" not in "\n".join(lines[at:])
    assert "/lineitem.parquet" in "\n".join(lines[:at])

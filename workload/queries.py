"""Every operator as a query over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.config import GOLD, Namespace, PipelineConfig, RunContext
from claimlake.functions import columns as C
from claimlake.operators import dimensions as D
from claimlake.functions.naming import normalize_headers
from claimlake.operators import facts, frames, joins, kpi
from claimlake.operators.standardize import TRIM_ONLY, reject_condition, split_rejects, standardize
from claimlake.plans import audit, gold, running_mart
from claimlake.sources.store import Buckets, TableStore
from workload.source import AS_OF, lookup, raw_claims, table

Query = Callable[[SparkSession, str], DataFrame]

_KEYS = ("claim_id", "member_id")
_AMOUNTS = ("line_charge", "line_allowed")


def clean(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Accepted claims with the given columns (all by default). The required keys always take part."""
    wanted = [*_KEYS, *(c for c in columns if c not in _KEYS)] if columns else None
    accepted, _ = split_rejects(standardize(raw_claims(spark, sf_dir, wanted)))
    return accepted


def fact(spark: SparkSession, sf_dir: str, *columns: str, hashed: bool = True) -> DataFrame:
    return facts.fact_claims(facts.apply_rules(clean(spark, sf_dir, *columns)), hashed=hashed)


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All dimensions by key column."""
    return {spec.key: _dim(spec)(spark, sf_dir) for spec in D.DIMENSIONS}


def dim_sizes(spark: SparkSession, sf_dir: str) -> dict[str, joins.Size]:
    """Bounds of the sizes of dimensions whose lookups have few enough rows to be broadcast."""
    sizes = {}
    for spec in D.DIMENSIONS:
        source = lookup(spark, sf_dir, spec.source)
        rows = source.count()
        if rows <= joins.DEFAULT_LIMITS.broadcast_rows:
            sizes[spec.key] = joins.Size(rows, source.agg(F.sum(joins.row_bytes(source))).first()[0] or 0)
    return sizes


def _dim(spec: D.DimSpec) -> Query:
    return lambda spark, sf_dir: D.build_dim(lookup(spark, sf_dir, spec.source), spec)


def scratch_store(spark: SparkSession) -> TableStore:
    """A store with databases of its own in the session's warehouse."""
    tag = uuid.uuid4().hex
    store = TableStore(spark, PipelineConfig("", "", *(Namespace(layer, tag) for layer in ("bronze", "silver", "gold"))))
    store.create_namespaces()
    return store


def scan_claims(spark, sf_dir):
    return raw_claims(spark, sf_dir)


def latest_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("run_id", F.to_date("ts").cast("string"))
    newest = frames.latest_batch(events, "run_id", "ts").select("run_id")
    return events.join(F.broadcast(newest), "run_id").select("run_id", "event_id", "event_type")


def claims_clean(spark, sf_dir):
    return clean(spark, sf_dir)


def claims_rejects(spark, sf_dir):
    _, rejects = split_rejects(standardize(raw_claims(spark, sf_dir)))
    return rejects


def silver_lookup(spark, sf_dir):
    padded = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as member_number", "concat('  ', c_name, ' ') as member_name",
        "concat(c_mktsegment, '\t ') as segment",
    )
    return standardize(padded, TRIM_ONLY)


def impute_flags(spark, sf_dir):
    ruled = facts.apply_rules(
        clean(spark, sf_dir, "service_line_number", "claim_type", *_AMOUNTS, "units"))
    return ruled.select(
        "claim_id", "member_id", "service_line_number", "line_charge", "line_charge_imputed_flag",
        "line_allowed", "line_allowed_imputed_flag", "units", "units_imputed_flag", "is_rx_claim")


def stable_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        C.stable_key("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date")).alias("line_key"),
        C.stable_key("l_partkey").alias("part_key"),
    )


def dim_place_of_service_ranges(spark, sf_dir):
    places = lookup(spark, sf_dir, D.PLACES_OF_SERVICE.source)
    return D.build_dim(D.expand_code_ranges(places, "Place_of_Service_Code"), D.PLACES_OF_SERVICE)


def assign_plan(spark, sf_dir):
    members, plans = _dim(D.MEMBERS)(spark, sf_dir), _dim(D.PLANS)(spark, sf_dir)
    return D.assign_plans(members, plans).select("member_id", "member_key", "plan_key")


def dim_date(spark, sf_dir):
    return D.dim_date(clean(spark, sf_dir, "admission_date"))


def fact_claims(spark, sf_dir):
    return fact(spark, sf_dir)


def dq_duplicate_grain(spark, sf_dir):
    return facts.duplicate_grain(clean(spark, sf_dir, *facts.GRAIN_FALLBACK))


def duplicate_claims(spark, sf_dir):
    return frames.duplicate_groups(clean(spark, sf_dir, "claim_id"), ["claim_id"])


def dedupe_claims(spark, sf_dir):
    return frames.dedupe_by_key(
        clean(spark, sf_dir),
        ["plan_id", "member_id", "claim_id", "service_line_number", "admission_date"],
        order_by=["discharge_date"],
    )


def mart_plan_month(spark, sf_dir):
    return facts.mart_plan_month(fact(spark, sf_dir, "plan_id", "admission_date", *_AMOUNTS))


def bi_fact_claims_enriched(spark, sf_dir):
    return facts.wide_claims(fact(spark, sf_dir, hashed=False), dims(spark, sf_dir), sizes=dim_sizes(spark, sf_dir))


def pos_first_code(spark, sf_dir):
    places = lookup(spark, sf_dir, "ref_place_of_service")
    return D.first_codes(places, "Place_of_Service_Code").groupBy("code").agg(
        F.count(F.lit(1)).alias("n"))


def code_list(spark, sf_dir):
    padded = table(spark, sf_dir, "part").selectExpr(
        "case when p_size = 7 then null else concat(' ', p_brand, ' ') end as raw")
    return D.code_list(padded, "raw")


def age_years(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        C.age_in_years(F.col("o_orderdate").cast("date"), F.lit(AS_OF).cast("date")).alias("age"),
    )


def length_of_stay(spark, sf_dir):
    stays = clean(spark, sf_dir, "service_line_number", "admission_date", "discharge_date")
    days = F.datediff("discharge_date", "admission_date")
    return stays.select(
        "claim_id", "service_line_number", "admission_date", "discharge_date", days.alias("days"),
        C.days_later("admission_date", F.lit(31)).alias("limit_of_stay"),
    )


def allowed_amount(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        C.share_of_amount(
            F.col("l_extendedprice").cast("decimal(18,2)"), 1 - F.col("l_discount").cast("decimal(4,2)")
        ).alias("allowed"),
    )


def recent_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return frames.newest(events, "ts", 50, tie=["event_id"]).select("event_id", "ts", "user_id")


def reconcile_counts(spark, sf_dir):
    typed = standardize(raw_claims(spark, sf_dir, [*_KEYS, "admission_date", *_AMOUNTS, "units"]))
    bad = reject_condition(typed)
    return typed.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~bad).alias("rows_written"),
        F.count_if(bad).alias("rows_rejected"),
        F.count("admission_date").alias("admission_dates"),
        F.count("line_charge").alias("line_charges"),
        F.count("units").alias("unit_counts"),
    )


def kpi_totals(spark, sf_dir):
    return kpi.totals(fact(spark, sf_dir, *_AMOUNTS))


def kpi_utilization_trend(spark, sf_dir):
    return kpi.utilization_trend(fact(spark, sf_dir, "admission_date", *_AMOUNTS))


def kpi_diagnosis_dist(spark, sf_dir):
    dim = _dim(D.DIAGNOSIS_CODES)(spark, sf_dir)
    return kpi.code_distribution(
        fact(spark, sf_dir, "diagnosis_code", "admission_date"), dim, "diagnosis_code_key", "DIAGNOSIS_CODE")


def kpi_procedure_dist(spark, sf_dir):
    dim = _dim(D.PROCEDURE_CODES)(spark, sf_dir)
    return kpi.code_distribution(
        fact(spark, sf_dir, "procedure_code", "admission_date"), dim, "procedure_code_key", "procedure_code")


def kpi_top_procedures(spark, sf_dir):
    """The twenty most frequent procedures: a report of its own beside the full distribution."""
    dim = _dim(D.PROCEDURE_CODES)(spark, sf_dir)
    return kpi.code_distribution(
        fact(spark, sf_dir, "procedure_code", "admission_date"), dim, "procedure_code_key", "procedure_code",
        top=20)


def kpi_unmatched_codes(spark, sf_dir):
    """A code list that lacks some codes: their lines are counted under null."""
    dim = _dim(D.DIAGNOSIS_CODES)(spark, sf_dir).filter(F.col("DIAGNOSIS_CODE") > "BRAND#3")
    return kpi.code_distribution(
        fact(spark, sf_dir, "diagnosis_code", "admission_date"), dim, "diagnosis_code_key", "DIAGNOSIS_CODE")


def run_columns(spark, sf_dir):
    """Rows stamped with run id and origin, as the raw layer does; the time is left out."""
    from claimlake.plans.bronze import stamp

    return stamp(table(spark, sf_dir, "supplier").select("s_suppkey"), "run-1", "source_file", "supplier.csv").drop("ingestion_timestamp")


def keyless_rejects(spark, sf_dir):
    """Claims without any required key column: none is rejected."""
    renamed = standardize(raw_claims(spark, sf_dir, ["claim_id", "units"]).withColumnRenamed("claim_id", "claim"))
    bad = reject_condition(renamed)
    return renamed.agg(F.count_if(~bad).alias("clean_rows"), F.count_if(bad).alias("rejects"))


def normalized_headers(spark, sf_dir):
    odd = table(spark, sf_dir, "nation").selectExpr("n_nationkey as `Place of Service Code(s)`", "n_name as ` NAME--of-it `")
    return normalize_headers(odd)


def validation_report(spark, sf_dir):
    """Rows per table, and of one run, in one frame."""
    events = table(spark, sf_dir, "events").withColumn("run_id", F.to_date("ts").cast("string"))
    lines = [
        audit.report_line("events", events, "run_id", "1995-01-01"), audit.report_line("nation", table(spark, sf_dir, "nation")),
        audit.report_line("nothing", None),
    ]
    return reduce(lambda a, b: a.unionByName(b), lines)


def dq_issue_rows(spark, sf_dir):
    """The issue record of duplicate grain keys, as the log writes and the review reads it, without its time."""
    store = scratch_store(spark)
    groups = facts.duplicate_grain_count(clean(spark, sf_dir, *facts.GRAIN_FALLBACK)).first()["duplicate_groups"]
    with audit.RunLog(store, GOLD, RunContext("run-1")) as log:
        log.issue("DUPLICATE_GRAIN", "fact_claims", groups, "several rows share a key")
    return audit.recent_issues(store).select("gold_run_id", "issue_type", "table_name", "record_count")


def log_review(spark, sf_dir):
    """The 50 newest log rows of a layer; errors among the events play its steps, other events those of another layer."""
    store = scratch_store(spark)
    rows = table(spark, sf_dir, "events").selectExpr(
        "concat('run-', event_id) as run_id", "'claims' as pipeline_name", "if(event_type = 'error', 'gold', 'silver') as layer", "event_type as source",
        "concat('user-', user_id) as target", "if(event_id % 2 = 0, 'SUCCESS', 'FAILED') as status", "cast(ts as timestamp) as start_time",
        "cast(ts as timestamp) as end_time", "0D as duration_seconds", "event_id as rows_read", "event_id as rows_written", "0L as rows_rejected",
        "cast(null as string) as error_message")
    store.append(rows, GOLD, audit.RUN_LOG_TABLE)
    return audit.recent_runs(store, GOLD).select("run_id", "layer", "target", "status", "rows_read")


def widened_batches(spark, sf_dir):
    """Two batches appended to one table: the later one has a new column and another order."""
    store = scratch_store(spark)
    first = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "'r1' as run_id")
    second = table(spark, sf_dir, "customer").selectExpr("'r2' as run_id", "c_custkey as id", "c_mktsegment as segment")
    for batch in (first, second):
        store.append(batch, GOLD, "batches_of_ids", ["run_id"])
    return store.read(GOLD, "batches_of_ids").select("id", "run_id", "segment")


def widened_types(spark, sf_dir):
    """Three batches appended to one table: numbers get more digits, then fewer again."""
    store = scratch_store(spark)
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_partkey", "l_linenumber", "cast(l_extendedprice as decimal(18,2)) as price")
    first = lines.filter("l_linenumber <= 2").selectExpr(
        "cast(l_orderkey as int) as id", "cast(l_linenumber as smallint) as line", "cast(price as decimal(10,2)) as amount", "cast(l_partkey as float) as part", "'r1' as run_id")
    second = lines.filter("l_linenumber in (3, 4)").selectExpr(
        "l_orderkey + 5000000000 as id", "cast(l_linenumber as int) + 100000 as line", "cast(price / 8 as decimal(16,6)) as amount", "l_partkey + 0.1D as part", "'r2' as run_id")
    third = lines.filter("l_linenumber > 4").selectExpr(
        "cast(price as decimal(8,1)) as amount", "cast(l_partkey as float) as part", "cast(l_linenumber as smallint) as line", "cast(l_orderkey as int) as id", "'r3' as run_id")
    for batch in (first, second, third):
        store.append(batch, GOLD, "batches_of_lines", ["run_id"])
    return store.read(GOLD, "batches_of_lines")


def wide_by_buckets(spark, sf_dir):
    """The wide table where members are too many to be broadcast: they and the fact are stored in the same buckets, by
    the ids' texts; keys are hashed after the joins."""
    store, cluster = scratch_store(spark), joins.Clustering("member_key", 16)
    by_key, rows = dims(spark, sf_dir), table(spark, sf_dir, "lineitem").count()
    grown = cluster.grown(rows)
    members = facts.dimension_by_text(by_key[cluster.key], cluster.key)
    ids = facts.fact_claims(facts.apply_rules(clean(spark, sf_dir, "member_id")), hashed=False)
    claims, members = joins.cluster_together(fact(spark, sf_dir, hashed=False), members, grown, rows, ids)
    buckets = Buckets((cluster.key, joins.SALT), grown.buckets)
    store.overwrite(claims, GOLD, gold.FACT_TABLE, replace(buckets, packed=True))
    store.overwrite(members, GOLD, D.MEMBERS.table, buckets)
    by_key[cluster.key] = joins.for_buckets(store.read(GOLD, D.MEMBERS.table), cluster, rows)
    return facts.wide_claims(store.read(GOLD, gold.FACT_TABLE), by_key, sizes=dim_sizes(spark, sf_dir), clustered=cluster.key)


def mart_after_correction(spark, sf_dir):
    """A second batch brings the claims of 1995 anew, with other amounts: its months are replaced, in the fact and in the mart."""
    store = scratch_store(spark)
    first = gold.with_month(fact(spark, sf_dir, "plan_id", "admission_date", *_AMOUNTS))
    again = first.filter(F.year("admission_date") == 1995).withColumn("line_charge", (F.col("line_charge") + 1).cast(C.MONEY_TYPE))
    for batch in (first, again):
        store.replace_partitions(batch, GOLD, gold.FACT_TABLE, [gold.MONTH])
        months = [p.split("=", 1)[1] for p in store.replaced[GOLD, gold.FACT_TABLE]]
        replaced = store.read(GOLD, gold.FACT_TABLE).filter(F.col(gold.MONTH).isin(months))
        mart = facts.mart_plan_month(replaced).withColumn(gold.MONTH, F.coalesce("year_month", F.lit(gold.NO_MONTH)))
        store.replace_partitions(mart, GOLD, gold.MART_TABLE, [gold.MONTH])
    return store.read(GOLD, gold.MART_TABLE).drop(gold.MONTH)


def mart_by_batches(spark, sf_dir):
    """A mart kept batch by batch. Claims have lines in both batches; the second batch first came with all lines, and
    comes again with its own and other amounts."""
    store = scratch_store(spark)
    lines = fact(spark, sf_dir, "plan_id", "admission_date", "discharge_date", *_AMOUNTS)
    early = F.col("discharge_date") < "1995-07-01"
    corrected = lines.filter(~early).withColumn("line_charge", (F.col("line_charge") + 1).cast(C.MONEY_TYPE))
    for name, batch in (("b1", lines.filter(early)), ("b2", lines), ("b2", corrected)):
        running_mart.add_batch(store, batch, name)
    return store.read(GOLD, running_mart.RUNNING_MART_TABLE).drop(running_mart.MONTH)


def calendar_bounds(spark, sf_dir):
    """Some claims are dated 9999: they are counted, and the calendar does not reach for them."""
    odd = F.when(F.col("service_line_number") == "7", F.lit("9999-12-31").cast("date")).otherwise(F.col("admission_date"))
    claims = clean(spark, sf_dir, "service_line_number", "admission_date").withColumn("admission_date", odd)
    outside = D.outside_calendar(claims).agg(F.count(F.lit(1))).scalar()
    days = D.dim_date(claims).agg(F.count(F.lit(1)).alias("days"), F.min("date_day").alias("first"), F.max("date_day").alias("last"))
    return days.withColumn("outside", outside)


def unpadded_dates(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(cast(o_orderdate as date), 'M/d/yyyy') as service_date")
    return standardize(raw)


def fact_by_line_id(spark, sf_dir):
    """The line id is the grain where claims have one, and health_plan_id comes before plan_id."""
    claims = clean(spark, sf_dir, "claim_id", "service_line_number", "plan_id").selectExpr(
        "*", "concat(claim_id, '/', service_line_number) as claim_line_id", "concat('H', plan_id) as health_plan_id")
    return facts.fact_claims(facts.apply_rules(claims)).select("claim_id", "claim_fact_key", "plan_key")


def impute_counts(spark, sf_dir):
    """All count columns, some missing or no numbers."""
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) as claim_id", "l_linenumber", "case when l_linenumber = 2 then null else cast(l_linenumber as string) end as units",
        "case when l_linenumber = 3 then 'three' else ' 12 ' end as quantity", "case when l_linenumber > 4 then '' else '30' end as days_supply")
    return facts.apply_rules(standardize(raw)).drop("is_rx_claim")


def kpi_provider(spark, sf_dir):
    dim = _dim(D.PROVIDERS)(spark, sf_dir)
    return kpi.provider_performance(fact(spark, sf_dir, "provider_id", "admission_date", *_AMOUNTS), dim)


def kpi_claim_type(spark, sf_dir):
    return kpi.by_claim_type(fact(spark, sf_dir, "claim_type", "admission_date", *_AMOUNTS))


def kpi_claim_status(spark, sf_dir):
    return kpi.by_status(facts.apply_rules(clean(spark, sf_dir, "claim_status", *_AMOUNTS)))


QUERIES: dict[str, Query] = {
    **{f.__name__: f for f in (
        scan_claims, latest_batch, claims_clean, claims_rejects, silver_lookup, impute_flags,
        stable_key)},
    **{spec.table: _dim(spec) for spec in D.DIMENSIONS},
    **{f.__name__: f for f in (
        dim_place_of_service_ranges, assign_plan, dim_date, fact_claims, dq_duplicate_grain,
        duplicate_claims, dedupe_claims, mart_plan_month, bi_fact_claims_enriched, pos_first_code,
        code_list, age_years, length_of_stay, allowed_amount, recent_events, reconcile_counts,
        run_columns, keyless_rejects, normalized_headers, validation_report, dq_issue_rows, widened_batches, widened_types,
        wide_by_buckets, mart_after_correction, mart_by_batches, calendar_bounds, log_review,
        unpadded_dates, fact_by_line_id, impute_counts, kpi_top_procedures, kpi_unmatched_codes,
        kpi_totals, kpi_utilization_trend, kpi_diagnosis_dist, kpi_procedure_dist, kpi_provider,
        kpi_claim_type, kpi_claim_status)},
}

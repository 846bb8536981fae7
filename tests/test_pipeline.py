"""Files to gold tables, and what happens when something is wrong."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimlake.config import BRONZE, GOLD, SILVER, LookupSpec, Namespace, PipelineConfig, RunContext
from claimlake.operators.joins import SALT, Clustering, JoinLimits, cluster_together, for_buckets, star_join
from claimlake.operators.standardize import may_be_rejected
from claimlake.plans import audit, bronze, gold, silver
from claimlake.plans.pipeline import run_pipeline
from claimlake.sources.files import malformed_records, read_lookup, read_marked_csv, read_text_csv
from claimlake.sources.store import Buckets, TableStore
from tests.oracle import connect, run_duckdb, run_spark
from workload.oracles import ORACLES
from workload.files import write_csv, write_input_files
from workload.source import raw_claims

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    write_input_files(spark, SF_DIR, str(root))
    return root


def config(files, **changes):
    tag = uuid.uuid4().hex[:8]
    return PipelineConfig(
        claims_path=str(files / "claims.csv"), reference_path=str(files),
        bronze=Namespace("bronze_layer", tag), silver=Namespace("silver_layer", tag),
        gold=Namespace("gold_layer", tag), **changes)


@pytest.fixture(scope="module")
def finished(spark, files):
    cfg = config(files)
    ids = run_pipeline(spark, cfg)
    return TableStore(spark, cfg), ids


def log_rows(store, layer):
    return {r["target"].split("`")[-2]: r for r in audit.recent_runs(store, layer).collect()}


def data(store, table):
    return run_spark(store.read(GOLD, table).drop("gold_run_id", "gold_processed_timestamp"))


@pytest.mark.parametrize("table", [
    "dim_providers", "dim_pharmacies", "dim_diagnosis_codes", "dim_procedures_codes",
    "dim_revenue_codes", "dim_place_of_service", "dim_plans", "dim_date", "fact_claims",
    "mart_plan_month", "bi_fact_claims_enriched",
])
def test_gold_tables_match_sql(finished, table):
    store, _ = finished
    assert data(store, table) == run_duckdb(connect(SF_DIR), ORACLES[table])


def test_members_carry_their_plan(finished):
    store, _ = finished
    got = run_spark(store.read(GOLD, "dim_members").select("member_id", "member_key", "plan_key"))
    assert got == run_duckdb(connect(SF_DIR), ORACLES["assign_plan"])


def test_counts_reconcile(finished):
    store, _ = finished
    claims = log_rows(store, SILVER)["claims_clean"]
    assert claims["rows_read"] == claims["rows_written"] + claims["rows_rejected"]
    assert claims["rows_read"] == log_rows(store, BRONZE)["claims_raw"]["rows_written"]
    assert claims["rows_rejected"] == store.read(SILVER, "claims_rejects").count() > 0
    fact = log_rows(store, GOLD)["fact_claims"]
    assert fact["rows_written"] == claims["rows_written"] == store.read(GOLD, "bi_fact_claims_enriched").count()
    assert all(r["status"] == "SUCCESS" for layer in (BRONZE, SILVER, GOLD)
               for r in log_rows(store, layer).values())


def test_every_written_count_is_the_tables_count(finished):
    store, _ = finished
    for layer in (BRONZE, SILVER, GOLD):
        for table, row in log_rows(store, layer).items():
            assert row["rows_written"] == store.read(layer, table).count(), table


def test_issues_are_recorded(finished):
    store, ids = finished
    issues = {r["issue_type"]: r for r in audit.recent_issues(store).collect()}
    assert set(issues) == {"DUPLICATE_GRAIN", "MISSING_REQUIRED_KEY"}
    duplicates = run_duckdb(connect(SF_DIR), ORACLES["dq_duplicate_grain"])[1]
    assert issues["DUPLICATE_GRAIN"]["record_count"] == len(duplicates)
    assert issues["DUPLICATE_GRAIN"]["gold_run_id"] == ids.gold


def test_validation_report(finished):
    store, ids = finished
    report = audit.validation_report(
        store, SILVER, [*silver.silver_tables(store), "nothing_here"], "silver_run_id", ids.silver)
    rows = {r["table"]: r for r in report.collect()}
    assert not rows["nothing_here"]["exists"] and rows["nothing_here"]["rows"] == 0
    assert rows["claims_clean"]["exists"]
    assert rows["claims_clean"]["rows"] == rows["claims_clean"]["rows_this_run"] > 0
    assert all(r["exists"] for r in audit.validation_report(store, GOLD, gold.gold_tables()).collect())
    assert all(r["exists"] for r in audit.validation_report(
        store, BRONZE, bronze.bronze_tables(store)).collect())


def test_second_run_is_chosen_and_gives_the_same_gold(spark, files):
    cfg = config(files)
    store = TableStore(spark, cfg)
    first = run_pipeline(spark, cfg)
    before = {t: data(store, t) for t in ("fact_claims", "dim_members", "mart_plan_month")}
    second = run_pipeline(spark, cfg)
    assert first.bronze != second.bronze
    chosen = store.read(SILVER, "claims_clean").select("bronze_run_id").distinct().collect()
    assert [r[0] for r in chosen] == [second.bronze]
    assert store.read(BRONZE, "claims_raw").select("run_id").distinct().count() == 2
    assert store.read(SILVER, "claims_rejects").select("silver_run_id").distinct().count() == 2
    assert {t: data(store, t) for t in before} == before
    bronze_members = store.read(BRONZE, "members_raw").count()
    assert store.read(SILVER, "members").count() * 2 == bronze_members
    explicit = replace(cfg, process_run_id=first.bronze)
    silver.run_silver(TableStore(spark, explicit))
    chosen = store.read(SILVER, "claims_clean").select("bronze_run_id").distinct().collect()
    assert [r[0] for r in chosen] == [first.bronze]


def test_append_modes_count_each_run_once(spark, files, finished):
    """The same silver batch twice: fact and mart hold both runs apart, the wide table the last one."""
    cfg = config(files, silver_mode="append", gold_mode="append")
    store = TableStore(spark, cfg)
    ids = run_pipeline(spark, cfg)
    once = store.read(GOLD, "fact_claims").count()
    again = gold.run_gold(store)
    assert store.read(GOLD, "fact_claims").count() == 2 * once
    sums = store.read(GOLD, "mart_plan_month").groupBy("gold_run_id").agg(
        F.sum("paid_amount"), F.sum("billed_amount"), F.sum("claims_cnt"), F.count(F.lit(1))).collect()
    assert {r[0] for r in sums} == {ids.gold, again} and len({tuple(r)[1:] for r in sums}) == 1
    assert data(store, "bi_fact_claims_enriched") == data(finished[0], "bi_fact_claims_enriched")
    assert all(r["status"] == "SUCCESS" for r in audit.recent_runs(store, GOLD).collect())
    silver.run_silver(store)
    assert store.read(SILVER, "claims_clean").select("silver_run_id").distinct().count() == 2


def test_large_dimensions_give_the_same_wide_table(spark, files, finished):
    cfg = config(files, limits=JoinLimits(broadcast_rows=10))
    run_pipeline(spark, cfg)
    table = "bi_fact_claims_enriched"
    assert data(TableStore(spark, cfg), table) == data(finished[0], table)


def test_batch_filter_prunes_partitions(finished):
    store, ids = finished
    batch = store.read(BRONZE, "claims_raw").filter(F.col("run_id") == ids.bronze)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(run_id" in plan and "PushedFilters: []" in plan


def test_a_batch_without_rejects(spark, files, tmp_path):
    complete = raw_claims(spark, SF_DIR).filter("trim(claim_id) <> '' and member_id is not null")
    write_csv(complete, str(tmp_path / "complete.csv"))
    cfg = replace(config(files), claims_path=str(tmp_path / "complete.csv"))
    store = TableStore(spark, cfg)
    store.create_namespaces()
    bronze.run_bronze(store)
    for _ in range(2):
        silver.run_silver(store)
        assert log_rows(store, SILVER)["claims_clean"]["rows_rejected"] == 0
        assert store.read(SILVER, "claims_rejects").isEmpty()
        assert "reject_reason" in store.read(SILVER, "claims_rejects").columns


def test_rejects_are_looked_for_in_suspicious_row_groups_only(finished):
    store, ids = finished
    raw = store.read(BRONZE, "claims_raw")
    plan = raw.filter(may_be_rejected(raw))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(Or(IsNull(claim_id),LessThan(claim_id,!)),Or(IsNull(member_id),LessThan(member_id,!)))]" in plan


def failed_rows(store, layer):
    return [r for r in audit.recent_runs(store, layer).collect() if r["status"] == "FAILED"]


def test_empty_source_is_logged_and_raised(spark, files, tmp_path):
    write_csv(raw_claims(spark, SF_DIR).limit(0), str(tmp_path / "empty.csv"))
    cfg = replace(config(files), claims_path=str(tmp_path / "empty.csv"))
    store = TableStore(spark, cfg)
    store.create_namespaces()
    with pytest.raises(Exception):
        bronze.run_bronze(store)
    assert len(failed_rows(store, BRONZE)) == 1


def test_missing_lookup_file_is_logged_and_raised(spark, files):
    cfg = config(files, lookups=(LookupSpec("gone_raw", "gone", "gone.csv"),))
    store = TableStore(spark, cfg)
    store.create_namespaces()
    with pytest.raises(Exception):
        bronze.run_bronze(store)
    (row,) = failed_rows(store, BRONZE)
    assert "gone.csv" in row["source"] and 0 < len(row["error_message"]) <= 4000


def test_no_valid_dates_stops_gold(spark, files, tmp_path):
    undated = raw_claims(spark, SF_DIR).withColumn("admission_date", F.lit("unknown"))
    write_csv(undated, str(tmp_path / "undated.csv"))
    cfg = replace(config(files), claims_path=str(tmp_path / "undated.csv"))
    with pytest.raises(ValueError, match="admission_date"):
        run_pipeline(spark, cfg)
    (row,) = failed_rows(TableStore(spark, cfg), GOLD)
    assert row["target"].endswith("`dim_date`")


def test_unknown_batch_is_refused(spark, files, finished):
    store, _ = finished
    cfg = replace(store.config, process_run_id="no-such-run")
    with pytest.raises(ValueError, match="no rows"):
        silver.run_silver(TableStore(spark, cfg))


def test_duplicates_can_stop_the_run(spark, files, finished):
    store, _ = finished
    cfg = replace(store.config, gold=Namespace("gold_layer", uuid.uuid4().hex[:8]), on_duplicate="fail")
    other = TableStore(spark, cfg)
    other.create_namespaces()
    with pytest.raises(ValueError, match="share the grain"):
        gold.run_gold(other)
    assert [r["issue_type"] for r in audit.recent_issues(other).collect()] == ["DUPLICATE_GRAIN"]


def test_duplicates_can_be_reduced_to_one_row(spark, files, finished):
    store, _ = finished
    cfg = replace(store.config, gold=Namespace("gold_layer", uuid.uuid4().hex[:8]), on_duplicate="dedupe")
    other = TableStore(spark, cfg)
    other.create_namespaces()
    gold.run_gold(other)
    fact = other.read(GOLD, "fact_claims")
    assert fact.count() == fact.select("claim_fact_key").distinct().count()
    assert fact.count() == store.read(GOLD, "fact_claims").select("claim_fact_key").distinct().count()
    assert other.read(GOLD, "bi_fact_claims_enriched").count() == fact.count()
    assert "ROW_COUNT" not in {r["issue_type"] for r in audit.recent_issues(other).collect()}


def test_columns_the_claims_lack_are_skipped(spark, files, tmp_path):
    narrow = raw_claims(spark, SF_DIR).drop("pharmacy_id", "claim_type", "units")
    write_csv(narrow, str(tmp_path / "narrow.csv"))
    cfg = replace(config(files), claims_path=str(tmp_path / "narrow.csv"))
    store = TableStore(spark, cfg)
    store.create_namespaces()
    bronze.run_bronze(store)
    silver.run_silver(store)
    with audit.RunLog(store, GOLD, RunContext()) as log:
        run = gold.GoldRun(store, log)
        run.dimension(gold.D.PHARMACIES)
        run.fact()
    assert not store.exists(GOLD, "dim_pharmacies")
    gold.run_gold(store)
    assert all(r["status"] == "SUCCESS" for r in audit.recent_runs(store, GOLD).collect())
    wide = store.read(GOLD, "bi_fact_claims_enriched")
    assert wide.filter("PHARMACY_NAME is not null or CLAIM_TYPE is not null").isEmpty() and len(wide.columns) == 44
    fact = store.read(GOLD, "fact_claims")
    assert wide.count() == fact.count()
    assert "pharmacy_key" not in fact.columns and "claim_type" not in fact.columns
    assert fact.filter(F.col("is_rx_claim").isNotNull()).isEmpty()


def test_claims_without_plans(spark, files, tmp_path):
    write_csv(raw_claims(spark, SF_DIR).drop("plan_id"), str(tmp_path / "planless.csv"))
    cfg = replace(config(files), claims_path=str(tmp_path / "planless.csv"))
    run_pipeline(spark, cfg)
    store = TableStore(spark, cfg)
    assert not store.exists(GOLD, "dim_plans") and not store.exists(GOLD, "mart_plan_month")
    assert "plan_key" not in store.read(GOLD, "dim_members").columns
    assert store.read(GOLD, "bi_fact_claims_enriched").filter("PLAN_KEY is not null").isEmpty()


def test_malformed_lines_are_kept_and_counted(spark, files, tmp_path):
    write_csv(raw_claims(spark, SF_DIR).limit(50), str(tmp_path / "claims.csv"))
    lines = (tmp_path / "claims.csv").read_text() if (tmp_path / "claims.csv").is_file() else ""
    if not lines:
        lines = "".join(p.read_text() for p in sorted((tmp_path / "claims.csv").glob("part-*")))
    header, rest = lines.split("\n", 1)
    (tmp_path / "broken.csv").write_text(f"{header}\n{rest}too,few\n{'x,' * 30}many\n")
    cfg = replace(config(files), claims_path=str(tmp_path / "broken.csv"))
    store = TableStore(spark, cfg)
    store.create_namespaces()
    run = bronze.run_bronze(store)
    assert store.read(BRONZE, "claims_raw").count() == 50
    broken = store.read(BRONZE, bronze.MALFORMED_TABLE)
    assert {r["record"] for r in broken.collect()} == {"too,few", "x," * 30 + "many"}
    row = log_rows(store, BRONZE)[cfg.landing_table]
    assert (row["rows_read"], row["rows_written"], row["rows_rejected"]) == (52, 50, 2)
    (issue,) = audit.recent_issues(store, layer=BRONZE).collect()
    assert (issue["issue_type"], issue["record_count"], issue["gold_run_id"]) == ("MALFORMED_RECORD", 2, run)


def test_claims_without_any_key_column_are_reported(spark, files, tmp_path):
    renamed = raw_claims(spark, SF_DIR).withColumnsRenamed({"claim_id": "claim", "member_id": "member"})
    write_csv(renamed, str(tmp_path / "renamed.csv"))
    cfg = replace(config(files), claims_path=str(tmp_path / "renamed.csv"))
    store = TableStore(spark, cfg)
    store.create_namespaces()
    bronze.run_bronze(store)
    silver.run_silver(store)
    assert [r["issue_type"] for r in audit.recent_issues(store, layer=SILVER).collect()] == ["NO_REQUIRED_KEY_COLUMN"]


def test_the_newest_batch_is_chosen_without_reading_claims(spark, store):
    """The claim table's files are gone; the batch table answers."""
    store.append(spark.sql("select 'r1' run_id, timestamp'2024-01-01 00:00:00' ingestion_timestamp"), BRONZE, "claims_raw", ["run_id"])
    for batch, day in (("r1", 1), ("r3", 3), ("r2", 3), ("r0", 2)):
        store.record_batch(BRONZE, "claims_raw", batch, datetime(2024, 1, day), day)
    store._delete(store._location(store.config.table(BRONZE, "claims_raw")))
    assert store.newest_batch(BRONZE, "claims_raw") == "r3"
    assert store.batch_rows(BRONZE, "claims_raw", "r0", "run_id") == 2
    assert store.newest_batch(BRONZE, "other") is None


def test_finished_steps_outlive_the_driver(spark, store):
    """A layer that is abandoned midway has logged what it had flushed."""
    log = audit.RunLog(store, BRONZE, RunContext("r"))
    with log.step("s", "`x`.`one`"):
        pass
    log.flush()
    with log.step("s", "`x`.`two`"):
        pass
    assert [r["target"] for r in audit.recent_runs(store, BRONZE).collect()] == ["`x`.`one`"]


def test_issues_are_written_even_if_the_log_is_not(spark, store, monkeypatch):
    log = audit.RunLog(store, GOLD, RunContext("r"))
    log.issue("KIND", "t", 1, "d")
    append = store.append

    def failing(df, layer, name, *rest):
        if name == audit.RUN_LOG_TABLE:
            raise OSError("no space")
        return append(df, layer, name, *rest)

    monkeypatch.setattr(store, "append", failing)
    with pytest.raises(OSError), log, log.step("s", "t"):
        pass
    assert audit.recent_issues(store).count() == 1


def test_queued_steps_do_not_start_after_a_failure(spark):
    from claimlake.plans.together import together

    ran = []

    def fail():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        together(spark, [fail, *(lambda k=k: (__import__("time").sleep(0.2), ran.append(k)) for k in range(20))], 1)
    assert len(ran) < 3


# --- store -------------------------------------------------------------------------------------

@pytest.fixture
def store(spark, files):
    s = TableStore(spark, config(files))
    s.create_namespaces()
    return s


def test_append_widens_the_table(spark, store):
    store.append(spark.sql("select 1 a, 'r1' run_id"), BRONZE, "t", ["run_id"])
    assert store.append(spark.sql("select 2 a, 'x' b, 'r2' run_id"), BRONZE, "t", ["run_id"]) == 1
    assert store.append(spark.sql("select 'r3' run_id, 3 a"), BRONZE, "t", ["run_id"]) == 1
    rows = store.read(BRONZE, "t").select("a", "b", "run_id").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, None, "r1"), (2, "x", "r2"), (3, None, "r3")]


def test_append_refuses_other_types(spark, store):
    store.append(spark.sql("select 1 a"), BRONZE, "t")
    with pytest.raises(Exception):
        store.append(spark.sql("select 'text' a"), BRONZE, "t")
    assert store.read(BRONZE, "t").count() == 1


def test_overwrite_replaces_rows_and_schema(spark, store):
    store.overwrite(spark.sql("select 1 a, 2 b"), GOLD, "t")
    assert store.overwrite(spark.range(3).selectExpr("cast(id as string) c"), GOLD, "t") == 3
    assert store.read(GOLD, "t").columns == ["c"]


def test_overwrite_may_read_its_target_and_survives_failure(spark, store):
    store.overwrite(spark.range(5), GOLD, "t")
    assert store.overwrite(store.read(GOLD, "t").filter("id > 1"), GOLD, "t") == 3
    with pytest.raises(Exception):
        store.overwrite(store.read(GOLD, "t").selectExpr("raise_error('no')"), GOLD, "t")
    assert store.read(GOLD, "t").count() == 3
    assert store.overwrite(spark.range(1), GOLD, "t") == 1


@pytest.mark.parametrize("columns", ["id", "cast(id as string) as name"])
@pytest.mark.parametrize("broken", ["_switch", "_drop_entry", "createTable", "_delete"])
def test_overwrite_leaves_the_old_or_the_new_table(spark, store, monkeypatch, columns, broken):
    """Whatever step breaks off, the next reader finds five old or three new rows, and a retry works."""
    store.overwrite(spark.range(5), GOLD, "t")

    def fail(*_, **__):
        raise RuntimeError("broken off")

    with monkeypatch.context() as patch:
        target = type(spark.catalog) if broken == "createTable" else TableStore
        patch.setattr(target, broken, fail)
        if broken == "_drop_entry" and columns == "id" or broken == "createTable" and columns == "id":
            store.overwrite(spark.range(3).selectExpr(columns), GOLD, "t")
        else:
            with pytest.raises(RuntimeError, match="broken off"):
                store.overwrite(spark.range(3).selectExpr(columns), GOLD, "t")
    assert store.read(GOLD, "t").count() in (3, 5)
    assert store.overwrite(spark.range(2), GOLD, "t") == 2
    assert store.read(GOLD, "t").count() == 2 and not store.exists(GOLD, "t__incoming")


def test_reset_needs_confirmation(spark, store):
    store.append(spark.range(1), GOLD, "t")
    with pytest.raises(ValueError):
        store.reset()
    assert store.exists(GOLD, "t")
    store.create_namespaces()
    store.reset(confirm=True)
    assert not store.exists(GOLD, "t")


def test_missing_table(store):
    with pytest.raises(ValueError, match="table not found"):
        store.read(GOLD, "nothing")


def test_modes_are_checked(files):
    with pytest.raises(ValueError, match="silver_mode"):
        config(files, silver_mode="upsert")
    assert config(files, gold_mode=" Append ").gold_mode == "append"


def test_run_context_is_injectable(spark, store):
    run = RunContext("run-1", lambda: datetime(2024, 1, 2, 3, 4, 5))
    with audit.RunLog(store, BRONZE, run) as log, log.step("s", "t") as counts:
        counts.written = 3
    (row,) = audit.recent_runs(store, BRONZE).collect()
    assert (row["run_id"], row["duration_seconds"], row["rows_written"]) == ("run-1", 0.0, 3)
    assert row["start_time"] == datetime(2024, 1, 2, 3, 4, 5)


# --- files -------------------------------------------------------------------------------------

def test_text_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n007,"say ""hi"", you"\n2,\n')
    rows = read_text_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in rows] == [("007", 'say "hi", you'), ("2", None)]


def test_text_csv_leaves_out_no_field_in_silence(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,2,3\n4\n5,"6, 7"\n')
    marked = read_marked_csv(spark, str(tmp_path / "a.csv"))
    assert [tuple(r) for r in read_text_csv(spark, str(tmp_path / "a.csv")).collect()] == [("5", "6, 7")]
    assert sorted(r["record"] for r in malformed_records(marked).collect()) == ["1,2,3", "4"]
    assert read_text_csv(spark, str(tmp_path / "a.csv"), ["a", "b"]).count() == 1


def test_text_csv_refuses_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n1,x\n")
    (tmp_path / "b.csv").write_text("note,id\nx,1\n")
    with pytest.raises(Exception):
        read_text_csv(spark, str(tmp_path)).collect()


def test_lookup_names_types_and_missing_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Code(s),N\n73-80,5\nN/A,6\n")
    df = read_lookup(spark, str(tmp_path / "a.csv"), LookupSpec("a", "a", "a.csv", ("code", "n"), {"n": "bigint"}))
    assert [tuple(r) for r in df.collect()] == [("73-80", 5), (None, 6)]
    normalized = read_lookup(spark, str(tmp_path / "a.csv"), LookupSpec("a", "a", "a.csv", normalize=True))
    assert normalized.columns == ["code_s", "n"]


def test_lookup_with_wrong_number_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\nfive\n")
    with pytest.raises(ValueError, match="a.csv: 1 values of n are not bigint"):
        read_lookup(spark, str(tmp_path / "a.csv"), LookupSpec("a", "a", "a.csv", types={"n": "bigint"}))
    (tmp_path / "b.csv").write_text("n,m\n5\n")
    with pytest.raises(ValueError, match="b.csv: 1 lines"):
        read_lookup(spark, str(tmp_path / "b.csv"), LookupSpec("b", "b", "b.csv"))


def test_lookup_names_must_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="expected 1 columns"):
        read_lookup(spark, str(tmp_path / "a.csv"), LookupSpec("a", "a", "a.csv", ("only",)))


def test_append_widens_types(spark, store):
    """Ints, floats and decimals get wider and narrower again; the files and partitions that were there stay."""
    rows = [
        "select cast(1 as int) a, cast(1.25 as decimal(6,2)) d, cast(0.5 as float) f, 'r1' run_id",
        "select 'r2' run_id, 5000000000 a, 0.1D f, 'new' b, cast(123456.1234 as decimal(10,4)) d",
        "select cast(3 as smallint) a, cast(7 as decimal(3,0)) d, cast(2.5 as float) f, 'r1' run_id",
    ]
    for row in rows:
        assert store.append(spark.sql(row), BRONZE, "t", ["run_id"]) == 1
    table = store.read(BRONZE, "t")
    assert dict(table.dtypes) == {"a": "bigint", "d": "decimal(10,4)", "f": "double", "b": "string", "run_id": "string"}
    got = [(r.a, str(r.d), r.f, r.b, r.run_id) for r in table.orderBy("a").collect()]
    assert got == [(1, "1.2500", 0.5, None, "r1"), (3, "7.0000", 2.5, None, "r1"), (5000000000, "123456.1234", 0.1, "new", "r2")]
    assert table.filter("run_id = 'r1'").count() == 2
    with pytest.raises(Exception):
        store.append(spark.sql("select 'text' a, 'r3' run_id"), BRONZE, "t", ["run_id"])
    assert store.read(BRONZE, "t").count() == 3


def test_widening_survives_a_driver(spark, store, monkeypatch):
    """The entry is dropped and not yet made anew: the next one that touches the table makes it, with its partitions."""
    store.append(spark.sql("select 1 a, 'r1' run_id"), BRONZE, "t", ["run_id"])
    copies, copy_entry = [], TableStore._copy_entry

    def copy(self, table, to, schema):
        copies.append(to)
        if len(copies) == 2:
            raise RuntimeError("lost")
        copy_entry(self, table, to, schema)

    monkeypatch.setattr(TableStore, "_copy_entry", copy)
    with pytest.raises(RuntimeError):
        store.append(spark.sql("select 5000000000 a, 'r2' run_id"), BRONZE, "t", ["run_id"])
    monkeypatch.undo()
    assert [tuple(r) for r in store.read(BRONZE, "t").collect()] == [(1, "r1")]
    store.append(spark.sql("select 5000000000 a, 'r2' run_id"), BRONZE, "t", ["run_id"])
    assert sorted(tuple(r) for r in store.read(BRONZE, "t").collect()) == [(1, "r1"), (5000000000, "r2")]


@pytest.mark.parametrize("buckets", [None, Buckets(("k",), 3)])
def test_partitions_are_replaced_alone(spark, store, buckets):
    first = spark.sql("select id, concat('m', id % 4) m, cast(id % 7 as string) k from range(40)")
    assert store.replace_partitions(first, GOLD, "t", ["m"], buckets) == 40
    table = store.config.table(GOLD, "t")
    before = store._folders(table, store._partitions(table))
    second = spark.sql("select concat('m', id + 3) m, 'x' k, id + 100 id from range(2)")
    assert store.replace_partitions(second, GOLD, "t", ["m"], buckets) == 2
    after = store._folders(table, store._partitions(table))
    assert {m for m in after if after[m] != before.get(m)} == {"m=m3", "m=m4"}
    got = store.read(GOLD, "t")
    assert sorted(r.id for r in got.collect()) == sorted([k for k in range(40) if k % 4 < 3] + [100, 101])
    assert sorted(r.id for r in got.filter("m = 'm3'").collect()) == [100]
    text = got.filter("m = 'm3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m#" in text and "m=m0" not in text
    with pytest.raises(ValueError):
        store.replace_partitions(second, GOLD, "t", ["k"])
    wider = second.withColumn("id", F.col("id").cast("decimal(30,2)"))
    with pytest.raises(TypeError):
        store.replace_partitions(wider, GOLD, "t", ["m"], buckets)


def month_rows(store, table):
    return {r[gold.MONTH]: r["n"] for r in store.read(GOLD, table).groupBy(gold.MONTH).agg(F.count("*").alias("n")).collect()}


def test_months_of_the_batch_are_replaced(spark, files, finished, tmp_path):
    """A second file with a few months: fact, mart and wide table keep the others, the calendar stays whole."""
    cfg = config(files, gold_mode="months")
    run_pipeline(spark, cfg)
    store = TableStore(spark, cfg)
    plain = lambda t: run_spark(store.read(GOLD, t).drop("gold_run_id", "gold_processed_timestamp", gold.MONTH))
    for table in ("fact_claims", "mart_plan_month", "bi_fact_claims_enriched", "dim_date"):
        assert plain(table) == data(finished[0], table)
    folders = {t: store._folders(store.config.table(GOLD, t), store._partitions(store.config.table(GOLD, t))) for t in ("fact_claims", "mart_plan_month")}
    raw = raw_claims(spark, SF_DIR).filter("admission_date like '1995-03%' or admission_date like '1995-04%'")
    write_csv(raw, str(tmp_path / "claims.csv"))
    again = replace(cfg, claims_path=str(tmp_path / "claims.csv"))
    run_pipeline(spark, again)
    for table, old in folders.items():
        new = store._folders(store.config.table(GOLD, table), store._partitions(store.config.table(GOLD, table)))
        assert {m for m in new if new[m] != old.get(m)} == {f"{gold.MONTH}=1995-03", f"{gold.MONTH}=1995-04"}
    assert plain("dim_date") == data(finished[0], "dim_date")
    fact, before = month_rows(store, "fact_claims"), month_rows(store, "bi_fact_claims_enriched")
    assert fact == before and 0 < fact["1995-03"] and set(fact) == set(p.split("=")[1] for p in folders["fact_claims"])
    text = store.read(GOLD, "fact_claims").filter(F.col(gold.MONTH) == "1995-03")._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({gold.MONTH}#" in text


def test_large_dimension_is_joined_in_buckets(spark, files, finished):
    """Members too many to be broadcast lie in the fact's buckets: the fact is not moved, hot members are spread."""
    cfg = config(files, cluster=Clustering("member_key", 8), limits=JoinLimits(broadcast_rows=100))
    run_pipeline(spark, cfg)
    store = TableStore(spark, cfg)
    assert data(store, "bi_fact_claims_enriched") == data(finished[0], "bi_fact_claims_enriched")
    small = config(files, cluster=Clustering("member_key", 8))
    run_pipeline(spark, small)
    assert SALT not in TableStore(spark, small).read(GOLD, "fact_claims").columns


def test_clustered_join_moves_no_fact(spark, store):
    fact = spark.sql("select sha2(if(id < 600, 'hot', cast(id as string)), 256) member_key, concat('c', id) claim_id, id from range(1000)")
    dim = spark.sql("select sha2(if(id = 0, 'hot', cast(id as string)), 256) member_key, id as attribute from range(900)")
    cluster = Clustering("member_key", 10)
    salted, wide = cluster_together(fact, dim, cluster, 1000)
    assert wide.count() == 905 and salted.select(SALT).distinct().count() == 6
    assert salted.groupBy("member_key", SALT).count().agg(F.max("count")).first()[0] < 200
    buckets = Buckets(("member_key", SALT), 10)
    store.overwrite(salted, GOLD, "fact", buckets)
    store.overwrite(wide, GOLD, "dim", buckets)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star_join(store.read(GOLD, "fact"), [("member_key", store.read(GOLD, "dim"))], clustered="member_key")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert text.count("Bucketed: true") == 2
        got = joined.select("id", "attribute").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.id, r.attribute) for r in got if r.attribute is not None) == [(k, 0 if k < 600 else k) for k in range(900)]
    assert len(got) == 1000
    # Written again with other buckets, the entry has them.
    store.overwrite(salted, GOLD, "fact", Buckets(("member_key",), 4))
    assert store._buckets(store.config.table(GOLD, "fact")) == Buckets(("member_key",), 4)
    store.overwrite(salted, GOLD, "fact")
    assert store._buckets(store.config.table(GOLD, "fact")) is None and store.read(GOLD, "fact").count() == 1000


def test_a_bucket_is_sorted_by_several_tasks(spark, store):
    """Buckets with more rows than a task may sort have several files; the join still moves no fact, and sorts none."""
    fact = spark.sql("select cast(id % 200 as string) member_key, id from range(1000)")
    dim = spark.sql("select cast(id as string) member_key, id as attribute from range(150)")
    cluster = Clustering("member_key", 2, rows_per_task=200)
    assert cluster.tasks(1000) == 3 and cluster.tasks(400) == 1 and cluster.tasks(0) == 1
    salted, wide = cluster_together(fact, dim, cluster, 1000)
    buckets = Buckets(("member_key", SALT), 2)
    store.overwrite(salted, GOLD, "fact", replace(buckets, tasks=3))
    store.overwrite(wide, GOLD, "dim", buckets)
    files = store.read(GOLD, "fact").inputFiles()
    assert len(files) == 6 and store._buckets(store.config.table(GOLD, "fact")) == buckets
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star_join(store.read(GOLD, "fact"), [("member_key", for_buckets(store.read(GOLD, "dim"), cluster, 1000))], clustered="member_key")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in text and "Exchange" not in text and "Sort " not in text
        got = joined.select("id", "attribute").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.id, r.attribute) for r in got if r.attribute is not None) == [(k, k % 200) for k in range(1000) if k % 200 < 150]
    assert len(got) == 1000


def test_replaced_partitions_are_known(spark, store):
    """What has been replaced is known from the write, also for a new table, and a first write that breaks off leaves no rows."""
    first = spark.sql("select id, concat('m', id % 4) m from range(40)")

    def lost(written):
        assert written.count() == 40
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.replace_partitions(first, GOLD, "t", ["m"], before_switch=lost)
    assert not store.exists(GOLD, "t")
    assert store.replace_partitions(first, GOLD, "t", ["m"]) == 40
    assert sorted(store.replaced[GOLD, "t"]) == ["m=m0", "m=m1", "m=m2", "m=m3"]
    assert store.replace_partitions(first.filter("m = 'm2'"), GOLD, "t", ["m"]) == 10
    assert store.replaced[GOLD, "t"] == ["m=m2"] and store.read(GOLD, "t").count() == 40


def test_dates_outside_the_calendar_are_an_issue(spark, files, tmp_path):
    claims = raw_claims(spark, SF_DIR).withColumn(
        "admission_date", F.when(F.col("service_line_number") == "7", F.lit("9999-12-31")).otherwise(F.col("admission_date")))
    write_csv(claims, str(tmp_path / "claims.csv"))
    cfg = replace(config(files), claims_path=str(tmp_path / "claims.csv"))
    run_pipeline(spark, cfg)
    store = TableStore(spark, cfg)
    issues = {r["issue_type"]: r["record_count"] for r in audit.recent_issues(store).collect()}
    assert issues["DATE_OUT_OF_RANGE"] == store.read(SILVER, "claims_clean").filter("admission_date > '2199-12-31'").count() > 0
    assert store.read(GOLD, "dim_date").count() < 5000


def test_lookup_batches_are_chosen_without_reading_lookups(spark, files, finished, monkeypatch):
    """A second raw run is chosen for every lookup, and none is searched for its newest batch."""
    store, ids = finished
    for spec in store.config.lookups:
        assert store.newest_batch(BRONZE, spec.table) == ids.bronze

    def searched(*_):
        raise AssertionError("a table was searched for its newest batch")

    monkeypatch.setattr("claimlake.operators.frames.latest_batch", searched)
    cfg = config(files)
    run_pipeline(spark, cfg)
    assert data(TableStore(spark, cfg), "dim_plans") == data(store, "dim_plans")

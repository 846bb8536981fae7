"""Clean layer: one raw batch, trimmed, typed and split into clean rows and rejects."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.config import BRONZE, SILVER, LookupSpec, RunContext
from claimlake.functions.naming import existing
from claimlake.operators.frames import choose_batch, in_batch, require_rows
from claimlake.operators.standardize import (
    REQUIRED_KEYS,
    TRIM_ONLY,
    may_be_rejected,
    split_rejects,
    standardize,
)
from claimlake.plans import bronze
from claimlake.plans.audit import RunLog, ensure_audit_tables
from claimlake.plans.together import together
from claimlake.sources.store import RowCounter, TableStore

CLAIMS_TABLE = "claims_clean"
REJECTS_TABLE = "claims_rejects"


def stamp(df: DataFrame, run_id: str, bronze_run_id: str) -> DataFrame:
    return df.withColumns({
        "silver_run_id": F.lit(run_id),
        "bronze_run_id": F.lit(bronze_run_id),
        "silver_processed_timestamp": F.current_timestamp(),
    })


def clean_claims(store: TableStore, log: RunLog, bronze_run_id: str) -> None:
    """Write the batch's clean rows, then its rejects.

    Rows read and written are counted by the first write. Their difference says how many rejects
    there are; only if there are any is the batch scanned again for them, and then only those row
    groups that may hold some.
    """
    cfg, run_id = store.config, log.run.run_id
    source = cfg.table(BRONZE, bronze.CLAIMS_TABLE)
    with log.step(f"{source} (run_id={bronze_run_id})", cfg.table(SILVER, CLAIMS_TABLE)) as counts:
        batch = in_batch(store.read(BRONZE, bronze.CLAIMS_TABLE), "run_id", bronze_run_id)
        require_rows(batch, f"run_id={bronze_run_id} in {source}")
        if not existing(batch, REQUIRED_KEYS):
            log.issue("NO_REQUIRED_KEY_COLUMN", source, 0, f"none of {', '.join(REQUIRED_KEYS)}: no row can be rejected")
        seen = RowCounter()
        clean, _ = split_rejects(standardize(seen.watch(batch)))
        clean = stamp(clean, run_id, bronze_run_id)
        counts.written = store.write(clean, SILVER, CLAIMS_TABLE, cfg.silver_mode, ["silver_run_id"])
        counts.read = seen.rows
        counts.rejected = counts.read - counts.written
        _, rejects = split_rejects(standardize(batch.filter(may_be_rejected(batch))))
        rejects = stamp(rejects, run_id, bronze_run_id)
        if not counts.rejected:
            rejects = rejects.limit(0)
        kept = store.append(rejects, SILVER, REJECTS_TABLE, ["silver_run_id"])
        if kept != counts.rejected:
            raise RuntimeError(f"{counts.rejected} rows were rejected, {kept} written to rejects")
        store.record_batch(SILVER, CLAIMS_TABLE, run_id, log.run.now(), counts.written)


def clean_lookup(store: TableStore, log: RunLog, spec: LookupSpec, bronze_run_id: str) -> None:
    """The lookup's latest batch, trimmed. Older batches would only repeat its rows. Its id comes from the table of
    batches; only a lookup without an entry there is searched for it."""
    cfg = store.config
    source = cfg.table(BRONZE, spec.table)
    with log.step(source, cfg.table(SILVER, spec.silver_table)) as counts:
        raw = store.read(BRONZE, spec.table)
        wanted = store.newest_batch(BRONZE, spec.table) or "latest"
        latest = in_batch(raw, "run_id", choose_batch(raw, "run_id", "ingestion_timestamp", wanted))
        trimmed = stamp(standardize(latest, TRIM_ONLY), log.run.run_id, bronze_run_id)
        counts.written = store.overwrite(trimmed, SILVER, spec.silver_table)
        counts.read = counts.written


def run_silver(store: TableStore, run: RunContext | None = None) -> str:
    """Clean the chosen raw batch and the lookups; the id of this silver run."""
    run = run or RunContext()
    cfg = store.config
    ensure_audit_tables(store, SILVER)
    with RunLog(store, SILVER, run) as log:
        raw = store.read(BRONZE, bronze.CLAIMS_TABLE)
        wanted = cfg.process_run_id
        if wanted.strip().lower() == "latest":
            wanted = store.newest_batch(BRONZE, bronze.CLAIMS_TABLE) or wanted
        bronze_run_id = choose_batch(raw, "run_id", "ingestion_timestamp", wanted)
        clean_claims(store, log, bronze_run_id)
        log.flush()
        lookups = [partial(clean_lookup, store, log, spec, bronze_run_id) for spec in cfg.lookups]
        together(store.spark, lookups, cfg.steps_at_once)
    return run.run_id


def silver_tables(store: TableStore) -> list[str]:
    return [CLAIMS_TABLE, REJECTS_TABLE, *(s.silver_table for s in store.config.lookups)]

"""Raw layer: files as they are, stamped with run id, time and origin."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from claimlake.config import BRONZE, LookupSpec, RunContext
from claimlake.operators.frames import require_rows
from claimlake.plans.audit import RunLog, ensure_audit_tables
from claimlake.plans.together import together
from claimlake.sources.files import MALFORMED, malformed_records, read_lookup, read_marked_csv
from claimlake.sources.store import TableStore

CLAIMS_TABLE = "claims_raw"
MALFORMED_TABLE = "claims_malformed"


def stamp(df: DataFrame, run_id: str, origin_column: str, origin: str) -> DataFrame:
    return df.withColumns({
        "run_id": F.lit(run_id),
        "ingestion_timestamp": F.current_timestamp(),
        origin_column: F.lit(origin),
    })


def land_claims(store: TableStore, log: RunLog) -> None:
    """The claims file as a table, replacing what was landed before.

    Lines with more or fewer fields than the header are kept whole in a table of their own and counted
    as rejected; the file is scanned a second time only if there are any.
    """
    cfg = store.config
    with log.step(cfg.claims_path, cfg.table(BRONZE, cfg.landing_table)) as counts:
        seen = Observation()
        marked = read_marked_csv(store.spark, cfg.claims_path)
        watched = marked.observe(seen, F.count(MALFORMED).alias("broken"))
        raw = watched.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
        counts.written = store.overwrite(raw, BRONZE, cfg.landing_table)
        counts.rejected = seen.get.get("broken", 0)
        counts.read = counts.written + counts.rejected
        if counts.rejected:
            broken = stamp(malformed_records(marked), log.run.run_id, "source_file", cfg.claims_path)
            store.append(broken, BRONZE, MALFORMED_TABLE, ["run_id"])
            log.issue("MALFORMED_RECORD", cfg.table(BRONZE, MALFORMED_TABLE), counts.rejected,
                      "lines with more or fewer fields than the header")


def ingest_claims(store: TableStore, log: RunLog) -> None:
    """Add the landed claims as a new batch."""
    cfg = store.config
    source = cfg.table(BRONZE, cfg.landing_table)
    with log.step(source, cfg.table(BRONZE, CLAIMS_TABLE)) as counts:
        landed = store.read(BRONZE, cfg.landing_table)
        require_rows(landed, source)
        batch = stamp(landed, log.run.run_id, "source_table", source.replace("`", ""))
        counts.written = store.write(batch, BRONZE, CLAIMS_TABLE, cfg.bronze_mode, ["run_id"])
        counts.read = counts.written
        store.record_batch(BRONZE, CLAIMS_TABLE, log.run.run_id, log.run.now(), counts.written)


def ingest_lookup(store: TableStore, log: RunLog, spec: LookupSpec, noted: list[tuple[str, int]]) -> None:
    cfg = store.config
    path = cfg.lookup_file(spec)
    with log.step(path, cfg.table(BRONZE, spec.table)) as counts:
        batch = stamp(read_lookup(store.spark, path, spec), log.run.run_id, "source_file", spec.file)
        counts.written = store.write(batch, BRONZE, spec.table, cfg.bronze_mode, ["run_id"])
        counts.read = counts.written
        noted.append((spec.table, counts.written))


def run_bronze(store: TableStore, run: RunContext | None = None) -> str:
    """Land and ingest everything; the id of the new batch."""
    run = run or RunContext()
    ensure_audit_tables(store, BRONZE)
    with RunLog(store, BRONZE, run) as log:
        land_claims(store, log)
        log.flush()
        ingest_claims(store, log)
        log.flush()
        noted: list[tuple[str, int]] = []
        lookups = [partial(ingest_lookup, store, log, spec, noted) for spec in store.config.lookups]
        together(store.spark, lookups, store.config.steps_at_once)
        store.record_batches(BRONZE, run.run_id, run.now(), noted)  # in one append, as the lookups run side by side
    return run.run_id


def bronze_tables(store: TableStore) -> list[str]:
    return [CLAIMS_TABLE, *(s.table for s in store.config.lookups)]

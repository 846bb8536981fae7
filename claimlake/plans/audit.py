"""Run log, data-quality issues and reports."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake import schemas
from claimlake.config import GOLD, RunContext
from claimlake.operators.frames import newest
from claimlake.sources.store import BATCH_TABLE, TableStore

RUN_LOG_TABLE = "pipeline_run_log"
DQ_TABLE = "dq_issues"
MAX_ERROR_CHARS = 4000


@dataclass
class Counts:
    """What a step reports about its rows."""

    read: int = 0
    written: int = 0
    rejected: int = 0


class RunLog:
    """One row per step. :meth:`flush` appends what has collected: after each large step and each group of
    small ones, and when the layer ends, well or badly. So a driver that dies loses the steps under way only."""

    def __init__(self, store: TableStore, layer: str, run: RunContext, pipeline: str = "claims") -> None:
        self.store = store
        self.layer = layer
        self.run = run
        self.pipeline = pipeline
        self._steps: list[tuple] = []
        self._issues: list[tuple] = []

    def __enter__(self) -> RunLog:
        return self

    def __exit__(self, *_: object) -> None:
        self.flush()

    def flush(self) -> None:
        """Append the collected rows; the issues also if the steps could not be."""
        try:
            self._append(self._steps, schemas.RUN_LOG, RUN_LOG_TABLE)
        finally:
            self._append(self._issues, schemas.DQ_ISSUES, DQ_TABLE)

    def _append(self, rows: list[tuple], schema: str, table: str) -> None:
        if rows:
            frame = self.store.spark.createDataFrame(list(rows), schema).coalesce(1)
            self.store.append(frame, self.layer, table)
            rows.clear()

    @contextmanager
    def step(self, source: str, target: str) -> Iterator[Counts]:
        """Log the enclosed work as SUCCESS, or as FAILED with its error, which is raised again."""
        started = self.run.now()
        counts = Counts()
        status, error = "SUCCESS", None
        try:
            yield counts
        except Exception as e:
            status, error = "FAILED", str(e)[:MAX_ERROR_CHARS]
            raise
        finally:
            ended = self.run.now()
            self._steps.append((
                self.run.run_id, self.pipeline, self.layer, source, target, status, started, ended,
                (ended - started).total_seconds(), counts.read, counts.written, counts.rejected, error,
            ))

    def issue(self, kind: str, table: str, records: int, details: str) -> None:
        self._issues.append((self.run.run_id, self.run.now(), kind, table, records, details))


def ensure_audit_tables(store: TableStore, layer: str) -> None:
    """Create the audit tables if absent, so that reports work before the first entry."""
    wanted = {RUN_LOG_TABLE: schemas.RUN_LOG, DQ_TABLE: schemas.DQ_ISSUES, BATCH_TABLE: schemas.BATCHES}
    for name, schema in wanted.items():
        store.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {store.config.table(layer, name)} ({schema})"
            f" USING {store.config.table_format}"
        )


def validation_report(
    store: TableStore, layer: str, tables: Iterable[str], run_column: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """One row per table: does it exist, how many rows has it, how many of them from ``run_id``."""
    return reduce(DataFrame.unionByName, [
        report_line(t, store.read(layer, t) if store.exists(layer, t) else None, run_column, run_id) for t in tables
    ])


def report_line(name: str, rows: DataFrame | None, run_column: str | None = None, run_id: str | None = None) -> DataFrame:
    """One line of :func:`validation_report`; ``rows`` is None for a table that does not exist."""
    found = rows is not None
    if rows is None:
        rows = SparkSession.active().range(0)
    this_run = F.lit(None).cast("bigint")
    if run_column in rows.columns:
        this_run = F.count_if(F.col(run_column) == F.lit(run_id))
    return rows.agg(F.count(F.lit(1)).alias("rows"), this_run.alias("rows_this_run")).select(
        F.lit(name).alias("table"), F.lit(found).alias("exists"), "rows", "rows_this_run")


def recent_runs(store: TableStore, layer: str, limit: int = 50) -> DataFrame:
    log = store.read(layer, RUN_LOG_TABLE).filter(F.col("layer") == layer)
    return newest(log, "end_time", limit, tie=["run_id", "target"])


def recent_issues(store: TableStore, limit: int = 50, layer: str = GOLD) -> DataFrame:
    return newest(store.read(layer, DQ_TABLE), "issue_timestamp", limit, tie=["gold_run_id", "issue_type", "table_name"])

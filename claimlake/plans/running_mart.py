"""The mart over all batches, brought up to date batch by batch.

A batch leaves its claim totals (:func:`claimlake.operators.facts.claim_totals`) in a table partitioned by batch and sorted
by month. Only the months that the batch holds, or held when it was added before, are then summed anew, from
the totals; facts of older batches are not read, nor are totals of other months. A batch that comes again replaces what
it brought before.

A run that breaks off leaves the months it owes in a small table; the next one sums those too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.config import GOLD
from claimlake.operators import facts
from claimlake.sources.store import TableStore

TOTALS_TABLE = "mart_claim_totals"
RUNNING_MART_TABLE = "mart_plan_month_running"
DUE_TABLE = "mart_months_due"
BATCH = "batch_id"
#: Partition column where months are replaced; claims without an admission date are in a partition of their own.
MONTH, NO_MONTH = "claim_month", "undated"


def month_of(column: Column) -> Column:
    return F.coalesce(column, F.lit(NO_MONTH))


def add_batch(store: TableStore, fact: DataFrame, batch: str) -> int:
    """Add or replace the facts of a batch; the number of mart rows written. The months are the driver's, a few per batch."""
    due = _months(store.read(GOLD, DUE_TABLE)) if store.exists(GOLD, DUE_TABLE) else set()
    known = store.exists(GOLD, TOTALS_TABLE)
    if known:
        due |= _months(store.read(GOLD, TOTALS_TABLE).filter(F.col(BATCH) == batch))

    def note(written: DataFrame) -> None:
        """The batch's months, taken from its totals, so that its facts are computed once."""
        due.update(_months(written))
        _note_due(store, due)

    totals = facts.claim_totals(fact).withColumns({MONTH: month_of(F.col("year_month")), BATCH: F.lit(batch)})
    written = store.replace_partitions(totals, GOLD, TOTALS_TABLE, [BATCH], sort_by=[MONTH], before_switch=note)
    if known and not written:
        store.drop_partitions(GOLD, TOTALS_TABLE, [f"{BATCH}={batch}"])
    rows = _sum_months(store, due)
    _note_due(store, ())
    return rows


def totals_of(store: TableStore, months: Iterable[str]) -> DataFrame:
    """Claim totals of some months, of all batches."""
    return store.read(GOLD, TOTALS_TABLE).filter(F.col(MONTH).isin(sorted(months)))


def _sum_months(store: TableStore, months: set[str]) -> int:
    totals = totals_of(store, months)
    mart = facts.mart_from_totals(totals).withColumn(MONTH, month_of(F.col("year_month")))
    rows = store.replace_partitions(mart, GOLD, RUNNING_MART_TABLE, [MONTH])
    gone = months - _months(totals)
    if gone:
        store.drop_partitions(GOLD, RUNNING_MART_TABLE, [f"{MONTH}={m}" for m in gone])
    return rows


def _months(rows: DataFrame) -> set[str]:
    return {r[0] for r in rows.select(MONTH).distinct().collect()}


def _note_due(store: TableStore, months: Iterable[str]) -> None:
    noted = store.spark.createDataFrame([(m,) for m in sorted(months)], f"{MONTH} string").coalesce(1)
    store.overwrite(noted, GOLD, DUE_TABLE)

"""Column subsets, dedupe, duplicate search, batch choice and guards."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions.naming import col, existing, find_column


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Those of ``names`` that the frame has, in the given order, under the given spelling."""
    return df.select(*(col(n).alias(n) for n in existing(df, names)))


def dedupe_by_key(df: DataFrame, keys: Iterable[str], order_by: Iterable[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order_by``, ties broken by all other columns.

    A total order makes the choice repeatable. As a min() over a struct it is combined before the
    shuffle, so a key that holds a third of the rows sends one row per input partition.
    Null keys form one group.
    """
    keys = [find_column(df, k) or k for k in keys]
    lead = [find_column(df, c) or c for c in order_by]
    taken = {c.lower() for c in (*keys, *lead)}
    ranked = [c for c in lead if c not in keys] + [c for c in df.columns if c.lower() not in taken]
    if not ranked:
        return df.distinct()
    smallest = F.min(F.struct(*(col(c) for c in ranked)))
    grouped = df.groupBy(*(col(k) for k in keys)).agg(smallest.alias("__row"))
    return grouped.select(*(
        col(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns
    ))


def dedupe_lookup(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """:func:`dedupe_by_key` for lookups, in which whole rows repeat: equal rows are hashed together
    first, so that only the distinct ones are sorted for their smallest."""
    return dedupe_by_key(df.distinct(), keys)


def duplicate_groups(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Counts are combined before the shuffle."""
    return (
        df.groupBy(*(col(k) for k in keys))
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") > 1)
    )


def newest(
    df: DataFrame, time_col: str, limit: int = 50, tie: Iterable[str] = (), descending_tie: bool = False
) -> DataFrame:
    """The ``limit`` newest rows; runs as a top-k per partition, not as a full sort."""
    ties = (col(t).desc() if descending_tie else col(t) for t in tie)
    return df.orderBy(col(time_col).desc(), *ties).limit(limit)


def latest_batch(df: DataFrame, batch_col: str, time_col: str) -> DataFrame:
    """One row: the batch holding the greatest timestamp; equal timestamps go to the greater id.

    Grouping by batch first keeps the scan in a hash aggregate on one timestamp per batch; only
    that handful of rows is ranked.
    """
    require_columns(df, (batch_col, time_col))
    return (
        df.groupBy(col(batch_col).alias(batch_col))
        .agg(F.max(col(time_col)).alias(time_col))
        .filter(col(time_col).isNotNull())
        .orderBy(col(time_col).desc(), col(batch_col).desc())
        .limit(1)
    )


def choose_batch(df: DataFrame, batch_col: str, time_col: str, wanted: str = "latest") -> str:
    """The batch id to process: ``wanted`` as given, or the newest one for ``'latest'``."""
    require_columns(df, (batch_col, time_col))
    wanted = wanted.strip()
    if wanted.lower() != "latest":
        return wanted
    row = latest_batch(df, batch_col, time_col).first()
    if row is None:
        raise ValueError(f"no batch to choose from: no rows with {batch_col} and {time_col}")
    return row[batch_col]


def in_batch(df: DataFrame, batch_col: str, batch: str) -> DataFrame:
    return df.filter(col(batch_col) == F.lit(batch))


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if find_column(df, n) is None]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def require_rows(df: DataFrame, what: str) -> None:
    """Raise if there is no row. Stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"no rows found: {what}")


def require_table(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table not found: {name}")

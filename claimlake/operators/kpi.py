"""Figures over the fact table. All are exact: decimals are summed as decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.columns import year_month
from claimlake.functions.naming import col, find_column


def _figures() -> list[Column]:
    return [
        F.count_distinct("claim_id").alias("encounters"),
        F.count(F.lit(1)).alias("claim_lines"),
        F.sum("line_charge").alias("total_charge"),
        F.sum("line_allowed").alias("total_allowed"),
    ]


def totals(fact: DataFrame) -> DataFrame:
    """Encounters, lines, cost and allowed amount over everything."""
    return fact.agg(*_figures())


def utilization_trend(fact: DataFrame) -> DataFrame:
    """The same per month of admission."""
    return fact.groupBy(year_month("admission_date").alias("year_month")).agg(*_figures())


def by_claim_type(fact: DataFrame) -> DataFrame:
    """The same per service type."""
    return fact.groupBy("claim_type").agg(*_figures())


def by_status(claims: DataFrame, status_col: str = "claim_status") -> DataFrame | None:
    """The same per claim status; None where the claims carry no status."""
    if find_column(claims, status_col) is None:
        return None
    return claims.groupBy(col(status_col).alias("claim_status")).agg(*_figures())


def code_distribution(
    fact: DataFrame, dim: DataFrame, key: str, code_col: str, top: int | None = None
) -> DataFrame:
    """Lines per code and their share of all lines; ``top`` gives the most frequent ones only.

    Lines are counted per key first, so one row per code meets the dimension. The total is a
    scalar subquery over those counts, not a window that pulls all codes into one task. Lines
    whose code the dimension lacks are counted together, under a null code.
    """
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("claim_lines"))
    total = counts.agg(F.sum("claim_lines")).scalar()
    share = F.round(F.col("claim_lines").cast("double") / total, 6)
    named = counts.join(dim.select(key, col(code_col).alias("code")), key, "left")
    per_code = named.groupBy("code").agg(F.sum("claim_lines").alias("claim_lines"))
    result = per_code.withColumn("share", share)
    if top is None:
        return result
    return result.orderBy(F.col("claim_lines").desc(), "code").limit(top)


def provider_performance(fact: DataFrame, providers: DataFrame) -> DataFrame:
    """Figures per provider and the allowed part of the charge."""
    figures = fact.groupBy("provider_key").agg(*_figures())
    ratio = F.col("total_allowed").cast("double") / F.nullif("total_charge", F.lit(0)).cast("double")
    names = providers.select("provider_key", "provider_id", "provider_specialty")
    return figures.join(names, "provider_key", "left").select(
        "provider_key", "provider_id", "provider_specialty", "encounters", "claim_lines", "total_charge",
        "total_allowed", F.round(ratio, 6).alias("allowed_ratio"),
    )

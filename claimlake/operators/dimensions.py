"""Dimensions: what they hold, and how each is built from its lookup table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlake.functions.columns import (
    calendar_columns,
    code_text,
    first_integer,
    stable_key,
)
from claimlake.functions.naming import col, find_column, rename_existing
from claimlake.operators.frames import dedupe_lookup, require_rows, select_existing


@dataclass(frozen=True)
class DimSpec:
    """One dimension: ``columns`` of ``source`` with one row per ``id`` and a surrogate ``key``."""

    table: str
    source: str
    id: str
    key: str
    columns: tuple[str, ...]
    rename: Mapping[str, str] = field(default_factory=dict)
    upper_id: bool = False


# Names and columns of the dimensions.
MEMBERS = DimSpec(
    "dim_members", "members", "member_id", "member_key",
    ("member_id", "member_name", "member_dob", "member_gender", "member_age"),
)
PROVIDERS = DimSpec(
    "dim_providers", "providers", "provider_id", "provider_key",
    ("provider_id", "npi", "provider_specialty", "provider_state"),
)
PHARMACIES = DimSpec(
    "dim_pharmacies", "pharmacies", "pharmacy_id", "pharmacy_key",
    ("pharmacy_id", "pharmacy_name", "pharmacy_state"),
)
DIAGNOSIS_CODES = DimSpec(
    "dim_diagnosis_codes", "ref_icd10_diagnosis", "diagnosis_code", "diagnosis_code_key",
    ("DIAGNOSIS_CODE", "SHORT_DESCRIPTION", "LONG_DESCRIPTION"), upper_id=True,
)
PROCEDURE_CODES = DimSpec(
    "dim_procedures_codes", "ref_hcpcs", "procedure_code", "procedure_code_key",
    ("procedure_code", "long_description", "short_description"),
    rename={"hcpc": "procedure_code"}, upper_id=True,
)
REVENUE_CODES = DimSpec(
    "dim_revenue_codes", "ref_revenue_codes", "revenue_code", "revenue_code_key",
    ("revenue_code", "DESCRIPTION"), rename={"CODE": "revenue_code"},
)
PLACES_OF_SERVICE = DimSpec(
    "dim_place_of_service", "ref_place_of_service", "place_of_service_code", "place_of_service_key",
    ("Place_of_Service_Code", "Place_of_Service_Name", "Place_of_Service_Description"),
)
PLANS = DimSpec(
    "dim_plans", "health_plans", "plan_id", "plan_key",
    ("plan_id", "plan_name", "plan_state", "payer_type"),
)
DIMENSIONS = (
    MEMBERS, PROVIDERS, PHARMACIES, DIAGNOSIS_CODES, PROCEDURE_CODES, REVENUE_CODES,
    PLACES_OF_SERVICE, PLANS,
)


def build_dim(source: DataFrame, spec: DimSpec) -> DataFrame:
    """Rename, pick columns, keep one row per id, add the surrogate key.

    Claims carry their codes in upper case, so diagnosis and procedure codes are raised too; else
    they would not meet. Revenue and place codes keep their spelling, on which published keys rest.
    """
    dim = select_existing(rename_existing(source, spec.rename), spec.columns)
    id_col = find_column(dim, spec.id)
    if id_col is None:
        raise ValueError(f"{spec.table}: no column {spec.id} among {source.columns}")
    if spec.upper_id:
        dim = dim.withColumn(id_col, F.upper(col(id_col)))
    return dedupe_lookup(dim, [id_col]).withColumn(spec.key, stable_key(id_col))


def expand_code_ranges(places: DataFrame, code_col: str, max_codes: int = 100_000) -> DataFrame:
    """One row per code for ranges such as ``28-30`` or ``28 - 30``; other codes stay as they are.

    Codes keep the width of a first code with leading zeros: ``01-03`` is 01, 02, 03. A range of more
    than ``max_codes`` codes, or with numbers of more than 18 digits, is an error, not a partial list.
    """
    code, pattern = col(code_col), r"^\s*([0-9]+)\s*-\s*([0-9]+)\s*$"
    low, high = (F.regexp_extract(code, pattern, i) for i in (1, 2))
    first, last = low.try_cast("bigint"), high.try_cast("bigint")
    is_range = F.ifnull(code.rlike(pattern), F.lit(False))
    too_long = F.greatest(F.length(low), F.length(high)) > 18
    refused = F.raise_error(F.concat(F.lit(f"range of more than {max_codes} codes: "), code)).cast("array<string>")
    padded = F.transform(
        F.sequence(first, last),
        lambda n: F.when(low.startswith("0"), F.lpad(n.cast("string"), F.greatest(F.length(low), F.length(n.cast("string"))), F.lit("0")))
        .otherwise(n.cast("string")),
    )
    codes = (
        F.when(~is_range, F.array(code))
        .when(too_long, refused)
        .when(first > last, F.array(code))
        .when(last - first >= max_codes, refused)
        .otherwise(padded)
    )
    return places.withColumn(code_col, F.explode(codes))


def code_list(df: DataFrame, code_col: str) -> DataFrame:
    """The non-null codes as trimmed text, one row per input row."""
    return df.filter(col(code_col).isNotNull()).select(code_text(code_col).alias("code"))


def first_codes(df: DataFrame, code_col: str) -> DataFrame:
    """The first number of each code; codes without a digit are dropped. A list without any number is an error."""
    codes = df.select(first_integer(code_col).alias("code")).filter(F.col("code").isNotNull())
    require_rows(codes, f"no number in any code of {code_col}")
    return codes


#: First and last day that a calendar may have.
CALENDAR = ("1900-01-01", "2199-12-31")


def in_calendar(first: str, last: str, date_col: str) -> Column:
    return col(date_col).cast("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def outside_calendar(claims: DataFrame, first: str = CALENDAR[0], last: str = CALENDAR[1], date_col: str = "admission_date") -> DataFrame:
    """Claims whose date is no day of the calendar; those without a date are not among them."""
    return claims.filter(~in_calendar(first, last, date_col))


def dim_date(claims: DataFrame, first: str = CALENDAR[0], last: str = CALENDAR[1], date_col: str = "admission_date") -> DataFrame:
    """One row per day from the first to the last date of the claims, with calendar attributes.

    Dates outside ``first`` and ``last`` do not count, so one mistyped year does not add millions of days, and the
    days come from one array of bounded length. Minimum and maximum stay in the plan: one
    aggregate row is exploded into days. No dates, no rows.
    """
    bounds = claims.filter(in_calendar(first, last, date_col)).agg(
        F.min(col(date_col)).cast("date").alias("first"), F.max(col(date_col)).cast("date").alias("last")
    )
    days = bounds.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_day")
    )
    return days.withColumns(calendar_columns("date_day"))


def plan_numbers(plans: DataFrame, key: str = "plan_key") -> DataFrame:
    """Distinct plan keys numbered 0.. in key order, without sorting them all in one task.

    Keys are hashes, so their first four hex digits split them evenly into at most 65,536 groups.
    Only the groups' counts are summed up in one place; keys are ranked within their group.
    """
    prefixed = (
        plans.filter(col(key).isNotNull())
        .select(col(key).alias(key), F.substring(col(key), 1, 4).alias("__prefix"))
        .distinct()
    )
    per_prefix = prefixed.groupBy("__prefix").agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__prefix").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_prefix.select("__prefix", F.ifnull(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    rank = F.row_number().over(W.partitionBy("__prefix").orderBy(key)) - 1
    return (
        prefixed.withColumn("__rank", rank)
        .join(F.broadcast(offsets), "__prefix")
        .select(key, (F.col("__offset") + F.col("__rank")).alias("plan_number"))
    )


def assign_plans(
    members: DataFrame, plans: DataFrame, member_key: str = "member_key", plan_key: str = "plan_key"
) -> DataFrame:
    """Give every member with a key one plan, evenly spread and the same on each run.

    The plan number is taken from the member key's hash, the number of plans from a scalar subquery.
    Any ``plan_key`` the members have is replaced. Without plans the query fails.
    """
    keyed = members.filter(col(member_key).isNotNull()).drop(plan_key)
    numbered = plan_numbers(plans, plan_key)
    total = numbered.agg(F.count(F.lit(1))).scalar()
    hashed = F.conv(F.substring(col(member_key), 1, 8), 16, 10).cast("bigint")
    with_number = keyed.withColumn("plan_number", F.pmod(hashed, F.nullif(total, F.lit(0))))
    none = F.raise_error(F.lit(f"no {plan_key} to assign members to")).cast("string")
    joined = with_number.join(numbered, "plan_number", "left").drop("plan_number")
    return joined.withColumn(plan_key, F.ifnull(plan_key, none))

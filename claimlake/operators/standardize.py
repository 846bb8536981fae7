"""Cleaning of raw text columns and the reject split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.columns import MONEY_TYPE, imputed_flag, is_blank, parse_date
from claimlake.functions.naming import col, existing, find_column

# Column names the rules look for, and the reason written to rejects.
CODE_COLUMNS = ("diagnosis_code", "procedure_code", "revenue_code", "place_of_service_code", "ndc_code")
MONEY_COLUMNS = (
    "line_charge", "line_allowed", "line_paid", "paid_amount",
    "billed_amount", "allowed_amount", "member_cost_share",
)
COUNT_COLUMNS = ("units", "quantity", "days_supply")
DATE_COLUMNS = (
    "claim_date", "service_date", "admission_date", "discharge_date", "fill_date", "paid_date",
)
REQUIRED_KEYS = ("claim_id", "member_id")
REJECT_REASON = "MISSING_REQUIRED_KEY"


@dataclass(frozen=True)
class ColumnRules:
    """What to do to which columns, where they are present. Every text column is trimmed."""

    upper: Iterable[str] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    dates: Iterable[str] = ()


CLAIM_RULES = ColumnRules(
    upper=CODE_COLUMNS,
    casts={**dict.fromkeys(MONEY_COLUMNS, MONEY_TYPE), **dict.fromkeys(COUNT_COLUMNS, "int")},
    dates=DATE_COLUMNS,
)
TRIM_ONLY = ColumnRules()


def standardize(df: DataFrame, rules: ColumnRules = CLAIM_RULES) -> DataFrame:
    """Trim, upper-case, safe-cast and date-parse.

    Trimming takes spaces only: tabs and no-break spaces stay. What does not cast or parse
    becomes null. Trimming is a projection of its own, so that a value that is looked at several
    times to find its date layout is trimmed once.
    """
    upper = {c.lower() for c in rules.upper}
    casts = {c.lower(): t for c, t in rules.casts.items()}
    dates = {c.lower() for c in rules.dates}
    fields = df.schema.fields
    texts = {f.name for f in fields if isinstance(f.dataType, T.StringType)}

    def typed(name: str) -> Column:
        key, value = name.lower(), col(name)
        if key in upper:
            value = F.upper(value)
        if key in casts:
            value = value.try_cast(casts[key])
        elif key in dates:
            value = parse_date(value) if name in texts else value.try_cast("date")
        return value.alias(name)

    trimmed = df.select(*(
        F.trim(col(f.name)).alias(f.name) if f.name in texts else col(f.name) for f in fields
    ))
    return trimmed.select(*(typed(f.name) for f in fields))


def reject_condition(df: DataFrame, keys: Iterable[str] = REQUIRED_KEYS) -> Column:
    """True where any required key that the frame has is missing; false everywhere if it has none."""
    present = existing(df, keys)
    return reduce(or_, (is_blank(k) for k in present), F.lit(False))


def may_be_rejected(df: DataFrame, keys: Iterable[str] = REQUIRED_KEYS) -> Column:
    """A condition on raw text that all later rejects meet, and that Parquet can test on row groups.

    A value of spaces only, or of nothing, sorts before ``!``, the character after the space. Row
    groups whose keys have no nulls and start higher are not read. False everywhere without keys.
    """
    types = dict(df.dtypes)

    def suspicious(name: str) -> Column:
        value = col(name)
        return value.isNull() | (value < "!") if types[find_column(df, name)] == "string" else value.isNull()

    return reduce(or_, (suspicious(k) for k in existing(df, keys)), F.lit(False))


def split_rejects(df: DataFrame, keys: Iterable[str] = REQUIRED_KEYS) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with ``reject_reason``). Every row lands in exactly one of them."""
    bad = reject_condition(df, keys)
    return df.filter(~bad), df.filter(bad).withColumn("reject_reason", F.lit(REJECT_REASON))


def impute_with_flag(df: DataFrame, names: Iterable[str], default: Column) -> DataFrame:
    """Replace nulls by ``default`` and tell by ``<name>_imputed_flag`` where that was done."""
    added: dict[str, Column] = {}
    for name in existing(df, names):
        actual = find_column(df, name)
        added[f"{name}_imputed_flag"] = imputed_flag(actual)
        added[actual] = F.ifnull(col(actual), default)
    return df.withColumns(added) if added else df

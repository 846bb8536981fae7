"""Business rules, the fact table, the plan-month mart and the wide reporting table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.columns import MONEY_TYPE, date_key, key_text, rx_flag, stable_key, stable_keys, year_month
from claimlake.functions.naming import col, existing, find_column, rename_existing, upper_names
from claimlake.operators.frames import duplicate_groups, select_existing
from claimlake.operators.joins import DEFAULT_LIMITS, SALT, JoinLimits, Size, star_join
from claimlake.operators.standardize import COUNT_COLUMNS, MONEY_COLUMNS, impute_with_flag

# Names the fact is built from.
PLACE_RENAME = {"place_of_service_std_id": "place_of_service_code"}
LINE_ID = "claim_line_id"
GRAIN_FALLBACK = ("claim_id", "member_id", "admission_date", "service_line_number")
FOREIGN_KEYS = {
    "member_key": ("member_id",),
    "provider_key": ("provider_id",),
    "pharmacy_key": ("pharmacy_id",),
    "plan_key": ("health_plan_id", "plan_id"),
    "diagnosis_code_key": ("diagnosis_code",),
    "procedure_code_key": ("procedure_code",),
    "revenue_code_key": ("revenue_code",),
    "place_of_service_key": ("place_of_service_code",),
}
FACT_KEY = "claim_fact_key"
FACT_COLUMNS = (
    FACT_KEY, "claim_id", "date_key", "admission_date", *FOREIGN_KEYS,
    "is_rx_claim", "claim_type", "discharge_date",
)
MEASURES = (
    "paid_amount", "allowed_amount", "billed_amount", "line_paid", "line_allowed", "line_charge",
    "member_cost_share", "units", "quantity", "days_supply",
)

#: Columns that the lines of a claim mostly share. Facts without hashes have them first, side by side: where a claim's lines follow
#: one another, as after the join to its header, a shuffle writes such a stretch once.
SHARED = ("claim_id", "admission_date", "plan_key", "revenue_code_key", "place_of_service_key")

#: Up to so many keys of a fact are hashed each on its own.
KEYS_APART = 4

#: Columns of the fallback grain that facts without hashes hold as the text of a key.
GRAIN_AS_KEY = {"member_id": "member_key"}

# Columns of the wide table, by the table they come from. ``old: new`` renames.
WIDE_FACT = {
    "claim_fact_key": "claim_fact_key", "claim_id": "encounter_id", "date_key": "date_key",
    "admission_date": "admission_date", **{k: k for k in FOREIGN_KEYS},
    "is_rx_claim": "is_rx_claim", "claim_type": "claim_type", "discharge_date": "discharge_date",
    "line_allowed": "line_allowed", "line_charge": "line_charge",
}
WIDE_DIMS: dict[str, dict[str, str]] = {
    "plan_key": {
        "plan_id": "plan_id", "plan_name": "plan_name", "plan_state": "plan_state",
        "payer_type": "payer_type",
    },
    "member_key": {
        "member_id": "member_id", "member_name": "member_name", "member_dob": "member_dob",
        "member_gender": "member_gender", "member_age": "member_age",
    },
    "provider_key": {
        "provider_id": "provider_id", "npi": "prescriber_npi",
        "provider_specialty": "provider_specialty", "provider_state": "provider_state",
    },
    "pharmacy_key": {
        "pharmacy_id": "pharmacy_id", "pharmacy_name": "pharmacy_name",
        "pharmacy_state": "pharmacy_state",
    },
    "diagnosis_code_key": {
        "DIAGNOSIS_CODE": "diagnosis_code", "SHORT_DESCRIPTION": "diag_short_description",
        "LONG_DESCRIPTION": "diag_long_description",
    },
    "procedure_code_key": {
        "procedure_code": "procedure_code", "short_description": "procedure_short_description",
        "long_description": "procedure_long_description",
    },
    "revenue_code_key": {
        "revenue_code": "revenue_code", "DESCRIPTION": "revenue_description",
    },
    "place_of_service_key": {
        "Place_of_Service_Code": "place_of_service_code",
        "Place_of_Service_Name": "place_of_service_name",
        "Place_of_Service_Description": "place_of_service_description",
    },
}

#: The order of joins whose dimensions are of unknown size. A fact that needs no shuffle of its own before the first join is
#: moved for that join before any dimension is measured; so the usually large ones, for which it must move, go first.
JOIN_ORDER = ("member_key", "procedure_code_key", "provider_key")


def apply_rules(claims: DataFrame) -> DataFrame:
    """Missing amounts and counts become 0 with a flag; pharmacy claims are marked."""
    claims = rename_existing(claims, PLACE_RENAME)
    claims = impute_with_flag(claims, MONEY_COLUMNS, F.lit(0).cast(MONEY_TYPE))
    claims = impute_with_flag(claims, COUNT_COLUMNS, F.lit(0))
    claim_type = find_column(claims, "claim_type")
    is_rx = rx_flag(claim_type) if claim_type else F.lit(None).cast("int")
    return claims.withColumn("is_rx_claim", is_rx)


def resolve_grain(df: DataFrame) -> list[str]:
    """The columns that tell fact rows apart: the line id, else what there is of the fallback."""
    if find_column(df, LINE_ID):
        return [LINE_ID]
    grain = existing(df, GRAIN_FALLBACK)
    if len(grain) < 2:
        raise ValueError(f"no fact grain: need {LINE_ID} or two of {GRAIN_FALLBACK}, have {df.columns}")
    return grain


def fact_claims(ruled: DataFrame, include_flags: bool = False, hashed: bool = True) -> DataFrame:
    """Fact rows from claims that went through :func:`apply_rules`.

    Keys are hashed here once; joins and marts use the stored keys. Many keys are hashed as one array, a few
    each on their own, so that those which a query does not use fall away.

    A hash has 64 characters that do not compress. Rows that are to be moved before anything needs the hashes can therefore
    be had with ``hashed=False``: their keys are the texts that would be hashed, and in place of the row's own key are the columns of
    its grain. :func:`hash_keys` makes the fact of them; :func:`wide_claims` takes both.
    """
    parts = {FACT_KEY: resolve_grain(ruled)}
    for key, ids in FOREIGN_KEYS.items():
        found = existing(ruled, ids)
        if found:
            parts[key] = found[:1]
    flags = [c for c in ruled.columns if c.endswith("_imputed_flag")] if include_flags else []
    if hashed:
        return select_existing(_hashed(ruled, parts), [*FACT_COLUMNS, *MEASURES, *flags])
    grain = [c for c in parts.pop(FACT_KEY) if c not in FACT_COLUMNS and c not in GRAIN_AS_KEY]
    by_text = ruled.withColumns({key: key_text(of) for key, of in parts.items()})
    return select_existing(by_text, dict.fromkeys([*SHARED, *grain, *FACT_COLUMNS, *MEASURES, *flags]))


def hash_keys(by_text: DataFrame) -> DataFrame:
    """Rows of ``fact_claims(hashed=False)``, perhaps joined to others since, with their keys hashed and the date's key."""
    return _hashed(by_text, {FACT_KEY: _grain_by_text(by_text), **{key: [key] for key in existing(by_text, FOREIGN_KEYS)}})


def _grain_by_text(by_text: DataFrame) -> list[str]:
    if find_column(by_text, LINE_ID):
        return [LINE_ID]
    return existing(by_text, [GRAIN_AS_KEY.get(c, c) for c in GRAIN_FALLBACK])


def _hashed(df: DataFrame, parts: Mapping[str, list[str]]) -> DataFrame:
    keys: dict[str, Column] = {key: stable_key(*of) for key, of in parts.items()}
    if len(parts) > KEYS_APART:
        df = df.withColumn("__keys", stable_keys(list(parts.values())))
        keys = {key: F.col("__keys")[k] for k, key in enumerate(parts)}
    if find_column(df, "admission_date"):
        keys["date_key"] = date_key("admission_date")
    return df.withColumns(keys)


def dimension_by_text(dim: DataFrame, key: str) -> DataFrame:
    """A dimension with the text of its id in place of ``key``, to be joined to facts without hashes."""
    return dim.withColumn(key, key_text([next(iter(WIDE_DIMS[key]))]))


def duplicate_grain(ruled: DataFrame) -> DataFrame:
    """The grain keys that more than one row has."""
    return duplicate_groups(ruled, resolve_grain(ruled))


def duplicate_grain_count(ruled: DataFrame) -> DataFrame:
    return duplicate_grain(ruled).agg(F.count(F.lit(1)).alias("duplicate_groups"))


def mart_plan_month(fact: DataFrame) -> DataFrame:
    """Distinct claims and amounts per plan and month; rows without a date form month null.

    ``paid_amount`` sums line_allowed and ``billed_amount`` sums line_charge.
    """
    zero = F.lit(0).cast(MONEY_TYPE)
    return fact.groupBy("plan_key", year_month("admission_date").alias("year_month")).agg(
        F.count_distinct("claim_id").alias("claims_cnt"),
        F.sum(F.ifnull("line_allowed", zero)).alias("paid_amount"),
        F.sum(F.ifnull("line_charge", zero)).alias("billed_amount"),
    )


def claim_totals(fact: DataFrame) -> DataFrame:
    """What a batch adds to :func:`mart_plan_month`, mergeable: the amounts of each plan, month and claim.

    Distinct claims cannot be added up over batches, so the claims themselves are kept, one narrow row each in place of
    the fact's lines. (Numbering claims to keep them as bitmaps would need a table of the same length.)
    """
    zero = F.lit(0).cast(MONEY_TYPE)
    return fact.groupBy("plan_key", year_month("admission_date").alias("year_month"), "claim_id").agg(
        F.sum(F.ifnull("line_allowed", zero)).alias("paid_amount"),
        F.sum(F.ifnull("line_charge", zero)).alias("billed_amount"),
    )


def mart_from_totals(totals: DataFrame) -> DataFrame:
    """:func:`mart_plan_month` of all facts whose :func:`claim_totals` are given. A claim of several batches counts once."""
    amounts = {c: totals.schema[c].dataType for c in ("paid_amount", "billed_amount")}
    return totals.groupBy("plan_key", "year_month").agg(
        F.count_distinct("claim_id").alias("claims_cnt"), *(F.sum(c).cast(kind).alias(c) for c, kind in amounts.items()))


def wide_claims(
    fact: DataFrame, dims: Mapping[str, DataFrame], limits: JoinLimits = DEFAULT_LIMITS,
    sizes: Mapping[str, Size] | None = None, clustered: str | None = None,
) -> DataFrame:
    """The fact with all dimensions' attributes, 44 upper-case columns, one row per fact row.

    ``dims`` maps key columns to dimensions, ``sizes`` to what is known of their size. Rows without a
    match keep nulls; a null business id matches the dimension row whose id is null. Columns that the
    fact or a dimension lacks, and those of an absent dimension, are null text. The fact and the dimension of key
    ``clustered`` are stored in the same buckets, see :mod:`claimlake.operators.joins`.

    A fact without hashes (``fact_claims(hashed=False)``) is joined by the ids' texts, and its keys are hashed after the last join. Its
    clustered dimension must be stored by text too (:func:`dimension_by_text`). While its rows are moved for the usually large
    dimensions, their other texts are packed; hashes would not get shorter by that.
    """
    by_text = find_column(fact, FACT_KEY) is None
    if by_text:
        carried = existing(fact, dict.fromkeys([*SHARED, *_grain_by_text(fact), *WIDE_FACT]))
        narrow = select_existing(fact, [*carried, *([SALT] if clustered else [])])
        dims = {key: dim if key == clustered else dimension_by_text(dim, key) for key, dim in dims.items()}
    else:
        narrow = fact.select(*(_or_null(fact, c).alias(c) for c in WIDE_FACT), *([SALT] if clustered else []))
    order = sorted(WIDE_DIMS, key=lambda key: JOIN_ORDER.index(key) if key in JOIN_ORDER else len(JOIN_ORDER))
    pairs = [
        (key, dims[key].select(key, *([SALT] if key == clustered else []), *(_or_null(dims[key], c).alias(f"{key}.{new}") for c, new in WIDE_DIMS[key].items())))
        for key in order if key in dims and find_column(fact, key)
    ]
    joined = star_join(narrow, pairs, limits, sizes, clustered, packed=JOIN_ORDER if by_text else ())
    if by_text:
        joined = hash_keys(joined)
    return upper_names(joined.select(
        *(_or_null(joined, c).alias(new) for c, new in WIDE_FACT.items()),
        *(_or_null(joined, f"{key}.{new}").alias(new) for key, names in WIDE_DIMS.items() for new in names.values()),
    ))


def _or_null(df: DataFrame, name: str) -> Column:
    return col(name) if find_column(df, name) else F.lit(None).cast("string")

"""Column expressions. All are built-in Spark expressions: no Python runs per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlake.functions.naming import col

# Part of every surrogate key, so changing one re-keys all tables.
KEY_SEPARATOR = "||"
KEY_BITS = 256

# Accepted date layouts, first match wins.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "dd-MM-yyyy", "dd/MM/yyyy")

# Claim types counted as pharmacy claims.
RX_CLAIM_TYPES = ("RX", "PHARMACY")

# Sunday and Saturday in Spark's dayofweek numbering.
WEEKEND_DAYS = (1, 7)

MONEY_TYPE = "decimal(18,2)"


def _as_column(c: str | Column) -> Column:
    return col(c) if isinstance(c, str) else c


def key_text(parts: Sequence[str | Column]) -> Column:
    """The text that :func:`stable_key` hashes. Equal texts have equal keys, so rows may be joined by either."""
    if not parts:
        raise ValueError("a key needs at least one column")
    texts = [F.ifnull(_as_column(p).cast("string"), F.lit("")) for p in parts]
    return texts[0] if len(texts) == 1 else F.concat_ws(KEY_SEPARATOR, *texts)


def stable_key(*parts: str | Column) -> Column:
    """Surrogate key: SHA-256 hex over the parts' text, a null part counting as ''.

    A null business id therefore has a key of its own, the hash of the empty string.
    """
    return F.sha2(key_text(parts), KEY_BITS)


def stable_keys(keys: Sequence[Sequence[str | Column]]) -> Column:
    """The :func:`stable_key` of each, as one array.

    The code for one hash serves all of them. Written out nine times it brings the method that Spark generates for
    a claim line beyond 8,000 bytes, and the JVM does not compile methods larger than that.
    """
    return F.transform(F.array(*(key_text(parts) for parts in keys)), lambda text: F.sha2(text, KEY_BITS))


def is_blank(c: str | Column) -> Column:
    """True for null, empty and spaces-only values; never null itself, so ``~`` is safe."""
    return F.ifnull(F.trim(_as_column(c).cast("string")), F.lit("")) == ""


def parse_date(c: str | Column) -> Column:
    """Date from text in any of ``DATE_FORMATS``, null if none fits; ``05/03/2024`` is the 3rd of May.

    Trying five formats one after the other costs an exception per miss in the JVM. The layouts
    exclude each other by shape, so each value is sent to the one that can match it:

    * ``-`` in fifth place: ``yyyy-MM-dd``. It is asked first and alone, as a filter on a date works out the text anew
      for each question;
    * ``/`` and a two-digit first part above 12: only ``dd/MM/yyyy`` can match;
    * any other ``/``: ``M/d/yyyy``, which accepts all that ``MM/dd/yyyy`` does; where it fails
      with a first part up to 12, ``dd/MM/yyyy`` fails too;
    * ``-`` in third place: ``dd-MM-yyyy``, as a year has four digits or more;
    * any other ``-``: ``yyyy-MM-dd``.
    """
    c = _as_column(c)
    third = F.substring(c, 3, 1)
    day_first = (third == "/") & F.substring(c, 1, 2).between("13", "99")
    return (
        F.when(F.substring(c, 5, 1) == "-", F.try_to_date(c, "yyyy-MM-dd"))
        .when(day_first, F.try_to_date(c, "dd/MM/yyyy"))
        .when(F.contains(c, F.lit("/")), F.try_to_date(c, "M/d/yyyy"))
        .when(third == "-", F.try_to_date(c, "dd-MM-yyyy"))
        .when(F.contains(c, F.lit("-")), F.try_to_date(c, "yyyy-MM-dd"))
    )


def imputed_flag(c: str | Column) -> Column:
    """1 where the value is missing, else 0."""
    return F.isnull(_as_column(c)).cast("int")


def rx_flag(claim_type: str | Column) -> Column:
    """1 for pharmacy claims, 0 for all others and for a null type."""
    return F.ifnull(F.upper(_as_column(claim_type)).isin(*RX_CLAIM_TYPES), F.lit(False)).cast("int")


def date_key(c: str | Column) -> Column:
    """20240305 for 2024-03-05; null for null. Arithmetic, so no text is formatted and parsed."""
    c = _as_column(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def year_month(c: str | Column) -> Column:
    return F.date_format(_as_column(c), "yyyy-MM")


def calendar_columns(day: str | Column) -> dict[str, Column]:
    """The calendar attributes of a date, by name. Weeks are ISO weeks, days count from Sunday = 1."""
    day = _as_column(day)
    weekday = F.dayofweek(day)
    return {
        "date_key": date_key(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_of_week_num": weekday,
        "day_of_week_name": F.date_format(day, "E"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": weekday.isin(*WEEKEND_DAYS).cast("int"),
    }


def first_integer(c: str | Column) -> Column:
    """First run of digits of a code (``'73-80'`` gives ``'73'``), null if there is none."""
    return F.nullif(F.regexp_extract(_as_column(c).cast("string"), "([0-9]+)", 1), F.lit(""))


def code_text(c: str | Column) -> Column:
    """A code as trimmed text."""
    return F.trim(_as_column(c).cast("string"))


def age_in_years(born: str | Column, as_of: str | Column) -> Column:
    """Whole years of 365 days between two dates. Not the calendar age: leap days count."""
    return F.floor(F.datediff(_as_column(as_of), _as_column(born)) / 365).cast("int")


def days_later(day: str | Column, days: str | Column) -> Column:
    return F.date_add(_as_column(day), _as_column(days))


def share_of_amount(amount: str | Column, ratio: Column) -> Column:
    """``amount`` times ``ratio`` to two places, half up, in decimals throughout."""
    return F.round(_as_column(amount) * ratio, 2).cast(MONEY_TYPE)

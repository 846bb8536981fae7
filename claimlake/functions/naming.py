"""Column-name helpers.

Spark resolves names without regard to case while a Python ``in df.columns`` test does not, so
every "is this column there?" question in the library goes through :func:`find_column`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by its literal name, safe for names holding dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def find_column(df: DataFrame, name: str) -> str | None:
    """The column's actual spelling in ``df``, or None."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def existing(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that ``df`` has, in the given order and spelling."""
    present = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() in present]


def normalize_header(name: str) -> str:
    """``' Place of Service Code(s)'`` becomes ``'place_of_service_code_s'``."""
    return re.sub("[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def normalize_headers(df: DataFrame) -> DataFrame:
    names = [normalize_header(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1 or not n})
    if clashes:
        raise ValueError(f"headers {df.columns} collapse to duplicate or empty names: {clashes}")
    return df.toDF(*names)


def rename_positional(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Give the columns new names by position; the number of names must match."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(names)} columns {names}, file has {df.columns}")
    return df.toDF(*names)


def rename_existing(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present, leave the rest alone."""
    return df.withColumnsRenamed(dict(mapping)) if mapping else df


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.upper() for c in df.columns))

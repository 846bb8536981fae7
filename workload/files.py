"""The test claims and lookups as CSV files, the input of a full run through the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlake.config import LOOKUPS
from workload.source import lookup, raw_claims

CLAIMS_FILE = "claims.csv"


def write_csv(df: DataFrame, path: str) -> None:
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)


def write_input_files(spark: SparkSession, sf_dir: str, target: str) -> None:
    write_csv(raw_claims(spark, sf_dir), f"{target}/{CLAIMS_FILE}")
    for spec in LOOKUPS:
        df = lookup(spark, sf_dir, spec.silver_table)
        if spec.normalize:
            df = df.toDF(" HCPC", "LONG DESCRIPTION", "Short Description")
        write_csv(df, f"{target}/{spec.file}")

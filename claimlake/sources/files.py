"""CSV files: raw claims and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.config import LookupSpec
from claimlake.functions.naming import col, find_column, normalize_headers, rename_positional
from claimlake.operators.frames import require_columns

# Texts that stand for "missing" in lookup files.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Column with the whole line of a record that has too many or too few fields, else null.
MALFORMED = "_malformed_record"


def read_marked_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns as text, and :data:`MALFORMED`; one record per line, so big files split.

    Columns are named by the header, which one small job reads unless ``columns`` are given. Quotes
    within quotes are doubled. With several files, a file whose header differs is an error rather than a
    silent shift of columns. A record with more or fewer fields is marked, never cut in silence.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", False)
        .option("escape", '"')
        .option("enforceSchema", False)
    )
    names = list(columns) if columns else reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, MALFORMED)])
    # Without pruning: a reader of some columns only does not see that a record has too many or too few.
    reader = reader.option("mode", "PERMISSIVE").option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The well-formed records of :func:`read_marked_csv`, all columns as text."""
    marked = read_marked_csv(spark, path, columns)
    # Always true; Spark refuses queries, such as a count, that look at the marking column only.
    any_field = F.length(F.ifnull(col(marked.columns[0]), F.lit(""))) >= 0
    return marked.filter(F.col(MALFORMED).isNull() & any_field).drop(MALFORMED)


def malformed_records(marked: DataFrame) -> DataFrame:
    """The records that :func:`read_text_csv` leaves out: the whole line, and its first field to find it by."""
    return marked.filter(F.col(MALFORMED).isNotNull()).select(
        F.col(MALFORMED).alias("record"), col(marked.columns[0]).alias("first_field"))


def read_lookup(spark: SparkSession, path: str, spec: LookupSpec) -> DataFrame:
    """A lookup file with its names and types.

    Lines with too many or too few fields, or text that does not fit its type, are an error that names the
    file, the column and the number of rows; typed files are scanned once more for that.
    """
    marked = read_marked_csv(spark, path)
    broken = marked.agg(F.count(MALFORMED), F.count(col(marked.columns[0]))).first()[0]
    if broken:
        raise ValueError(f"{path}: {broken} lines have more or fewer fields than the header")
    df = marked.drop(MALFORMED)
    if spec.normalize:
        df = normalize_headers(df)
    if spec.names:
        df = rename_positional(df, spec.names)
    require_columns(df, spec.types)
    types = {find_column(df, c): t for c, t in spec.types.items()}
    present = {c: F.when(~col(c).isin(*MISSING_TEXTS), col(c)) for c in df.columns}
    if types:
        wrong = df.agg(*(
            F.count_if(present[c].isNotNull() & present[c].try_cast(t).isNull()).alias(c) for c, t in types.items()
        )).first().asDict()
        found = [f"{n} values of {c} are not {types[c]}" for c, n in wrong.items() if n]
        if found:
            raise ValueError(f"{path}: {', '.join(found)}")
    return df.select(*(
        (v.cast(types[c]) if c in types else v).alias(c) for c, v in present.items()
    ))

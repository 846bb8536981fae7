"""What the operators share: scratch tables, shipped code, byte helpers."""

from __future__ import annotations

import os
import string
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: ASCII upper case to lower case; every other byte stays.
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
MASK = (1 << 64) - 1


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only, whatever the locale or the other letters."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder of its own; any other session has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="claimlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """Path of a new table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it is computed once, and lost executors cost no rerun."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers that this session starts find the package where it lies in a source folder.

    A cluster has the package installed or gets it by ``--py-files``; the path then does no harm.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])


def fields(df: DataFrame, *keep: str, and_: str = "") -> T.StructType:
    """Schema with columns ``keep`` of ``df`` as they are, and further ones as DDL."""
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + (T.StructType.fromDDL(and_).fields if and_ else []))


def decimals(values: list[int | None]) -> pa.Array:
    """126-bit numbers as an Arrow column of type decimal(38,0), which Spark hashes and compares as it is."""
    data = b"".join((v or 0).to_bytes(16, "little") for v in values)
    valid = np.packbits(np.array([v is not None for v in values], bool), bitorder="little").tobytes()
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(values), [pa.py_buffer(valid), pa.py_buffer(data)])


def per_tile(work: Callable[[pa.Table], pa.RecordBatch | None], names: list[str]):
    """A batch function that calls ``work`` with one tile after the other. Rows come sorted by ``names``, which tell
    tiles apart; a tile has a bounded number of rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish() -> pa.RecordBatch | None:
            table = pa.Table.from_batches(held) if held else None
            held.clear()
            return work(table) if table is not None and table.num_rows > 1 else None

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            new = np.zeros(batch.num_rows, bool)
            for column in columns:
                new[1:] |= column[1:] != column[:-1]
            now = tuple(c[0] for c in columns)
            new[0] = now != last
            last = tuple(c[-1] for c in columns)
            starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            if starts[0]:
                held.append(batch.slice(0, starts[0]))
            for a, b in zip(starts, starts[1:], strict=False):
                out = finish()
                if out is not None:
                    yield out
                held.append(batch.slice(a, b - a))
        out = finish()
        if out is not None:
            yield out

    return run


def matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)

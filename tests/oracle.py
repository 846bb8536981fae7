"""Order-free comparison of a Spark query with its DuckDB SQL."""

from __future__ import annotations

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows]
    table.sort(key=lambda r: tuple((v is not None, v or "") for v in r))
    return [columns[i] for i in order], table


def run_spark(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def run_duckdb(con, sql):
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def spark_types(df) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def duckdb_types(con, sql) -> dict[str, str]:
    names = {"varchar": "string", "integer": "int", "double": "double", "bigint": "bigint", "date": "date",
             "timestamp": "timestamp_ntz"}
    return {
        r[0]: names.get(r[1].lower(), r[1].lower()) for r in con.execute(f"describe {sql}").fetchall()
    }

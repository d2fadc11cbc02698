"""Compare a Spark result with its oracle: columns, types and values, in any row order."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_timestamp(kind):
        return pa.timestamp("us", tz=kind.tz)
    return pa.string() if pa.types.is_large_string(kind) else kind


def types_of(rows: pa.Table) -> dict[str, pa.DataType]:
    return {f.name: _plain(f.type) for f in sorted(rows.schema, key=lambda f: f.name)}


def values_of(rows: pa.Table) -> list[str]:
    names = sorted(rows.column_names)
    columns = [rows.column(n).to_pylist() for n in names]
    return sorted(repr(row) for row in zip(*columns))


def differences(spark_df, con, sql: str) -> list[str]:
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    if types_of(got) != types_of(want):
        found.append(f"types: {set(types_of(got).items()) ^ set(types_of(want).items())}")
    if got.num_rows != want.num_rows:
        found.append(f"rows: {got.num_rows} instead of {want.num_rows}")
    a, b = values_of(got), values_of(want)
    if a != b:
        only_got, only_want = set(a) - set(b), set(b) - set(a)
        found.append(f"values: {len(only_got)} differ, such as {sorted(only_got)[:2]} / {sorted(only_want)[:2]}")
    return found

"""Compare a Spark query with its DuckDB twin the way the driver does:
same column names, same row count, same multiset of rows (columns sorted by
name; floats compared after rounding to 6 decimals)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from keelson.sources.tables import TABLES, table_path


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


DIGITS = int(os.environ.get("KEELSON_ORACLE_DIGITS", "6"))


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return (round(v, DIGITS) if DIGITS >= 0 else v) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp": "TIMESTAMP", "smallint": "SMALLINT",
}


def type_mismatches(spark_df, rel) -> list[str]:
    duck = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    out = []
    for f in spark_df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs sql {duck.get(f.name)}")
    return out


def compare(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> tuple[bool, str]:
    rel = con.sql(sql)
    bad_types = type_mismatches(spark_df, rel)
    s = spark_df.toPandas()
    d = rel.df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} sql={sorted(d.columns)}"
    if bad_types:
        return False, "types differ: " + "; ".join(bad_types)
    if len(s) != len(d):
        return False, f"row count differs: spark={len(s)} sql={len(d)}"
    rs, rd = _rows(s), _rows(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first differing row: spark={a} sql={b}"
    return True, f"{len(s)} rows"

"""Compare a Spark result with a DuckDB query over the same parquet tables.

Mirrors the correctness gate: columns sorted by name, row count, column
names, and an order-insensitive hash of the values.
"""

from __future__ import annotations

import decimal
import hashlib
import math

from tabelion.fixtures import SOURCE_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in SOURCE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else str(v.normalize())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), cols, h


def compare(df, sql: str, sf_dir: str) -> dict:
    con = duckdb_connection(sf_dir)
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    s_rows = [tuple(r) for r in df.collect()]
    s = digest(df.columns, s_rows)
    o = digest(o_cols, o_rows)
    return {
        "rows_match": s[0] == o[0],
        "schema_match": s[1] == o[1],
        "value_match": s[2] == o[2],
        "spark_rows": s[0],
        "oracle_rows": o[0],
        "spark_cols": s[1],
        "oracle_cols": o[1],
    }

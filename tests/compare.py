"""Compare a Spark result with a DuckDB result, as multisets of typed rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = ["customer", "nation", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in result.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    (left_names, left), (right_names, right) = spark_rows(df), duck_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} vs {right_names}"
    if left != right:
        return (f"{sum(left.values())} vs {sum(right.values())} rows\n only spark: "
                f"{list((left - right).items())[:2]}\n only duckdb: {list((right - left).items())[:2]}")
    return None

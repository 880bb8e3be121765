"""Spark result against SQL result, as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    order = [names.index(c) for c in df.columns]
    wanted = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    found = Counter(tuple(row) for row in df.collect())
    if wanted == found:
        return None
    return (
        f"{sum(found.values())} rows, expected {sum(wanted.values())}; "
        f"only found {list((found - wanted).items())[:3]}; "
        f"only expected {list((wanted - found).items())[:3]}"
    )

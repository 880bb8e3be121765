"""Membership with SQL's three values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def exists_in(
    df: DataFrame, other: DataFrame, key: str, flag: str = "exists_in_external"
) -> DataFrame:
    """Add the value of ``key IN (SELECT key FROM other)``.

    True on a match; false when the list is empty or holds no NULL; else NULL.
    A value that is NULL itself is NULL, unless the list is empty.
    """
    values = other.select(F.col(key).alias("__listed"))
    listed = values.where(F.col("__listed").isNotNull()).distinct()
    facts = values.agg(
        F.count(F.lit(1)).alias("size"),
        F.coalesce(F.max(F.col("__listed").isNull()), F.lit(False)).alias("has_null"),
    )
    is_empty = facts.select(F.col("size") == 0).scalar()
    has_null = facts.select("has_null").scalar()
    found = df.join(listed, df[key] == listed["__listed"], "left")
    return found.select(
        *df.columns,
        F.when(F.col("__listed").isNotNull(), True)
        .when(is_empty, False)
        .when(F.col(key).isNull() | has_null, None)
        .otherwise(False)
        .alias(flag),
    )

"""Positions in a global order: a report's row numbers without a sort in one task."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from cashweave.scratch import shared_folder

# Rows that a part of the order is for.
ROWS_PER_PART = 1_000_000


def with_positions(
    df: DataFrame, order: list[str], name: str = "position", rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """df with the place of each row in the order of these columns, from 1 on; missing values last.

    Rows are dealt out by ranges of the order and sorted within them, so each task
    sorts a part. What comes before a part is known from the parts' counts: one
    small row each, added up in a window over the parts alone. The sorted rows are
    written once, because a row's place in its part has to be the one that was
    counted. Rows equal in all these columns follow each other in any order.
    """
    spark = df.sparkSession
    parts = max(1, -(-df.count() // rows_per_part))
    keys = [F.asc_nulls_last(f"`{c}`") for c in order]
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    turn = F.monotonically_increasing_id()  # the partition, then 33 bits for the row in it
    numbered = ranged.withColumns(
        {"__part": F.shiftright(turn, 33), "__turn": turn.bitwiseAND(F.lit((1 << 33) - 1))}
    )
    path = f"{shared_folder(spark)}/positions-{uuid.uuid4().hex}"
    numbered.write.parquet(path)
    written = spark.read.schema(numbered.schema).parquet(path)
    counts = written.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    ahead = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__ahead"))
    return written.join(ahead, "__part").select(
        (F.col("__ahead") + F.col("__turn") + 1).alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )

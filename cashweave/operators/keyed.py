"""Join helpers: null-safe keys, size-checked broadcast, salted hot keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cashweave.scratch import written

# A side is broadcast only when measured to have at most so many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

# A key is hot when it has more rows than a task should get, and is split into
# parts of that size. The number of such keys is at most the number of tasks of
# that size which all rows would fill.
ROWS_PER_TASK = 2_000_000

# A task holds its part of a key table as a hash table up to so many bytes of rows, else
# both sides are sorted.
HASH_BYTES = 64 << 20


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str
) -> DataFrame:
    """Join in which NULL keys match each other; the right keys are dropped."""
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"__r_{c}" if c in keys else c) for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys],
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def _width(df: DataFrame) -> Column:
    """Bytes of a row, roughly: texts by their length, anything else eight."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    fixed = F.lit(8 * (len(df.columns) - len(text)))
    return reduce(
        lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in text], fixed
    )


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Measure up to the bound (an action) and tell whether rows and bytes keep it."""
    seen = df.limit(rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_width(df).cast("long")).alias("width")
    ).first()
    return seen["n"] <= rows and (seen["width"] or 0) <= most


def fits_hash(df: DataFrame, key: str, most: int = HASH_BYTES) -> bool:
    """Measure (an action) whether a task's part of df, dealt by key, keeps the bound.

    A part is about the rows of all keys over the number of shuffle partitions, and
    holds at least the key that has most.
    """
    per_key = df.groupBy(key).agg(F.sum(_width(df).cast("long")).alias("width"))
    seen = per_key.agg(F.max("width").alias("key"), F.sum("width").alias("all")).first()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (seen["key"] or 0) + (seen["all"] or 0) // parts <= most


def hot_keys(df: DataFrame, key: str, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more rows than a task should get, and into how many parts to split each.

    The counts are pre-aggregated per input split.
    """
    return hot_counts(df.where(F.col(key).isNotNull()).groupBy(key).count(), key, per_task)


def hot_counts(counts: DataFrame, key: str, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The same from rows per key (column ``count``) that are known already."""
    return counts.where(F.col("count") > per_task).select(
        key, F.ceil(F.col("count") / per_task).alias("copies")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Equi-join on one key that splits the hot keys of the left side.

    Left rows of a hot key are dealt out over ``copies`` salts by their input
    split, which a recomputed task reproduces; the right rows of that key are
    repeated once per salt. Other keys have the one salt 0. Rows without a key,
    which match nothing, are left out of an inner join and else have a salt for
    each input split, so their parts grow in number and not in size. ``hot`` may
    bring the hot keys where they are known; they are written, so that measuring and
    joining them counts nothing again. ``hashed`` sorts neither side: the left rows
    stream by a hash table of a task's right rows. Inner and left only.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left joins, not {how!r}")
    if how == "inner":
        left = left.where(F.col(key).isNotNull())
    if hot is None:
        hot = hot_keys(left, key, per_task)
    hot = written(hot, "hot-keys")
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    # The split is noted before the hot keys come in, which may take a shuffle.
    split = left.withColumn("__split", F.spark_partition_id())
    salt = F.when(F.col(key).isNull(), F.col("__split")).otherwise(
        F.pmod("__split", F.coalesce(F.col("copies"), F.lit(1)))
    )
    dealt = split.join(hot, key, "left").withColumn("__salt", salt.cast("int")).drop(
        "copies", "__split"
    )
    repeated = right.join(hot, key, "left").withColumn(
        "__salt",
        F.explode(
            F.sequence(
                F.lit(0), F.coalesce(F.col("copies"), F.lit(1)).cast("int") - 1
            )
        ),
    ).drop("copies")
    if hashed:
        repeated = repeated.hint("shuffle_hash")
    return dealt.join(repeated, [key, "__salt"], how).drop("__salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    per_task: int = ROWS_PER_TASK,
    hot: Callable[[], DataFrame] | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Row-level join of a very large side to a key table.

    Without a shuffle while the key table is measured to be small, else with its
    hot keys split; ``hot`` is asked for them only then. Sorted rows compress better in
    a shuffle or file that follows. Where that is not needed, ``hashed`` saves the memory
    of the sort, as long as a task's part of the key table is measured to be small.
    """
    if fits_broadcast(right, rows):
        return left.join(F.broadcast(right), key, how)
    hashed = hashed and fits_hash(right, key)
    return salted_join(left, right, key, how, per_task, hot() if hot else None, hashed)


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key (NULL is a key), the smallest one, so reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("__row"))
        .select(*[F.col(c) if c in keys else F.col(f"__row.{c}") for c in df.columns])
    )

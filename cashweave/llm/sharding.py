"""Sharding: bytes, tokens and rows are balanced together by vector bin packing.

Rows with equal texts form a group and stay together. Only a group that is large
beside a shard (over a quarter of one, by bytes, tokens or rows) is cut into pieces
below that size, by row. All other groups are gathered into parcels by a hash of the
text. There are so many parcels (4096 and the pieces) whatever the size of the table,
and so the placement fits the driver: largest first, each goes to the shard where the
dot product of its vector and the shard's residual capacity is highest.

A row's slot within its shard is the offset there of its part of a parcel plus the
row's rank in that part, so no task ever sorts a whole shard.

Defined cases: a null text counts as an empty one; null and repeated ids are rows
like any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cashweave.llm.base import staged, table, unnamed

PARCELS = 4096
PIECES_IN_SHARD = 4
PARTS_OF_PIECE = 16
ROW_BYTES = 16
_GROUP = ["text_hash", "text_crc32", "size"]
_MEASURES = ["bytes", "tokens", "rows"]


#: Spare capacity beside an equal share: bytes have none, the other measures give way.
SLACK = (0.0, 0.05, 0.05)


def place(vectors: np.ndarray, shards: int, slack: tuple[float, ...] = SLACK) -> np.ndarray:
    """The shard of each vector. Capacities are equal shares of each measure's total, and slack.

    A vector goes only to a shard whose residual capacity holds it, while there is
    one; else to the one that has the most of its scarcest measure left.
    """
    total = vectors.sum(axis=0)
    share = vectors * (shards / np.where(total > 0, total, 1))
    residual = np.ones((shards, vectors.shape[1])) + np.array(slack)
    chosen = np.zeros(len(vectors), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        v = share[i]
        fits = (residual >= v - 1e-12).all(axis=1)
        worth = residual @ v
        best = int(np.argmax(np.where(fits, worth, -np.inf))) if fits.any() else int(np.argmax((residual - v).min(axis=1)))
        chosen[i] = best
        residual[best] -= v
    return chosen


def shard(docs: DataFrame, shards: int, parcels: int = PARCELS) -> DataFrame:
    """doc_id, size, text_crc32, tokens, shard and slot of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    measured = unnamed(docs, "doc_id", "text").select(
        F.col("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written once: the row numbers are data from here on.
    measured = staged(measured, "sizes")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = measured.agg(*sums).first()
    limits = [max(1.0, (total[m] or 0) / (shards * PIECES_IN_SHARD)) for m in _MEASURES]
    pieces = F.ceil(F.greatest(*[F.col(m) / limit for m, limit in zip(_MEASURES, limits, strict=True)]))
    # Few groups can be over a limit: PIECES_IN_SHARD * shards for each measure at most.
    large = measured.groupBy(*_GROUP).agg(*sums).withColumn("pieces", pieces).where("pieces > 1").select(*_GROUP, "pieces")
    is_large, row = F.col("pieces").isNotNull(), F.xxhash64("row")
    parcel = F.when(is_large, F.concat_ws("-", F.hex("text_hash"), F.hex("text_crc32"), F.pmod(row, F.col("pieces")))).otherwise(F.pmod(F.col("text_hash"), F.lit(parcels)).cast("string"))
    part = F.when(is_large, F.pmod(F.shiftright(row, 32), F.lit(PARTS_OF_PIECE))).otherwise(F.lit(0)).cast("int")
    dealt = measured.join(F.broadcast(large), _GROUP, "left").select("doc_id", "size", "text_crc32", "tokens", "row", parcel.alias("parcel"), part.alias("part"))
    parts = dealt.groupBy("parcel", "part").agg(*sums).orderBy("parcel", "part").collect()
    loads: dict[str, np.ndarray] = {}
    for r in parts:
        loads[r["parcel"]] = loads.get(r["parcel"], 0) + np.array([r[m] for m in _MEASURES], float)
    at = dict(zip(loads, place(np.array(list(loads.values())).reshape(-1, 3), shards).tolist(), strict=True))
    offsets, filled = [], np.zeros(shards, np.int64)
    for r in parts:
        s = at[r["parcel"]]
        offsets.append((r["parcel"], r["part"], s, int(filled[s])))
        filled[s] += r["rows"]
    placed = spark.createDataFrame(offsets, "parcel string, part int, shard int, offset long")
    rank = F.row_number().over(Window.partitionBy("parcel", "part").orderBy("doc_id", "row")) - 1
    return (
        dealt.withColumn("rank", rank)
        .join(F.broadcast(placed), ["parcel", "part"])
        .select("doc_id", "size", "text_crc32", "tokens", "shard", (F.col("offset") + F.col("rank")).alias("slot"))
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = shard(table(spark, sf_dir, "documents"), 40)
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

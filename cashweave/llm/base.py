"""What the operators share: tables, folds, staging in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.scratch import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as fold 0 (held out)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % parts, F.lit(0))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df written to the shared folder and read back: computed once, lineage cut.

    Written files outlive the executors that wrote them, so a lost executor costs
    only the tasks it was running.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if data is None or len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about `most` bytes.

    Bounds the memory of the vectorised steps; a longer text is a slice of its own.
    """
    data, at = text_bytes(column)
    lo, rows = 0, len(at) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def planes(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of integers, all first bytes first: compresses well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(raw: bytes, width: int) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((part.shape[1], 8), np.uint8)
    out[:, :width] = part.T
    return out.reshape(-1).view("<u8")


def hashed_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """The `most` rows of df whose keys hash lowest. What lies far beyond goes before the sort,
    so that the rows which meet in the driver do not grow with the number of partitions."""
    count = df.count()
    hashed = F.xxhash64(key)
    if count > 2 * most:
        df = df.where(F.pmod(hashed, F.lit(1 << 31)) < int((1 << 31) * min(1.0, 1.5 * most / count)))
        hashed = F.pmod(hashed, F.lit(1 << 31))
        df = df.orderBy(hashed, key)
    else:
        df = df.orderBy(F.pmod(hashed, F.lit(1 << 31)), key)
    return df.limit(most)


def unnamed(df: DataFrame, *wanted: str) -> DataFrame:
    """df with only the wanted columns: others, whatever their names, go no further."""
    return df.select(*[F.col(f"`{c}`") for c in wanted])

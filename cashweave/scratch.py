"""Where jobs leave tables that later jobs read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# How a step of a larger plan is kept: (its rows, a name) to the rows to go on with.
Kept = Callable[[DataFrame, str], DataFrame]

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def as_it_is(df: DataFrame, name: str) -> DataFrame:
    """Not kept: the step stays a part of the plan that uses it."""
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is not set, a session on one machine (master ``local``) gets a folder of
    its own; on a cluster, executors would each write to their own disk, so it raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cashweave-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """df as a table in that folder, computed now and once; it outlives lost executors.

    Its shuffle files go when it is written (from Spark 4.1 on), not when the driver
    happens to collect its garbage: of a chain of tables disk holds one's at a time. The
    setting is the session's; a query that another thread begins meanwhile, and runs again
    from the same frame, shuffles again.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Kept]:
    """``written`` for steps: their tables are deleted when the block ends.

    Whatever is computed from them must be written by then.
    """
    folder = f"{shared_folder(spark)}/passing-{uuid.uuid4().hex}"
    try:
        yield lambda df, name: written(df, name, folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

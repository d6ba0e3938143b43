"""Tables in the folder that all executors share, and global ranks by range partitions."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where it is unset and driver and executors are one process, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints/scissile-ops"
        os.makedirs(root.removeprefix("file://"), exist_ok=True)
    return root.rstrip("/")


#: Tables that were staged and still stand, by the scope in which they were: the first is the session's.
_scopes: list[list[str]] = [[]]


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    uri = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri), uri


def staged(df: DataFrame) -> DataFrame:
    """df written in the shared folder and read back; it stands until the scope in which it was staged ends."""
    out, uri = _written(df)
    _scopes[-1].append(uri)
    return out


@contextlib.contextmanager
def scope(spark: SparkSession):
    """Deletes at its end every table that was staged within: for a plan whose results are written or read by then."""
    _scopes.append([])
    try:
        yield
    finally:
        _delete(spark, _scopes.pop())


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that build() gives, staged; what was staged on the way to it is deleted."""
    with scope(spark):
        out, uri = _written(build())
    _scopes[-1].append(uri)
    return out


def release(spark: SparkSession) -> None:
    """Deletes what was staged outside of any scope: for a session that has read its results."""
    held, _scopes[0][:] = list(_scopes[0]), []
    _delete(spark, held)


#: Rows that a task sorts or groups where a step deals rows by their number.
TASK_ROWS = 1 << 18


def tasks_for(df: DataFrame) -> int:
    """Tasks among which df's rows are dealt so that none holds many more than TASK_ROWS, whatever the session's number of partitions: one count of df."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def _delete(spark: SparkSession, uris: list[str]) -> None:
    for uri in uris:
        path = spark._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, order: list[str], out: str, by: list[str] = ()) -> DataFrame:
    """df with `out`, each row's place (from 1) in the order, within `by`.

    Rows are dealt by ranges and written once, so that places within a range and the sizes of the ranges before it
    come from the same partitions; no task holds more than a range.
    """
    ranged = staged(df.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id()))
    own = ranged.withColumn("__own", F.row_number().over(W.partitionBy("__part", *by).orderBy(*order)))
    sizes = ranged.groupBy(*by, "__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy(*(by or [F.lit(0)])).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")  # a row a range
    return own.join(sizes, [*by, "__part"]).withColumn(out, F.col("__own") + F.col("__before")).drop("__part", "__own", "__before")

"""Incremental ingest: new files of assimilated reads become fragments batch by batch.

Evaluation itself is a batch computation; this only saves reading old runs again.
Each micro-batch is written to a folder of its own, so a repeated batch replaces
itself, and the fragments of all batches are summed when they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluation import RANGE


def follow_reads(spark: SparkSession, source: str, schema, target: str, checkpoint: str):
    """A query that ends when the files present have been taken in."""

    def write(batch: DataFrame, number: int) -> None:
        level = batch.groupBy(*RANGE, "specimen", "sampleName", "umitag").agg(F.sum("contrib").alias("sum"), F.max("contrib").alias("max"))
        level.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fragments_so_far(spark: SparkSession, target: str) -> DataFrame:
    """The fragments of all batches, as operators.evaluation.fragments has them for one table."""
    level = spark.read.parquet(target).groupBy(*RANGE, "specimen", "sampleName", "umitag").agg(F.sum("sum").alias("c"), F.max("max").alias("m"))
    return level.groupBy(*RANGE, "specimen", "sampleName").agg(F.sum("c").alias("count"), F.coalesce(F.sum(F.when(F.col("umitag").isNotNull(), F.col("m"))), F.lit(0.0)).alias("umitag"), F.max("m").alias("contrib"))

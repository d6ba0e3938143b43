"""Data frames behind the figures of a report; drawing them is left to others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sequences import divergence
from .intervals import coverage, tile_counts


def genome_offsets(contigs: DataFrame, width: int, order: str = "seqnames") -> DataFrame:
    """(seqnames, offset): where each contig begins on an axis of all, lengths rounded up to whole tiles; a row a contig."""
    size = F.ceil(F.col("length") / width) * width
    before = F.sum(size).over(W.orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return contigs.select("seqnames", F.coalesce(before, F.lit(0)).cast("long").alias("offset"))


def density_track(df: DataFrame, contigs: DataFrame, width: int, by: list[str] = (), cutoff: int = 2, adj: int = 1, drop_alt: bool = True) -> DataFrame:
    """Tiles of each group with at least `cutoff` ranges: count, log_count, its share of the group's largest, and their place on the axis of all contigs."""
    own = contigs.where(~F.contains("seqnames", F.lit("_"))) if drop_alt else contigs
    counts = tile_counts(df, width, list(by)).join(F.broadcast(genome_offsets(own, width)), "seqnames").withColumn("log_count", F.log10(F.col("count") + adj))
    if by:
        counts = counts.join(counts.groupBy(*by).agg(F.max("log_count").alias("__top")), list(by))
    else:
        counts = counts.join(F.broadcast(counts.agg(F.max("log_count").alias("__top"))))  # one row
    out = counts.where(F.col("count") >= cutoff).withColumn("norm_log_count", F.col("log_count") / F.col("__top"))
    return out.select(*by, "seqnames", "start", "count", "log_count", "norm_log_count", (F.col("offset") + F.col("start")).alias("adj_start"), (F.col("offset") + F.col("start") + width - 1).alias("adj_end"))


def coverage_track(df: DataFrame, resolution: int = 10) -> DataFrame:
    """Windows with their counts upwards (+) and downwards (-)."""
    return coverage(df, resolution).select("seqnames", "start", F.col("plus"), (-F.col("minus")).alias("minus"))


def divergence_grid(df: DataFrame, column: str, ref: str, key: str, fill: str = "left") -> DataFrame:
    """(key, place, letter) of each sequence beside a reference: a dot where they agree, N where the sequence is shorter."""
    letters = divergence(F.col(column), ref, fill=fill)
    return df.select(key, F.explode(F.sequence(F.lit(1), F.lit(len(ref)))).alias("place"), letters.alias("__l")).select(key, "place", F.substring("__l", F.col("place"), F.lit(1)).alias("letter"))

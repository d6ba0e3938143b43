"""Bounded, deterministic samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A fit reads at most so many stretches of so many characters of each sampled text, dealt over the whole of it.
STRETCHES, STRETCH = 8, 2048


def residue(column: str, modulus: int):
    """crc32 of a key as text, modulo `modulus`; 0 for null keys."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def share_of(key: Column) -> Column:
    """A number from 0 to 1 by the key's hash."""
    return F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 40)) / float(1 << 40)


def stretches(text: Column, many: int = STRETCHES, length: int = STRETCH) -> Column:
    """The text, or of one longer than many * length characters a stretch from each of `many` equal parts, at a hashed place in it."""
    size = F.char_length(text)
    part = size / F.lit(many)
    places = [F.floor(part * k + share_of(F.concat_ws(":", F.lit(str(k)), F.substring(text, 1, 64), size)) * (part - length)) + 1 for k in range(many)]
    return F.when(size > many * length, F.concat_ws(" ", *(F.substr(text, p.cast("int"), F.lit(length)) for p in places))).otherwise(text)


def class_counts(labels: DataFrame, target: str, modulus: int = 3, held_out: int = 1) -> dict[int, int]:
    """Learnable rows by label."""
    got = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & (residue("doc_id", modulus) != held_out)).groupBy(F.col(target).cast("int").alias("k")).count().collect()
    return {0: 0, 1: 0} | {r["k"]: r["count"] for r in got}


def labelled(docs: DataFrame, labels: DataFrame, target: str, counts: dict[int, int], max_rows: int, modulus: int = 3, held_out: int = 1):
    """At most max_rows (text, label) rows outside the held-out fold as an Arrow table, the least hashed ids of each class first; texts as `stretches` has them.

    Only ids and labels are ranked, and of those only the share by hash that the bound can reach, so what
    tasks send is bounded by max_rows, not by their number; the texts of the chosen ids are then fetched
    by a join whose small side is max_rows long at most.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & (residue("doc_id", modulus) != held_out)).select("doc_id", F.col(target).cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("place", share_of(F.col("doc_id")))
    half = max_rows // 2
    picks = [known.where((F.col("label") == k) & (F.col("place") <= 2.0 * half / max(1, counts[k]))).orderBy("place", "doc_id").limit(half) for k in (0, 1)]
    chosen = picks[0].unionByName(picks[1])
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").withColumn("text", stretches(F.col("text")))
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"), F.min("place").alias("place")).orderBy("place", "doc_id").select("text", "label").toArrow()

"""From raw reads to the sequences that are aligned: demultiplexing, trimming, filtering, consolidation, as one plan.

Reads come as FASTQ of both ends (R1, R2) and of the index reads (I1, I2); samples
as a sheet.  R2 reads the anchored end, whose lead is the primer; R1 the adrift end,
whose lead holds the UMI under ambiguous codes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reads as rd
from ..operators.staging import staged
from ..sources import writers


@dataclass
class RunConfig:
    """What the read-handling stages need."""

    barcode1_length: int = 8
    barcode2_length: int = 8
    barcode_mismatch: int = 0
    r1_lead: str = ""
    r2_lead: str = ""
    r1_tail: str = ""
    r2_tail: str = ""
    lead_mismatch: int = 1
    tail_identity: float = 0.95
    quality: str = "?"
    min_length: int = 30
    umis: bool = False
    consolidate: bool = True

    @classmethod
    def of(cls, raw: dict) -> "RunConfig":
        return cls(**{k: v for k, v in raw.items() if k in cls.__dataclass_fields__})


def demultiplex(index1: DataFrame, index2: DataFrame | None, sheet: DataFrame, config: RunConfig) -> DataFrame:
    """(key, sampleName) of every read; those without a sample are degenerate, ambiguous or unassigned.

    Barcodes are cut to the barcode length, as the index reads are; ambiguous codes in them stand for their bases.
    """
    lengths = {"barcode1": config.barcode1_length} | ({} if index2 is None else {"barcode2": config.barcode2_length})
    for column, length in lengths.items():
        sheet = sheet.withColumn(column, F.upper(F.substring(column, 1, length)))
    codes = {c: sorted(r[0] for r in sheet.select(c).where(F.length(c) > 0).distinct().collect()) for c in lengths}  # a sheet is a few rows
    classes = [rd.classify_barcodes(rd.with_key(reads), codes[c], lengths[c], config.barcode_mismatch) for c, reads in zip(lengths, (index1, index2))]
    return rd.assign_samples(classes[0], classes[1] if index2 is not None else None, sheet.select("sampleName", *lengths))


def index_umis(index2: DataFrame, assigned: DataFrame, sheet: DataFrame, config: RunConfig) -> DataFrame:
    """(key, umitag): the ambiguous part of each sample's second barcode, as the index read has it; reads that don't fit have none."""
    patterns: dict[str, list[str]] = {}
    for r in sheet.select("sampleName", F.upper("barcode2").alias("code")).collect():  # a sheet is a few rows
        if set(r["code"] or "") - set("ACGT"):
            patterns.setdefault(r["code"], []).append(r["sampleName"])
    reads = rd.with_key(index2).join(assigned, "key")
    out = reads.select("key", F.lit(None).cast("string").alias("umitag")).where(F.lit(False))
    for code, samples in patterns.items():
        own = rd.lead_trim(reads.where(F.col("sampleName").isin(samples)), code, 0, config.barcode_mismatch, "umitag")
        out = out.unionByName(own.where("umitag IS NOT NULL").select("key", "umitag"))
    return out


def from_samples(ends: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(key, sampleName) of reads that are already in files by sample: sampleName -> the reads of each end.

    A sample's reads count where every one of its files has them.  A read in two samples is an error of the sheet, told
    where its rows are used: it has a row for each.
    """
    parts = [rd.shared_keys([rd.with_key(x) for x in files.values()]).withColumn("sampleName", F.lit(name)) for name, files in ends.items()]
    return reduce(DataFrame.unionByName, parts)


def trim_end(reads: DataFrame, lead: str, tail: str, config: RunConfig, collect: str | None = None) -> DataFrame:
    """Reads after quality, lead and over-read trimming that are long enough."""
    own = rd.quality_trim(reads, threshold=config.quality)
    if lead:
        own = rd.lead_trim(own, lead, 0, config.lead_mismatch, collect)
    if tail:
        own = rd.overread_trim(own, tail, config.tail_identity)
    return rd.min_length(own, config.min_length)


def process_reads(r1: DataFrame, r2: DataFrame, index1: DataFrame | None, index2: DataFrame | None, sheet: DataFrame, config: RunConfig, assigned: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables that alignment starts from, each read once from what the stage before wrote.

    reads: both trimmed ends of each read with a sample (read_id, sampleName, r1, r2, umitag); r1 and r2: distinct
    sequences by sample with seq_id; r1_keys and r2_keys: (readNames, seqID); stats: (sampleName, metric, count).
    UMIs are taken from the second index read where the sheet's second barcodes have ambiguous codes, else from R1's lead.
    assigned: (key, sampleName) of reads that need no demultiplexing.
    """
    assigned = staged(demultiplex(index1, index2, sheet, config) if assigned is None else assigned)
    named = assigned.join(F.broadcast(sheet.select("sampleName").distinct()), "sampleName")
    with_sample = lambda reads: rd.with_key(reads).join(named, "key")
    by_index = config.umis and index2 is not None and "barcode2" in sheet.columns and not sheet.where(F.col("barcode2").rlike("(?i)[^acgt]")).isEmpty()
    umi = "umitag" if config.umis and not by_index and set(config.r1_lead) - set("ACGT") else None
    one = staged(trim_end(with_sample(r1), config.r1_lead, config.r1_tail, config, umi))
    two = staged(trim_end(with_sample(r2), config.r2_lead, config.r2_tail, config))
    if by_index:
        one = one.join(index_umis(index2, named, sheet, config), "key", "left")
    elif umi is None:
        one = one.withColumn("umitag", F.lit(None).cast("string"))
    both = staged(one.select("key", "sampleName", F.col("seq").alias("r1"), "umitag").join(two.select("key", F.col("seq").alias("r2")), "key").select(F.col("key").alias("read_id"), "sampleName", "r1", "r2", "umitag"))
    out = {"assigned": assigned, "reads": both}
    for end in ("r1", "r2"):
        own = both.select("read_id", "sampleName", F.col(end).alias("seq"))
        if config.consolidate:
            distinct, keys = rd.consolidate(own, "seq", "sampleName")
            name = F.concat_ws(":", "sampleName", "seq_id")
            out[end] = distinct.select("sampleName", name.alias("seq_id"), "seq")
            out[f"{end}_keys"] = keys.select(F.col("read_id").alias("readNames"), name.alias("seqID"))
        else:
            out[end] = own.withColumnRenamed("read_id", "seq_id")
            out[f"{end}_keys"] = own.select(F.col("read_id").alias("readNames"), F.col("read_id").alias("seqID"))
    count = lambda df, metric: df.groupBy("sampleName").agg(F.count("*").cast("double").alias("count")).select("sampleName", F.lit(metric).alias("metric"), "count")
    stats = [count(assigned, "demulti.reads"), count(one, "R1.trim.reads"), count(two, "R2.trim.reads"), count(both, "filt.reads")]
    if umi or by_index:
        stats.append(count(one.where("umitag IS NOT NULL"), "umitags.reads"))
    if config.consolidate:
        stats += [count(out[e], f"{e.upper()}.consol.reads") for e in ("r1", "r2")]
    total = stats[0]
    for part in stats[1:]:
        total = total.unionByName(part)
    out["stats"] = total
    return out


def write_run(tables: dict[str, DataFrame], folder: str) -> None:
    """FASTA by sample of either end, key files, read tables and statistics below `folder`."""
    for end in ("r1", "r2"):
        writers.fasta(tables[end].select(F.col("seq_id").alias("read_id"), "seq", "sampleName"), f"{folder}/{end}.fasta", ["sampleName"])
        writers.table(tables[f"{end}_keys"], f"{folder}/{end}_keys.csv")
    writers.table(tables["reads"], f"{folder}/reads.parquet")
    writers.table(tables["assigned"], f"{folder}/assigned.parquet")
    writers.stats(tables["stats"], f"{folder}/run.stat")


def write_demultiplexed(ends: dict[str, DataFrame], assigned: DataFrame, folder: str, rows_a_file: int = 1 << 22) -> None:
    """The raw reads of each end as gzip FASTQ by sample, those that are degenerate, ambiguous or unassigned included."""
    for name, reads in ends.items():
        own = rd.with_key(reads).join(assigned, "key").drop("key")
        writers.fastq_by_sample(own, f"{folder}/{name}.fastq", rows_a_file)

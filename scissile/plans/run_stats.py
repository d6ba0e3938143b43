"""What became of a run's reads, sample by sample: attrition of reads, outcomes of alignment, and where incorporations lie."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignments, evaluation as ev

#: The metrics of each table in order, as the stages name them.
ATTRITION = ["demulti.reads", "R1.trim.reads", "R1.primer.trim.reads", "R2.primer.trim.reads", "R2.trim.reads", "umitags.reads", "filt.reads", "R1.consol.reads", "R2.consol.reads", "align.unique.reads", "align.chimera.reads", "align.multihit.reads"]
OUTCOMES = ["align.unique.reads", "align.unique.algns", "align.unique.loci", "align.multihit.reads", "align.multihit.lengths", "align.multihit.clusters", "align.chimera.reads"]
INCORPORATION = ["eval.total.algns", "eval.combined.algns", "eval.pileup.algns", "eval.paired.algns", "eval.matched.algns", "eval.ontarget.algns", "eval.offtarget.algns"]
UNIQUE = {"reads": "align.unique.reads", "aligns": "align.unique.algns", "loci": "align.unique.loci"}
#: Reads of no sample.
APART = ["ambiguous", "degenerate", "unassigned", "ambiguous_reads", "degenerate_reads", "unassigned_reads"]


def unique_stats(reads: DataFrame) -> DataFrame:
    """(sampleName, metric, count) of the unique alignments among assembled reads (recovered multihits aren't), counted anew."""
    own = alignments.assembly_stats(reads.where("type = 'uniq'"))
    return own.select("sampleName", reduce(lambda c, k: F.when(F.col("metric") == k, UNIQUE[k]).otherwise(c), UNIQUE, F.lit(None).cast("string")).alias("metric"), "count")


def incorporation_stats(flagged: DataFrame) -> DataFrame:
    """(sampleName, metric, count): abundance under each criterion, of an alignment once however many combinations it was shown to.

    Matches count once a site and target.
    """
    keys = ["sampleName", "seqnames", "start", "end", "strand", "abund"]
    tests = {"eval.combined.algns": "probable", "eval.pileup.algns": "is_pileup", "eval.paired.algns": "is_paired"}
    once = flagged.groupBy(*keys).agg(*(F.max(c).alias(c) for c in tests.values()))
    own = once.groupBy("sampleName").agg(F.sum("abund").alias("eval.total.algns"), *(F.sum(F.when(F.col(c), F.col("abund")).otherwise(0)).alias(m) for m, c in tests.items()))
    hits = flagged.where("is_matched").select(*keys, "edit_site", "target_match", "on_off_target").distinct()
    on = {"eval.ontarget.algns": "On-target", "eval.offtarget.algns": "Off-target"}
    met = hits.groupBy("sampleName").agg(F.sum("abund").alias("eval.matched.algns"), *(F.sum(F.when(F.col("on_off_target") == k, F.col("abund")).otherwise(0)).alias(m) for m, k in on.items()))
    long = lambda df: df.unpivot("sampleName", [f"`{c}`" for c in df.columns[1:]], "metric", "count")
    return long(own).unionByName(long(met))


def _table(stats: DataFrame, metrics: list[str], start: str, end: str) -> DataFrame:
    """Samples in order, those of no sample last; names lose `start` and `end`, and have _ for dots."""
    wide = ev.stat_matrix(stats, metrics)
    short = {m: m.removeprefix(start).removesuffix(end).replace(".", "_") for m in metrics}
    return wide.select("sampleName", *(F.col(f"`{m}`").cast("long").alias(n) for m, n in short.items())).orderBy(F.col("sampleName").isin(APART), "sampleName")


def run_stats(core: DataFrame, evaluated: DataFrame | Callable[[], DataFrame], reads: DataFrame, umis: bool = True, consolidated: bool = True, alternate_umis: bool = False, names: DataFrame | None = None, tables: list[str] = ("attrition", "outcomes", "incorporation")) -> dict[str, DataFrame]:
    """The three tables of a run: attrition, outcomes, incorporation; a sample that any of the inputs knows has a row, with zeros.

    core and evaluated: long (sampleName, metric, count), parts of a sample added up; the counts of unique
    alignments that core has are replaced by those of `reads` (sampleName, ID, seqnames, start, end, strand, type), in
    which multihits may since have been recovered.  Reads of no sample are in the first table alone.  alternate_umis: the
    primer was trimmed from R1 instead of R2.

    names: (sampleName) of the samples in `evaluated`.  With them each table is made of the inputs whose counts it shows, so
    that a table without incorporations doesn't wait for the evaluation; only the others' names are read.  tables: which
    are made; `evaluated` may be a function, called only if its counts are shown.
    """
    if names is not None:
        return _apart(core, evaluated, reads, umis, consolidated, alternate_umis, names, tables)
    evaluated = evaluated() if callable(evaluated) else evaluated
    every = core.where(~F.col("metric").isin(list(UNIQUE.values()))).select("sampleName", "metric", F.col("count").cast("double").alias("count"))
    for part in (evaluated, unique_stats(reads)):
        every = every.unionByName(part.select("sampleName", "metric", F.col("count").cast("double").alias("count")))
    return _tables(every, umis, consolidated, alternate_umis, tables)


def _apart(core, evaluated, reads, umis, consolidated, alternate_umis, names, tables):
    """The tables, each of the inputs whose counts it shows and of the names of the rest."""
    long = lambda df: df.select("sampleName", "metric", F.col("count").cast("double").alias("count"))
    core = long(core.where(~F.col("metric").isin(list(UNIQUE.values()))))
    seen = lambda df: df.select("sampleName").distinct().select("sampleName", F.lit("").alias("metric"), F.lit(0.0).alias("count"))
    out = {}
    for table in tables:
        if table == "incorporation":
            every = core.unionByName(seen(reads.where("type = 'uniq'"))).unionByName(long(evaluated() if callable(evaluated) else evaluated))
        else:
            every = core.unionByName(long(unique_stats(reads))).unionByName(seen(names))
        out |= _tables(every, umis, consolidated, alternate_umis, [table])
    return out


def _tables(every: DataFrame, umis: bool, consolidated: bool, alternate_umis: bool, tables: list[str]) -> dict[str, DataFrame]:
    gone = {"umitags.reads"} if not umis else set()
    gone |= set() if consolidated else {"R1.consol.reads", "R2.consol.reads"}
    gone |= {"R2.primer.trim.reads"} if alternate_umis else {"R1.primer.trim.reads"}
    placed = every.where(~F.col("sampleName").isin(APART))
    shown = {
        "attrition": (every, [m for m in ATTRITION if m not in gone], "", ".reads"),
        "outcomes": (placed, OUTCOMES, "align.", ""),
        "incorporation": (placed, INCORPORATION, "eval.", ".algns"),
    }
    return {k: _table(*shown[k]) for k in tables}

"""The tables of an evaluation as a reader gets them: titles, filters by power and likelihood, a sequence table a condition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tables that a summary reads.
NEEDED = ["eval_summary", "algnmts", "specimen_totals", "combos", "on_target", "efficiency", "inclusion", "off_target", "enrichment", "off_target_sequences", "pileup_summary", "matched_summary", "paired_regions"]


def specimen_spread(algnmts: DataFrame) -> DataFrame:
    """alt_specimen with its abundance on target, off target and without an edit site, 0 where there is none."""
    kind = F.when(F.col("edit_site").isNull(), "Independent").otherwise(F.col("on_off_target"))
    return algnmts.groupBy("alt_specimen", kind.alias("__k")).agg(F.sum("abund").alias("__a")).groupBy("alt_specimen").pivot("__k", ["On-target", "Off-target", "Independent"]).agg(F.sum("__a")).fillna(0)


def summary_tables(frames: dict[str, DataFrame], power: float = 0.0, mesl: float = 0.0) -> dict[str, DataFrame]:
    """Title to table, in order.  power: least test power (percent) of an enrichment row; mesl: least likelihood of a sequence.

    Conditions number tens, so a table for each is listed on the driver.
    """
    out = {
        "1. Analysis overview": frames["eval_summary"].fillna(0, ["abundance", "predicted_off_targets"]),
        "2. Specimens: abundance by kind of site": specimen_spread(frames["algnmts"]),
        "3. Specimens: reads, UMIs and alignments": frames["specimen_totals"],
        "4. Combinations of nuclease and treatment": frames["combos"],
        "5. On-target share under each criterion (percent)": frames["on_target"],
        "6. On-target efficiency by target (percent)": frames["efficiency"],
        "7. Share of on-target breaks within reach of the cut": frames["inclusion"],
        "8. Off-target loci under each criterion": frames["off_target"],
        "9. Gene enrichment": frames["enrichment"].where((F.col("onco_power") >= power / 100) | (F.col("special_power") >= power / 100)),
    }
    sequences = frames["off_target_sequences"]
    sequences = sequences.where(F.col("MESL") >= mesl) if mesl > 0 else sequences
    by = "annotation" if "annotation" in sequences.columns else "combo"  # conditions of a support file, or combinations
    names = [r[0] for r in sequences.select(by).distinct().orderBy(by).collect()]
    for i, name in enumerate(names, 10):
        out[f"{i}. Loci of {name}"] = sequences.where(F.col(by).eqNullSafe(name)).drop(by)
    return out

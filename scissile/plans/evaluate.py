"""Whole runs: reads to assigned samples, alignments to assimilated reads, reads to an evaluation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import expand_positions
from ..operators import alignments, evaluation as ev, intervals, targets
from ..operators.staging import staged
from ..operators.targets import several
from .run_stats import incorporation_stats


@dataclass
class Config:
    """What a run needs; absent values are None, never False."""

    up: int = 100
    down: int = 30
    pileup_min: int = 3
    max_target_mismatch: int = 6
    abundance: str = "fragment"
    max_align_start: int = 5
    min_percent_identity: float = 95.0
    min_template: int = 30
    max_template: int = 2500
    recover_multihits: bool = False
    targets: dict = field(default_factory=dict)
    profiles: dict = field(default_factory=dict)
    on_targets: dict = field(default_factory=dict)
    onco: list = field(default_factory=list)
    special: list = field(default_factory=list)
    umis: bool | None = None

    @classmethod
    def of(cls, raw: dict) -> "Config":
        return cls(**{k: None if v is False and k not in ("recover_multihits", "umis") else v for k, v in raw.items() if k in cls.__dataclass_fields__})


def reconcile(configs: list[Config]) -> Config:
    """One configuration for runs that are evaluated together.

    The first run's parameters hold, with the targets, on-target sites and nuclease profiles of all: each distinct sequence
    of a target's name, each distinct site of it, and of profiles of one name the first.  Multihits count if all runs
    recover them; distances and the pile-up minimum must then agree.  UMIs as the measure need UMIs in every run.
    """
    first = configs[0]
    multihits = all(c.recover_multihits for c in configs)
    differing = [n for n in ("up", "down", "pileup_min") if len({getattr(c, n) for c in configs}) > 1]
    if multihits and differing:
        raise ValueError(f"runs whose multihits are recovered must agree in {', '.join(differing)}")
    if first.abundance == "umi" and any(c.umis is False for c in configs):
        raise ValueError("abundance by UMIs needs UMIs in every run")
    seqs, sites, profiles = {}, {}, {}
    for c in configs:
        for name, value in (c.targets or {}).items():
            seqs.setdefault(name, {}).update({x.upper(): None for x in several(value)})
        for name, value in (c.on_targets or {}).items():
            sites.setdefault(name, {}).update(dict.fromkeys(several(value)))
        for name, value in (c.profiles or {}).items():
            profiles.setdefault(name, value)
    held = lambda found: {n: list(v) for n, v in found.items()}
    return replace(first, recover_multihits=multihits, targets=held(seqs), on_targets=held(sites), profiles=profiles)


def considered(config: Config, specimens: DataFrame) -> tuple[dict, dict]:
    """(targets, on-target sites) of those targets that a sheet's treatments name, Mock aside; a sheet is a few rows."""
    named = {t for r in specimens.select("treatment").distinct().collect() for t in (r["treatment"] or "").split(";")} - {"Mock"}
    own = lambda name: re.match(r"[\w\-.]*", name)[0]
    return {n: v for n, v in config.targets.items() if own(n) in named}, {n: v for n, v in (config.on_targets or {}).items() if own(n) in named}


def assimilate(anchor_psl: DataFrame, adrift_psl: DataFrame, keys: DataFrame, config: Config, umis: DataFrame | None = None) -> dict[str, DataFrame]:
    """Alignments of both ends to unique reads (with recovered multihits), pair classes, multihits, and (sampleName, metric, count) of the classes."""
    good = lambda psl: alignments.extended_ranges(alignments.quality_filter(alignments.drop_alt(psl), config.min_percent_identity, config.max_align_start))
    anchor, adrift = (staged(alignments.known_hits(good(p), keys, k)) for p, k in ((anchor_psl, "anchor_key"), (adrift_psl, "adrift_key")))
    coupled = staged(alignments.couple(keys, anchor, adrift, config.min_template, config.max_template))
    unique = alignments.unique_reads(keys, coupled)
    multi_hits = coupled.where("n_loci > 1")
    reads = unique.withColumn("type", F.lit("uniq")).withColumn("contrib", F.lit(1.0))
    if config.recover_multihits:
        multi = alignments.unique_reads(keys, multi_hits.withColumn("n_loci", F.lit(1)))
        reads = alignments.recover_multihits(unique, multi)
    reads = alignments.attach_umis(reads, umis) if umis is not None else reads.withColumn("umitag", F.lit(None).cast("string"))
    classes = staged(alignments.classify_pairs(keys, coupled, anchor, adrift))
    stats = alignments.outcome_stats(keys, classes).withColumn("metric", F.concat(F.lit("align."), "metric"))
    return {"reads": reads, "classes": classes, "multihits": multi_hits, "stats": stats}


def on_target_positions(spark, on_targets: dict) -> DataFrame:
    """(target, position): the listed on-target positions, one by one; a target's name ends at its first other character."""
    listed = [(name, p) for name, ps in on_targets.items() for p in several(ps)]
    rows = spark.createDataFrame(listed, "name string, p string").withColumn("target", F.regexp_extract("name", r"[\w\-.]+", 0))
    return expand_positions(rows, "p").select("target", "position").distinct()


def place_of(position):
    """(seqnames, pos) of a position chr:strand:pos."""
    return F.element_at(F.split(position, ":"), 1).alias("seqnames"), F.element_at(F.split(position, ":"), -1).cast("long").alias("pos")


def with_genes(summaries: dict[str, tuple], genes: DataFrame, config: Config) -> dict[str, DataFrame]:
    """Each summary, given with its place (seqnames, pos), with the gene_id of the place; places are annotated once for all."""
    marked = {n: df.withColumn("__s", place[0]).withColumn("__p", place[1]) for n, (df, place) in summaries.items()}
    places = None
    for df in marked.values():
        own = df.select(F.col("__s").alias("seqnames"), F.col("__p").alias("pos"))
        places = own if places is None else places.unionByName(own)
    found = staged(intervals.annotate_genes(places.distinct(), genes, "pos", config.onco or [], config.special or []).select(F.col("seqnames").alias("__s"), F.col("pos").alias("__p"), "gene_id"))
    return {n: df.join(found, ["__s", "__p"], "left").drop("__s", "__p") for n, df in marked.items()}


def enrichment(summaries: dict[str, DataFrame], genes: DataFrame, conditions: DataFrame, config: Config) -> DataFrame:
    """Rates of onco and special genes among the pile-ups, pairs and matches of each annotation against those of the gene list, with adjusted p and power.

    Driver-side once the genes are counted: a row a condition.
    """
    spark = genes.sparkSession
    rows = [{"origin": "Reference", "annotation": "--"} | ev.reference_counts(genes, config.onco or [], config.special or []).head().asDict()]
    for origin, df in summaries.items():
        own = df.join(F.broadcast(conditions), "alt_specimen")
        counted = ev.gene_counts(own, ["annotation"], each_row=origin == "Target Matched").orderBy("annotation").collect()
        rows += [{"origin": origin} | r.asDict() for r in counted]
    rows = [r for r in rows if r["total"] > 0]
    kinds = "origin string, annotation string, total long, onco long, onco_p double, onco_power double, special long, special_p double, special_power double"
    if not rows or rows[0]["origin"] != "Reference":
        return spark.createDataFrame([], kinds)
    tests = {k: (ev.enrichment_tests(rows, k), ev.power_of(rows, k)) for k in ("onco", "special")}
    out = [(r["origin"], r["annotation"], r["total"], *(x for k, (p, w) in tests.items() for x in (r[k], p[i][f"{k}_adj_p"], w[i]))) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, kinds)


def evaluate(reads: DataFrame, specimens: DataFrame, contigs: DataFrame, genes: DataFrame, config: Config, support: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of an evaluation.  specimens: specimen, nuclease, treatment, ord; support: specimen, ord and columns that name its condition.

    Tables that many others read are written once: fragments, alignments, those that meet a criterion, and the summaries.
    """
    spark = reads.sparkSession
    if support is not None:
        specimens = ev.restrict(specimens, support)
    spec = specimens.withColumn("nuclease", ev.normalise_mock(F.col("nuclease"))).withColumn("treatment", ev.normalise_mock(F.col("treatment")))
    aims, on_targets = considered(config, spec)
    combos = ev.combinations(spec)
    fan = ev.fan_out(spec, combos).join(combos, "combo")
    told = [c for c in support.columns if c not in ("specimen", "ord", "run_set")] if support is not None else []
    conditions = ev.annotate_conditions(spec.join(support.drop("ord", *[c for c in spec.columns if c != "specimen"]), "specimen"), told) if told else ev.annotate_conditions(spec, ["nuclease", "treatment"])
    conditions = conditions.select("specimen", "annotation", "annot_ord")
    frags = staged(ev.with_abundance(ev.fragments(reads.withColumn("specimen", F.regexp_extract("sampleName", r"^\w+", 0))), config.abundance))
    own = frags.join(F.broadcast(fan), "specimen")
    own = intervals.identify_pairs(intervals.pileup_clusters(own, ["alt_specimen"]), ["alt_specimen"], 2 * config.up)
    own = own.withColumn("pos", place_of(F.col("clus_ori"))[1])
    sites = targets.site_sequences(own, contigs, config.up, config.down)
    matched = None
    for name, profile in config.profiles.items():  # a few nucleases
        part = targets.compare_targets(sites, aims, profile, config.up, config.down, config.max_target_mismatch).withColumn("nuclease", F.lit(name))
        matched = part if matched is None else matched.unionByName(part)
    found = own.join(matched.drop("site_seq"), ["nuclease", "seqnames", "pos", "strand"], "left").withColumn("target_match", F.coalesce("target_match", F.lit(targets.NO_MATCH)))
    treat = fan.select("alt_specimen", F.split("treatment", ";").alias("treatment"))
    algnmts = staged(targets.treated_only(found, treat.withColumnRenamed("alt_specimen", "specimen"), "alt_specimen"))
    on = staged(on_target_positions(spark, on_targets))
    flagged = staged(ev.on_target_flag(ev.criteria(algnmts, config.pileup_min), on.select("position")).join(F.broadcast(conditions), "specimen"))
    probable = flagged.where("probable")
    # Summaries and the genes at their places.
    aimed = treat.withColumn("target", F.explode("treatment")).join(on, "target").select("alt_specimen", *place_of(F.col("position"))).distinct()
    summaries = {
        "matched_summary": ev.matched_summary(probable.where("is_matched")),
        "pileup_summary": ev.pileup_summary(probable.where("is_pileup")),
        "paired_regions": ev.paired_on_target(ev.paired_regions(probable.where("is_paired")), aimed, down=config.down),
    }
    places = {"matched_summary": place_of(F.col("edit_site")), "pileup_summary": place_of(F.col("clus_ori")), "paired_regions": (F.col("seqnames"), F.floor("mid"))}
    summaries = {n: staged(df) for n, df in with_genes({n: (df, places[n]) for n, df in summaries.items()}, genes, config).items()}
    # Distances from the cut, of each alignment's own 5' point.
    own_genes = summaries["matched_summary"].select("edit_site", "gene_id").distinct()
    edit = place_of(F.col("edit_site"))[1]
    dist = probable.where("is_matched").withColumn("dist", ev.edit_distance(F.col("start"), F.col("end"), edit, F.col("strand"))).withColumn("target", F.regexp_extract("target_match", r"\w+", 0))
    dist = staged(dist.join(own_genes, "edit_site", "left"))
    on_dist = dist.where("on_off_target = 'On-target'")
    grid = staged(ev.density_grid(on_dist, ["annotation"], high=float(config.up)))
    mesl = staged(ev.max_likelihood(dist, grid))
    # Percentages on target and counts off it.
    piled = flagged.where("is_pileup")
    by = ["alt_specimen"]
    percents = [ev.on_target_percent(df, by, f"pct_{n}") for n, df in (("all", flagged), ("probable", probable), ("pile", piled), ("pair", summaries["paired_regions"]), ("match", summaries["matched_summary"]))]
    counts = [ev.off_target_counts(df, by, f"n_{n}") for n, df in (("all", flagged), ("probable", probable), ("pile", piled))]
    counts += [ev.off_target_rows(df, by, f"n_{n}") for n, df in (("pair", summaries["paired_regions"]), ("match", summaries["matched_summary"]))]
    combo_overview = fan.select("alt_specimen", "specimen").join(F.broadcast(conditions.select("specimen", "annotation")), "specimen").select("alt_specimen", "specimen", "annotation")
    listed = combo_overview.select("alt_specimen", "annotation")
    on_table, off_table = ev.joined_summaries(listed, *percents, on="alt_specimen"), ev.joined_summaries(listed, *counts, on="alt_specimen")
    names = sorted(aims)
    wide = ev.efficiency_pivot(summaries["matched_summary"], names)
    efficiency = listed.join(wide, "alt_specimen", "left")
    totals = ev.specimen_totals(flagged)
    overview = ev.joined_summaries(combo_overview, ev.efficiency_ranges(efficiency, names), off_table.select("alt_specimen", F.col("n_match").alias("predicted_off_targets")), on="alt_specimen", how="full")
    abundance = {"umi": "umitags", "read": "reads"}.get(config.abundance, "algns")
    summary = overview.join(totals.select("specimen", F.col(abundance).alias("abundance")), "specimen", "full").select("alt_specimen", "annotation", "abundance", "efficiency", "predicted_off_targets")
    by_annotation = summaries["matched_summary"].join(F.broadcast(listed), "alt_specimen").withColumn("combo", F.regexp_extract("alt_specimen", r"\((.*)\)$", 1))
    # The first combination of each specimen stands for it among pile-ups and pairs.
    firsts = fan.groupBy("specimen").agg(F.min("alt_specimen").alias("alt_specimen")).join(F.broadcast(conditions), "specimen").select("alt_specimen", "annotation")
    held = {"Pile Ups": summaries["pileup_summary"], "Flanking Pairs": summaries["paired_regions"]}
    held = {n: df.join(F.broadcast(firsts.select("alt_specimen")), "alt_specimen", "left_semi") for n, df in held.items()} | {"Target Matched": summaries["matched_summary"]}
    return summaries | {
        "combos": combos, "algnmts": flagged, "specimen_totals": totals, "criteria_stats": ev.criteria_stats(flagged), "incorporation_stats": incorporation_stats(flagged), "on_target": on_table, "off_target": off_table,
        "efficiency": efficiency, "eval_summary": summary, "distance_histogram": ev.distance_histogram(on_dist, ["annotation", "target"]), "density": grid, "inclusion": ev.inclusion(on_dist, ["annotation", "target"], config.up),
        "mesl": mesl, "off_target_sequences": ev.off_target_sequences(by_annotation, mesl, ("combo",) if support is None else ("annotation",)), "enrichment": enrichment(held, genes, listed, config),
    }

"""From assimilated reads to the tables of an evaluation: fragments, abundance, criteria, summaries, models."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.strings import combo_symbols

RANGE = ["seqnames", "start", "end", "strand"]


# ---- who was treated how ------------------------------------------------------------------------


def treatment_info(form, sample_info: list[dict], specimen_of, none: str = "Mock") -> dict[str, str]:
    """specimen -> treatment or nuclease from one of three forms: 'sampleInfo:column', {'all': value} or {specimen: value}.

    Driver-side: a sample sheet is a few rows.
    """
    specimens = list(dict.fromkeys(specimen_of(r["sampleName"]) for r in sample_info))
    if isinstance(form, str) and form.startswith("sampleInfo:"):
        column = form.partition(":")[2]
        out = {}
        for r in sample_info:
            out.setdefault(specimen_of(r["sampleName"]), r.get(column) or none)
        return out
    if isinstance(form, dict) and set(form) == {"all"}:
        return {s: form["all"] or none for s in specimens}
    return {s: (form or {}).get(s) or none for s in specimens}


def normalise_mock(value):
    return F.when(F.lower(value).isin("mock", "none", "control"), "Mock").otherwise(value)


def combinations(specimens: DataFrame) -> DataFrame:
    """(combo, nuclease, treatment): a letter for each distinct pair without Mock, in order of `ord`; A for Mock alone.

    Specimens number tens; the letters are given on the driver.
    """
    real = specimens.where("nuclease <> 'Mock' AND treatment <> 'Mock'").groupBy("nuclease", "treatment").agg(F.min("ord").alias("o")).orderBy("o").collect()
    rows = [(r["nuclease"], r["treatment"]) for r in real] or [("Mock", "Mock")]
    return specimens.sparkSession.createDataFrame([(c, *r) for c, r in zip(combo_symbols(len(rows)), rows)], "combo string, nuclease string, treatment string")


def fan_out(specimens: DataFrame, combos: DataFrame) -> DataFrame:
    """(specimen, combo, alt_specimen): a Mock stands in every combination that it can be a control of."""
    c = F.broadcast(combos.select("combo", F.col("nuclease").alias("__n"), F.col("treatment").alias("__t")))
    fits = ((F.col("nuclease") == F.col("__n")) | (F.col("nuclease") == "Mock")) & ((F.col("treatment") == F.col("__t")) | (F.col("treatment") == "Mock"))
    return specimens.join(c, fits).select("specimen", "combo", F.concat("specimen", F.lit("("), "combo", F.lit(")")).alias("alt_specimen"))


def target_table(treatments: DataFrame, sequences: DataFrame, profiles: DataFrame) -> DataFrame:
    """(run_set, target, sequence, PAM): treatments split at ; with their sequences and the PAM of their run's nuclease."""
    each = treatments.withColumn("target", F.explode(F.split("treatment", ";"))).select("run_set", "nuclease", "target").distinct()
    return each.join(F.broadcast(sequences), ["run_set", "target"], "left").join(F.broadcast(profiles), ["run_set", "nuclease"], "left")


def annotate_conditions(specimens: DataFrame, columns: list[str]) -> DataFrame:
    """specimens with annotation: the columns joined by ' - ', null as NA; and annot_ord, its first appearance."""
    out = specimens.withColumn("annotation", F.concat_ws(" - ", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns]))
    return out.withColumn("annot_ord", F.min("ord").over(W.partitionBy("annotation")))


def restrict(df: DataFrame, support: DataFrame) -> DataFrame:
    """Rows of the support file's specimens, with its order as `ord`."""
    return df.drop("ord").join(F.broadcast(support.select("specimen", "ord")), "specimen")


def strip_target_suffix(name):
    return F.regexp_replace(name, r"'\d*$", "")


# ---- fragments ----------------------------------------------------------------------------------


def fragments(reads: DataFrame, by: list[str] = ("specimen", "sampleName")) -> DataFrame:
    """A row per range and sample: count (sum of contrib), umitag (each distinct UMI's largest contrib, summed), contrib (the largest).

    The UMI level aggregates first, so that hot ranges shrink before they meet.
    """
    level = reads.groupBy(*RANGE, *by, "umitag").agg(F.sum("contrib").alias("__c"), F.max("contrib").alias("__m"))
    return level.groupBy(*RANGE, *by).agg(F.sum("__c").alias("count"), F.coalesce(F.sum(F.when(F.col("umitag").isNotNull(), F.col("__m"))), F.lit(0.0)).alias("umitag"), F.max("__m").alias("contrib"))


def with_abundance(frags: DataFrame, mode: str = "fragment") -> DataFrame:
    return frags.withColumn("abund", F.col({"umi": "umitag", "read": "count", "fragment": "contrib"}[mode]))


# ---- criteria -----------------------------------------------------------------------------------


def pileups_of(algnmts: DataFrame, minimum: int = 3, scope: str = "global") -> DataFrame:
    """Rows in pile-ups of `minimum` alignments.  A pile-up of one specimen admits its origin in all of them, unless scope is `specimen`."""
    n = algnmts.groupBy("alt_specimen", "clus_ori").agg(F.count("*").alias("__n")).where(F.col("__n") >= minimum)
    keys = ["clus_ori"] if scope == "global" else ["alt_specimen", "clus_ori"]
    return algnmts.join(n.select(*keys).distinct(), keys, "left_semi")


def criteria(algnmts: DataFrame, minimum: int = 3, scope: str = "global") -> DataFrame:
    """algnmts with is_pileup, is_paired, is_matched and probable (any of them)."""
    keys = ["clus_ori"] if scope == "global" else ["alt_specimen", "clus_ori"]
    n = algnmts.groupBy("alt_specimen", "clus_ori").agg(F.count("*").alias("__n")).where(F.col("__n") >= minimum).select(*keys).distinct().withColumn("__p", F.lit(True))
    out = algnmts.join(n, keys, "left").withColumn("is_pileup", F.coalesce("__p", F.lit(False))).drop("__p")
    out = out.withColumn("is_paired", F.col("paired_algn").isNotNull()).withColumn("is_matched", F.coalesce(F.col("target_match") != "No_valid_match", F.lit(False)))
    return out.withColumn("probable", F.col("is_pileup") | F.col("is_paired") | F.col("is_matched"))


def on_target_flag(df: DataFrame, on_targets: DataFrame, column: str = "edit_site") -> DataFrame:
    """df with on_off_target; on_targets(position) are single positions, some tens."""
    own = F.broadcast(on_targets.select(F.col("position").alias(column)).distinct().withColumn("__on", F.lit(True)))
    return df.join(own, column, "left").withColumn("on_off_target", F.when(F.col("__on"), "On-target").otherwise("Off-target")).drop("__on")


# ---- summaries ----------------------------------------------------------------------------------


def joined_set(column, sep: str = ";"):
    return F.array_join(F.array_sort(F.collect_set(column)), sep)


def _totals() -> list:
    """What every summary adds up; alignments count by their contribution, so that a recovered multihit is a part of one."""
    return [F.sum("count").alias("count"), F.sum("umitag").alias("umitag"), F.sum("contrib").alias("algns"), F.sum("abund").alias("abund")]


def matched_summary(matched: DataFrame) -> DataFrame:
    """A row a specimen, edit site and aligned sequence of a target; target_match loses its direction, orient holds the strands."""
    name = F.regexp_replace("target_match", r":\(\w+\)$", "")
    keys = ["alt_specimen", "edit_site", "aligned_sequence", "target_match", "target_mismatch"]
    return matched.withColumn("target_match", name).groupBy(*keys).agg(joined_set("on_off_target").alias("on_off_target"), joined_set("paired_algn").alias("paired_algn"), *_totals(), joined_set("strand").alias("orient"))


def pileup_summary(piled: DataFrame) -> DataFrame:
    return piled.groupBy("alt_specimen", "clus_ori").agg(joined_set("on_off_target").alias("on_off_target"), joined_set("paired_algn").alias("paired_algn"), *_totals())


def paired_regions(paired: DataFrame) -> DataFrame:
    """Span, middle and width of each pair: the outermost 5' points of either strand."""
    pos = F.when(F.col("strand") == "+", F.min("start")).otherwise(F.max("end"))
    sides = paired.groupBy("alt_specimen", "paired_algn", "seqnames", "strand").agg(pos.alias("__p"), F.sum("contrib").alias("contrib"), *(F.sum(c).alias(c) for c in ("count", "umitag", "abund")))
    out = sides.groupBy("alt_specimen", "paired_algn", "seqnames").agg(F.min("__p").alias("start"), F.max("__p").alias("end"), *_totals())
    return out.withColumn("mid", F.col("start") + (F.col("end") - F.col("start")) / 2).withColumn("width", F.col("end") - F.col("start"))


def paired_on_target(regions: DataFrame, on_targets: DataFrame, up: int = 100, down: int = 30) -> DataFrame:
    """regions with on_off_target: an on-target position (seqnames, pos) of the specimen lies within the region, stretched by `down`."""
    hits = regions.join(F.broadcast(on_targets.select(F.col("seqnames").alias("__s"), F.col("pos").alias("__p"), F.col("alt_specimen").alias("__x"))), (F.col("seqnames") == F.col("__s")) & (F.col("alt_specimen") == F.col("__x")) & (F.col("start") <= F.col("__p") + down) & (F.col("end") >= F.col("__p") - down), "left_semi")
    keys = ["alt_specimen", "paired_algn", "seqnames"]
    return regions.join(hits.select(*keys).withColumn("__on", F.lit(True)), keys, "left").withColumn("on_off_target", F.when(F.col("__on"), "On-target").otherwise("Off-target")).drop("__on")


def complete_stats(stats: DataFrame, samples: DataFrame, metrics: list[str]) -> DataFrame:
    """(sampleName, metric, count) for every sample and metric, 0 where there is none.  Both lists are short."""
    grid = samples.select("sampleName").distinct().withColumn("metric", F.explode(F.array(*map(F.lit, metrics))))
    return grid.join(stats.groupBy("sampleName", "metric").agg(F.sum("count").alias("count")), ["sampleName", "metric"], "left").fillna(0, ["count"])


def criteria_stats(flagged: DataFrame) -> DataFrame:
    """Abundance a sample under each criterion, complete with zeros."""
    tests = ["all", "is_pileup", "is_paired", "is_matched", "probable"]
    sums = [F.sum(F.col("abund") if t == "all" else F.when(F.col(t), F.col("abund")).otherwise(0)).alias(t) for t in tests]
    return flagged.groupBy("sampleName").agg(*sums).unpivot("sampleName", tests, "metric", "count")


def specimen_totals(algnmts: DataFrame) -> DataFrame:
    """Reads, UMIs and alignments (by contribution) of each specimen, through its first alt_specimen alone."""
    first = algnmts.groupBy("specimen").agg(F.min("alt_specimen").alias("alt_specimen"))
    return algnmts.join(F.broadcast(first), ["specimen", "alt_specimen"]).groupBy("specimen").agg(F.sum("count").alias("reads"), F.sum("umitag").alias("umitags"), F.sum("contrib").alias("algns"))


def on_target_percent(df: DataFrame, by: list[str], name: str = "pct") -> DataFrame:
    on = F.sum(F.when(F.col("on_off_target") == "On-target", F.col("abund")).otherwise(0))
    return df.groupBy(*by).agg((100.0 * on / F.sum("abund")).alias(name))


def off_target_counts(df: DataFrame, by: list[str], name: str = "n_off") -> DataFrame:
    """Pile-ups with off-target alignments, in groups that have any."""
    return df.where("on_off_target = 'Off-target'").groupBy(*by).agg(F.count_distinct("clus_ori").alias(name))


def off_target_rows(df: DataFrame, by: list[str], name: str = "n_off") -> DataFrame:
    """Off-target rows of a summary, in groups that have any."""
    return df.where("on_off_target = 'Off-target'").groupBy(*by).agg(F.count("*").alias(name))


def efficiency_pivot(matched: DataFrame, targets: list[str]) -> DataFrame:
    """alt_specimen x target: the on-target percentage of the abundance that matches the target; null without any."""
    on = F.sum(F.when(F.col("on_off_target") == "On-target", F.col("abund")).otherwise(0))
    return matched.groupBy("alt_specimen").pivot("target_match", targets).agg(100.0 * on / F.sum("abund"))


def efficiency_range(pct_min, pct_max):
    """Both ends to a decimal, or one if they are alike; null without any."""
    low, high = F.bround(pct_min, 1), F.bround(pct_max, 1)
    return F.when(low == high, F.format_string("%.1f%%", high)).when(low.isNotNull() & high.isNotNull(), F.format_string("%.1f - %.1f%%", low, high))


def efficiency_ranges(wide: DataFrame, targets: list[str]) -> DataFrame:
    """(alt_specimen, efficiency): the range over the targets of an efficiency pivot."""
    every = F.array_compact(F.array(*(F.col(f"`{t}`") for t in targets))) if targets else F.array().cast("array<double>")
    return wide.select("alt_specimen", efficiency_range(F.array_min(every), F.array_max(every)).alias("efficiency"))


def joined_summaries(first: DataFrame, *others: DataFrame, on: str = "specimen", how: str = "left") -> DataFrame:
    for o in others:
        first = first.join(o, on, how)
    return first


# ---- distances ----------------------------------------------------------------------------------


def edit_distance(start, end, edit_pos, strand):
    """From the cut to an alignment's own 5' point, along the genome."""
    return F.when(strand == "+", start - edit_pos).otherwise(end - edit_pos)


def distance_histogram(df: DataFrame, by: list[str]) -> DataFrame:
    """Abundance at each distance and strand, and its log10, negative on the - strand."""
    own = df.groupBy(*by, "strand", "dist").agg(F.sum("abund").alias("count"))
    return own.withColumn("log_count", F.log10("count") * F.when(F.col("strand") == "+", 1).otherwise(-1))


def density_grid(df: DataFrame, by: list[str], value: str = "dist", bandwidth: float = 1.0, low: float = 0.0, high: float = 100.0, points: int = 512, at_least: int = 10) -> DataFrame:
    """Gaussian kernel density of |value| on a grid, for groups of `at_least` rows.

    Values are counted first: the kernel is evaluated once a distinct value and grid point, both bounded by the grid's reach.
    """
    counts = df.groupBy(*by, F.abs(value).alias("__v")).agg(F.count("*").alias("__n"))
    sized = counts.join(df.groupBy(*by).agg(F.count("*").alias("__total")).where(F.col("__total") >= at_least), by)
    step = (high - low) / (points - 1)
    grid = sized.withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", low + F.col("idx") * step)
    u = (F.col("x") - F.col("__v")) / bandwidth
    return grid.groupBy(*by, "idx", "x").agg((F.sum(F.col("__n") * F.exp(-u * u / 2)) / F.first("__total") / (bandwidth * math.sqrt(2 * math.pi))).alias("y"))


def tail_probability(values: DataFrame, grid: DataFrame, by: list[str], value: str = "z") -> DataFrame:
    """values with es_prob: 1 minus the density's mass up to the first grid point whose rounded x is the value; null without one."""
    w = W.partitionBy(*by).orderBy("idx")
    step = F.max("x").over(W.partitionBy(*by)) - F.min("x").over(W.partitionBy(*by))
    mass = F.sum("y").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)) * step / (F.count("*").over(W.partitionBy(*by)) - 1)
    table = grid.withColumn("__mass", mass).groupBy(*by, F.bround("x").cast("long").alias(value)).agg(F.min_by("__mass", "idx").alias("__m"))
    return values.join(F.broadcast(table), [*by, value], "left").withColumn("es_prob", 1 - F.col("__m")).drop("__m")


def inclusion(df: DataFrame, by: list[str], up: int) -> DataFrame:
    """Percent of abundance at most `up` from the cut, on either side of it."""
    return df.groupBy(*by).agg((100.0 * F.sum(F.when(F.abs("dist") <= up, F.col("abund")).otherwise(0)) / F.sum("abund")).alias("pct_incl"))


def max_likelihood(df: DataFrame, grid: DataFrame, by: list[str] = ("annotation",), keys: list[str] = ("edit_site", "gene_id")) -> DataFrame:
    """100 * the largest tail probability (0 at least) of each edit site's distances."""
    scored = tail_probability(df.withColumn("z", F.abs("dist")), grid, list(by))
    return scored.groupBy(*by, *keys).agg((100 * F.greatest(F.lit(0.0), F.max(F.coalesce("es_prob", F.lit(0.0))))).alias("MESL"))


def off_target_sequences(matched: DataFrame, mesl: DataFrame, by: tuple[str, ...] = ("annotation",)) -> DataFrame:
    """Sequences of a matched summary by condition, on target (`On`) and off (`Off`), with their likelihood: most abundant first, then likeliest, then fewest mismatches."""
    own = matched.join(mesl, ["annotation", "edit_site", "gene_id"], "left").withColumn("target", F.regexp_extract("on_off_target", r"\w+", 0))
    keys = [F.col("target_match").alias("target_seq"), F.col("edit_site"), F.col("aligned_sequence"), F.col("target_mismatch").alias("mismatch"), F.col("target"), F.col("gene_id")]
    out = own.groupBy(*by, *keys).agg(F.sum("abund").alias("abund"), F.max("MESL").alias("MESL"))
    return out.orderBy(F.desc("abund"), F.desc("MESL"), "mismatch", *by, "target_seq", "edit_site")


def top_per_condition(df: DataFrame, by: list[str], order: list, n: int = 10) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def weighted_quantiles(df: DataFrame, by: list[str], value: str, weight: str, probs: list[float]) -> DataFrame:
    """The first value at which the cumulative weight reaches each share; values are summed up first."""
    sums = df.groupBy(*by, value).agg(F.sum(weight).alias("__w"))
    own = W.partitionBy(*by)
    cum = sums.withColumn("__c", F.sum("__w").over(own.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)) / F.sum("__w").over(own))
    return cum.groupBy(*by).agg(*[F.min(F.when(F.col("__c") >= p - 1e-12, F.col(value))).alias(f"q{round(100 * p)}") for p in probs])


# ---- enrichment ---------------------------------------------------------------------------------


def enrichment_counts(genes: DataFrame, onco: DataFrame, special: DataFrame, by: list[str]) -> DataFrame:
    """Distinct symbols a group in all, and among the onco and special lists."""
    own = genes.select(*by, "symbol").distinct()
    own = own.join(onco.select("symbol").distinct().withColumn("__o", F.lit(1)), "symbol", "left").join(special.select("symbol").distinct().withColumn("__s", F.lit(1)), "symbol", "left")
    return own.groupBy(*by).agg(F.count("*").alias("total"), F.count("__o").alias("onco"), F.count("__s").alias("special"))


def gene_counts(summary: DataFrame, by: list[str], each_row: bool = False) -> DataFrame:
    """(by, total, onco, special): distinct genes of a summary by the marks in gene_id; in all, its rows if each_row."""
    gene = F.regexp_replace("gene_id", r"\*", "")
    marked = lambda sign: F.count_distinct(F.when(F.contains(gene, F.lit(sign)), gene))
    return summary.groupBy(*by).agg((F.count("*") if each_row else F.count_distinct(gene)).alias("total"), marked("~").alias("onco"), marked("!").alias("special"))


def reference_counts(genes: DataFrame, onco: list[str], special: list[str]) -> DataFrame:
    """The same of a gene list: its symbols, and how many of the onco and special ones it has."""
    own = genes.select("symbol").distinct()
    count = lambda names: F.count_if(F.col("symbol").isin(list(names))) if names else F.lit(0).cast("long")
    return own.agg(F.count("*").alias("total"), count(onco).alias("onco"), count(special).alias("special"))


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """P of tables as unlikely as (a b / c d) or more, margins fixed."""
    row, col, total = a + b, a + c, a + b + c + d
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    logp = lambda x: choose(col, x) + choose(total - col, row - x) - choose(total, row)
    own = logp(a)
    return min(1.0, sum(math.exp(p) for x in range(max(0, row + col - total), min(row, col) + 1) if (p := logp(x)) <= own + 1e-7))


def benjamini_hochberg(p: list[float]) -> list[float]:
    n, out, low = len(p), [0.0] * len(p), 1.0
    for rank, i in sorted(enumerate(sorted(range(n), key=lambda i: p[i])), reverse=True):
        low = min(low, p[i] * n / (rank + 1))
        out[i] = low
    return out


def enrichment_tests(rows: list[dict], kind: str = "onco") -> list[dict]:
    """Each group's rate of `kind` genes against the first row's, with adjusted p.  Driver-side: a row a condition."""
    base = rows[0]
    p = [fisher_two_sided(r[kind], r["total"] - r[kind], base[kind], base["total"] - base[kind]) for r in rows]
    return [r | {f"{kind}_p": x, f"{kind}_adj_p": y} for r, x, y in zip(rows, p, benjamini_hochberg(p))]


#: What of either binomial may be left out at each end of the sum behind a power.
TAIL = 1e-9


def binomial_core(n: int, p: float, tail: float = TAIL) -> tuple[int, list[float]]:
    """(first count, probabilities) of a binomial but for at most `tail` at either end."""
    if p <= 0 or p >= 1:
        return (n if p >= 1 else 0), [1.0]
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p) for k in range(n + 1)]
    mass = [math.exp(x) for x in logs]
    lo, hi, left, right = 0, n, mass[0], mass[n]
    while left <= tail and lo < n:
        lo, left = lo + 1, left + mass[lo + 1]
    while right <= tail and hi > lo:
        hi, right = hi - 1, right + mass[hi - 1]
    return lo, mass[lo : hi + 1]


def power_of(rows: list[dict], kind: str = "onco", alpha: float = 0.05, tail: float = TAIL) -> list[float]:
    """The chance, at the observed rates, that the exact test finds a group different from the first row.

    It is the sum over both groups' binomials of the tables that the test rejects, but for ends of at most `tail`.  For
    each count of one group what the test rejects are the counts of the other below and above a stretch, and its ends only
    grow with the count, so tests are made along the two ends and not at every table.
    """
    base, out = rows[0], []
    rate = lambda r: r[kind] / max(1, r["total"])
    y0, ys = binomial_core(base["total"], rate(base), tail)
    upto = [0.0]
    for y in ys:
        upto.append(upto[-1] + y)
    for r in rows:
        x0, xs = binomial_core(r["total"], rate(r), tail)
        kept = lambda x, y: fisher_two_sided(x, r["total"] - x, y, base["total"] - y) >= alpha  # noqa: E731, B023
        total, lo, hi = 0.0, 0, 0
        for i, px in enumerate(xs):
            # The counts y0 + lo to y0 + hi - 1 are not rejected.
            while lo < len(ys) and not kept(x0 + i, y0 + lo) and (y0 + lo) * r["total"] < (x0 + i) * base["total"]:
                lo += 1
            hi = max(hi, lo)
            while hi < len(ys) and (kept(x0 + i, y0 + hi) or (y0 + hi) * r["total"] < (x0 + i) * base["total"]):
                hi += 1
            total += px * (upto[lo] + upto[-1] - upto[hi])
        out.append(min(1.0, total))
    return out


# ---- run statistics -----------------------------------------------------------------------------


def stat_matrix(stats: DataFrame, metrics: list[str]) -> DataFrame:
    """Long (sampleName, metric, count) summed over bins, then wide with the metrics in the given order."""
    return stats.groupBy("sampleName", "metric").agg(F.sum("count").alias("count")).groupBy("sampleName").pivot("metric", metrics).agg(F.first("count")).fillna(0)


def sample_list(samples: DataFrame, specimen_pattern: str = r"^\w+", support: DataFrame | None = None) -> DataFrame:
    out = samples.groupBy(F.regexp_extract("sampleName", specimen_pattern, 0).alias("specimen")).agg(F.count("*").alias("replicates"))
    return out.join(F.broadcast(support), "specimen", "left") if support is not None else out


def run_union(runs: dict[str, DataFrame], versions: dict[str, str] | None = None, override: bool = False) -> DataFrame:
    """Rows of several runs with run_set; versions must agree unless overridden."""
    if versions and len(set(versions.values())) > 1 and not override:
        raise ValueError(f"runs of different versions: {versions}")
    out = None
    for name, df in runs.items():
        own = df.withColumn("run_set", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out

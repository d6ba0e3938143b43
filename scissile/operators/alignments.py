"""Alignment records to template fragments: filters, coupling of anchor and adrift ends, multihits, chimeras."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sequences import clipped, five_prime, percent_identity
from .graphs import connected_components
from .intervals import islands, proximity_join
from .staging import staged, tasks_for


def join_keys(anchor: DataFrame, adrift: DataFrame) -> DataFrame:
    """(read, anchor_key, adrift_key, read_pair): key tables (readNames, seqID) joined by read, the first row of a read on either side."""
    first = lambda t, name: t.groupBy("readNames").agg(F.min("seqID").alias(name))
    both = first(anchor, "anchor_key").join(first(adrift, "adrift_key"), "readNames")
    return both.select(F.col("readNames").alias("read"), "anchor_key", "adrift_key", F.concat_ws(":", "anchor_key", "adrift_key").alias("read_pair"))


def default_keys(anchor_hits: DataFrame, adrift_hits: DataFrame) -> DataFrame:
    """Without key tables: query names of both sides stand for themselves."""
    return anchor_hits.select("qName").intersect(adrift_hits.select("qName")).select(F.col("qName").alias("readNames"), F.col("qName").alias("seqID"))


def drop_alt(hits: DataFrame, column: str = "tName") -> DataFrame:
    return hits.where(~F.contains(column, F.lit("_")))


def known_hits(hits: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    return hits.join(keys.select(F.col(column).alias("qName")).distinct(), "qName", "left_semi")


def quality_filter(psl: DataFrame, min_percent: float = 95.0, max_start: int = 5, max_insert: int = 5) -> DataFrame:
    share = 100 * (F.col("matches") + F.col("repMatches")) / F.col("qSize")
    return psl.where((share >= min_percent) & (F.col("qStart") <= max_start) & (F.col("tBaseInsert") <= max_insert))


def extended_ranges(psl: DataFrame) -> DataFrame:
    """(qName, seqnames, start, end, strand): the target's span with the query's unaligned ends added, 1-based."""
    head, tail = F.col("qStart"), F.col("qSize") - F.col("qEnd")
    plus = F.col("strand") == "+"
    return psl.select("qName", F.col("tName").alias("seqnames"), (F.col("tStart") - F.when(plus, head).otherwise(tail) + 1).alias("start"), (F.col("tEnd") + F.when(plus, tail).otherwise(head)).alias("end"), "strand")


def decode_flags(sam: DataFrame) -> DataFrame:
    """Rows whose read and mate are mapped, with `end`: anchor for the first read of a pair, else adrift, and the strand."""
    flag = F.col("flag")
    mapped = sam.where((flag.bitwiseAND(0x4) == 0) & (flag.bitwiseAND(0x8) == 0))
    return mapped.withColumn("end", F.when(flag.bitwiseAND(0x40) != 0, "anchor").otherwise("adrift")).withColumn("strand", F.when(flag.bitwiseAND(0x10) != 0, "-").otherwise("+"))


def sam_filter(decoded: DataFrame, min_percent: float = 95.0, min_width: int = 30, max_start: int = 5) -> DataFrame:
    """Rows of good identity and width with a short clip at the 5' end, of reads that keep both ends."""
    clip = F.when(F.col("strand") == "+", clipped(F.col("cigar"), "start")).otherwise(clipped(F.col("cigar"), "end"))
    good = decoded.withColumn("pct_id", percent_identity(F.col("cigar"), F.col("MD"))).where((F.col("pct_id") >= min_percent) & (F.col("qwidth") >= min_width) & (clip <= max_start))
    both = good.groupBy("qname").agg(F.count_if(F.col("end") == "anchor").alias("n1"), F.count_if(F.col("end") == "adrift").alias("n2")).where("n1 > 0 AND n2 > 0")
    return good.join(both, "qname", "left_semi")


def loci_pairs(anchor: DataFrame, adrift: DataFrame, min_length: int = 30, max_length: int = 2500) -> DataFrame:
    """(seqnames, strand, anchor_pos, adrift_pos, start, end) of distinct 5' points that can bound a template.

    Opposite strands, the adrift point downstream of the anchor, min_length to max_length apart.  Works on distinct points.
    """
    a = anchor.select("seqnames", "strand", F.col("pos").alias("anchor_pos")).distinct()
    b = adrift.select("seqnames", F.when(F.col("strand") == "+", "-").otherwise("+").alias("strand"), F.col("pos").alias("adrift_pos")).distinct()
    pairs = proximity_join(a, b, ["seqnames", "strand"], "anchor_pos", "adrift_pos", max_length + 1)
    apart = F.when(F.col("strand") == "+", F.col("adrift_pos") - F.col("anchor_pos")).otherwise(F.col("anchor_pos") - F.col("adrift_pos"))
    return pairs.where((apart >= 1) & (apart - 1 <= max_length) & (apart + 1 >= min_length)).select("seqnames", "strand", "anchor_pos", "adrift_pos", F.least("anchor_pos", "adrift_pos").alias("start"), F.greatest("anchor_pos", "adrift_pos").alias("end"))


def couple(keys: DataFrame, anchor: DataFrame, adrift: DataFrame, min_length: int = 30, max_length: int = 2500) -> DataFrame:
    """(read_pair, seqnames, strand, start, end, n_loci): template ranges consistent with each read pair, and how many it has.

    keys: read_pair, anchor_key, adrift_key; hits: qName and ranges.  Equi-joins by key and by buckets as wide as a
    template on distinct points: a repeat's hits meet their neighbours, not all hits of the pair.
    """
    point = lambda hits, name: hits.select(F.col("qName").alias(name), "seqnames", "strand", five_prime(F.col("start"), F.col("end"), F.col("strand")).alias("pos")).distinct()
    a, b = point(anchor, "anchor_key"), point(adrift, "adrift_key")
    flipped = b.select("adrift_key", "seqnames", F.when(F.col("strand") == "+", "-").otherwise("+").alias("strand"), F.col("pos").alias("adrift_pos"))
    # The adrift point lies in its anchor's bucket or in the next one downstream.
    bucket = F.floor(F.col("adrift_pos") / (max_length + 1))
    flipped = flipped.withColumn("__bucket", F.explode(F.array(bucket, F.when(F.col("strand") == "+", bucket - 1).otherwise(bucket + 1))))
    a = a.withColumnRenamed("pos", "anchor_pos").withColumn("__bucket", F.floor(F.col("anchor_pos") / (max_length + 1)))
    got = keys.select("read_pair", "anchor_key", "adrift_key").distinct().join(a, "anchor_key").join(flipped, ["adrift_key", "seqnames", "strand", "__bucket"])
    apart = F.when(F.col("strand") == "+", F.col("adrift_pos") - F.col("anchor_pos")).otherwise(F.col("anchor_pos") - F.col("adrift_pos"))
    got = got.where((apart >= 1) & (apart - 1 <= max_length) & (apart + 1 >= min_length))
    got = got.withColumn("start", F.least("anchor_pos", "adrift_pos")).withColumn("end", F.greatest("anchor_pos", "adrift_pos"))
    ranges = got.select("read_pair", "seqnames", "strand", "start", "end").distinct()
    return ranges.withColumn("n_loci", F.count("*").over(W.partitionBy("read_pair")))


def classify_pairs(keys: DataFrame, coupled: DataFrame, anchor: DataFrame, adrift: DataFrame) -> DataFrame:
    """(read_pair, class): unique, multihit, chimera (both ends aligned, no template) or failed."""
    n = coupled.select("read_pair", "n_loci").distinct()
    both = keys.select("read_pair", "anchor_key", "adrift_key").distinct()
    seen = lambda hits, name: hits.select(F.col("qName").alias(name)).distinct().withColumn(f"__{name}", F.lit(True))
    out = both.join(n, "read_pair", "left").join(seen(anchor, "anchor_key"), "anchor_key", "left").join(seen(adrift, "adrift_key"), "adrift_key", "left")
    label = F.when(F.col("n_loci") == 1, "unique").when(F.col("n_loci") > 1, "multihit").when(F.col("__anchor_key") & F.col("__adrift_key"), "chimera").otherwise("failed")
    return out.select("read_pair", label.alias("class"))


def unique_reads(keys: DataFrame, coupled: DataFrame) -> DataFrame:
    """Unique templates a read: range, width, read_pair, ID and the sample in the anchor sequence's name."""
    one = coupled.where("n_loci = 1").join(keys, "read_pair")
    return one.select("seqnames", "start", "end", (F.col("end") - F.col("start") + 1).alias("width"), "strand", "read_pair", F.regexp_extract("anchor_key", r"^[\w-]+", 0).alias("sampleName"), F.col("read").alias("ID"))


def condense_sites(sites: DataFrame, by: list[str] = ()) -> DataFrame:
    """Per 5' position: reads, distinct template widths, and the widths with their reads as width:reads strings, ascending."""
    pos = five_prime(F.col("start"), F.col("end"), F.col("strand"))
    widths = sites.groupBy(*by, "seqnames", "strand", pos.alias("pos"), (F.col("end") - F.col("start") + 1).alias("width")).agg(F.count("*").alias("reads"))
    return widths.groupBy(*by, "seqnames", "strand", "pos").agg(F.sum("reads").alias("reads"), F.count("*").alias("fragments"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("width", "reads"))), lambda x: F.concat_ws(":", x["width"], x["reads"])), ";").alias("widths"))


def pair_sam(filtered: DataFrame, min_length: int = 30, max_length: int = 2500) -> DataFrame:
    """(ID, seqnames, strand, start, end): consistent anchor and adrift rows of each read.

    Distinct points meet by buckets as wide as a template, so a read of many hits meets their neighbours, not all its pairs.
    """
    point = five_prime(F.col("pos"), F.col("pos") + F.col("span") - 1, F.col("strand"))
    a = filtered.where("end = 'anchor'").select(F.col("qname").alias("ID"), F.col("rname").alias("seqnames"), "strand", point.alias("p")).distinct()
    b = filtered.where("end = 'adrift'").select(F.col("qname").alias("ID"), F.col("rname").alias("seqnames"), F.when(F.col("strand") == "+", "-").otherwise("+").alias("strand"), point.alias("q")).distinct()
    length = F.when(F.col("strand") == "+", F.col("q") - F.col("p")).otherwise(F.col("p") - F.col("q")) + 1
    # The adrift point lies in its anchor's bucket or in the next one downstream; before it only where lengths below 1 are let through.
    width = max(1, max_length, 1 - min_length)
    own, on = F.floor(F.col("q") / width), F.when(F.col("strand") == "+", -1).otherwise(1)
    b = b.withColumn("__bucket", F.explode(F.array(own, own + on, *([own - on] if min_length < 1 else []))))
    near = a.withColumn("__bucket", F.floor(F.col("p") / width)).join(b, ["ID", "seqnames", "strand", "__bucket"])
    return near.where(length.between(min_length, max_length)).select("ID", "seqnames", "strand", F.least("p", "q").alias("start"), F.greatest("p", "q").alias("end")).distinct()


def split_hits(paired: DataFrame) -> DataFrame:
    """paired with `class`: unique for reads of one range, else multihit."""
    n = F.count("*").over(W.partitionBy("ID"))
    return paired.withColumn("class", F.when(n == 1, "unique").otherwise("multihit"))


def multihit_clusters(hits: DataFrame, gap: int = 5) -> dict[str, DataFrame]:
    """Multihit read pairs (read_pair, ranges) clustered by the loci they share.

    5' points within `gap` are a locus; a locus links its read pairs to the smallest of them, and the components are the
    clusters.  alignments: hits with cluster and the read pair's median width; positions and widths: per cluster.
    """
    points = hits.where("read_pair IS NOT NULL").withColumn("pos", five_prime(F.col("start"), F.col("end"), F.col("strand")))
    placed = islands(points.select("seqnames", "strand", "pos").distinct().withColumn("__e", F.col("pos")), ["seqnames", "strand"], "pos", "__e", gap).drop("__e")
    # Written once: links and the result read it.
    own = staged(points.join(placed, ["seqnames", "strand", "pos"]))
    moved = _linked(own.withColumn("__pair", F.col("read_pair").cast("string")), "__pair").where("node <> component").withColumnRenamed("node", "__pair")
    # The median is taken where the clusters meet the hits, over the same read pairs.
    width = F.bround(F.percentile(F.col("end") - F.col("start") + 1, F.lit(0.5)).over(W.partitionBy("read_pair"))).cast("long")
    full = own.join(moved, own["read_pair"].cast("string") == moved["__pair"], "left").withColumn("cluster", F.coalesce("component", F.col("read_pair").cast("string"))).drop("__pair", "component").withColumn("width", width)
    widths = full.select("cluster", "read_pair", "width").distinct().groupBy("cluster", "width").agg(F.count("*").alias("reads"))
    return {"alignments": full, "positions": full.select("cluster", "seqnames", "strand", F.col("island").alias("pos")).distinct(), "widths": widths}


def _linked(own: DataFrame, name: str, loci: DataFrame | None = None, task_links: int | None = None) -> DataFrame:
    """(node, component) of names that share a locus (seqnames, strand, island): a star a locus, never its pairs; `loci` says of which."""
    place = ["seqnames", "strand", "island"]
    hubs = own.groupBy(*place).agg(F.min(name).alias("a")) if loci is None else loci
    return connected_components(own.join(hubs, place).select("a", F.col(name).alias("b")), **({} if task_links is None else {"task_links": task_links}))


def multihit_points(clustered: dict[str, DataFrame]) -> DataFrame:
    """(cluster, seqnames, strand, pos): a run's clusters by their 5' points, all that later runs need to know of it."""
    return clustered["alignments"].select("cluster", "seqnames", "strand", "pos").distinct()


def combine_multihits(known: DataFrame, hits: DataFrame, gap: int = 5, task_links: int | None = None) -> dict[str, DataFrame]:
    """A further run's multihits (read_pair, ranges) joined to clusters that are known by their points.

    Hits of the runs before aren't read: only loci on which a new point lies link clusters, read pairs and each other, so
    what is clustered anew is the new run and the clusters that it touches.  The outcome is that of clustering all runs at
    once, if read pairs have names of their own in each run.

    renamed: (cluster, combined) of the known clusters that merge into one of another name; pairs: (read_pair, cluster) of
    the new run; points: the points of all, for the next run.
    """
    place = ["seqnames", "strand", "pos"]
    points = hits.where("read_pair IS NOT NULL").select(F.col("read_pair").cast("string").alias("name"), "seqnames", "strand", five_prime(F.col("start"), F.col("end"), F.col("strand")).alias("pos")).distinct()
    both = staged(known.select(F.col("cluster").alias("name"), *place, F.lit(False).alias("fresh")).union(points.withColumn("fresh", F.lit(True))))
    placed = islands(both.select(*place).distinct().withColumn("__e", F.col("pos")), ["seqnames", "strand"], "pos", "__e", gap).drop("__e")
    own = staged(both.join(placed, place))
    hubs = own.groupBy("seqnames", "strand", "island").agg(F.min("name").alias("a"), F.max("fresh").alias("__met")).where("__met").drop("__met")
    parts = _linked(own, "name", hubs, task_links)
    moved = parts.where("node <> component").withColumnRenamed("node", "name")
    renamed = own.where("NOT fresh").select("name").distinct().join(moved, "name").select(F.col("name").alias("cluster"), F.col("component").alias("combined"))
    pairs = own.where("fresh").select("name").distinct().join(moved, "name", "left").select(F.col("name").alias("read_pair"), F.coalesce("component", "name").alias("cluster"))
    points = own.join(moved, "name", "left").select(F.coalesce("component", "name").alias("cluster"), *place).distinct()
    return {"renamed": renamed, "pairs": pairs, "points": points}


def recover_multihits(unique: DataFrame, multi: DataFrame) -> DataFrame:
    """Unique rows and those multihit rows that share a sample's pile-up with a unique one; contrib is 1 / rows left of the read in the sample.

    Rows are dealt among tasks by their number, so that a task's share stays as it is while tables grow, and placed once;
    only multihit rows are exchanged further.
    """
    both = unique.withColumn("type", F.lit("uniq")).unionByName(multi.withColumn("type", F.lit("multi")))
    place, tasks = ["sampleName", "seqnames", "strand", "island"], tasks_for(both)
    placed = staged(islands(both, place[:3], tasks=tasks))
    anchored = placed.where("type = 'uniq'").select(*place).repartition(tasks, *place).distinct()
    met = placed.where("type = 'multi'").repartition(tasks, *place).join(anchored, place, "left_semi")
    n = F.count("*").over(W.partitionBy("sampleName", "ID"))
    met = met.repartition(tasks, "sampleName", "ID").withColumn("contrib", 1.0 / n)
    return placed.where("type = 'uniq'").withColumn("contrib", F.lit(1.0)).unionByName(met).drop("island")


def attach_umis(reads: DataFrame, umis: DataFrame) -> DataFrame:
    """reads with umitag; of several tags of a read the smallest."""
    return reads.join(umis.groupBy("ID").agg(F.min("umitag").alias("umitag")), "ID", "left")


def assembly_stats(reads: DataFrame) -> DataFrame:
    """(sampleName, metric, count): distinct reads, alignments and 5' loci."""
    pos = five_prime(F.col("start"), F.col("end"), F.col("strand"))
    wide = reads.groupBy("sampleName").agg(F.count_distinct("ID").alias("reads"), F.count_distinct("seqnames", "start", "end", "strand").alias("aligns"), F.count_distinct("seqnames", "strand", pos).alias("loci"))
    return wide.unpivot("sampleName", ["reads", "aligns", "loci"], "metric", "count")


def multihit_stats(clustered: dict[str, DataFrame]) -> DataFrame:
    """(metric, count) of multihit_clusters: distinct reads pairs, template lengths (a row a read pair's median) and clusters."""
    pairs = clustered["alignments"].agg(F.count_distinct("read_pair").alias("multihit.reads"), F.count_distinct("cluster").alias("multihit.clusters"))
    lengths = clustered["widths"].agg(F.coalesce(F.sum("reads"), F.lit(0)).cast("long").alias("multihit.lengths"))
    return pairs.join(F.broadcast(lengths)).unpivot([], ["`multihit.reads`", "`multihit.lengths`", "`multihit.clusters`"], "metric", "count")


def outcome_stats(keys: DataFrame, classes: DataFrame) -> DataFrame:
    """(sampleName, metric, count): reads by the class of their read pair, complete with zeros; the sample is in the anchor sequence's name."""
    own = keys.join(classes, "read_pair").withColumn("sampleName", F.regexp_extract("anchor_key", r"^[\w-]+", 0))
    named = {"unique": "unique.reads", "multihit": "multihit.reads", "chimera": "chimera.reads", "failed": "failed.reads"}
    wide = own.groupBy("sampleName").agg(*(F.count_if(F.col("class") == k).alias(k) for k in named))
    long = F.explode(F.array(*(F.struct(F.lit(v).alias("metric"), F.col(k).alias("count")) for k, v in named.items())))
    return wide.select("sampleName", long.alias("__s")).select("sampleName", "__s.metric", "__s.count")

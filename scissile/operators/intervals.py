"""Ranges on a genome: islands, pile-ups, pairing, proximity and nearest joins, tiles.

Ranges are rows (seqnames, start, end, strand, ...), 1-based and inclusive.
Windows that run along a chromosome are cut into coordinate blocks, with what a
block hands to the next carried by a small aggregate, so that no task holds a
whole chromosome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sequences import five_prime
from .staging import ranked, staged, tasks_for

BLOCK = 1 << 20


#: Stands for null in text keys while rows are grouped and joined, so that none is lost.
NO_KEY = "\x00null"


def _filled(df: DataFrame, keys: list[str]) -> DataFrame:
    text = [k for k in keys if df.schema[k].dataType.typeName() == "string"]
    return df.withColumns({k: F.coalesce(k, F.lit(NO_KEY)) for k in text})


def _emptied(df: DataFrame, keys: list[str]) -> DataFrame:
    text = [k for k in keys if df.schema[k].dataType.typeName() == "string"]
    return df.withColumns({k: F.nullif(F.col(k), F.lit(NO_KEY)) for k in text})


def islands(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", maxgap: int = 0, out: str = "island", block: int = BLOCK, tasks: int | None = None) -> DataFrame:
    """df with `out`: the first position of the row's island.  Ranges join if one begins within maxgap of the furthest end so far; touching neighbours don't at gap 0.

    Rows are exchanged once, by block, where each finds the last head before it as if nothing came from earlier blocks.
    That head stands if it lies beyond what they reach; else the row belongs to their last head, and so does all before
    it in the block.  A block's summary (furthest end, last head) is a row, and those before a block add up by maximum.
    Null keys are a group like any other.  tasks: among how many the blocks are dealt, in place of the session's number.
    """
    return _emptied(_placed(_filled(df, keys), keys, start, end, maxgap, out, block, tasks).drop("__block", "__wide"), keys)


def _placed(df: DataFrame, keys: list[str], start: str, end: str, maxgap: int, out: str, block: int, tasks: int | None = None) -> DataFrame:
    """df (keys filled) with `out`, __block, and __wide: whether the row's island has rows in other blocks too."""
    own = df.withColumn("__block", F.floor(F.col(start) / block))
    own = own.repartition(tasks, *keys, "__block") if tasks else own
    ordered = W.partitionBy(*keys, "__block").orderBy(start, end)
    reach = F.max(end).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    own = own.withColumn("__new", F.when(reach.isNull() | (F.col(start) > reach + maxgap), F.col(start)))
    own = own.withColumn("__head", F.max("__new").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("__new")
    along = W.partitionBy(*keys).orderBy("__block")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    sums = own.groupBy(*keys, "__block").agg(F.max(end).alias("__top"), F.max("__head").alias("__last"), F.min("__head").alias("__first"))
    sums = sums.withColumn("__reach", F.max("__top").over(before))
    stands = lambda head: F.col("__reach").isNull() | (F.col(head) > F.col("__reach") + maxgap)
    sums = sums.withColumn("__carried", F.max(F.when(stands("__last"), F.col("__last"))).over(before))
    # The island that a block ends in goes on if the next block's first rows don't stand.
    goes_on = F.coalesce(F.lead(~stands("__first")).over(along), F.lit(False))
    ends_in = F.when(stands("__last"), F.col("__last")).otherwise(F.col("__carried"))
    sums = sums.withColumn("__onward", F.when(goes_on, ends_in)).select(*keys, "__block", "__reach", "__carried", "__onward")
    own = own.join(sums, [*keys, "__block"])
    head = F.when(stands("__head"), F.col("__head")).otherwise(F.col("__carried"))
    wide = ~stands("__head") | F.coalesce(head == F.col("__onward"), F.lit(False))
    return own.withColumn("__wide", wide).withColumn(out, head).drop("__reach", "__head", "__carried", "__onward")


def reduce_ranges(df: DataFrame, keys: list[str], maxgap: int = 0) -> DataFrame:
    """Merged ranges: keys, start, end, members."""
    own = df.groupBy(*keys, "start", "end").agg(F.count("*").alias("__n"))  # equal ranges once
    return islands(own, keys, maxgap=maxgap).groupBy(*keys, "island").agg(F.max("end").alias("end"), F.sum("__n").alias("members")).withColumnRenamed("island", "start").select(*keys, "start", "end", "members")


def merged_members(df: DataFrame, keys: list[str], maxgap: int = 0) -> DataFrame:
    """df with merged_start and merged_end: the merged range that each row went into, the map behind reduce_ranges."""
    placed = islands(df, keys, maxgap=maxgap, out="merged_start")
    ends = placed.groupBy(*keys, "merged_start").agg(F.max("end").alias("merged_end"))
    return placed.join(ends, [*keys, "merged_start"])


def pileup_clusters(df: DataFrame, grouping: list[str] = (), maxgap: int = 0, block: int = BLOCK) -> DataFrame:
    """df with island and clus_ori = seqnames:strand:origin.

    The origin is the island's most frequent start (+, ties to the smallest) or end (-, ties to the largest).
    Islands are found on distinct ranges, which are far fewer than rows at hot loci.  An island's origin is found in the
    block where its ranges were ordered, without another exchange; only islands that cross a block's border, one a border
    at most, are counted up over their blocks.
    """
    keys = [*grouping, "seqnames", "strand"]
    named = named_ranges(df, grouping, maxgap, block)
    return _emptied(_filled(df, keys).join(named, [*keys, "start", "end"]).withColumn("clus_ori", origin_name()).drop("__origin"), keys)


def origin_name():
    return F.concat_ws(":", F.nullif("seqnames", F.lit(NO_KEY)), F.nullif("strand", F.lit(NO_KEY)), "__origin")


def named_ranges(df: DataFrame, grouping: list[str], maxgap: int = 0, block: int = BLOCK) -> DataFrame:
    """The distinct ranges behind pileup_clusters, their keys filled, with island and __origin."""
    keys = [*grouping, "seqnames", "strand"]
    df = _filled(df, keys)
    ranges = df.groupBy(*keys, "start", "end").agg(F.count("*").alias("__n"))
    placed = _placed(ranges, keys, "start", "end", maxgap, "island", block).withColumn("__pos", five_prime(F.col("start"), F.col("end"), F.col("strand")))
    tie = F.when(F.col("strand") == "-", F.col("__pos")).otherwise(-F.col("__pos"))
    most = F.max_by("__pos", F.struct("__m", tie))
    # Both windows lie within the rows of a block, so they need no exchange.
    counted = placed.withColumn("__m", F.sum("__n").over(W.partitionBy(*keys, "__block", "island", "__pos")))
    placed = staged(counted.withColumn("__origin", most.over(W.partitionBy(*keys, "__block", "island"))).select(*keys, "start", "end", "island", "__pos", "__n", "__wide", "__origin"))
    across = placed.where("__wide").groupBy(*keys, "island", "__pos").agg(F.sum("__n").alias("__m")).groupBy(*keys, "island").agg(most.alias("__origin"))
    shown = [*keys, "start", "end", "island", "__origin"]
    return placed.where("NOT __wide").select(*shown).unionByName(placed.where("__wide").drop("__origin").join(across, [*keys, "island"]).select(*shown))


def cluster_ids(clustered: DataFrame) -> DataFrame:
    """(clus_ori, clus_id): dense ranks of the cluster origins."""
    return ranked(clustered.select("clus_ori").distinct(), ["clus_ori"], "clus_id")


def paired_points(df: DataFrame, grouping: list[str] = (), maxgap: int = 200, maxovlp: int = 10, block: int = BLOCK) -> DataFrame:
    """(grouping, seqnames, strand, pos, pair_start) of 5' points that face a point of the other strand.

    A + point p and a - point q pair if |p - q| - 1 <= maxgap and p - q >= -maxovlp.  Partners of a point fill one
    stretch around it, so pairs are islands of the stretches, and no graph is walked.
    """
    if maxovlp < 0:
        raise ValueError("maxovlp must not be negative")
    keys = [*grouping, "seqnames"]
    far, near = maxgap + 1, min(maxovlp, maxgap + 1)
    points = df.withColumn("pos", five_prime(F.col("start"), F.col("end"), F.col("strand"))).where(F.col("strand").isin("+", "-")).select(*keys, "strand", "pos").distinct()
    own = F.floor(F.col("pos") / block)
    # Points near a block's edge are also shown to the neighbour.
    spread = points.withColumn("__own", own).withColumn("__block", F.explode(F.array_distinct(F.array(own, F.floor((F.col("pos") - far) / block), F.floor((F.col("pos") + far) / block)))))
    w = W.partitionBy(*keys, "__block").orderBy("pos")
    plus, minus = F.when(F.col("strand") == "+", F.col("pos")), F.when(F.col("strand") == "-", F.col("pos"))
    left, right = w.rangeBetween(-far, near), w.rangeBetween(-near, far)
    lo = F.when(F.col("strand") == "+", F.min(minus).over(left)).otherwise(F.min(plus).over(right))
    hi = F.when(F.col("strand") == "+", F.max(minus).over(left)).otherwise(F.max(plus).over(right))
    linked = spread.withColumn("__lo", lo).withColumn("__hi", hi).where("__block = __own AND __lo IS NOT NULL")
    stretch = linked.select(*keys, "strand", "pos", F.least("pos", "__lo").alias("__a"), F.greatest("pos", "__hi").alias("__z"))
    return islands(stretch, keys, "__a", "__z", 0, "pair_start", block).drop("__a", "__z")


def identify_pairs(df: DataFrame, grouping: list[str] = (), maxgap: int = 200, maxovlp: int = 10) -> DataFrame:
    """df with paired_algn: grouping and the pair's first position, null for unpaired rows."""
    pairs = paired_points(df, grouping, maxgap, maxovlp).withColumn("paired_algn", F.concat_ws(".", *grouping, "seqnames", "pair_start")).drop("pair_start").withColumnRenamed("pos", "__pos5")
    own = df.withColumn("__pos5", five_prime(F.col("start"), F.col("end"), F.col("strand")))
    return own.join(pairs, [*grouping, "seqnames", "strand", "__pos5"], "left").drop("__pos5")


def proximity_join(left: DataFrame, right: DataFrame, keys: list[str], left_pos: str, right_pos: str, reach: int) -> DataFrame:
    """Pairs with |left_pos - right_pos| <= reach and equal keys: an equi-join on buckets of width `reach`, of which the right side takes its own and both neighbours."""
    width = max(1, reach)
    one = left.withColumn("__bucket", F.floor(F.col(left_pos) / width))
    other = right.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(right_pos) / width) - 1, F.floor(F.col(right_pos) / width) + 1)))
    return one.join(other, [*keys, "__bucket"]).where(F.abs(F.col(left_pos) - F.col(right_pos)) <= reach).drop("__bucket")


#: Width of the buckets in which points meet the ranges that hold them.
WIDTH = 100_000


def containing(points: DataFrame, ranges: DataFrame, pos: str, width: int = WIDTH, keys: tuple = ("seqnames",)) -> DataFrame:
    """Pairs of a point and a range (start, end) that holds it, by buckets of `width`."""
    one = points.withColumn("__bucket", F.floor(F.col(pos) / width))
    other = ranges.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    return one.join(other, [*keys, "__bucket"]).where((F.col(pos) >= F.col("start")) & (F.col(pos) <= F.col("end"))).drop("__bucket")


def nearest_ranges(points: DataFrame, ranges: DataFrame, pos: str, block: int = BLOCK) -> DataFrame:
    """(seqnames, pos, symbol, inside) of distinct points: the first symbol among the ranges that hold the point, else that of the nearest range, ties to the one before it.

    Points are dealt among tasks by their number: by buckets, where they are told apart and meet the ranges that hold them,
    and by blocks, where ends before and starts after are found by one ordered pass over the union of points and range ends,
    in place of a range join; the nearest end or start beyond a block comes from a row a block.
    """
    tasks, own = tasks_for(points), points.select("seqnames", F.col(pos).alias("pos"))
    bucket = ["seqnames", "__bucket"]
    own = own.withColumn("__bucket", F.floor(F.col("pos") / WIDTH)).repartition(tasks, *bucket).distinct()
    holding = ranges.select("seqnames", F.explode(F.sequence(F.floor(F.col("start") / WIDTH), F.floor(F.col("end") / WIDTH))).alias("__bucket"), "start", "end", "symbol").alias("r")
    inside = [F.col(f"p.{k}") == F.col(f"r.{k}") for k in bucket] + [F.col("p.pos").between(F.col("r.start"), F.col("r.end"))]
    # Merged: ranges follow the data, and Spark would broadcast them by the size of their compressed files.
    met = own.alias("p").join(holding.hint("merge"), inside, "left").select("p.*", F.col("r.symbol").alias("symbol"))
    # Written once: points and their blocks are read from it.
    points = staged(met.groupBy(*bucket, "pos").agg(F.min("symbol").alias("__held")).select("seqnames", "pos", "__held", F.floor(F.col("pos") / block).alias("__block")))
    none = F.lit(None).cast("string")
    at = lambda column, kind: ranges.groupBy("seqnames", F.col(column).alias("pos")).agg(F.min("symbol").alias("symbol")).select("seqnames", "pos", none.alias("__held"), F.floor(F.col("pos") / block).alias("__block"), F.lit(kind).alias("kind"), "symbol")
    marks = at("end", 0).unionByName(at("start", 2))
    both = points.withColumns({"kind": F.lit(1), "symbol": none}).unionByName(marks).repartition(tasks, "seqnames", "__block")
    end, start = F.when(F.col("kind") == 0, F.struct("pos", "symbol")), F.when(F.col("kind") == 2, F.struct("pos", "symbol"))
    held = points.select("seqnames", "__block").distinct().select("seqnames", F.lit(None).cast("long").alias("pos"), none.alias("__held"), "__block", F.lit(1).alias("kind"), none.alias("symbol"))
    edges = marks.unionByName(held).groupBy("seqnames", "__block").agg(F.max(end).alias("__e"), F.min(start).alias("__s"))
    along = W.partitionBy("seqnames").orderBy("__block")  # a row a block
    edges = edges.select("seqnames", "__block", F.last("__e", True).over(along.rowsBetween(W.unboundedPreceding, -1)).alias("__eb"), F.first("__s", True).over(along.rowsBetween(1, W.unboundedFollowing)).alias("__sa"))
    w = W.partitionBy("seqnames", "__block").orderBy("pos", "kind")
    back = W.partitionBy("seqnames", "__block").orderBy(F.desc("pos"), F.desc("kind"))  # a running frame; one to the end would be quadratic
    seen = both.withColumn("__b", F.last(end, True).over(w.rowsBetween(W.unboundedPreceding, -1))).withColumn("__a", F.last(start, True).over(back.rowsBetween(W.unboundedPreceding, -1))).where("kind = 1")
    seen = seen.join(edges, ["seqnames", "__block"]).withColumn("__b", F.coalesce("__b", "__eb")).withColumn("__a", F.coalesce("__a", "__sa"))
    before, after = F.col("pos") - F.col("__b.pos"), F.col("__a.pos") - F.col("pos")
    near = F.when(after.isNull() | (before <= after), F.col("__b.symbol")).otherwise(F.col("__a.symbol"))
    return seen.select("seqnames", "pos", F.coalesce("__held", near).alias("symbol"), F.col("__held").isNotNull().alias("inside"))


def annotate_genes(points: DataFrame, genes: DataFrame, pos: str, onco: list[str] = (), special: list[str] = ()) -> DataFrame:
    """(seqnames, pos, gene_id): the nearest gene's symbol with * inside it, ~ for onco genes and ! for special ones."""
    found = nearest_ranges(points, genes, pos)
    mark = lambda names, sign: F.when(F.col("symbol").isin(list(names)), sign).otherwise("") if names else F.lit("")
    return found.withColumn("gene_id", F.concat(F.col("symbol"), F.when(F.col("inside"), "*").otherwise(""), mark(onco, "~"), mark(special, "!")))


def tiles(contigs: DataFrame, width: int, drop_alt: bool = True) -> DataFrame:
    """Fixed windows over each contig (seqnames, length), the last one clipped; alternative contigs have an underscore."""
    own = contigs.where(~F.contains("seqnames", F.lit("_"))) if drop_alt else contigs
    return own.withColumn("start", F.explode(F.sequence(F.lit(1).cast("long"), F.col("length").cast("long"), F.lit(width).cast("long")))).select("seqnames", "start", F.least(F.col("start") + width - 1, "length").cast("long").alias("end"))


def tile_counts(df: DataFrame, width: int, by: list[str] = ()) -> DataFrame:
    """(seqnames, by, start, count): ranges over each tile that has any."""
    first, last = F.floor((F.col("start") - 1) / width), F.floor((F.col("end") - 1) / width)
    return df.withColumn("__t", F.explode(F.sequence(first, last))).groupBy("seqnames", *by, (F.col("__t") * width + 1).cast("long").alias("start")).agg(F.count("*").alias("count"))


def genomic_density(df: DataFrame, contigs: DataFrame, width: int, cutoff: int = 2, adj: int = 1) -> DataFrame:
    """Tiles with at least `cutoff` ranges: count, log10(count + adj) and its share of the largest over all tiles."""
    counted = tiles(contigs, width).join(tile_counts(df, width), ["seqnames", "start"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    logged = counted.withColumn("log_count", F.log10(F.col("count") + adj))
    top = logged.agg(F.max("log_count").alias("__top"))  # one row
    return logged.join(F.broadcast(top)).withColumn("norm_log_count", F.col("log_count") / F.col("__top")).where(F.col("count") >= cutoff).drop("__top")


def coverage(df: DataFrame, resolution: int) -> DataFrame:
    """Windows of `resolution` from each sequence's first to its last position, with the ranges of either strand over them."""
    bounds = df.groupBy("seqnames").agg(F.min("start").alias("__from"), F.max("end").alias("__to"))
    windows = bounds.withColumn("start", F.explode(F.sequence("__from", "__to", F.lit(resolution).cast("long"))))
    own = df.join(F.broadcast(bounds), "seqnames")  # a row a contig
    k = lambda p: F.floor((F.col(p) - F.col("__from")) / resolution)
    hits = own.withColumn("__k", F.explode(F.sequence(k("start"), k("end")))).groupBy("seqnames", (F.col("__from") + F.col("__k") * resolution).alias("start")).agg(F.count_if(F.col("strand") == "+").alias("plus"), F.count_if(F.col("strand") == "-").alias("minus"))
    out = windows.join(hits, ["seqnames", "start"], "left")
    return out.select("seqnames", "start", F.least(F.col("start") + resolution - 1, "__to").alias("end"), F.coalesce("plus", F.lit(0)).alias("plus"), F.coalesce("minus", F.lit(0)).alias("minus"))


MAIN_CONTIGS = r"chr[0-9XY]+$"


#: Rounds of the permutation, and the steps of a walk.
ROUNDS, WALK = 4, 400


def _bits(key: str, value, bits: int):
    """The first `bits` (60 at most) bits of the MD5 of `key:value`."""
    digest = F.md5(F.concat(F.lit(f"{key}:"), value.cast("string")).cast("binary"))
    return F.shiftright(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 60 - bits)


def permuted(value, half: int, seed: int):
    """A keyed permutation of the numbers of 2 * half bits: Feistel rounds over their halves."""
    left, right = F.shiftright(value, half), value.bitwiseAND((1 << half) - 1)
    for k in range(ROUNDS):
        left, right = right, left.bitwiseXOR(_bits(f"{seed}:{k}", right, half))
    return F.shiftleft(left, half).bitwiseOR(right)


def shuffled(value, total: int, seed: int = 1):
    """Where a keyed permutation of 0..total-1 takes the value: the permutation of the next numbers of even bits, walked until it falls below total."""
    half = max(1, -(-max(1, total - 1).bit_length() // 2))
    one = lambda x: permuted(x, half, seed)
    # At least a quarter of the numbers lie below total: that many steps are enough but for a chance of 1e-50.
    step = lambda x, _: F.when(x < total, x).otherwise(one(x))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), one(value), step)


def random_sites(contigs: DataFrame, n: int, seed: int = 1, drop_alt: bool = True, names: list[str] | None = None) -> DataFrame:
    """n distinct sites (seqnames, start, strand), contigs in proportion to length, strands alike.

    Contigs are those of `names`, or the numbered and sex chromosomes, or all without drop_alt.  Draw i is the place to
    which a keyed permutation of all positions takes i, so draws are distinct as they come: nothing is sorted or compared,
    any part of them can be drawn anywhere, and they are the same on any cluster.
    """
    if names is not None:
        own = contigs.where(F.col("seqnames").isin(list(names)))
    else:
        own = contigs.where(F.col("seqnames").rlike(MAIN_CONTIGS)) if drop_alt else contigs
    upto = F.sum("length").over(W.orderBy("seqnames").rowsBetween(W.unboundedPreceding, W.currentRow))
    table = own.withColumn("__hi", upto).withColumn("__lo", F.col("__hi") - F.col("length"))  # a row a contig
    total = table.agg(F.max("__hi")).head()[0] or 0
    if n > total:
        raise ValueError("more sites than positions")
    spark = contigs.sparkSession
    side = F.when(_bits(f"{seed}:side", F.col("id"), 1) == 0, "+").otherwise("-").alias("strand")
    placed = spark.range(n).select(shuffled(F.col("id"), total, seed).alias("__at"), side)
    at = placed.join(F.broadcast(table), (F.col("__at") >= F.col("__lo")) & (F.col("__at") < F.col("__hi")))
    return at.select("seqnames", (F.col("__at") - F.col("__lo") + 1).alias("start"), "strand")

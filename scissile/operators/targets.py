"""Nuclease targets in the sequence around a break: site sequences, matching, PAM checks, cut sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sequences import mismatches_at, pattern_places, reverse_complement

NO_MATCH = "No_valid_match"


def site_sequences(sites: DataFrame, contigs: DataFrame, up: int = 100, down: int = 30, chunk: int = 1 << 16) -> DataFrame:
    """Distinct sites (seqnames, pos, strand) with site_seq: `up` bases before the 5' point to `down` after it along the strand, cut at contig ends.

    Contigs are pieces (seqnames, at, part), as sources.genome reads them, or rows (seqnames, seq), which are split into
    overlapping chunks in one pass over each, so that a site joins some kilobases, not a chromosome.
    """
    if "part" in contigs.columns:
        return _from_pieces(sites, contigs, up, down, chunk)
    reach = up + down + 1

    def split(batches):
        import pyarrow as pa

        for batch in batches:
            for name, seq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for first in range(0, len(seq or ""), 64 * chunk):  # some megabytes a batch
                    at = list(range(first, min(len(seq), first + 64 * chunk), chunk))
                    rows = {"seqnames": [name] * len(at), "__chunk": pa.array([x // chunk for x in at], pa.int64()), "__at": pa.array(at, pa.int64()), "__part": [seq[x : x + chunk + reach] for x in at]}
                    yield pa.RecordBatch.from_pydict(rows)

    chunks = contigs.select("seqnames", "seq").mapInArrow(split, "seqnames string, __chunk long, __at long, __part string")
    own = sites.select("seqnames", "pos", "strand").distinct()
    lo = F.when(F.col("strand") == "-", F.col("pos") - down).otherwise(F.col("pos") - up)
    own = own.withColumn("__lo", F.greatest(lo, F.lit(1))).withColumn("__n", lo + reach - F.col("__lo")).withColumn("__chunk", F.floor((F.col("__lo") - 1) / chunk))
    joined = own.join(chunks, ["seqnames", "__chunk"])
    text = F.substring("__part", (F.col("__lo") - F.col("__at")).cast("int"), F.col("__n").cast("int"))
    return joined.select("seqnames", "pos", "strand", F.when(F.col("strand") == "-", reverse_complement(text)).otherwise(text).alias("site_seq"))


def _from_pieces(sites: DataFrame, pieces: DataFrame, up: int, down: int, cell: int) -> DataFrame:
    """site_sequences of pieces of any lengths: both sides meet in cells of a contig; a site puts its stretches together."""
    own = sites.select("seqnames", "pos", "strand").distinct()
    minus = F.col("strand") == "-"
    own = own.withColumn("__lo", F.greatest(F.when(minus, F.col("pos") - down).otherwise(F.col("pos") - up) - 1, F.lit(0))).withColumn("__hi", F.when(minus, F.col("pos") + up).otherwise(F.col("pos") + down))
    cells = lambda a, z: F.explode(F.sequence(F.floor(a / cell), F.floor(z / cell)))
    own = own.where("__hi > __lo").withColumn("__cell", cells(F.col("__lo"), F.col("__hi") - 1))
    held = pieces.select("seqnames", F.col("at").cast("long").alias("__at"), "part").where("part <> ''").withColumn("__end", F.col("__at") + F.length("part"))
    held = held.withColumn("__cell", cells(F.col("__at"), F.col("__end") - 1)).withColumn("__from", F.greatest("__at", F.col("__cell") * cell)).withColumn("__to", F.least("__end", (F.col("__cell") + 1) * cell))
    # Only a cell's own stretch of a piece travels.
    held = held.select("seqnames", "__cell", "__from", F.substring("part", (F.col("__from") - F.col("__at") + 1).cast("int"), (F.col("__to") - F.col("__from")).cast("int")).alias("__part"))
    a = F.greatest("__lo", "__from")
    z = F.least("__hi", F.col("__from") + F.length("__part"))
    met = own.join(held, ["seqnames", "__cell"]).withColumn("__a", a).withColumn("__z", z).where("__z > __a")
    bit = F.substring("__part", (F.col("__a") - F.col("__from") + 1).cast("int"), (F.col("__z") - F.col("__a")).cast("int"))
    whole = met.groupBy("seqnames", "pos", "strand").agg(F.array_sort(F.collect_list(F.struct("__a", bit.alias("bit")))).alias("bits"))
    text = F.array_join(F.transform("bits", lambda x: x["bit"]), "")
    return whole.select("seqnames", "pos", "strand", F.when(minus, reverse_complement(text)).otherwise(text).alias("site_seq"))


def several(value: str | list[str]) -> list[str]:
    """A value that may be one or a list, as a list."""
    return [value] if isinstance(value, str) else list(value)


def align_targets(seqs: DataFrame, targets: dict[str, str | list[str]], tolerance: int = 6, column: str = "site_seq") -> DataFrame:
    """seqs exploded to (target, first, last, mismatch): every place where a target fits with at most `tolerance` mismatches, ends clamped to the sequence.

    Targets are few literals, a name may have several: a batch of sites is matched with all of them at once, without a join.
    """
    each = [(name, seq) for name, value in targets.items() for seq in several(value)]
    if not each:
        return seqs.select("*", F.lit("").alias("target"), F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(0).alias("mismatch")).where(F.lit(False))
    found = pattern_places(F.col(column), [seq for _, seq in each], tolerance, beyond=tolerance)
    names = F.array(*(F.lit(name) for name, _ in each))
    size = F.array(*(F.lit(len(seq)) for _, seq in each))
    hits = seqs.withColumn("__m", F.explode(found))
    last = F.col("__m.offset") + F.get(size, F.col("__m.pattern")) - 1
    return hits.select(*seqs.columns, F.get(names, F.col("__m.pattern")).alias("target"), F.greatest("__m.offset", F.lit(1)).alias("first"), F.least(last, F.length(column)).alias("last"), F.col("__m.mismatch").alias("mismatch"))


def compare_targets(sites: DataFrame, targets: dict[str, str], profile: dict, up: int = 100, down: int = 30, tolerance: int = 6) -> DataFrame:
    """sites (seqnames, pos, strand, site_seq) with target_match `name:(sense|antisense)`, target_mismatch, aligned_sequence and edit_site.

    Both strands of the window are searched; the PAM beside a match must fit; the fewest mismatches win, then the cut
    nearest to the site; ties stay as rows.  profile: PAM, PAM_Loc (5p, 3p or None), PAM_Tol, Cut_Offset, Insert_size.
    """
    pam, where, allowed = (profile.get("PAM") or ""), profile.get("PAM_Loc"), profile.get("PAM_Tol") or 0
    pam = pam if where else ""
    both = None
    for sense in ("sense", "antisense"):
        own = sites.withColumn("__seq", F.col("site_seq") if sense == "sense" else reverse_complement(F.col("site_seq")))
        hits = align_targets(own, targets, tolerance, "__seq").withColumn("__sense", F.lit(sense))
        both = hits if both is None else both.unionByName(hits)
    n = len(pam)
    a = F.col("first") - (n if where == "5p" else 0)
    z = F.col("last") + (n if where == "3p" else 0)
    both = both.withColumn("__a", a).withColumn("__z", z).where((F.col("__a") >= 1) & (F.col("__z") <= F.length("__seq")))
    if n:
        both = both.where(mismatches_at(F.col("__seq"), pam, F.col("__a") if where == "5p" else F.col("__z") - n + 1) <= allowed)
    size = F.length("site_seq")
    # Back on the window's own strand.
    sense = F.col("__sense") == "sense"
    both = both.withColumn("__p", F.when(sense, F.col("__a")).otherwise(size - F.col("__z") + 1)).withColumn("__q", F.when(sense, F.col("__z")).otherwise(size - F.col("__a") + 1))
    both = both.withColumn("aligned_sequence", F.substring("__seq", F.col("__a").cast("int"), (F.col("__z") - F.col("__a") + 1).cast("int")))
    both = both.withColumn("edit_site", cut_site(F.col("seqnames"), F.col("pos"), F.col("strand"), F.col("__p"), F.col("__q"), sense, profile, up))
    keys = ["seqnames", "pos", "strand"]
    apart = F.abs(F.element_at(F.split("edit_site", ":"), -1).cast("long") - F.col("pos"))
    best = both.withColumn("__r", F.rank().over(W.partitionBy(*keys).orderBy("mismatch", apart))).where("__r = 1")
    best = best.select(*keys, F.concat("target", F.lit(":("), "__sense", F.lit(")")).alias("target_match"), F.col("mismatch").alias("target_mismatch"), "aligned_sequence", "edit_site").distinct()
    return sites.join(best, keys, "left").withColumn("target_match", F.coalesce("target_match", F.lit(NO_MATCH)))


def cut_site(seqnames, pos, strand, first, last, sense, profile: dict, up: int):
    """`chr:strand:pos` of the cut for a match (PAM included) at first..last of a site's window.

    The cut lies Cut_Offset bases along the match from the PAM's first base (from the match's first base without a PAM);
    `mid_insert` stands for the median insert size, half to even.  Window place k is genome position pos - up + k - 1 (+)
    or pos + up - k + 1 (-).
    """
    pam, where, offset = (profile.get("PAM") or ""), profile.get("PAM_Loc"), profile.get("Cut_Offset")
    if isinstance(offset, str):
        if offset.lower() != "mid_insert":
            raise ValueError("Cut_Offset is a number or mid_insert")
        lo, _, hi = str(profile.get("Insert_size") or 0).partition(":")
        offset = round((int(lo) + int(hi or lo)) / 2)
    offset = int(offset or 0)
    if pam and where == "3p":
        along_sense, along_anti = last - len(pam) + 1 + offset, first + len(pam) - 1 - offset
    else:
        along_sense, along_anti = first + offset, last - offset
    along = F.when(sense, along_sense).otherwise(along_anti)
    plus = strand == "+"
    place = F.when(plus, pos - up + along - 1).otherwise(pos + up - along + 1)
    facing = F.when(sense, strand).otherwise(F.when(plus, "-").otherwise("+"))
    return F.concat_ws(":", seqnames, facing, place.cast("long"))


def treated_only(matched: DataFrame, treatments: DataFrame, specimen: str = "specimen") -> DataFrame:
    """matched with target_match kept only where the target is among the specimen's treatments (array; `all` allows any)."""
    own = matched.join(F.broadcast(treatments.select(F.col("specimen").alias(specimen), F.col("treatment").alias("__t"))), specimen, "left")
    name = F.regexp_extract("target_match", r"[\w\-\.]+", 0)
    fits = F.array_contains("__t", name) | F.array_contains("__t", "all")
    return own.withColumn("target_match", F.when(F.coalesce(fits, F.lit(False)), F.col("target_match")).otherwise(NO_MATCH)).drop("__t")

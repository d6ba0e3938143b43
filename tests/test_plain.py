"""Batch operators against plain Python, and summaries worked by hand."""

import random

import pytest
from pyspark.sql import functions as F

from scissile.functions import sequences as sq
from scissile.operators import alignments, evaluation as ev, intervals, reads as rd, staging, targets
from tests.conftest import rows_of

CODES = sq.IUPAC


def plain_places(seq, pattern, limit, beyond=0):
    out = []
    for o in range(1 - beyond, len(seq) - len(pattern) + 2 + beyond):
        wrong = 0
        for i, c in enumerate(pattern):
            at = o + i - 1
            base = seq[at] if 0 <= at < len(seq) else ""
            wrong += c != "." and not (base and set(CODES.get(base, "")) & set(CODES.get(c, "")))
        if wrong <= limit:
            out.append((o, wrong))
    return out


@pytest.mark.parametrize("beyond", [0, 2])
def test_patterns_fit_where_plain_ones_do(spark, beyond):
    rng = random.Random(3)
    seqs = ["".join(rng.choice("ACGTNRx") for _ in range(rng.choice([0, 1, 4, 9, 40, 200]))) for _ in range(60)] + ["", None]
    patterns = ["ACG", "NRYT", "A", "ACGTACGTAC", "A..T"]
    got = spark.createDataFrame(list(enumerate(seqs)), "id long, seq string").select("id", sq.pattern_places(F.col("seq"), patterns, 1, beyond).alias("m")).collect()
    for r in got:
        seq = seqs[r["id"]] or ""
        assert [tuple(x) for x in r["m"]] == [(k, o, w) for k, p in enumerate(patterns) for o, w in plain_places(seq, p, 1, beyond)], seq


def plain_over(seq, tail, percent_id, max_length, min_length):
    pattern = tail[:max_length]
    limit = lambda n: round(n * (1 - percent_id))
    starts = [o for o, _ in plain_places(seq, pattern, limit(len(pattern)))]
    for n in range(min_length, len(pattern)):
        if len(seq) >= n and plain_places(seq[-n:], pattern[:n], limit(n)):
            starts.append(len(seq) - n + 1)
    return seq[: min(starts) - 1] if starts else seq


def plain_quality(seq, qual, k, half, limit):
    low = [c <= limit for c in qual]
    for i in range(len(qual)):
        if sum(low[max(0, i - half) : i + half + 1]) >= k:
            return seq[:i]
    return seq


def test_trims_match_plain_ones(spark):
    rng = random.Random(5)
    tail = "ACGTTGCAACGTACGTAACC"
    rows = []
    for i in range(200):
        body = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 40)))
        seq = body + tail[: rng.randint(0, 20)] + ("".join(rng.choice("ACGT") for _ in range(5)) if rng.random() < 0.4 else "")
        rows.append((str(i), seq, "".join(rng.choice("?B5I") for _ in seq)))
    df = spark.createDataFrame(rows, "read_id string, seq string, qual string")
    over = {r["read_id"]: (r["seq"], r["qual"]) for r in rd.overread_trim(df, tail, 0.9, 20, 3).collect()}
    assert over == {i: ((w := plain_over(s, tail, 0.9, 20, 3)), q[: len(w)]) for i, s, q in rows}
    cut = {r["read_id"]: (r["seq"], r["qual"]) for r in rd.quality_trim(df, 5, 10, "?").collect()}
    assert cut == {i: ((w := plain_quality(s, q, 5, 5, "?")), q[: len(w)]) for i, s, q in rows}


def plain_identity(read, ref, kind, identity, min_align, gap_open, gap_extend):
    """A cell at a time; each state is (score, minus the read's first aligned base)."""
    scores = sq.scoring_matrix("asymmetric")
    free_read, free_ref = kind in ("local", "overlap", "local-global"), kind in ("local", "overlap", "global-local")
    never, ends = (float("-inf"), 0), []
    add = lambda state, v: (state[0] + v, state[1])
    cost = lambda n: -(gap_open + gap_extend * n)
    m = [(0.0, 0)] + [(0.0, 0) if free_ref else never] * len(ref)
    x = [never] * (len(ref) + 1)
    y = [never] + [never if free_ref else (cost(j), 0) for j in range(1, len(ref) + 1)]
    for i, a in enumerate(read, 1):
        m2, x2, y2 = [(0.0, -i) if free_read else never], [never if free_read else (cost(i), 0)], [never]
        for j, b in enumerate(ref, 1):
            here = add(max(m[j - 1], x[j - 1], y[j - 1]), scores.get((a, b), 0.0))
            m2.append(max(here, (0.0, 1 - i)) if kind == "local" else here)
            x2.append(max(add(max(m[j], y[j]), cost(1)), add(x[j], -gap_extend)))
            y2.append(max(add(max(m2[j - 1], x2[j - 1]), cost(1)), add(y2[j - 1], -gap_extend)))
            if kind == "local" or (i == len(read) and (free_ref or j == len(ref))) or (j == len(ref) and free_read):
                best = max(m2[j], x2[j], y2[j])
                ends.append((best[0], i + best[1]))
        m, x, y = m2, x2, y2
    score, width = max(ends)
    if identity == "global":
        return 100.0 * max(score, 0.0) / len(read)
    return 100.0 * score / width if width >= min_align else 0.0


def test_alignment_matches_the_cell_by_cell_one():
    rng = random.Random(1)
    for _ in range(250):
        ref = "".join(rng.choice("ACGTN") for _ in range(rng.randint(1, 25)))
        read = "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 25))) if rng.random() < 0.4 else ref[rng.randint(0, 3) :] + rng.choice("ACGT")
        how = rng.choice(["global", "local", "overlap", "global-local", "local-global"]), rng.choice(["global", "local"]), rng.choice([1, 3, 20]), rng.choice([10, 1]), rng.choice([4, 0.5])
        assert rd.align_identity(read, ref, *how) == pytest.approx(max(0.0, plain_identity(read, ref, *how))), (read, ref, how)


def test_ranks_are_places_in_the_order(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), f"s{rng.randint(0, 10**6):07d}-{i}") for i in range(500)]
    got = staging.ranked(spark.createDataFrame(rows, "g string, s string"), ["s"], "n", ["g"]).collect()
    want = {(g, s): i + 1 for g in "ab" for i, (_, s) in enumerate(sorted(r for r in rows if r[0] == g))}
    assert {(r["g"], r["s"]): r["n"] for r in got} == want
    whole = staging.ranked(spark.createDataFrame(rows, "g string, s string"), ["s"], "n").collect()
    assert [r["s"] for r in sorted(whole, key=lambda r: r["n"])] == sorted(s for _, s in rows)


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_nearest_ranges_across_blocks(spark, block):
    rng = random.Random(4)
    genes = [(f"chr{rng.randint(1, 2)}", s := rng.randint(1, 400), s + rng.randint(0, 12), f"G{i:02d}") for i in range(25)]
    points = [(f"chr{rng.randint(1, 3)}", rng.randint(1, 420)) for _ in range(120)]

    def nearest(c, p):
        own = [g for g in genes if g[0] == c]
        held = [g[3] for g in own if g[1] <= p <= g[2]]
        if held:
            return min(held), True
        before = max(((g[2]) for g in own if g[2] <= p), default=None)
        after = min(((g[1]) for g in own if g[1] >= p), default=None)
        if before is None and after is None:
            return None, False
        first = after is None or (before is not None and p - before <= after - p)
        return min(g[3] for g in own if (g[2] == before if first else g[1] == after)), False

    got = intervals.nearest_ranges(spark.createDataFrame(points, "seqnames string, pos long"), spark.createDataFrame(genes, "seqnames string, start long, end long, symbol string"), "pos", block).collect()
    assert {(r["seqnames"], r["pos"]): (r["symbol"], r["inside"]) for r in got} == {(c, p): nearest(c, p) for c, p in points}


def test_couples_meet_in_neighbouring_buckets(spark):
    rng = random.Random(6)
    hit = lambda k: (k, "chr1", s := rng.randint(1, 400), s + rng.randint(5, 30), rng.choice("+-"))
    a, b = [hit(f"a{i % 3}") for i in range(60)], [hit(f"b{i % 3}") for i in range(60)]
    keys = [(f"a{i}:b{i}", f"a{i}", f"b{i}") for i in range(3)]
    kind = "qName string, seqnames string, start long, end long, strand string"
    got = rows_of(alignments.couple(spark.createDataFrame(keys, "read_pair string, anchor_key string, adrift_key string"), spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), 10, 60).select("read_pair", "strand", "start", "end"))
    five = lambda r: r[3] if r[4] == "-" else r[2]
    want = set()
    for pair, x, y in keys:
        for p in (r for r in a if r[0] == x):
            for q in (r for r in b if r[0] == y and r[4] != p[4]):
                apart = five(q) - five(p) if p[4] == "+" else five(p) - five(q)
                if apart >= 1 and apart - 1 <= 60 and apart + 1 >= 10:
                    want.add((pair, p[4], min(five(p), five(q)), max(five(p), five(q))))
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("chunk", [8, 50, 1 << 16])
def test_site_sequences_by_chunks(spark, chunk):
    rng = random.Random(9)
    dna = "".join(rng.choice("ACGT") for _ in range(300))
    sites = [("c", p, s) for p in (1, 3, 7, 8, 9, 50, 51, 140, 299, 300) for s in "+-"]
    got = targets.site_sequences(spark.createDataFrame(sites, "seqnames string, pos long, strand string"), spark.createDataFrame([("c", dna), ("d", None), ("e", "")], "seqnames string, seq string"), 6, 4, chunk).collect()
    turn = str.maketrans("ACGT", "TGCA")
    want = {}
    for _, p, s in sites:
        lo = p - (4 if s == "-" else 6)
        text = dna[max(lo, 1) - 1 : lo + 10]
        want[p, s] = text[::-1].translate(turn) if s == "-" else text
    assert {(r["pos"], r["strand"]): r["site_seq"] for r in got} == want


@pytest.mark.parametrize("n", [0, 1, 400, 500, 501, 950, 1000])
def test_random_sites_are_as_many_as_asked(spark, n):
    contigs = spark.createDataFrame([("chr1", 700), ("chrX", 300), ("chrUn_1", 5000), ("other", 10**6)], "seqnames string, length long")
    got = [tuple(r) for r in intervals.random_sites(contigs, n).collect()]
    assert len(got) == len({g[:2] for g in got}) == n
    assert all(c in ("chr1", "chrX") and 1 <= p <= (700 if c == "chr1" else 300) and s in "+-" for c, p, s in got)
    assert sorted(got) == sorted(tuple(r) for r in intervals.random_sites(contigs.repartition(3), n).collect())
    with pytest.raises(ValueError):
        intervals.random_sites(contigs, 1001)


# ---- the evaluation's summaries, by hand ---------------------------------------------------------

ALGNMTS = [
    # specimen, chromosome, start, end, strand, count, umitag, contrib, abund, pair, match, mismatch, sequence, edit site, on or off, pile-up
    ("A", "chr1", 100, 150, "+", 4, 2, 1.0, 3, "p1", "T1:(sense)", 0, "ACGT", "chr1:+:98", "On-target", "chr1:+:100"),
    ("A", "chr1", 103, 160, "+", 2, 1, 0.5, 1, "p1", "T1:(antisense)", 0, "ACGT", "chr1:+:98", "On-target", "chr1:+:100"),
    ("A", "chr1", 60, 95, "-", 1, 1, 0.25, 2, "p1", "T1:(sense)", 2, "ACGA", "chr1:-:98", "Off-target", "chr1:-:95"),
    ("A", "chr2", 10, 31, "-", 1, 0, 1.0, 5, None, "T2:(sense)", 1, "GGGG", "chr2:-:40", "Off-target", "chr2:-:31"),
    ("B", "chr1", 100, 150, "+", 1, 0, 1.0, 7, None, "T1:(sense)", 0, "ACGT", "chr1:+:98", "Off-target", "chr1:+:100"),
]
KIND = "alt_specimen string, seqnames string, start long, end long, strand string, count long, umitag long, contrib double, abund long, paired_algn string, target_match string, target_mismatch int, aligned_sequence string, edit_site string, on_off_target string, clus_ori string"


def test_summaries_by_hand(spark):
    df = spark.createDataFrame(ALGNMTS, KIND)
    matched = {(r["alt_specimen"], r["edit_site"]): r for r in ev.matched_summary(df).collect()}
    one = matched["A", "chr1:+:98"]
    assert (one["target_match"], one["count"], one["umitag"], one["algns"], one["abund"], one["orient"], one["paired_algn"]) == ("T1", 6, 3, 1.5, 4, "+", "p1") and len(matched) == 4
    region = ev.paired_regions(df.where("paired_algn IS NOT NULL")).head()
    assert (region["start"], region["end"], region["mid"], region["width"], region["count"], region["umitag"], region["algns"], region["abund"]) == (95, 100, 97.5, 5, 7, 4, 1.75, 6)
    piles = {(r["alt_specimen"], r["clus_ori"]): (r["paired_algn"], r["count"], r["algns"]) for r in ev.pileup_summary(df).collect()}
    assert piles["A", "chr1:+:100"] == ("p1", 6, 1.5) and piles["A", "chr2:-:31"] == ("", 1, 1.0)


def test_efficiency_by_hand(spark):
    summary = ev.matched_summary(spark.createDataFrame(ALGNMTS, KIND))
    wide = ev.efficiency_pivot(summary, ["T1", "T2", "T9"])
    got = {r["alt_specimen"]: r for r in wide.collect()}
    assert got["A"]["T1"] == pytest.approx(100 * 4 / 6) and got["A"]["T2"] == 0.0 and got["A"]["T9"] is None and got["B"]["T1"] == 0.0
    assert dict(map(tuple, ev.efficiency_ranges(wide, ["T1", "T2", "T9"]).collect())) == {"A": "0.0 - 66.7%", "B": "0.0%"}
    assert dict(map(tuple, ev.efficiency_ranges(wide, ["T9"]).collect())) == {"A": None, "B": None}
    assert dict(map(tuple, ev.off_target_rows(summary, ["alt_specimen"]).collect())) == {"A": 2, "B": 1}


def test_distances_by_hand(spark):
    df = spark.createDataFrame(ALGNMTS, KIND)
    edit = F.element_at(F.split("edit_site", ":"), -1).cast("long")
    df = df.withColumn("dist", ev.edit_distance(F.col("start"), F.col("end"), edit, F.col("strand"))).withColumn("target", F.substring("target_match", 1, 2))
    assert [r["dist"] for r in df.orderBy("alt_specimen", "start", "seqnames").collect()] == [-9, -3, 2, 5, 2]
    hist = {(r["target"], r["strand"], r["dist"]): (r["count"], r["log_count"]) for r in ev.distance_histogram(df.where("alt_specimen = 'A'"), ["target"]).collect()}
    assert hist["T2", "-", -9] == (5, pytest.approx(-0.69897)) and hist["T1", "+", 2] == (3, pytest.approx(0.477121))
    assert dict(map(tuple, ev.inclusion(df.where("alt_specimen = 'A'"), ["target"], 3).collect())) == {"T1": pytest.approx(100 * 5 / 6), "T2": 0.0}


def test_sequences_keep_both_kinds(spark):
    own = ev.matched_summary(spark.createDataFrame(ALGNMTS, KIND)).withColumn("annotation", F.lit("x")).withColumn("gene_id", F.lit("G"))
    mesl = spark.createDataFrame([("x", "chr1:+:98", "G", 80.0)], "annotation string, edit_site string, gene_id string, MESL double")
    got = [(r["target_seq"], r["edit_site"], r["target"], r["mismatch"], r["abund"], r["MESL"]) for r in ev.off_target_sequences(own, mesl).collect()]
    assert got == [("T1", "chr1:+:98", "Off", 0, 7, 80.0), ("T2", "chr2:-:40", "Off", 1, 5, None), ("T1", "chr1:+:98", "On", 0, 4, 80.0), ("T1", "chr1:-:98", "Off", 2, 2, None)]


def test_gene_counts_by_hand(spark):
    df = spark.createDataFrame([("x", "A*"), ("x", "A"), ("x", "B~"), ("x", "B*~"), ("x", "C!"), ("y", "D~!")], "annotation string, gene_id string")
    assert rows_of(ev.gene_counts(df, ["annotation"])) == [("x", 3, 1, 1), ("y", 1, 1, 1)]
    assert rows_of(ev.gene_counts(df, ["annotation"], each_row=True)) == [("x", 5, 1, 1), ("y", 1, 1, 1)]


@pytest.mark.parametrize("task_links", [0, 10, 1 << 20])
def test_components_by_contraction(spark, task_links):
    """Chains, stars and loops of words, by rounds and in one task."""
    from scissile.operators.graphs import connected_components

    rng = random.Random(11)
    names = [f"n{i:03d}" for i in range(120)]
    rng.shuffle(names)
    links = [(names[i], names[i + 1]) for i in range(40)] + [(names[50], names[i]) for i in range(51, 80)] + [(names[i], names[80 + (i + 1) % 10]) for i in range(80, 90)] + [("z", "z")]
    parent = {n: n for pair in links for n in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(links, "a string, b string").repartition(5), task_links)
    assert {r["node"]: r["component"] for r in got.collect()} == {n: find(n) for n in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_maps_behind_merged_ranges_and_clusters(spark):
    from scissile.operators.graphs import cluster_graph, cluster_members

    df = spark.createDataFrame([("c", 1, 5, "a"), ("c", 4, 9, "b"), ("c", 20, 21, "d"), ("e", 1, 2, "f")], "seqnames string, start long, end long, id string")
    got = {r["id"]: (r["merged_start"], r["merged_end"]) for r in intervals.merged_members(df, ["seqnames"]).collect()}
    assert got == {"a": (1, 9), "b": (1, 9), "d": (20, 21), "f": (1, 2)}
    kv = spark.createDataFrame([("A", 1), ("A", 2), ("B", 2), ("C", 6), ("C", 6)], "key string, val int")
    assert rows_of(cluster_members(kv).select("key", "val", "cluster")) == [("A", 1, "A"), ("A", 2, "A"), ("B", 2, "A"), ("C", 6, "C")]
    graph = cluster_graph(kv)
    assert rows_of(graph["nodes"]) == [("1", "value", "A"), ("2", "value", "A"), ("6", "value", "C"), ("A", "key", "A"), ("B", "key", "A"), ("C", "key", "C")] and graph["edges"].count() == 4


def test_statistics_of_classes_and_multihits(spark):
    keys = spark.createDataFrame([("r1", "S-1:seq1", "x", "p1"), ("r2", "S-1:seq1", "x", "p1"), ("r3", "S-2:seq9", "y", "p2"), ("r4", "S-2:seq8", "y", "p3")], "read string, anchor_key string, adrift_key string, read_pair string")
    classes = spark.createDataFrame([("p1", "unique"), ("p2", "multihit"), ("p3", "chimera")], "read_pair string, class string")
    got = {(r["sampleName"], r["metric"]): r["count"] for r in alignments.outcome_stats(keys, classes).collect()}
    assert len(got) == 8 and {k: v for k, v in got.items() if v} == {("S-1", "unique.reads"): 2, ("S-2", "multihit.reads"): 1, ("S-2", "chimera.reads"): 1}
    hits = spark.createDataFrame([("p", "c", 10, 40, "+"), ("p", "c", 500, 530, "+"), ("q", "c", 502, 540, "+"), ("z", "d", 1, 9, "+"), ("z", "d", 90, 98, "+")], "read_pair string, seqnames string, start long, end long, strand string")
    stats = dict(map(tuple, alignments.multihit_stats(alignments.multihit_clusters(hits)).collect()))
    assert stats == {"multihit.reads": 3, "multihit.lengths": 3, "multihit.clusters": 2}


def test_rows_with_null_keys_and_clashing_names_stay(spark):
    df = spark.createDataFrame([("c", 1, 5, None, "k"), ("c", 4, 9, None, "l"), ("c", 4, 9, "+", "m"), (None, 4, 9, "+", "n")], "seqnames string, start long, end long, strand string, pos string")
    got = {r["pos"]: (r["island"], r["clus_ori"]) for r in intervals.pileup_clusters(df).collect()}
    assert got == {"k": (1, "c:9"), "l": (1, "c:9"), "m": (4, "c:+:4"), "n": (4, "+:4")} or got["k"][0] == 1 and set(got) == set("klmn")
    assert rows_of(intervals.reduce_ranges(df, ["seqnames", "strand"]).select("seqnames", "strand", "start", "end", "members")) == rows_of(spark.createDataFrame([("c", None, 1, 9, 2), ("c", "+", 4, 9, 1), (None, "+", 4, 9, 1)], "a string, b string, c long, d long, e long"))
    paired = intervals.identify_pairs(df)
    assert {r["pos"] for r in paired.collect()} == set("klmn") and "paired_algn" in paired.columns


@pytest.mark.parametrize("block", [7, 50, 1 << 20])
def test_islands_over_blocks(spark, block):
    """Long ranges over many blocks, ties, gaps: against a plain scan."""
    rng = random.Random(block)
    rows = [(rng.choice("ab"), s, s + rng.choice([0, 1, 5, 90]) , i) for i in range(400) for s in [rng.randrange(2000)]]
    for gap in (0, 3):
        want, reach, head = {}, {}, {}
        for k, s, e, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
            if k not in reach or s > reach[k] + gap:
                head[k] = s
            reach[k] = max(e, reach.get(k, e))
            want[i] = head[k]
        got = intervals.islands(spark.createDataFrame(rows, "k string, start long, end long, i int").repartition(3), ["k"], maxgap=gap, block=block).collect()
        assert {r["i"]: r["island"] for r in got} == want


def test_power_is_the_sum_over_all_tables():
    from math import comb

    from scissile.operators import evaluation as ev

    def whole(a, b, alpha):
        chance = lambda r, k: comb(r["total"], k) * (r["onco"] / r["total"]) ** k * (1 - r["onco"] / r["total"]) ** (r["total"] - k)
        return sum(chance(a, x) * chance(b, y) for x in range(a["total"] + 1) for y in range(b["total"] + 1) if ev.fisher_two_sided(x, a["total"] - x, y, b["total"] - y) < alpha)

    row = lambda total, onco: {"total": total, "onco": onco}
    rng = random.Random(2)
    for _ in range(12):
        base, other = row(n := rng.randrange(1, 40), rng.randrange(n + 1)), row(m := rng.randrange(1, 30), rng.randrange(m + 1))
        got = ev.power_of([base, other], alpha=0.1)
        assert got == pytest.approx([whole(base, base, 0.1), whole(other, base, 0.1)], abs=1e-7)
    assert ev.power_of([row(20_000, 900), row(300, 40)])[1] > 0.9 and ev.power_of([row(0, 0), row(5, 5)]) == [0.0, 0.0]


@pytest.mark.parametrize("total", [1, 2, 5, 64, 65, 1000])
def test_a_permutation_of_positions(spark, total):
    got = [r[0] for r in spark.range(total).select(intervals.shuffled(F.col("id"), total, 3)).collect()]
    assert sorted(got) == list(range(total)) and (total < 60 or got != sorted(got))


@pytest.mark.parametrize("limit", [0, 1, 3, 6])
def test_seeds_find_what_every_offset_finds(limit):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(limit)
    word = lambda n, letters="ACGT": "".join(rng.choice(letters) for _ in range(n))
    panel = [word(rng.randint(16, 24)) for _ in range(24)] + ["NGG" + word(17), "ACGT", "..." + word(15), "RY" + word(20)]
    seqs = [None, "", word(100, "ACGTN"), "N" * 60, word(40, "ACGTRYKM")] + [word(rng.randint(0, 140)) for _ in range(30)]
    for guide in panel[:24]:
        near = "".join(rng.choice("ACGT") if rng.random() < limit / 20 else c for c in guide)
        seqs += [word(20) + near + word(30), near[2:] + word(40), word(40) + near[:-2]]
    for beyond in (0, limit):
        column = pa.array(seqs)
        got, want = sq.scanner(panel, limit, beyond)(column), sq.scanner(panel, limit, beyond, seeds_from=1000)(column)
        assert len(want[0]) > 20 and all(np.array_equal(a, b) for a, b in zip(got, want))
    row, which, place, wrong = sq.scanner(panel[:24], limit, limit)(pa.array(seqs[5:15]))
    told = sorted(zip(row.tolist(), which.tolist(), place.tolist(), wrong.tolist()))
    assert told == [(i, k, o, w) for i, s in enumerate(seqs[5:15]) for k, p in enumerate(panel[:24]) for o, w in plain_places(s, p, limit, limit)]


@pytest.mark.parametrize("kind", ["local", "global", "overlap", "global-local", "local-global"])
@pytest.mark.parametrize("identity", ["local", "global"])
def test_seeded_alignment_keeps_the_same_reads(kind, identity):
    rng = random.Random(11)
    word = lambda n, letters="ACGT": "".join(rng.choice(letters) for _ in range(n))
    refs = [word(rng.randint(25, 60)) for _ in range(12)] + ["ACGTN" * 6, ""]
    reads = [word(rng.randint(0, 50)) for _ in range(40)] + [word(30, "ACGTN") for _ in range(4)]
    for _ in range(160):
        ref = rng.choice(refs[:12])
        a = rng.randint(0, 5)
        own = [rng.choice("ACGT") if rng.random() < 0.04 else c for c in ref[a : a + rng.randint(20, 55)]]
        if rng.random() < 0.3:
            own.insert(rng.randrange(len(own)), rng.choice("ACGT"))
        reads.append(word(rng.randint(0, 3)) + "".join(own) + word(rng.randint(0, 3)))
    for percent, width in ((95.0, 20), (90.0, 30), (98.0, 20), (100.0, 12)):
        whole = rd.identity_scorer(refs, kind, identity, width)(reads)
        some = rd.identity_scorer(refs, kind, identity, width, least=percent)(reads)
        assert rd.shared_word(width, percent) >= 6
        assert ((whole >= percent) == (some >= percent)).all() and (some <= whole).all()
        assert (some[whole >= percent] == whole[whole >= percent]).all()


def test_shared_words_are_certain():
    for width, percent in ((20, 95), (25, 90), (30, 97), (16, 99)):
        word = rd.shared_word(width, percent)
        for w in range(width, 200):  # a changed base at the end of every stretch is the fewest that leave no word
            assert 100 * (w - w // word) / w < percent
    assert rd.shared_word(8, 60) == 0

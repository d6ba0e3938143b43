"""Operators on small inputs with known results."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scissile.functions import sequences as sq
from scissile.functions import strings as st
from scissile.operators import alignments, evaluation as ev, graphs, intervals, reads as rd, targets as tg

RANGES = "seqnames string, start long, end long, strand string, i int"


def ranges(spark, starts, width, strands="+"):
    strands = strands * len(starts) if len(strands) == 1 else strands
    return spark.createDataFrame([("chr4", s, s + width - 1, x, i) for i, (s, x) in enumerate(zip(starts, strands))], RANGES)


def by_i(df, column):
    return [r[column] for r in df.orderBy("i").collect()]


def test_pileups_merge_overlapping_not_touching(spark):
    out = intervals.pileup_clusters(ranges(spark, [1, 2, 3, 5, 8, 13, 21], 5))
    assert by_i(out, "clus_ori") == ["chr4:+:1"] * 5 + ["chr4:+:13", "chr4:+:21"]


@pytest.mark.parametrize("block", [4, 16, 1 << 20])
def test_islands_do_not_depend_on_blocks(spark, block):
    rng = random.Random(3)
    data = [("c", rng.randrange(0, 300), 0, "+", i) for i in range(200)]
    data = [(c, s, s + rng.randrange(0, 9), x, i) for c, s, _, x, i in data]
    got = {r["i"]: r["island"] for r in intervals.islands(spark.createDataFrame(data, RANGES), ["seqnames"], maxgap=1, block=block).collect()}
    reach, head = None, None
    for _, s, e, _, i in sorted(data, key=lambda r: (r[1], r[2])):
        if reach is None or s > reach + 1:
            head = s
        reach = e if reach is None else max(reach, e)
        assert got[i] == head


def test_minus_strand_origin_takes_the_largest_tie(spark):
    out = intervals.pileup_clusters(ranges(spark, [1, 2], 5, "--"))
    assert by_i(out, "clus_ori") == ["chr4:-:6"] * 2


def test_pairs(spark):
    out = intervals.identify_pairs(ranges(spark, [1, 2, 3, 5, 8, 13, 21, 34, 55], 2, "-+-+-+-+-"), [], 5, 3)
    got = by_i(out, "paired_algn")
    assert got[6:] == [None] * 3 and len(set(got[:4])) == 1 and len(set(got[4:6])) == 1 and got[0] != got[4] and None not in got[:6]


def test_loci(spark):
    got = by_i(graphs.assign_loci(ranges(spark, [1, 2, 3, 5, 8, 13, 21, 34, 55], 2, "-+-+-+-+-"), [], pairgap=5), "locus")
    assert len(set(got[:6])) == 1 and len(set(got)) == 4


def test_pairs_agree_with_a_graph(spark):
    rng = random.Random(5)
    data = [("c", s := rng.randrange(1, 4000), s, rng.choice("+-"), i) for i in range(400)]
    df = spark.createDataFrame(data, RANGES)
    got = {r["i"]: r["paired_algn"] for r in intervals.identify_pairs(df, [], 12, 5).collect()}
    parent = {(s, x): (s, x) for _, s, _, x, _ in data}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    linked = set()
    for p, a in list(parent):
        for q, b in list(parent):
            if a == "+" and b == "-" and abs(p - q) - 1 <= 12 and p - q >= -5:
                parent[find((p, a))] = find((q, b))
                linked |= {(p, a), (q, b)}
    names = {}
    for _, s, _, x, i in data:
        if (s, x) not in linked:
            assert got[i] is None
        else:
            assert names.setdefault(find((s, x)), got[i]) == got[i] is not None
    assert len(set(names.values())) == len(names)


def test_key_clusters(spark):
    kv = [("A", 1), ("A", 2), ("A", 3), ("B", 3), ("B", 4), ("B", 5), ("C", 6), ("C", 7), ("C", 8)]
    got = dict(map(tuple, graphs.cluster_keys(spark.createDataFrame(kv, "key string, val int")).collect()))
    assert got == {"A": "A", "B": "A", "C": "C"}


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r["component"] for r in graphs.connected_components(links).collect()} == {0}


def test_gene_ids(spark):
    genes = spark.createDataFrame([("chr4", s, s + 2, n) for n, s in zip("ABCDEF", [2, 5, 13, 20, 32, 60])], "seqnames string, start long, end long, symbol string")
    pts = spark.createDataFrame([("chr4", p) for p in [1, 2, 3, 5, 8, 13, 21, 34, 55]], "seqnames string, pos long")
    got = {r["pos"]: r["gene_id"] for r in intervals.annotate_genes(pts, genes, "pos", list("CDEF"), list("EF")).collect()}
    assert [got[p] for p in [1, 2, 3, 5, 8, 13, 21, 34, 55]] == ["A", "A*", "A*", "B*", "B", "C*~", "D*~", "E*~!", "F~!"]


def test_density_and_tiles(spark):
    con = spark.createDataFrame([("chr1", 25), ("chrUn_x", 99)], "seqnames string, length long")
    assert [(r["start"], r["end"]) for r in intervals.tiles(con, 10).orderBy("start").collect()] == [(1, 10), (11, 20), (21, 25)]
    pts = spark.createDataFrame([("chr1", p, p) for p in (1, 3, 12, 25)], "seqnames string, start long, end long")
    got = intervals.genomic_density(pts, con, 10, cutoff=1).orderBy("start").collect()
    assert [r["count"] for r in got] == [2, 1, 1]
    assert [round(r["log_count"], 3) for r in got] == [0.477, 0.301, 0.301] and [round(r["norm_log_count"], 3) for r in got] == [1, 0.631, 0.631]


def test_expand_positions(spark):
    df = spark.createDataFrame([("a", "chr2:+:392-394"), ("b", "chr2:*:392"), ("c", "chr2:*:390-391"), ("d", "chr2:+:400")], "n string, p string")
    got = {}
    for r in st.expand_positions(df, "p").collect():
        got.setdefault(r["n"], []).append(r["position"])
    assert {k: len(v) for k, v in got.items()} == {"a": 3, "b": 2, "c": 4, "d": 1} and sorted(got["b"]) == ["chr2:+:392", "chr2:-:392"]


def test_strings(spark):
    df = spark.createDataFrame([("a", 3, "B"), ("b", None, "C")], "x string, y int, z string")
    assert sorted(r[0] for r in df.select(st.collapse(["x", "y", "z"], "-")).collect()) == ["a-3-B", "b-NA-C"]
    seqs = spark.createDataFrame([("GBCDEFA",), ("ACBDEFG",), ("ABCDFEG",)], "s string")
    assert [r[0] for r in seqs.select(sq.divergence(F.col("s"), "ABCDEFG")).collect()] == ["G.....A", ".CB....", "....FE."]
    assert st.combo_symbols(28)[25:] == ["Z", "AA", "AB"]


def test_barcode_classes(spark):
    df = spark.createDataFrame([(1, "ACGTTT"), (2, "NNGTTT"), (3, "GGGGGG"), (4, "ACGTTA")], "read_id int, seq string")
    got = {r["read_id"]: r["barcode"] for r in rd.classify_barcodes(df, ["ACGTTT", "ACGTTA"], 6, 0).collect()}
    assert got == {1: "ACGTTT", 2: "degenerate", 3: "unassigned", 4: "ACGTTA"}
    wide = {r["read_id"]: r["barcode"] for r in rd.classify_barcodes(df, ["ACGTTT", "ACGTTA"], 6, 1).collect()}
    assert wide[1] == wide[4] == "ambiguous"


def test_trims(spark):
    df = spark.createDataFrame([(1, "ACGTACGGGGTTTT", "B" * 8 + "!" * 6), (2, "TTTTTTTTTTTTTT", "B" * 14)], "read_id int, seq string, qual string")
    cut = {r["read_id"]: r["seq"] for r in rd.quality_trim(df).collect()}
    assert cut[2] == "T" * 14 and len(cut[1]) == 7
    lead = rd.lead_trim(df, "ACGTAC").collect()
    assert [(r["read_id"], r["seq"]) for r in lead] == [(1, "GGGGTTTT")]
    over = {r["read_id"]: r["seq"] for r in rd.overread_trim(df, "GGGGTTCA", 1.0).collect()}
    assert over[1] == "ACGTACGGGGTTTT" and over[2] == "T" * 14
    umi = rd.lead_trim(df.where("read_id = 1"), "ACGNNC", collect="umi").collect()[0]
    assert umi["umi"] == "TA" and umi["seq"] == "GGGGTTTT"


def test_overread_partial_tail(spark):
    df = spark.createDataFrame([(1, "CCCCCCGATT")], "read_id int, seq string")
    assert rd.overread_trim(df, "GATTACA", 1.0).head()["seq"] == "CCCCCC"


def test_alignment_identity():
    read = "ACGTACGTACGTACGTACGTA"
    assert rd.align_identity(read, "TT" + read + "TT") == 100.0
    assert rd.align_identity(read, "TT" + read + "TT", "global-local", "global") == 100.0
    assert rd.align_identity("ACGT", "ACGA", "global", "global") == 75.0
    assert rd.align_identity("ACGT", "ACGT", "local", "local", 20) == 0.0
    assert rd.align_identity(read, read[:10] + read[11:], "global", "global") == pytest.approx(100 * (20 - 14) / 21)
    assert rd.align_identity("GGG" + read, read + "CC", "overlap", "local") == 100.0


def test_scoring_matrices():
    sym, asym, binary = (sq.scoring_matrix(k) for k in ("symmetric", "asymmetric", "binary"))
    assert sym["S", "B"] == asym["B", "S"] == 0.67 and asym["S", "B"] == 1 and binary["S", "B"] == 0 and binary["A", "R"] == 1
    assert all(m["N", c] == m[c, "N"] == m[c, c] == 1 for m in (sym, asym, binary) for c in sq.IUPAC) and sym["A", "T"] == 0


def test_alignment_filter(spark):
    df = spark.createDataFrame([(1, "ACGTACGTACGTACGTACGTA"), (2, "TTTTTTTTTTTTTTTTTTTTT")], "read_id int, seq string")
    assert [r["read_id"] for r in rd.alignment_filter(df, ["ACGTACGTACGTACGTACGTA"]).collect()] == [1]


def test_bins_and_consolidate(spark):
    df = spark.range(10).select(F.col("id").alias("read_id"), F.lit("A").alias("seq"))
    assert sorted(r["bin"] for r in rd.bins(df, 3, 100).collect()) == [1] * 10
    assert sorted(r["bin"] for r in rd.bins(df, 3, 2).collect()) == [1, 1, 1, 2, 2, 2, 3, 3, 3, 3]
    named, keys = rd.consolidate(spark.createDataFrame([(1, "C"), (2, "A"), (3, "C")], "read_id int, seq string"))
    assert {r["seq"]: r["seq_id"] for r in named.collect()} == {"A": "seq1", "C": "seq2"}
    assert {r["read_id"]: r["seq_id"] for r in keys.collect()} == {1: "seq2", 2: "seq1", 3: "seq2"}


def test_target_search_and_cut(spark):
    target = "GAGTAGCGCGAGCACAGCTA"
    window = "C" * 84 + target + "AGG" + "T" * 24
    sites = spark.createDataFrame([("chr15", 44711569, "+", window)], "seqnames string, pos long, strand string, site_seq string")
    profile = {"PAM": "NGG", "PAM_Loc": "3p", "PAM_Tol": 1, "Cut_Offset": -4}
    got = tg.compare_targets(sites, {"B2M": target}, profile).collect()
    assert [(r["target_match"], r["target_mismatch"]) for r in got] == [("B2M:(sense)", 0)]
    flipped = spark.createDataFrame([("chr15", 44711569, "+", window[::-1].translate(str.maketrans("ACGT", "TGCA")))], sites.schema)
    assert tg.compare_targets(flipped, {"B2M": target}, profile).head()["target_match"] == "B2M:(antisense)"
    none = spark.createDataFrame([("chr1", 5, "+", "A" * 131)], sites.schema)
    assert tg.compare_targets(none, {"B2M": target}, profile).head()["target_match"] == "No_valid_match"


def test_treatment_check(spark):
    m = spark.createDataFrame([(1, "A", "B2M"), (2, "A", "TRAC"), (3, "B", "TRBC"), (4, "C", "B2M")], "i int, specimen string, target_match string")
    t = spark.createDataFrame([("A", ["B2M"]), ("B", ["TRAC", "TRBC"]), ("C", ["all"])], "specimen string, treatment array<string>")
    assert by_i(tg.treated_only(m, t), "target_match") == ["B2M", "No_valid_match", "TRBC", "B2M"]


def test_fragments_weigh_umis_once(spark):
    rows = [("c", 1, 9, "+", "A", "A-1", "u1", 0.5), ("c", 1, 9, "+", "A", "A-1", "u1", 1.0), ("c", 1, 9, "+", "A", "A-1", None, 1.0)]
    got = ev.fragments(spark.createDataFrame(rows, "seqnames string, start long, end long, strand string, specimen string, sampleName string, umitag string, contrib double")).head()
    assert (got["count"], got["umitag"], got["contrib"]) == (2.5, 1.0, 1.0)


def test_exact_test_and_adjustment():
    assert math.isclose(ev.fisher_two_sided(3, 1, 1, 3), 0.4857142857, rel_tol=1e-9)
    assert ev.benjamini_hochberg([0.01, 0.04, 0.03]) == pytest.approx([0.03, 0.04, 0.04])


def test_coupling(spark):
    keys = spark.createDataFrame([("r1", "a1", "b1"), ("r2", "a2", "b2")], "read string, anchor_key string, adrift_key string").withColumn("read_pair", F.concat_ws(":", "anchor_key", "adrift_key"))
    kind = "qName string, seqnames string, start long, end long, strand string"
    anchor = spark.createDataFrame([("a1", "c", 100, 150, "+"), ("a2", "c", 100, 150, "+")], kind)
    adrift = spark.createDataFrame([("b1", "c", 250, 300, "-"), ("b2", "d", 250, 300, "-")], kind)
    out = alignments.couple(keys, anchor, adrift)
    assert [(r["read_pair"], r["start"], r["end"], r["n_loci"]) for r in out.collect()] == [("a1:b1", 100, 300, 1)]
    assert {r["read_pair"]: r["class"] for r in alignments.classify_pairs(keys, out, anchor, adrift).collect()} == {"a1:b1": "unique", "a2:b2": "chimera"}


@pytest.mark.parametrize("f", [lambda d: intervals.pileup_clusters(d), lambda d: intervals.identify_pairs(d), lambda d: intervals.reduce_ranges(d, ["seqnames", "strand"]), lambda d: intervals.coverage(d, 10), lambda d: graphs.assign_loci(d)])
def test_empty_tables(spark, f):
    assert f(spark.createDataFrame([], RANGES)).count() == 0


@pytest.mark.parametrize("strand", ["+", "-"])
def test_cut_sites_of_known_matches(spark, strand):
    profile = {"PAM": "NGG", "PAM_Loc": "3p", "PAM_Tol": 1, "Cut_Offset": -4}
    df = spark.createDataFrame([("chr15", 44711569, strand)], "c string, p long, s string")
    at = lambda prof, sense: df.select(tg.cut_site(F.col("c"), F.col("p"), F.col("s"), F.lit(85), F.lit(107), F.lit(sense), prof, 100)).head()[0]
    assert at(profile, True) == f"chr15:{strand}:44711569"
    five = {"PAM": "TTTV", "PAM_Loc": "5p", "Cut_Offset": 16}
    assert at(five, True) == f"chr15:{strand}:44711569"
    mid = {"PAM": None, "PAM_Loc": None, "Cut_Offset": "Mid_insert", "Insert_size": "14:18"}
    assert at(mid, True) == f"chr15:{strand}:44711569"
    assert at(profile, False).split(":")[1] == ("-" if strand == "+" else "+")

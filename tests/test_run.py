"""Raw reads to an evaluation, binary formats, and the commands that start them."""

import csv
import gzip
import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from scissile import cli
from scissile.plans.run import RunConfig, process_reads
from scissile.plans.summary import specimen_spread
from scissile.sources import binary, blocks, readers, writers
from tests.conftest import rows_of

BARCODES = {"A-1": ("ACGTACGT", "GGTTCCAA"), "A-2": ("TTGCAAGC", "GGTTCCAA"), "B-1": ("CCATGGTA", "AATTGGCC")}
R1_LEAD, R2_LEAD = "GACTNNNNCATG", "TTGAGTTGTC"


def raw_reads(n=60):
    """(key, R1, R2, I1, I2, sample, UMI, insert) of simulated reads; every tenth has an unknown barcode."""
    rng = random.Random(7)
    base = lambda k: "".join(rng.choice("ACGT") for _ in range(k))
    out, inserts = [], [base(60) for _ in range(8)]
    for i in range(n):
        sample = rng.choice(sorted(BARCODES))
        one, two = BARCODES[sample]
        if i % 10 == 9:
            sample, one = None, "GGGGGGGG"
        umi, insert = base(4), inserts[rng.randrange(8)]
        out.append((f"M:1:{i}", R1_LEAD.replace("NNNN", umi) + insert[:40], R2_LEAD + insert[-40:], one, two, sample, umi, insert))
    return out


def test_reads_to_sequences(spark):
    raw = raw_reads()
    table = lambda k: spark.createDataFrame([(r[0], r[k], "I" * len(r[k])) for r in raw], "read_id string, seq string, qual string")
    sheet = spark.createDataFrame([(s, *b) for s, b in BARCODES.items()], "sampleName string, barcode1 string, barcode2 string")
    config = RunConfig(r1_lead=R1_LEAD, r2_lead=R2_LEAD, lead_mismatch=0, min_length=20, umis=True)
    out = process_reads(table(1), table(2), table(3), table(4), sheet, config)
    assert {(r["key"], r["sampleName"]) for r in out["assigned"].collect()} == {(r[0], r[5] or "unassigned") for r in raw}
    got = {r["read_id"]: (r["sampleName"], r["r1"], r["r2"], r["umitag"]) for r in out["reads"].collect()}
    assert got == {r[0]: (r[5], r[7][:40], r[7][-40:], r[6]) for r in raw if r[5]}
    names = {r["seq_id"]: r["seq"] for r in out["r2"].collect()}
    assert {r["readNames"]: names[r["seqID"]] for r in out["r2_keys"].collect()} == {r[0]: r[7][-40:] for r in raw if r[5]}
    stats = {(r["sampleName"], r["metric"]): r["count"] for r in out["stats"].collect()}
    for s in BARCODES:
        n = sum(r[5] == s for r in raw)
        assert stats[s, "demulti.reads"] == stats[s, "filt.reads"] == stats[s, "umitags.reads"] == n
        assert stats[s, "R1.consol.reads"] == len({r[7][:40] for r in raw if r[5] == s})
    empty = lambda k: table(k).limit(0)
    assert all(df.count() == 0 for df in process_reads(empty(1), empty(2), empty(3), empty(4), sheet, config).values())


def test_commands_from_reads_to_summary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    raw = raw_reads()
    for k, name in enumerate(("R1", "R2", "I1", "I2"), 1):
        with gzip.open(tmp_path / f"{name}.fastq.gz", "wt") as f:
            f.write("".join(f"@{r[0]}\n{r[k]}\n+\n{'I' * len(r[k])}\n" for r in raw))
    (tmp_path / "sheet.csv").write_text("sampleName,barcode1,barcode2\n" + "".join(f"{s},{a},{b}\n" for s, (a, b) in BARCODES.items()))
    files = {n: f"{n}.fastq.gz" for n in ("R1", "R2", "I1", "I2")}
    config = {"samples": "sheet.csv", "r1_lead": R1_LEAD, "r2_lead": R2_LEAD, "lead_mismatch": 0, "min_length": 20, "umis": True}
    (tmp_path / "run.json").write_text(json.dumps(files | config))
    assert cli.main(["run", str(tmp_path / "run.json"), "-o", str(tmp_path / "out")]) == 0
    ends = {e: {r["read_id"]: r["seq"] for r in readers.fasta(spark, str(tmp_path / "out" / f"{e}.fasta" / "*")).collect()} for e in ("r1", "r2")}
    # A genome that holds every insert, and alignments of both ends to it.
    inserts = sorted({r[7] for r in raw if r[5]})
    genome, place = "T" * 500, {}
    for x in inserts:
        place[x] = len(genome)
        genome += x + "C" * 400
    (tmp_path / "g.fasta").write_text(f">chr1\n{genome}\n")

    def psl(name, seq, at, strand):
        return "\t".join(map(str, [len(seq), 0, 0, 0, 0, 0, 0, 0, strand, name, len(seq), 0, len(seq), "chr1", len(genome), at, at + len(seq), 1, f"{len(seq)},", "0,", f"{at},"]))

    lines = {"anchor": [], "adrift": []}
    for x in inserts:
        for name, seq in ends["r2"].items():
            lines["anchor"] += [psl(name, seq, place[x] + 20, "+")] if seq == x[-40:] else []
        for name, seq in ends["r1"].items():
            lines["adrift"] += [psl(name, seq, place[x], "-")] if seq == x[:40] else []
    # The adrift end lies downstream of the anchor's 5' point, on the other strand.
    for k, v in lines.items():
        (tmp_path / f"{k}.psl").write_text("\n".join(v) + "\n")
    (tmp_path / "align.json").write_text(json.dumps({"anchor_psl": "anchor.psl", "adrift_psl": "adrift.psl", "umis": True, "min_template": 10}))
    assert cli.main(["run", str(tmp_path / "align.json"), "-o", str(tmp_path / "out")]) == 0
    reads = spark.read.parquet(str(tmp_path / "out" / "reads.parquet"))
    assert reads.count() == sum(r[5] is not None for r in raw)
    assert reads.where("umitag IS NULL").count() == 0
    (tmp_path / "spec.csv").write_text("specimen,nuclease,treatment\nB,Cas9,T2\nA,Cas9,T1\n")
    (tmp_path / "genes.csv").write_text("seqnames,start,end,symbol\nchr1,450,700,GENE\nchr1,2000,2100,OTHER\n")
    (tmp_path / "eval.json").write_text(json.dumps({"targets": {"T1": genome[505:525], "T2": genome[970:990]}, "profiles": {"Cas9": {"PAM": "N", "PAM_Loc": "3p", "Cut_Offset": -3}}, "on_targets": {"T1": "chr1:*:500-540"}, "onco": ["GENE"], "name": "one"}))
    (tmp_path / "support.csv").write_text("specimen,dose\nA,high\nB,low\n")
    both = [f"{tmp_path}/out/reads.parquet"] * 1
    assert cli.main(["eval", ",".join(both), str(tmp_path / "spec.csv"), str(tmp_path / "g.fasta"), str(tmp_path / "genes.csv"), "-c", str(tmp_path / "eval.json"), "-s", str(tmp_path / "support.csv"), "-o", str(tmp_path / "eval")]) == 0
    frames = writers.load_evaluation(spark, str(tmp_path / "eval"), ["combos", "eval_summary", "algnmts"])
    assert {(r["combo"], r["treatment"]) for r in frames["combos"].collect()} == {("A", "T1"), ("B", "T2")}  # by the support file's order
    assert {r["annotation"] for r in frames["eval_summary"].collect()} == {"high", "low"}
    assert cli.main(["summary", str(tmp_path / "eval"), "-o", str(tmp_path / "s.txt"), "--csv", str(tmp_path / "tables")]) == 0
    text = (tmp_path / "s.txt").read_text()
    assert all(f"\n{k}. " in f"\n{text}" for k in range(1, 10))
    assert spark.read.option("header", True).csv(str(tmp_path / "tables" / "4_Combinations_of_nuclease_and_treatment.csv")).count() == 2
    assert cli.main(["report", str(tmp_path / "eval"), "-o", str(tmp_path / "r.html"), "--html"]) == 0
    (tmp_path / "page.html").write_text("<html><h1>{{title}}</h1>{{tables}}<p>end</p></html>")
    assert cli.main(["report", str(tmp_path / "eval"), "-o", str(tmp_path / "full"), "-t", "html", "--title", "A & B", "--template", str(tmp_path / "page.html"), "-b", "-f", "-d"]) == 0
    text = (tmp_path / "full.html").read_text()
    assert text.startswith("<html><h1>A &amp; B</h1><h2>") and text.endswith("<p>end</p></html>")
    assert spark.read.option("header", True).csv(str(tmp_path / "full_tables" / "combos.csv")).count() == 2
    assert (tmp_path / "full_figures" / "density.csv").exists()
    assert writers.load_evaluation(spark, str(tmp_path / "full_data"), ["combos"])["combos"].count() == 2
    (tmp_path / "bad.html").write_text("<html></html>")
    with pytest.raises(ValueError):
        cli.main(["report", str(tmp_path / "eval"), "-o", str(tmp_path / "x.html"), "--template", str(tmp_path / "bad.html")])
    core = ",".join(str(tmp_path / "out" / n) for n in ("run.stat", "align.stat"))
    assert cli.main(["stats", core, str(tmp_path / "eval"), str(tmp_path / "out" / "reads.parquet"), "-o", str(tmp_path / "stats.txt"), "--csv", str(tmp_path / "stats")]) == 0
    told = {n: {r["sampleName"]: r.asDict() for r in spark.read.option("header", True).csv(str(tmp_path / "stats" / f"{n}.csv")).collect()} for n in ("1_Reads_after_each_stage", "2_Outcomes_of_alignment", "3_Incorporations_by_criterion")}
    for s in BARCODES:
        n = str(sum(r[5] == s for r in raw))
        one = told["1_Reads_after_each_stage"][s]
        assert (one["demulti"], one["filt"], one["align_unique"], one["align_chimera"]) == (n, n, n, "0")
        assert told["2_Outcomes_of_alignment"][s]["unique_reads"] == n and int(told["3_Incorporations_by_criterion"][s]["total"]) > 0
    assert told["1_Reads_after_each_stage"]["unassigned"]["demulti"] == str(sum(r[5] is None for r in raw)) and "unassigned" not in told["2_Outcomes_of_alignment"]
    with pytest.raises(SystemExit):
        cli.main(["eval", "a,b", "c", "d", "e", "-c", str(tmp_path / "eval.json"), "-o", "x"])


def test_spread_of_sites(spark):
    rows = [("A", "chr1:+:5", "On-target", 3), ("A", "chr1:+:9", "Off-target", 2), ("A", None, "Off-target", 4), ("B", None, "Off-target", 1)]
    df = spark.createDataFrame(rows, "alt_specimen string, edit_site string, on_off_target string, abund long")
    assert rows_of(specimen_spread(df)) == [("A", 3, 2, 4), ("B", 0, 0, 1)]


def bam_bytes(records, refs=("chr1", "chr2")):
    body = b"BAM\1" + struct.pack("<i", 3) + b"@HD" + struct.pack("<i", len(refs)) + b"".join(struct.pack("<i", len(r) + 1) + r.encode() + b"\0" + struct.pack("<i", 1000) for r in refs)
    for name, flag, ref, pos, mapq, cigar, seq, tags in records:
        ops = b"".join(struct.pack("<I", n << 4 | blocks.CIGAR_OPS.index(o)) for n, o in cigar)
        rest = name.encode() + b"\0" + ops + bytes((len(seq) + 1) // 2) + bytes(len(seq)) + tags
        block = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + rest
        body += struct.pack("<i", len(block)) + block
    return b"".join(gzip.compress(body[i : i + 50]) for i in range(0, len(body), 50))  # many members, as BGZF has


def test_bam(spark, tmp_path):
    tags = b"NMi" + struct.pack("<i", 1) + b"XBBc" + struct.pack("<i", 3) + b"abc" + b"RGZgroup\0" + b"MDZ3A4\0"
    records = [("r1", 99, 0, 9, 60, [(3, "S"), (8, "M")], "ACGTACGTACG", tags), ("r2", 4, -1, -1, 0, [], "AC", b""), ("r3", 147, 1, 0, 7, [(5, "M"), (2, "D"), (1, "I"), (4, "M")], "ACGTACGTAC", b"MDZ5^AC4\0"), ("r4", 0x4B, 0, 3, 1, [(4, "M")], "ACGT", b"")]
    (tmp_path / "x.bam").write_bytes(bam_bytes(records))
    (tmp_path / "empty.bam").write_bytes(bam_bytes([]))
    got = rows_of(binary.bam(spark, str(tmp_path)))
    assert got == sorted([("r1", 99, "chr1", 10, 60, "3S8M", 11, 8, "3A4"), ("r2", 4, "*", 0, 0, "*", 0, 0, None), ("r3", 147, "chr2", 1, 7, "5M2D1I4M", 10, 11, "5^AC4"), ("r4", 75, "chr1", 4, 1, "4M", 4, 4, None)])
    assert [r[0] for r in rows_of(binary.bam(spark, str(tmp_path / "x.bam"), mapped_pairs=True))] == ["r1", "r3"]
    (tmp_path / "bad.bam").write_bytes(gzip.compress(b"nothing"))
    with pytest.raises(Exception, match="not a BAM file"):
        binary.bam(spark, str(tmp_path / "bad.bam")).collect()


@pytest.mark.parametrize("kind", ["2bit", "fasta"])
def test_genome_round_trip(spark, tmp_path, kind):
    rng = random.Random(3)
    rows = [(f"chr{i}", "".join(rng.choice("ACGTN") if i % 2 else rng.choice("ACGT") for _ in range(rng.choice([1, 7, 200, 1001])))) for i in range(6)] + [("n", "NNNN")]
    path = str(tmp_path / f"g.{kind}")
    df = spark.createDataFrame(rows, "seqnames string, seq string")
    binary.write_genome(df, path)
    assert [(r["seqnames"], r["seq"], r["length"]) for r in cli.genome(spark, path).orderBy("seqnames").collect()] == [(n, s, len(s)) for n, s in sorted(rows)]
    with pytest.raises(FileExistsError):
        binary.write_genome(df, path)
    with pytest.raises(ValueError):
        binary.write_genome(df, str(tmp_path / "g.txt"))


def test_one_csv_and_empty_tables(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([(2, None), (3, "y,z")], "n int, s string").withColumn("more", F.lit(5))
    writers.one_csv([a, b], str(tmp_path / "d" / "all.csv"))
    with open(tmp_path / "d" / "all.csv") as f:
        rows = list(csv.reader(f))
    assert rows[0] == ["n", "s", "more"] and sorted(rows[1:]) == [["1", "x", ""], ["2", "", "5"], ["3", "y,z", "5"]]
    writers.empty("a int, b string", str(tmp_path / "none.parquet"), spark)
    assert spark.read.parquet(str(tmp_path / "none.parquet")).columns == ["a", "b"]


def test_run_stats_count_alignments_once(spark):
    from scissile.plans.run_stats import incorporation_stats, run_stats

    kind = "sampleName string, alt_specimen string, seqnames string, start long, end long, strand string, abund long, is_pileup boolean, is_paired boolean, is_matched boolean, probable boolean, edit_site string, target_match string, on_off_target string"
    rows = [
        ("M-1", "M(A)", "chr1", 10, 40, "+", 2, True, False, True, True, "chr1:+:10", "T1", "On-target"),
        ("M-1", "M(B)", "chr1", 10, 40, "+", 2, True, False, True, True, "chr1:+:10", "T1", "On-target"),
        ("M-1", "M(C)", "chr1", 10, 40, "+", 2, False, False, True, True, "chr1:+:12", "T2", "Off-target"),
        ("M-1", "M(A)", "chr1", 90, 95, "-", 5, False, False, False, False, None, "No_valid_match", "Off-target"),
    ]
    counted = incorporation_stats(spark.createDataFrame(rows, kind))
    assert {r["metric"]: r["count"] for r in counted.collect()} == {"eval.total.algns": 7, "eval.combined.algns": 2, "eval.pileup.algns": 2, "eval.paired.algns": 0, "eval.matched.algns": 4, "eval.ontarget.algns": 2, "eval.offtarget.algns": 2}
    core = spark.createDataFrame([("M-1", "demulti.reads", 9.0), ("M-1", "demulti.reads", 1.0), ("M-1", "align.unique.reads", 99.0), ("degenerate", "demulti.reads", 3.0)], "sampleName string, metric string, count double")
    reads = spark.createDataFrame([("M-1", "a", "chr1", 10, 40, "+", "uniq"), ("M-1", "b", "chr1", 10, 50, "+", "uniq"), ("M-1", "c", "chr1", 10, 50, "+", "multihit"), ("Z-1", "d", "chr2", 1, 5, "-", "uniq")], "sampleName string, ID string, seqnames string, start long, end long, strand string, type string")
    out = run_stats(core, counted, reads, umis=False)
    assert "umitags" not in out["attrition"].columns and "R1_primer_trim" not in out["attrition"].columns
    assert [(r["sampleName"], r["demulti"], r["align_unique"]) for r in out["attrition"].collect()] == [("M-1", 10, 2), ("Z-1", 0, 1), ("degenerate", 3, 0)]
    assert [(r["sampleName"], r["unique_reads"], r["unique_algns"], r["unique_loci"]) for r in out["outcomes"].collect()] == [("M-1", 2, 2, 1), ("Z-1", 1, 1, 1)]
    assert [(r["sampleName"], r["total"], r["ontarget"]) for r in out["incorporation"].collect()] == [("M-1", 7, 2), ("Z-1", 0, 0)]
    empty = run_stats(core.limit(0), counted.limit(0), reads.limit(0))
    assert all(df.count() == 0 for df in empty.values())

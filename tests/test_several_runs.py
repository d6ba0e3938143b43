"""Runs of different guides evaluated together, and run's handling of the sheets' barcodes."""

import json
import os
import random

import pytest

from scissile import cli
from scissile.operators import staging
from scissile.plans.evaluate import Config, considered, reconcile
from scissile.plans.run import RunConfig, from_samples, process_reads, write_demultiplexed
from scissile.sources import readers, writers
from tests.conftest import rows_of


def test_reconciled_configurations():
    a = Config.of({"up": 90, "targets": {"T1": "acgt"}, "on_targets": {"T1": "chr1:+:5"}, "profiles": {"Cas9": {"PAM": "NGG"}}, "recover_multihits": True})
    b = Config.of({"up": 50, "targets": {"T2": "GGCC", "T1": ["ACGT", "TTTT"]}, "on_targets": {"T1": ["chr1:+:5", "chr2:+:7"], "T2": "chr3:*:9"}, "profiles": {"Cas9": {"PAM": "NAG"}, "Cpf1": {"PAM": "TTTN"}}})
    got = reconcile([a, b])
    assert got.targets == {"T1": ["ACGT", "TTTT"], "T2": ["GGCC"]} and got.on_targets == {"T1": ["chr1:+:5", "chr2:+:7"], "T2": ["chr3:*:9"]}
    assert got.profiles == {"Cas9": {"PAM": "NGG"}, "Cpf1": {"PAM": "TTTN"}} and got.up == 90 and not got.recover_multihits
    b.recover_multihits = True
    with pytest.raises(ValueError, match="agree in up"):
        reconcile([a, b])
    b.up = 90
    assert reconcile([a, b]).recover_multihits
    with pytest.raises(ValueError, match="UMIs in every run"):
        reconcile([Config(abundance="umi", umis=True), Config(umis=False)])


def test_targets_that_sheets_name(spark):
    config = Config(targets={"T1": "A", "T2": "C", "T3": "G"}, on_targets={"T1'2": "x", "T1": "y", "T9": "z"})
    sheet = spark.createDataFrame([("a", "T1;T2"), ("b", "Mock"), ("c", None)], "specimen string, treatment string")
    assert considered(config, sheet) == ({"T1": "A", "T2": "C"}, {"T1'2": "x", "T1": "y"})


def test_eval_of_two_runs_with_guides_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    rng = random.Random(4)
    base = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    guides = {"T1": base(20), "T2": base(20)}
    genome = base(1000) + guides["T1"] + "AGG" + base(2000) + guides["T2"] + "TGG" + base(1000)
    (tmp_path / "g.fasta").write_text(">chr1\n" + "\n".join(genome[i : i + 60] for i in range(0, len(genome), 60)) + "\n")
    (tmp_path / "genes.csv").write_text("seqnames,start,end,symbol\nchr1,900,1100,ONE\nchr1,3000,3100,TWO\n")
    cuts = {t: genome.index(s) + 18 for t, s in guides.items()}
    for k, (t, specimen) in enumerate((("T1", "A"), ("T2", "B")), 1):
        rows = [("chr1", cuts[t] + i % 3, cuts[t] + 60 + i % 3, "+", f"{specimen}-1", f"{t}r{i}", None, 1.0) for i in range(6)]
        spark.createDataFrame(rows, "seqnames string, start long, end long, strand string, sampleName string, ID string, umitag string, contrib double").write.parquet(str(tmp_path / f"reads{k}.parquet"))
        (tmp_path / f"spec{k}.csv").write_text(f"specimen,nuclease,treatment\n{specimen},Cas9,{t}\n")
        raw = {"name": f"run{k}", "targets": {t: guides[t]}, "profiles": {"Cas9": {"PAM": "NGG", "PAM_Loc": "3p", "PAM_Tol": 1, "Cut_Offset": -4}}, "on_targets": {t: f"chr1:*:{cuts[t] - 15}-{cuts[t] + 15}"}, "onco": ["ONE"]}
        (tmp_path / f"{k}.json").write_text(json.dumps(raw))
    both = lambda name: ",".join(str(tmp_path / name.format(k)) for k in (1, 2))
    args = ["eval", both("reads{}.parquet"), both("spec{}.csv"), str(tmp_path / "g.fasta"), str(tmp_path / "genes.csv"), "-c", str(tmp_path / "1.json"), str(tmp_path / "2.json"), "-o", str(tmp_path / "out")]
    before = set(os.listdir(staging.shared_folder(spark).removeprefix("file://")))
    assert cli.main(args) == 0
    assert set(os.listdir(staging.shared_folder(spark).removeprefix("file://"))) == before  # what was staged is gone
    frames = writers.load_evaluation(spark, str(tmp_path / "out"), ["algnmts", "combos", "efficiency", "off_target_sequences"])
    got = {(r["alt_specimen"], r["target_match"], r["on_off_target"]) for r in frames["algnmts"].collect()}
    assert got == {("A(A)", "T1:(sense)", "On-target"), ("B(B)", "T2:(sense)", "On-target")}
    assert {(r["combo"], r["target_seq"]) for r in frames["off_target_sequences"].collect()} == {("A", "T1"), ("B", "T2")}
    assert cli.main(["summary", str(tmp_path / "out"), "-o", str(tmp_path / "s.txt")]) == 0 and "Loci of A" in (tmp_path / "s.txt").read_text()


SHEET = [("s1", "TTNACGAA", "ACGTACGTNNNN"), ("s2", "NACGTAGG", "TTTTACGTNNWW"), ("s3", "CCCCGGGGAAAA", "GGGGGGGGNNNN")]


def raw(n=60):
    rng = random.Random(n)
    pick = {"N": "ACGT", "W": "AT", "A": "A", "C": "C", "G": "G", "T": "T"}
    rows = []
    for i in range(n):
        name, one, two = rng.choice([*SHEET, (None, "A" * 8, "C" * 12), ("degenerate", "NNACGTAC", "ACGTACGTAAAA")])
        draw = lambda code: code if name == "degenerate" else "".join(rng.choice(pick[c]) for c in code)
        one, two = draw(one), draw(two)
        rows.append((f"q{i}", "".join(rng.choice("ACGT") for _ in range(30)), "".join(rng.choice("ACGT") for _ in range(30)), one, two, name or "unassigned"))
    return rows


def test_whole_barcodes_index_umis_and_files_of_all_classes(spark, tmp_path):
    rows = raw()
    table = lambda k: spark.createDataFrame([(r[0], r[k], "I" * len(r[k])) for r in rows], "read_id string, seq string, qual string")
    sheet = spark.createDataFrame(SHEET, "sampleName string, barcode1 string, barcode2 string")
    out = process_reads(table(1), table(2), table(3), table(4), sheet, RunConfig(min_length=1, umis=True, consolidate=False))
    assert {(r["key"], r["sampleName"]) for r in out["assigned"].collect()} == {(r[0], r[5]) for r in rows}
    named = {s[0] for s in SHEET}
    assert {r["read_id"]: r["umitag"] for r in out["reads"].collect()} == {r[0]: r[4][8:] for r in rows if r[5] in named}
    write_demultiplexed({"R1": table(1), "I2": table(4)}, out["assigned"], str(tmp_path / "demulti"), rows_a_file=5)
    for end, k in (("R1", 1), ("I2", 4)):
        for name in named | {"degenerate", "unassigned"}:
            want = sorted((r[0], r[k]) for r in rows if r[5] == name)
            folder = tmp_path / "demulti" / f"{end}.fastq" / f"sampleName={name}"
            assert sorted((r["read_id"], r["seq"]) for r in readers.fastq(spark, str(folder)).collect()) == want
            files = len(list(folder.glob("*.gz")))
            assert files >= (2 if len(want) > 10 else 1)
    staging.release(spark)


def test_reads_that_are_demultiplexed_already(spark):
    table = lambda names: spark.createDataFrame([(n, "ACGTACGT", "IIIIIIII") for n in names], "read_id string, seq string, qual string")
    ends = {"s1": {"R1": table(["a", "b", "c"]), "R2": table(["b", "a", "x"])}, "s2": {"R1": table(["d"]), "R2": table(["d", "e"])}}
    assert rows_of(from_samples(ends).select("key", "sampleName")) == [("a", "s1"), ("b", "s1"), ("d", "s2")]

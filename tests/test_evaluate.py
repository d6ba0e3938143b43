"""An evaluation from reads to tables."""

import random

from scissile.plans.evaluate import Config, evaluate

TARGET = "GAGTAGCGCGAGCACAGCTA"


def test_end_to_end(spark):
    rng = random.Random(1)
    genome = "".join(rng.choice("ACGT") for _ in range(5000))
    genome = genome[:2000] + TARGET + "AGG" + genome[2023:]
    cut = 2017  # before the PAM by four
    reads = [("chr1", cut + k, cut + k + 60, "+", "A-1", f"r{i}", None, 1.0) for i, k in enumerate([0, 0, 1, 2, 3, 3])]
    reads += [("chr1", cut - 60 + k, cut + 3 + k, "-", "A-1", f"m{i}", None, 1.0) for i, k in enumerate([0, 1, 2])]
    reads += [("chr1", 4000, 4060, "+", "B-1", "far", None, 1.0)]
    reads = spark.createDataFrame(reads, "seqnames string, start long, end long, strand string, sampleName string, ID string, umitag string, contrib double")
    specimens = spark.createDataFrame([("A", "Cas9", "B2M", 0), ("B", "mock", "none", 1)], "specimen string, nuclease string, treatment string, ord int")
    genes = spark.createDataFrame([("chr1", 1900, 2100, "GENE"), ("chr1", 3900, 3950, "OTHER")], "seqnames string, start long, end long, symbol string")
    contigs = spark.createDataFrame([("chr1", genome)], "seqnames string, seq string")
    config = Config.of({"targets": {"B2M": TARGET}, "profiles": {"Cas9": {"PAM": "NGG", "PAM_Loc": "3p", "PAM_Tol": 1, "Cut_Offset": -4}}, "on_targets": {"B2M": "chr1:*:2000-2030"}, "onco": False})
    assert config.onco is None
    config.onco = ["GENE"]
    out = evaluate(reads, specimens, contigs, genes, config)
    assert {r["alt_specimen"] for r in out["specimen_totals"].join(out["algnmts"].select("specimen", "alt_specimen").distinct(), "specimen").collect()} == {"A(A)", "B(A)"}
    flags = {(r["sampleName"], r["on_off_target"], r["is_paired"], r["is_matched"]) for r in out["algnmts"].collect()}
    assert ("A-1", "On-target", True, True) in flags and ("B-1", "Off-target", False, False) in flags
    assert out["on_target"].where("alt_specimen = 'A(A)'").head()["pct_match"] == 100.0
    for name, df in out.items():
        df.collect()

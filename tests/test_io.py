"""Readers, writers and the command line."""

import gzip

from scissile import cli
from scissile.sources import readers, writers


def test_fastq_round_trip(spark, tmp_path):
    path = tmp_path / "r.fastq.gz"
    with gzip.open(path, "wt") as f:
        f.write("@r1 extra\nACGT\n+\n@BBB\n@r2\nGG\n+\nBB\n")
    got = readers.fastq(spark, str(path))
    assert sorted((r["read_id"], r["description"], r["seq"], r["qual"]) for r in got.collect()) == [("r1", "extra", "ACGT", "@BBB"), ("r2", "", "GG", "BB")]
    writers.fastq(got, str(tmp_path / "out"))
    assert sorted(r["seq"] for r in readers.fastq(spark, str(tmp_path / "out")).collect()) == ["ACGT", "GG"]


def test_fastq_records_cross_splits(spark, tmp_path):
    import random

    rng, rows = random.Random(2), []
    for i in range(400):
        n = rng.randint(0, 30)
        rows.append((f"r{i}", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+BI") for _ in range(n))))
    (tmp_path / "r.fastq").write_text("".join(f"@{a}\n{b}\n+\n{c}\n" for a, b, c in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        got = readers.fastq(spark, str(tmp_path / "r.fastq")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["read_id"], r["seq"], r["qual"]) for r in got) == sorted(rows)


def test_fasta(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1 x\nACGT\nacgt\n>chr2\nTT\n")
    assert sorted(tuple(r) for r in readers.contigs(spark, str(tmp_path / "g.fa")).collect()) == [("chr1", "ACGTACGT", 8), ("chr2", "TT", 2)]


def test_psl_sam_and_empty(spark, tmp_path):
    (tmp_path / "a.psl").write_text("")
    assert readers.psl(spark, str(tmp_path / "a.psl")).count() == 0
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nr1\t99\tchr1\t10\t60\t3S5M\t=\t50\t60\tACGTACGT\tBBBBBBBB\tNM:i:0\tMD:Z:5\n")
    r = readers.sam(spark, str(tmp_path / "a.sam")).head()
    assert (r["qname"], r["flag"], r["pos"], r["qwidth"], r["span"], r["MD"]) == ("r1", 99, 10, 8, 5, "5")


def test_stat_files(spark, tmp_path):
    (tmp_path / "s1.R1.bin01.trim.stat").write_text("s1,reads,5\n")
    r = readers.stat_files(spark, str(tmp_path)).head()
    assert (r["sampleName"], r["metric"], r["count"], r["bin"]) == ("s1", "reads", 5.0, "bin01")


def test_tables_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    for kind in ("csv", "tsv", "parquet"):
        writers.table(df, str(tmp_path / f"t.{kind}"))
    assert spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "t.tsv")).count() == 2
    writers.report({"t": df}, str(tmp_path / "r.html"), "html")
    assert "<td>NA</td>" in (tmp_path / "r.html").read_text()


def test_report_tells_of_rows_left_out(spark, tmp_path):
    df = spark.range(0, 450).selectExpr("449 - id AS locus", "array(id) AS own").repartition(4)
    for kind in ("txt", "html"):
        writers.report({"sites": df, "few": df.limit(200)}, str(tmp_path / "r"), kind)
        text = (tmp_path / "r").read_text()
        assert text.count("250 more rows are left out here") == 1
    shown = writers.text_table(df, "sites").splitlines()[3:203]
    assert [int(x.split()[0]) for x in shown] == list(range(200))


def test_list_samples(spark, tmp_path, capsys):
    (tmp_path / "s.csv").write_text("sampleName,barcode1\nA-1,ACGT\nA-2,GGTT\nB-1,TTTT\n")
    assert cli.main(["list_samples", str(tmp_path / "s.csv")]) == 0
    assert "A         2" in capsys.readouterr().out


def test_setup_and_clean(tmp_path):
    cli.main(["setup", str(tmp_path / "run")])
    assert (tmp_path / "run" / "output").is_dir()
    cli.main(["clean", str(tmp_path / "run")])
    assert not (tmp_path / "run" / "logs").exists() and (tmp_path / "run" / "output").is_dir()

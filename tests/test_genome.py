"""Genomes by pieces: FASTA cut anywhere, .2bit by ranges, sites across pieces."""

import gzip
import random

import pytest

from scissile.operators import targets
from scissile.sources import binary, genome, readers
from tests.conftest import rows_of


def contigs(seed):
    rng = random.Random(seed)
    base = lambda n: "".join(rng.choice("ACGTN" if rng.random() < 0.1 else "ACGT") for _ in range(n))
    return {"chr1": base(3001), "a-very-long-name-of-a-contig-that-many-ranges-cut": base(7), "empty": "", "chrX": base(900), "last": base(1)}


def fasta(seqs, width, end="\n", last=True):
    out = "".join(f">{n} some text > with marks{end}" + "".join(s[i : i + width].lower() + end for i in range(0, len(s), width)) for n, s in seqs.items())
    return out if last else out.removesuffix(end)


def joined(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["seqnames"], r["at"])):
        assert r["at"] == len(out.get(r["seqnames"], ""))
        out[r["seqnames"]] = out.get(r["seqnames"], "") + r["part"]
    return out


@pytest.mark.parametrize("width,end,last", [(60, "\n", True), (7, "\r\n", False), (10**6, "\n", False)])
def test_fasta_cut_anywhere(spark, tmp_path, width, end, last):
    seqs = contigs(width)
    (tmp_path / "g.fa").write_bytes(fasta(seqs, width, end, last).encode())
    for step in (13, 97, 1 << 20):
        df = genome.fasta_pieces(spark, str(tmp_path / "g.fa"), split_bytes=step, piece=50)
        assert joined(df) == seqs and max(len(r["part"]) for r in df.collect()) <= 50
    assert {tuple(r) for r in genome.lengths(df).collect()} == {(n, len(s)) for n, s in seqs.items()}


def test_gzip_and_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(genome, "RANGE", 100)
    one, two = contigs(1), {f"second{n}": s for n, s in contigs(2).items()}
    (tmp_path / "a.fa.gz").write_bytes(gzip.compress(fasta(one, 10**6).encode()))
    (tmp_path / "b.fa").write_text("ACGT\n" + fasta(two, 60))
    (tmp_path / "c.fa").write_text("")
    assert joined(genome.fasta_pieces(spark, str(tmp_path), split_bytes=64, piece=50)) == one | two


def test_twobit_by_ranges(spark, tmp_path):
    seqs = contigs(5)
    path = str(tmp_path / "g.2bit")
    binary.write_genome(spark.createDataFrame(list(seqs.items()), "seqnames string, seq string"), path)
    for step, piece in ((10, 4), (333, 100), (1 << 20, 1 << 16)):
        assert joined(genome.twobit_pieces(spark, path, step, piece)) == seqs
    assert joined(genome.pieces(spark, path)) == seqs


@pytest.mark.parametrize("cell", [100, 1 << 16])
def test_sites_of_pieces_equal_sites_of_contigs(spark, tmp_path, cell):
    seqs = {n: s for n, s in contigs(9).items() if s}
    rng = random.Random(1)
    sites = [(n, rng.randrange(-20, len(s) + 20), rng.choice("+-")) for n, s in seqs.items() for _ in range(60)]
    sites = spark.createDataFrame(sites + [("nowhere", 5, "+")], "seqnames string, pos long, strand string")
    (tmp_path / "g.fa").write_text(fasta(seqs, 60))
    parts = genome.fasta_pieces(spark, str(tmp_path / "g.fa"), split_bytes=77, piece=50)
    got = targets.site_sequences(sites, parts, 100, 30, cell)
    want = targets.site_sequences(sites, readers.contigs(spark, str(tmp_path / "g.fa")), 100, 30).where("site_seq <> ''")
    assert rows_of(got) == rows_of(want)


def test_files_are_parsed_once(spark, tmp_path):
    seqs = contigs(11)
    (tmp_path / "g.fa").write_text(fasta(seqs, 60))
    df = genome.fasta_pieces(spark, str(tmp_path / "g.fa"), split_bytes=200, piece=50)
    # Whatever reads the pieces, lengths and sites included, finds them staged; a name's own row is left only where a contig has no bases.
    assert "fasta_pieces" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [r["seqnames"] for r in df.where("part = ''").collect()] == ["empty"] and joined(df) == seqs


def test_few_tasks_for_a_large_file():
    files = [("a", 2 << 30), ("b", 5)]
    got = [p.value for p in genome.FastaReader({"files": genome.json.dumps(files), "splitbytes": str(1 << 16), "piece": "1000"}).partitions()]
    assert len(got) <= genome.blocks.MOST_TASKS + len(files) and got[-1] == ("b", 0, 5) and sum(z - a for _, a, z in got) == sum(n for _, n in files)

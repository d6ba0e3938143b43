"""Block-compressed files cut anywhere: every record once, whatever the ranges; damage is told."""

import gzip
import random
import struct

import pytest

from scissile.sources import binary, blocks, readers
from tests.conftest import rows_of

REFS = [("chr1", 50_000), ("chr2", 9_000)]


def records(seed, many):
    rng = random.Random(seed)
    out = []
    for i in range(many):
        ref = rng.choice([0, 0, 1, -1])
        ops = [] if ref < 0 else [(rng.randrange(1, 50), rng.choice("MIDS")) for _ in range(rng.randrange(1, 5))]
        length = sum(n for n, o in ops if o in "MIS") if ops else rng.choice([4, 900])
        md = None if rng.random() < 0.3 else f"{rng.randrange(90)}A"
        tags = b"NMi" + struct.pack("<i", i) + b"XBBc" + struct.pack("<i", 3) + b"MDZ" + (b"" if md is None else b"MDZ" + md.encode() + b"\0")
        out.append((f"r{i}" + "x" * rng.randrange(40), rng.randrange(4096), ref, 0 if ref < 0 else rng.randrange(1, 9000), rng.randrange(60), ops, length, tags, md))
    return out


def wanted(r):
    name, flag, ref, pos, mapq, ops, _, _, md = r
    size = lambda which: sum(n for n, o in ops if o in which)
    return name, flag, REFS[ref][0] if ref >= 0 else "*", pos, mapq, "".join(f"{n}{o}" for n, o in ops) or "*", size("MIS"), size("MD"), md


def bam_file(path, rows, block, text="@HD\n"):
    body = blocks.bam_header(REFS, text) + b"".join(blocks.bam_record(*r[:8]) for r in rows)
    path.write_bytes(blocks.to_blocks(body, block) + blocks.END_BLOCK)
    return f"file://{path}", path.stat().st_size


def read(uri, size, step, kind=blocks.bam_records, **more):
    out = []
    for a in range(0, size, step):
        for batch in kind(uri, a, min(size, a + step), **more):
            out += [tuple(r.values()) for r in batch.to_pylist()]
    return out


@pytest.mark.parametrize("block", [37, 400, 5000, 0xFF00])
@pytest.mark.parametrize("text", ["@HD\n", "@CO\t" + "long header " * 300])
def test_bam_cut_anywhere(tmp_path, block, text):
    rows = records(block, 300)
    uri, size = bam_file(tmp_path / "x.bam", rows, block, text)
    for step in (97, 1000, 7001, size):
        got = read(uri, size, step, tests=[])
        assert [g[:9] for g in got] == [wanted(r) for r in rows]
        assert [g[9] for g in got] == [r[1] & 1 > 0 and r[1] & 0xC == 0 for r in rows]


def test_records_longer_than_blocks_and_ranges(tmp_path):
    rows = [("a", 1, 0, 5, 9, [(40_000, "M")], 40_000, b"", None), ("b", 1, 1, 5, 9, [(10, "M")], 10, b"", None)] * 4
    uri, size = bam_file(tmp_path / "x.bam", rows, 1000)
    assert [g[:9] for g in read(uri, size, 300, tests=[])] == [wanted(r) for r in rows]


def test_small_pieces(tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "PIECE", 500)
    rows = records(1, 200)
    uri, size = bam_file(tmp_path / "x.bam", rows, 400)
    assert [g[:9] for g in read(uri, size, 2000, tests=[])] == [wanted(r) for r in rows]
    plain = tmp_path / "p.bam"
    plain.write_bytes(gzip.compress(blocks.bam_header(REFS) + b"".join(blocks.bam_record(*r[:8]) for r in rows)))
    assert [g[:9] for g in read(f"file://{plain}", plain.stat().st_size, 900, tests=[])] == [wanted(r) for r in rows]


def test_damage_is_told(tmp_path):
    uri, size = bam_file(tmp_path / "x.bam", records(2, 100), 300)
    data = (tmp_path / "x.bam").read_bytes()
    cases = {"no end": data[:-28], "inside a block": data[: size // 2], "a byte": data[: size // 2] + bytes([data[size // 2] ^ 0x55]) + data[size // 2 + 1 :], "nothing": b""}
    body = blocks.bam_header(REFS) + blocks.bam_record(*records(2, 1)[0][:8])
    cases["inside a record"] = blocks.to_blocks(body[:-3]) + blocks.END_BLOCK
    cases["plain, cut"] = gzip.compress(body)[:-4]
    for name, bad in cases.items():
        (tmp_path / "bad.bam").write_bytes(bad)
        with pytest.raises(ValueError):
            read(f"file://{tmp_path}/bad.bam", max(1, len(bad)), 500, tests=[])
            raise AssertionError(name)


@pytest.mark.parametrize("block", [37, 400, 0xFF00])
def test_fastq_cut_anywhere(tmp_path, block):
    rng, rows = random.Random(block), []
    for i in range(300):
        n = rng.randrange(0, 60)
        rows.append((f"@@r{i} a @b +", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+BI") for _ in range(n))))
    for end, line in (("\n", "\n"), ("", "\n"), ("\r\n", "\r\n")):
        text = line.join(f"@{a}{line}{b}{line}+{line}{c}" for a, b, c in rows) + end
        path = tmp_path / "r.fastq.gz"
        path.write_bytes(blocks.to_blocks(text.encode(), block) + blocks.END_BLOCK)
        for step in (61, 500, path.stat().st_size):
            assert read(f"file://{path}", path.stat().st_size, step, blocks.fastq_records) == rows
    path.write_bytes(gzip.compress(text.encode()))
    assert read(f"file://{path}", path.stat().st_size, 500, blocks.fastq_records) == rows
    path.write_bytes(blocks.to_blocks(text.encode()[:-9], block) + blocks.END_BLOCK)
    with pytest.raises(ValueError):
        read(f"file://{path}", path.stat().st_size, 500, blocks.fastq_records)


def test_sources_through_spark(spark, tmp_path):
    rows = records(7, 3000)
    bam_file(tmp_path / "x.bam", rows, 2000)
    df = binary.bam(spark, str(tmp_path / "x.bam"), split_bytes=9000)
    assert df.rdd.getNumPartitions() > 5 and rows_of(df) == rows_of(spark.createDataFrame([wanted(r) for r in rows], df.schema))
    want = sorted(r[0] for r in rows if r[1] & 1 and not r[1] & 0xC)
    pairs = binary.bam(spark, str(tmp_path), mapped_pairs=True, split_bytes=9000)
    assert sorted(r["qname"] for r in pairs.collect()) == want
    some = df.where("flag >= 100 AND mapq IN (3, 4, 5) AND rname = 'chr2' AND pos < 5000")
    assert sorted(r["qname"] for r in some.collect()) == sorted(r[0] for r in rows if r[1] >= 100 and r[4] in (3, 4, 5) and r[2] == 1 and r[3] < 5000)
    none = df.where("rname IN ('*', 'nowhere')")
    assert none.count() == sum(r[2] < 0 for r in rows)
    text = "".join(f"@q{i} d\nAC\n+\nII\n" for i in range(900))
    (tmp_path / "r.fastq.gz").write_bytes(blocks.to_blocks(text.encode(), 500) + blocks.END_BLOCK)
    got = binary.fastq_blocks(spark, str(tmp_path / "r.fastq.gz"), split_bytes=1000)
    assert got.rdd.getNumPartitions() > 2 and rows_of(got) == rows_of(readers.fastq(spark, str(tmp_path / "r.fastq.gz")))


def test_filters_are_pushed():
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith

    reader = blocks.BamReader({"files": "[]"})
    left = list(reader.pushFilters([EqualTo(("mapped_pair",), True), StringStartsWith(("qname",), "r"), GreaterThan(("mapq",), 3), EqualTo(("rname",), "chr1")]))
    assert [type(f) for f in left] == [StringStartsWith] and len(reader.filters) == 3


def test_a_range_reads_little_beyond_itself(tmp_path, monkeypatch):
    uri, size = bam_file(tmp_path / "x.bam", records(3, 60_000), 20_000)
    inflated, plain = [], blocks.zlib.decompress
    monkeypatch.setattr(blocks.zlib, "decompress", lambda *a: (inflated.append(1), plain(*a))[1])
    ends = [m.start() for m in blocks.BLOCK.finditer((tmp_path / "x.bam").read_bytes())]
    start, stop = size // 3, size // 3 + 50_000
    assert sum(b.num_rows for b in blocks.bam_records(uri, start, stop, [])) > 500
    # The range's own blocks, the header's and those that the last record goes on in.
    assert len(inflated) <= sum(start <= e < stop for e in ends) + 3 and len(ends) > 40


def test_tasks_stay_few(tmp_path):
    files = [("a", 5 << 30), ("b", 0), ("c", 77)]
    got = [p.value for p in blocks._splits({"files": blocks.json.dumps(files), "splitbytes": str(1 << 16)})]
    assert len(got) <= blocks.MOST_TASKS + len(files)
    for uri, size in files:
        own = [(a, z) for u, a, z in got if u == uri]
        assert [a for a, _ in own] == [0] + [z for _, z in own[:-1]] and own[-1][1] == size
    assert max(z - a for _, a, z in got) <= blocks.SPLIT_BYTES
    wide = blocks._splits({"files": blocks.json.dumps([("a", 100 << 30)]), "splitbytes": str(1 << 16)})
    assert {z - a for _, a, z in (p.value for p in wide)} == {blocks.SPLIT_BYTES}


def test_records_of_a_batch_at_once(monkeypatch):
    import pyarrow as pa

    rng, rows = random.Random(5), []
    for i in range(400):
        cigar = rng.choice(["*", "", "3M", "2S30M1I4D8=2X", f"{rng.randrange(1, 3000)}M", "7H5M9N5M"])
        rows.append((f"q{i}" + "ä" * rng.randrange(9), rng.randrange(1 << 16), rng.choice(["chr1", "chr2", "*"]), rng.randrange(0, 9000), rng.randrange(256), cigar, rng.choice([None, "", "20A19", "9" * rng.randrange(60)])))
    places = {"chr1": 0, "chr2": 1, "*": -1}
    want = b""
    for name, flag, ref, pos, mapq, cigar, md in rows:
        runs = [(int(n), o) for n, o in blocks.re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
        want += blocks.bam_record(name, flag, places[ref], pos, mapq, runs, sum(n for n, o in runs if o in "MIS=X"), b"" if md is None else b"MDZ" + md.encode() + b"\0")
    batch = lambda own: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*own), (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()))], names=list("abcdefg"))
    assert b"".join(blocks.bam_bytes(batch(rows), places)) == want == b"".join(blocks.bam_bytes(batch([rows[0], *rows])[1:], places))
    monkeypatch.setattr(blocks, "PIECE", 5000)
    assert b"".join(blocks.bam_bytes(batch(rows), places)) == want
    for bad in ((None, *rows[0][1:]), ("n" * 255, *rows[0][1:]), (rows[0][0], 1 << 16, *rows[0][2:])):
        with pytest.raises(ValueError):
            list(blocks.bam_bytes(batch([rows[1], bad]), places))
    with pytest.raises(KeyError):
        list(blocks.bam_bytes(batch([(*rows[0][:2], "chr9", *rows[0][3:])]), places))

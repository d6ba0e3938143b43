"""Genomes by pieces: no row holds more of a contig than some 64 kB, whatever its length.

FASTA is read by ranges of bytes through the data source `fasta_pieces`; what a range
cannot tell alone (which contig its first bytes belong to, and how far in) follows
from an index of all pieces without their bases, a row a piece.  Files are parsed once: what
the ranges give is staged, and the index reads it without the bases.  .2bit files have an
index of their own; their contigs are read by ranges of bases.  Pieces are
(seqnames, at, part): `at` counts from 0, parts of a contig follow each other.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from . import blocks
from .binary import TWOBIT_BASES, TWOBIT_SIGNATURE, listed

#: Bases of a piece, bytes of a file or bases of a contig that a task is given.
PIECE, RANGE = 1 << 16, 8 << 20
COLUMNS = "file string, at long, k int, name string, rest boolean, open string, part string"
_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
#: The place of a range's last row, which says what its last line is.
LAST = (1 << 31) - 1


def _rows(uri: str, at: int, text: bytes, fresh: bool, more, piece: int):
    """Rows of a range's bytes: contigs that begin in it, pieces of bases, and last what kind of line its end lies in.

    fresh: whether the range begins a line; what precedes its first line end is marked `rest` otherwise, as it may be bases
    or a name.  more(): the rest of a name that the range's end cuts.
    """
    k, i, open_ = 0, 0, "s"
    bare = lambda x: x.translate(None, b" \t\r\n\x0b\x0c").upper().decode("latin-1")

    def bases(raw: bytes, rest: bool):
        nonlocal k
        for a in range(0, len(raw), piece):
            if part := bare(raw[a : a + piece]):
                yield (uri, at, k, None, rest, None, part)
                k += 1

    if not fresh:
        end = text.find(b"\n")
        yield from bases(text if end < 0 else text[:end], True)
        i, open_ = (len(text), "p") if end < 0 else (end + 1, "s")
    while i < len(text):
        if text[i : i + 1] == b">":
            end = text.find(b"\n", i)
            line = text[i + 1 :] + more() if end < 0 else text[i + 1 : end]
            yield (uri, at, k, (line.split(None, 1) or [b""])[0].decode(), False, None, "")
            k, i, open_ = k + 1, len(text) if end < 0 else end + 1, "h" if end < 0 else "s"
        else:
            end = text.find(b"\n>", i)
            yield from bases(text[i:] if end < 0 else text[i:end], False)
            i, open_ = len(text) if end < 0 else end + 1, "s"
    yield (uri, at, LAST, None, False, open_, "")


def fasta_rows(uri: str, start: int, stop: int, piece: int = PIECE):
    with blocks._open(uri) as file:
        size = file.size()
        if file.read_at(min(2, size), 0) == b"\x1f\x8b":  # gzip: one task, in stretches of whole lines
            if start:
                return
            held, at, fresh = b"", 0, True
            for data, _ in blocks.inflate_all(file):
                held += data
                if len(held) < RANGE:
                    continue
                cut = held.rfind(b"\n") + 1 or len(held)
                yield from _rows(uri, at, held[:cut], fresh, lambda: b"", piece)
                fresh, at, held = held[cut - 1 : cut] == b"\n", at + cut, held[cut:]
            yield from _rows(uri, at, held, fresh, lambda: b"", piece)
            return

        def more():
            out, at = b"", stop
            while at < size and b"\n" not in out:
                out += file.read_at(min(1 << 12, size - at), at)
                at = stop + len(out)
            return out.split(b"\n")[0]

        fresh = start == 0 or file.read_at(1, start - 1) == b"\n"
        yield from _rows(uri, start, file.read_at(stop - start, start), fresh, more, piece)


class FastaReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        return blocks.ranges(json.loads(self.options["files"]), int(self.options["splitbytes"]), RANGE)

    def read(self, partition):
        rows, size = [], 0
        for row in fasta_rows(*partition.value, int(self.options["piece"])):
            rows.append(row)
            size += len(row[-1])
            if size > 4 << 20:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows):
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_NAMES)


class FastaSource(DataSource):
    @classmethod
    def name(cls):
        return "fasta_pieces"

    def schema(self):
        return COLUMNS

    def reader(self, schema):
        return FastaReader(self.options)


def fasta_pieces(spark: SparkSession, path, split_bytes: int = RANGE, piece: int = PIECE) -> DataFrame:
    """(seqnames, at, part) of FASTA files; a contig without bases has one empty piece.  Bases before a file's first name are left out."""
    import sys

    from pyspark import cloudpickle

    from ..operators.staging import staged

    blocks.register(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FastaSource)
    files = [(r["path"], r["length"]) for r in listed(spark, path, "*", "length").where("length > 0").collect()]  # a row a file
    rows = spark.read.format("fasta_pieces").option("files", json.dumps(files)).option("splitBytes", split_bytes).option("piece", piece).load()
    rows = staged(rows.withColumn("n", F.length("part").cast("long")))
    order = W.partitionBy("file").orderBy("at", "k")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    index = rows.select("file", "at", "k", "name", "rest", "open", "n")
    # A line that is still a name at a range's end goes on as one; ranges without a line end pass that on.
    told = F.last(F.when(F.col("open") != "p", F.col("open")), ignorenulls=True).over(before)
    index = index.withColumn("named", F.col("rest") & F.coalesce(told == "h", F.lit(False)))
    index = index.withColumn("contig", F.count("name").over(order)).withColumn("seqnames", F.last("name", ignorenulls=True).over(order))
    index = index.where("k < 2147483647 AND NOT named AND contig > 0")
    contig = W.partitionBy("file", "contig").orderBy("at", "k")
    at = F.coalesce(F.sum("n").over(contig.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # A name's own row stands only for a contig that has no bases.
    bare = F.sum("n").over(contig.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) == 0
    index = staged(index.select("file", "at", "k", "seqnames", at.alias("__at"), "n", bare.alias("__bare")).where("n > 0 OR __bare").drop("n", "__bare"))
    own = rows.where("k < 2147483647").select("file", "at", "k", "part").join(index, ["file", "at", "k"])
    return own.select("seqnames", F.col("__at").alias("at"), "part")


def twobit_pieces(spark: SparkSession, path, split_bases: int = RANGE, piece: int = PIECE) -> DataFrame:
    """(seqnames, at, part) of .2bit genomes, masked bases in capitals: ranges of contigs are read by their offsets."""
    bases, signature = TWOBIT_BASES, TWOBIT_SIGNATURE

    def contigs(batches):
        import struct

        from pyarrow.fs import FileSystem

        for given in batches:
            for uri in given.column(0).to_pylist():
                fs, name = FileSystem.from_uri(uri)
                with fs.open_input_file(name) as f:
                    if (head := f.read(16))[:4] != struct.pack("<I", signature):
                        raise ValueError(f"{uri} is not a little-endian .2bit file")
                    index = [(f.read(f.read(1)[0]).decode(), struct.unpack("<I", f.read(4))[0]) for _ in range(struct.unpack_from("<I", head, 8)[0])]
                    for i in range(0, len(index), 10_000):
                        names, offsets = zip(*index[i : i + 10_000])
                        sizes = [struct.unpack("<I", f.read_at(4, o))[0] for o in offsets]
                        yield pa.RecordBatch.from_pydict({"uri": [uri] * len(names), "seqnames": list(names), "offset": pa.array(offsets, pa.int64()), "size": pa.array(sizes, pa.int64())})

    def read(batches):
        import struct

        import numpy as np
        from pyarrow.fs import FileSystem

        letters = np.frombuffer(bases.encode(), np.uint8)
        for given in batches:
            for uri, name, offset, size, first in zip(*(c.to_pylist() for c in given.columns)):
                fs, path = FileSystem.from_uri(uri)
                with fs.open_input_file(path) as f:
                    many = struct.unpack("<I", f.read_at(4, offset + 4))[0]
                    unknown = np.frombuffer(f.read_at(8 * many, offset + 8), "<u4").reshape(2, many).astype(np.int64)
                    at = offset + 8 + 8 * many
                    at += 8 + 8 * struct.unpack("<I", f.read_at(4, at))[0]  # masked stretches, then a reserved number
                    last = min(size, first + split_bases)
                    low = first // 4
                    packed = np.frombuffer(f.read_at((last + 3) // 4 - low, at + low), np.uint8)
                    seq = letters[((packed[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).ravel()[first - 4 * low : last - 4 * low]]
                    starts, ends = np.maximum(unknown[0], first), np.minimum(unknown[0] + unknown[1], last)
                    for a, z in zip(starts[starts < ends].tolist(), ends[starts < ends].tolist()):
                        seq[a - first : z - first] = ord("N")
                places = list(range(first, last, piece)) or [first]
                yield pa.RecordBatch.from_pydict({"seqnames": [name] * len(places), "at": pa.array(places, pa.int64()), "part": [seq[a - first : a - first + piece].tobytes().decode() for a in places]})

    own = listed(spark, path, "*.2bit").mapInArrow(contigs, "uri string, seqnames string, offset long, size long")
    ranges = own.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bases).cast("long"))))
    return ranges.repartition("uri", "seqnames", "first").mapInArrow(read, "seqnames string, at long, part string")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """A genome's pieces, by the path's extension."""
    return twobit_pieces(spark, path) if path.endswith(".2bit") else fasta_pieces(spark, path)


def lengths(parts: DataFrame) -> DataFrame:
    """(seqnames, length) of pieces."""
    return parts.groupBy("seqnames").agg(F.max(F.col("at") + F.length("part")).cast("long").alias("length"))

"""Binary formats: BAM alignment files and .2bit genomes.

BAM files and block-compressed FASTQ are read by ranges of bytes (see blocks);
.2bit files by ranges of their contigs.  Paths are those that Spark lists and
Arrow's filesystems open.
"""

from __future__ import annotations

import json
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .readers import named

#: Fixed values of .2bit: the order of bases, the signature.
TWOBIT_BASES, TWOBIT_SIGNATURE = "TCAG", 0x1A412743


def bam(spark: SparkSession, path, mapped_pairs: bool = False, split_bytes: int = blocks.SPLIT_BYTES) -> DataFrame:
    """(qname, flag, rname, pos, mapq, cigar, qwidth, span, MD) of BAM files, as readers.sam has them.

    A file is read by a task for each split_bytes of it (wider ranges where those would be over blocks.MOST_TASKS), records
    that cross a border included.  mapped_pairs: only records
    of paired reads that are mapped as their mates are; the others' fields are never read.
    """
    rows = _scan(spark, path, "*.bam", "bam", split_bytes)
    return (rows.where("mapped_pair = true") if mapped_pairs else rows).drop("mapped_pair")


def fastq_blocks(spark: SparkSession, path, split_bytes: int = blocks.SPLIT_BYTES) -> DataFrame:
    """(read_id, description, seq, qual) of gzip FASTQ, as readers.fastq has them: by many tasks a file where it is block-compressed."""
    return named(_scan(spark, path, "*.gz", "bgzf_fastq", split_bytes).withColumnRenamed("name", "__name"))


def _scan(spark: SparkSession, path, pattern: str, kind: str, split_bytes: int) -> DataFrame:
    blocks.register(spark)
    files = [(r["path"], r["length"]) for r in listed(spark, path, pattern, "length").collect()]  # a row a file
    return spark.read.format(kind).option("files", json.dumps(files)).option("splitBytes", split_bytes).load()


def listed(spark: SparkSession, path, pattern: str, *more: str) -> DataFrame:
    """(path) of each file, a task each; their contents aren't read here."""
    reader = spark.read.format("binaryFile")
    listed = reader.load(path) if str(path).endswith(pattern.lstrip("*")) else reader.option("pathGlobFilter", pattern).load(path)
    return listed.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), *more)


def twobit(spark: SparkSession, path) -> DataFrame:
    """(seqnames, seq, length) of .2bit genomes, masked bases in capitals."""
    bases, signature = TWOBIT_BASES, TWOBIT_SIGNATURE

    def scan(batches):
        import struct

        import numpy as np
        import pyarrow as pa
        from pyarrow.fs import FileSystem

        letters = np.frombuffer(bases.encode(), np.uint8)
        for given in batches:
            for uri in given.column(0).to_pylist():
                fs, name = FileSystem.from_uri(uri)
                with fs.open_input_file(name) as f:
                    number = lambda: struct.unpack("<I", f.read(4))[0]
                    if number() != signature:
                        raise ValueError(f"{uri} is not a little-endian .2bit file")
                    number()
                    many, _ = number(), number()
                    index = [(f.read(f.read(1)[0]).decode(), number()) for _ in range(many)]
                    for seqname, offset in index:
                        f.seek(offset)
                        size = number()
                        blocks = []
                        for _ in range(2):  # stretches of N, then masked ones
                            n = number()
                            blocks.append(np.frombuffer(f.read(8 * n), "<u4").reshape(2, n))
                        number()
                        packed = np.frombuffer(f.read((size + 3) // 4), np.uint8)
                        seq = letters[((packed[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).ravel()[:size]]
                        for start, length in blocks[0].T.tolist():
                            seq[start : start + length] = ord("N")
                        yield pa.RecordBatch.from_pydict({"seqnames": [seqname], "seq": [seq.tobytes().decode()], "length": pa.array([size], pa.int64())})

    return listed(spark, path, "*.2bit").mapInArrow(scan, "seqnames string, seq string, length long")


def pack_contigs(contigs: DataFrame) -> DataFrame:
    """(seqnames, size, record): each contig's .2bit record; other letters than bases become N."""
    bases = TWOBIT_BASES

    def pack(batches):
        import struct

        import numpy as np
        import pyarrow as pa

        code = np.full(256, 4, np.uint8)
        for i, b in enumerate(bases):
            code[[ord(b), ord(b.lower())]] = i
        for given in batches:
            for name, seq in zip(given.column(0).to_pylist(), given.column(1).to_pylist()):
                raw = code[np.frombuffer((seq or "").encode("latin-1", "replace"), np.uint8)]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], raw == 4, [0]]).astype(np.int8)))
                start, end = edge[::2], edge[1::2]
                two = np.zeros((len(raw) + 3) // 4 * 4, np.uint8)
                two[: len(raw)] = raw & 3
                packed = (two.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)).sum(1).astype(np.uint8)
                record = struct.pack("<II", len(raw), len(start)) + start.astype("<u4").tobytes() + (end - start).astype("<u4").tobytes() + struct.pack("<II", 0, 0) + packed.tobytes()
                yield pa.RecordBatch.from_pydict({"seqnames": [name], "size": pa.array([len(record)], pa.int64()), "record": pa.array([record], pa.binary())})

    return contigs.select("seqnames", "seq").mapInArrow(pack, "seqnames string, size long, record binary")


def write_genome(contigs: DataFrame, path: str) -> None:
    """One .2bit or FASTA file, by the path's extension, of contigs (seqnames, seq) by name; an existing file is an error.

    One file is written by the driver, which holds a contig at a time.
    """
    if path.endswith(".2bit"):
        from ..operators.staging import staged

        packed = staged(pack_contigs(contigs))
        sizes = [(r["seqnames"], r["size"]) for r in packed.select("seqnames", "size").orderBy("seqnames").collect()]  # a row a contig
        at = 16 + sum(5 + len(n.encode()) for n, _ in sizes)
        with open(path, "xb") as f:
            f.write(struct.pack("<IIII", TWOBIT_SIGNATURE, 0, len(sizes), 0))
            for name, size in sizes:
                f.write(bytes([len(name.encode())]) + name.encode() + struct.pack("<I", at))
                at += size
            for r in packed.orderBy("seqnames").toLocalIterator():
                f.write(r["record"])
    elif path.endswith((".fasta", ".fa")):
        with open(path, "x") as f:
            for r in contigs.select("seqnames", "seq").orderBy("seqnames").toLocalIterator():
                f.write(f">{r['seqnames']}\n")
                f.writelines(r["seq"][i : i + 80] + "\n" for i in range(0, len(r["seq"] or ""), 80))
    else:
        raise ValueError("a genome is written as .2bit, .fasta or .fa")

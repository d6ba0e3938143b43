"""Named queries of readers and writers: tables are written in the formats that runs use and read again.

Files stand in the folder that all executors share.  Importing this module registers its queries with contract.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import reads as rd, targets
from ..operators.staging import shared_folder
from ..sources import binary, genome, readers, writers
from .contract import READ, genes, query, reads, t


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/trip-{uuid.uuid4().hex}/{name}"


QUAL = "translate(md5(CAST({} AS {})), '0123456789abcdef', '@+?FGHIJKLMNOPQR')"


@query(f"{READ} SELECT 'r' || id AS read_id, seq, {QUAL.format('cust', 'VARCHAR')} AS qual FROM reads")
def fastq_scan(spark, d):
    """Gzip FASTQ; qualities may begin with @ or +."""
    path = place(spark, "reads.fastq")
    own = reads(spark, d)
    writers.fastq(own.select(F.concat(F.lit("r"), "read_id").alias("read_id"), "seq", F.expr(QUAL.format("cust", "STRING")).alias("qual")), path)
    return readers.fastq(spark, path).select("read_id", "seq", "qual")


@query(f"{READ} SELECT 'r' || id AS read_id, 'cust ' || cust AS description, seq FROM reads")
def fasta_scan(spark, d):
    path = place(spark, "reads.fasta")
    writers.fasta(reads(spark, d).select(F.concat(F.lit("r"), "read_id", F.lit(" cust "), "cust").alias("read_id"), "seq"), path, gzip=False)
    return readers.fasta(spark, f"{path}/*")


@query(f"{READ} SELECT 'r' || id AS read_id, seq FROM reads WHERE cust % 3 = 1")
def fastq_by_sample(spark, d):
    """Reads written to a folder a sample, of which one is read."""
    path = place(spark, "samples")
    own = reads(spark, d).select(F.concat(F.lit("r"), "read_id").alias("read_id"), "seq", F.expr(QUAL.format("cust", "STRING")).alias("qual"), F.concat(F.lit("s"), F.col("cust") % 3).alias("sampleName"))
    writers.fastq(own, path, ["sampleName"])
    return readers.fastq(spark, f"{path}/sampleName=s1").select("read_id", "seq")


_PSL = {n: f"l_partkey % {k + 7}" for k, n in enumerate(readers.PSL_NAMES) if n not in readers.PSL_TEXT}


@query("SELECT CAST(l_orderkey AS VARCHAR) AS \"qName\", CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, 'chr' || (l_suppkey % 5) AS \"tName\", CAST(l_linenumber AS BIGINT) AS matches, CAST(" + _PSL["qSize"] + " AS BIGINT) AS \"qSize\", CAST(" + _PSL["tStart"] + " AS BIGINT) AS \"tStart\", CAST(" + _PSL["blockCount"] + " AS BIGINT) AS \"blockCount\", '7,' AS \"tStarts\" FROM lineitem")
def psl_scan(spark, d):
    path = place(spark, "hits.psl")
    text = {"strand": "if(l_linestatus = 'O', '+', '-')", "qName": "CAST(l_orderkey AS STRING)", "tName": "concat('chr', l_suppkey % 5)", "blockSizes": "'5,'", "qStarts": "'0,'", "tStarts": "'7,'", "matches": "l_linenumber"}
    t(spark, d, "lineitem").selectExpr(*(f"{text.get(n) or _PSL[n]} AS {n}" for n in readers.PSL_NAMES)).write.option("sep", "\t").option("compression", "gzip").csv(path)
    return readers.psl(spark, path).select("qName", "strand", "tName", "matches", "qSize", "tStart", "blockCount", "tStarts")


@query("SELECT 'q' || l_orderkey AS qname, CAST(l_partkey % 256 AS INTEGER) AS flag, 'chr' || (l_suppkey % 5) AS rname, l_orderkey AS pos, CAST(l_linenumber AS INTEGER) AS mapq, CAST(l_partkey % 9 + 1 + 40 + 2 AS INTEGER) AS qwidth, CAST(40 + 3 AS INTEGER) AS span, CASE WHEN l_linenumber % 2 = 0 THEN '20A19' END AS \"MD\" FROM lineitem")
def sam_scan(spark, d):
    """Clips, insertions and deletions; a header line a file; the MD tag in half of the records."""
    path = place(spark, "hits.sam")
    cigar = "concat(l_partkey % 9 + 1, 'S30M2I3D10M')"
    md = "if(l_linenumber % 2 = 0, '\tMD:Z:20A19', '')"
    line = f"concat(concat_ws('\t', concat('q', l_orderkey), l_partkey % 256, concat('chr', l_suppkey % 5), l_orderkey, l_linenumber, {cigar}, '=', 1, 0, '*', '*', 'NM:i:0'), {md}) AS value"
    t(spark, d, "lineitem").selectExpr(line).unionByName(spark.createDataFrame([("@HD\tVN:1.6",)], "value string")).write.text(path)
    return readers.sam(spark, path).select("qname", "flag", "rname", "pos", "mapq", "qwidth", "span", "MD")


_BAM = "SELECT 'q' || l_orderkey AS qname, CAST(l_partkey % 256 AS INTEGER) AS flag, 'chr' || (l_suppkey % 5) AS rname, l_orderkey AS pos, CAST(l_linenumber AS INTEGER) AS mapq, CAST(l_partkey % 9 + 1 + 40 + 2 AS INTEGER) AS qwidth, CAST(40 + 3 AS INTEGER) AS span, CASE WHEN l_linenumber % 2 = 0 THEN '20A19' END AS \"MD\" FROM lineitem"


def bam_rows(spark, d):
    return t(spark, d, "lineitem").selectExpr("concat('q', l_orderkey) AS qname", "CAST(l_partkey % 256 AS INT) AS flag", "concat('chr', l_suppkey % 5) AS rname", "l_orderkey AS pos", "CAST(l_linenumber AS INT) AS mapq", "concat(l_partkey % 9 + 1, 'S30M2I3D10M') AS cigar", "if(l_linenumber % 2 = 0, '20A19', NULL) AS MD")


def bam_files(spark, d) -> str:
    path = place(spark, "hits-bam")
    writers.bam(bam_rows(spark, d), path, [(f"chr{i}", (1 << 31) - 1) for i in range(5)]).collect()  # a row a file
    return path


@query(_BAM)
def bam_scan(spark, d):
    """Block-compressed files, a task for every 64 kB of them, or for more where that would be over a thousand tasks."""
    return binary.bam(spark, bam_files(spark, d), split_bytes=1 << 16).drop("cigar")


@query(f"{_BAM} WHERE flag % 2 = 1 AND flag % 16 < 4 AND mapq >= 3 AND rname IN ('chr1', 'chr3')".replace("SELECT", "SELECT * FROM (SELECT", 1).replace("FROM lineitem", "FROM lineitem)"))
def bam_mapped_pairs(spark, d):
    """Filters that the source takes: mapped pairs of two contigs with a quality of 3 or more."""
    return binary.bam(spark, bam_files(spark, d), mapped_pairs=True, split_bytes=1 << 16).where("mapq >= 3 AND rname IN ('chr1', 'chr3')").drop("cigar")


@query(f"""{READ}, one AS (SELECT 'c' || (cust % 40) AS seqnames, string_agg(seq, '' ORDER BY id) AS s FROM reads GROUP BY ALL),
  site AS (SELECT seqnames, s, p_partkey * 37 % length(s) + 1 AS pos, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM one JOIN part ON 'c' || (p_partkey % 40) = seqnames),
  cut AS (SELECT DISTINCT seqnames, pos, strand, substr(s, greatest(1, CASE WHEN strand = '+' THEN pos - 60 ELSE pos - 30 END), CASE WHEN strand = '+' THEN pos + 30 ELSE pos + 60 END - greatest(1, CASE WHEN strand = '+' THEN pos - 60 ELSE pos - 30 END) + 1) AS w FROM site)
  SELECT seqnames, pos, strand, CASE WHEN strand = '+' THEN w ELSE reverse(translate(w, 'ACGT', 'TGCA')) END AS site_seq FROM cut""")
def genome_pieces(spark, d):
    """Reads joined to forty contigs in FASTA, read by ranges of 64 kB as pieces of 1000 bases; the sequences around sites in them."""
    path = place(spark, "genome.fasta")
    own = reads(spark, d).select(F.concat(F.lit("c"), F.col("cust") % 40).alias("name"), "read_id", "seq")
    lines = own.select("name", F.col("read_id").cast("long").alias("at"), F.col("seq").alias("line")).unionByName(own.select("name", F.lit(-1).cast("long").alias("at"), F.concat(F.lit(">"), "name", F.lit(" x")).alias("line")).distinct())
    # A contig's lines follow each other in one file, as its range has them.
    lines.repartition(8, "name").sortWithinPartitions("name", "at").select("line").write.text(path)
    parts = genome.fasta_pieces(spark, f"{path}/*.txt", split_bytes=1 << 16, piece=1000)
    size = genome.lengths(parts)
    sites = t(spark, d, "part").select(F.concat(F.lit("c"), F.col("p_partkey") % 40).alias("seqnames"), "p_partkey", "p_size").join(F.broadcast(size), "seqnames")  # a row a contig
    sites = sites.select("seqnames", (F.col("p_partkey") * 37 % F.col("length") + 1).alias("pos"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"))
    return targets.site_sequences(sites, parts, 60, 30, chunk=4096)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS \"readNames\", 'seq' || o_custkey AS \"seqID\" FROM orders")
def key_file_scan(spark, d):
    path = place(spark, "keys.tsv")
    writers.table(t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("readNames"), F.concat(F.lit("seq"), "o_custkey").alias("seqID")), path)
    return readers.keys(spark, path)


@query("SELECT c_name AS \"sampleName\", CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment || ', \"x\"' END AS note, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def sample_sheet_scan(spark, d):
    """Quoted cells with commas and quotes, and empty ones."""
    path = place(spark, "sheet.csv")
    note = F.when(F.col("c_custkey") % 7 > 0, F.concat("c_mktsegment", F.lit(', "x"')))
    own = t(spark, d, "customer").select(F.col("c_name").alias("sampleName"), note.alias("note"), F.col("c_nationkey").cast("string").alias("nation"))
    own.write.option("header", True).option("escape", '"').csv(path)
    return readers.sample_sheet(spark, path)


@query("SELECT 'chr' || (p_partkey % 5) AS seqnames, CAST(p_partkey * 500 AS VARCHAR) AS start, upper(p_brand) AS symbol, upper(p_brand) AS annot_sym FROM part")
def reference_set_scan(spark, d):
    path = place(spark, "genes.tsv")
    writers.table(genes(spark, d).select("seqnames", "start", F.lower("symbol").alias("symbol")), path)
    return readers.reference_set(spark, path).select("seqnames", "start", "symbol", "annot_sym")


@query("SELECT 'one' AS name, n_nationkey AS k, n_name AS v FROM nation UNION ALL SELECT 'two', r_regionkey, r_name FROM region")
def evaluation_object(spark, d):
    """Tables of an evaluation folder, loaded by name."""
    path = place(spark, "evaluation")
    frames = {"one": t(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v")), "two": t(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("v"))}
    writers.evaluation(frames, path, {"runs": 1})
    back = writers.load_evaluation(spark, path, list(frames))
    return back["one"].select(F.lit("one").alias("name"), "k", "v").unionByName(back["two"].select(F.lit("two").alias("name"), "k", "v"))


@query("SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem")
def multihit_scan(spark, d):
    """Parquet tables of several folders below one."""
    path = place(spark, "multihits")
    own = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))
    for part in range(3):
        own.where(F.pmod("k", F.lit(3)) == part).write.parquet(f"{path}/run{part}/data")
    return readers.multihit_tables(spark, path)


@query()
def alignment_filter(spark, d):
    """Reads that align to a reference; tested against the cell-by-cell programme."""
    own = reads(spark, d).select("read_id", "seq")
    return rd.alignment_filter(own, ["ACGTACGTACGTACGTACGTACGT", "GGTTCCAAGGTTCCAAGGTT"], 60.0, min_align=8).select("read_id")

"""Readers: FASTQ, FASTA, PSL, SAM, key files, sample sheets, stat files, reference sets, earlier runs.

All are built from Spark's text and CSV sources, so any path that Spark reads will
do; gzip files are one task each and are spread out after parsing.  An empty file
or folder gives an empty table with its schema.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of a PSL file, in order; the first eight and those marked are numbers.
PSL_NAMES = ["matches", "misMatches", "repMatches", "nCount", "qNumInsert", "qBaseInsert", "tNumInsert", "tBaseInsert", "strand", "qName", "qSize", "qStart", "qEnd", "tName", "tSize", "tStart", "tEnd", "blockCount", "blockSizes", "qStarts", "tStarts"]
PSL_TEXT = {"strand", "qName", "tName", "blockSizes", "qStarts", "tStarts"}
PSL = T.StructType([T.StructField(n, T.StringType() if n in PSL_TEXT else T.LongType()) for n in PSL_NAMES])
KEYS = T.StructType([T.StructField("readNames", T.StringType()), T.StructField("seqID", T.StringType())])
STATS = T.StructType([T.StructField("sampleName", T.StringType()), T.StructField("metric", T.StringType()), T.StructField("count", T.DoubleType())])


FASTQ_OUT = "name string, seq string, qual string, file string, at long, lines array<string>"


def _records(batches):
    """Records of four lines from a task's lines, file split by file split; lines of a record that crosses a split's edge come as they are.

    A record begins where a line with @ is followed, two lines on, by one with +, and sequence and quality are of one
    length; a quality line that begins with @ fails that test.
    """
    here, held, synced, done, loose = None, [], True, [], []

    def begins(x):
        return x[0].startswith("@") and x[2].startswith("+") and len(x[1]) == len(x[3])

    def out():
        nonlocal done, loose
        n, m = len(done), len(loose)
        cols = [[r[i] for r in done] + [None] * m for i in range(3)] + [[None] * n + [r[i] for r in loose] for i in range(3)]
        kinds = [pa.string()] * 4 + [pa.int64(), pa.list_(pa.string())]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["name", "seq", "qual", "file", "at", "lines"])
        done, loose = [], []
        return batch

    def close():
        nonlocal held
        if held and here is not None:
            loose.append((here[0], 2 * here[1] + (1 if synced else 0), held))
        held = []

    for batch in batches:
        for value, file, at in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if here != (file, at):
                close()
                here, synced, head = (file, at), at == 0, []
            held.append(value.removesuffix("\r"))
            if not synced and len(held) >= 4 and begins(held[-4:]):
                head, held, synced = held[:-4], held[-4:], True
                if head:
                    loose.append((file, 2 * at, head))
            if synced and len(held) == 4:
                done.append((held[0][1:], held[1], held[3]))
                held = []
        yield out()
    close()
    yield out()


def fastq(spark: SparkSession, path) -> DataFrame:
    """(read_id, description, seq, qual) of plain or gzip files.

    Plain files are split like any text; the few lines of records that cross a split's edge are put together again, a file
    at a time.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    parts = lines.mapInArrow(_records, FASTQ_OUT)
    whole = parts.where("lines IS NULL").select(F.col("name").alias("__name"), "seq", "qual")
    crossing = parts.where("lines IS NOT NULL").groupBy("file").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "lines"))), lambda x: x["lines"])).alias("l"))
    n = F.floor(F.size("l") / 4).cast("int")
    each = crossing.select("l", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))).alias("i"))
    line = lambda k: F.get("l", F.col("i") * 4 + k)
    rest = each.select(F.substring(line(0), F.lit(2), F.length(line(0))).alias("__name"), line(1).alias("seq"), line(3).alias("qual"))
    return named(whole.unionByName(rest))


def named(rows: DataFrame) -> DataFrame:
    cut = F.regexp_extract("__name", r"^(\S+)\s*(.*)$", 1), F.regexp_extract("__name", r"^(\S+)\s*(.*)$", 2)
    return rows.select(cut[0].alias("read_id"), cut[1].alias("description"), *[c for c in rows.columns if c != "__name"])


def fasta(spark: SparkSession, path) -> DataFrame:
    """(read_id, description, seq): records are what stands between > at line starts."""
    rows = spark.read.option("lineSep", "\n>").text(path).where("value <> ''")
    body = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    name = F.regexp_extract(body, r"^([^\n]*)", 1)
    seq = F.regexp_replace(F.substring(body, F.length(name) + 1, F.length(body)), r"\s", "")
    return named(rows.select(name.alias("__name"), F.upper(seq).alias("seq")))


def contigs(spark: SparkSession, path) -> DataFrame:
    """A genome as (seqnames, seq, length)."""
    return fasta(spark, path).select(F.col("read_id").alias("seqnames"), "seq", F.length("seq").cast("long").alias("length"))


def psl(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(PSL).option("sep", "\t").csv(path)


def sam(spark: SparkSession, path) -> DataFrame:
    """(qname, flag, rname, pos, mapq, cigar, qwidth, span, MD) of a SAM text; header lines are left out."""
    rows = spark.read.text(path).where("value <> '' AND NOT startswith(value, '@')").select(F.split("value", "\t").alias("f"))
    size = lambda ops: F.aggregate(F.regexp_extract_all(F.get("f", F.lit(5)), F.lit(rf"(\d+)[{ops}]"), F.lit(1)), F.lit(0), lambda n, x: n + x.cast("int"))
    tag = F.get(F.filter("f", lambda x: F.startswith(x, F.lit("MD:Z:"))), F.lit(0))
    field = lambda i, kind="string": F.get("f", F.lit(i)).cast(kind)
    return rows.select(field(0).alias("qname"), field(1, "int").alias("flag"), field(2).alias("rname"), field(3, "long").alias("pos"), field(4, "int").alias("mapq"), field(5).alias("cigar"), size("MIS=X").alias("qwidth"), size("MDN=X").alias("span"), F.substring(tag, F.lit(6), F.length(tag)).alias("MD"))


def keys(spark: SparkSession, path: str) -> DataFrame:
    """(readNames, seqID) from CSV, TSV or Parquet, by extension."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select("readNames", "seqID")
    return spark.read.schema(KEYS).option("header", True).option("sep", separator(path)).csv(path)


def separator(path: str) -> str:
    return "\t" if path.removesuffix(".gz").endswith((".tsv", ".txt", ".psl")) else ","


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A manifest by its header; quotes are stripped, all columns are text."""
    if path.endswith((".yml", ".yaml")):
        rows = load_yaml(path)["samples"]
        names = list(dict.fromkeys(["sampleName", *(k for r in rows.values() for k in r)]))
        data = [tuple([name, *[None if r.get(k) is None else str(r[k]) for k in names[1:]]]) for name, r in rows.items()]
        return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))
    return spark.read.option("header", True).option("sep", separator(path)).option("quote", '"').option("escape", '"').csv(path)


def load_yaml(path: str) -> dict:
    """A YAML file on the driver, where a YAML library is installed."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs PyYAML; a CSV or TSV sheet doesn't") from e
    with open(path) as f:
        return yaml.safe_load(f)


def stat_files(spark: SparkSession, path) -> DataFrame:
    """(sampleName, metric, count, type, bin) of *.stat files: type and bin are parts of the file name."""
    rows = spark.read.schema(STATS).option("pathGlobFilter", "*.stat").csv(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.stat$", 1)
    parts = F.split(name, r"\.")
    return rows.select("sampleName", "metric", "count", F.get(F.filter(parts, lambda x: ~x.rlike("^bin\\d+$")), F.lit(1)).alias("type"), F.nullif(F.regexp_extract(name, r"(bin\d+)", 1), F.lit("")).alias("bin"))


def reference_set(spark: SparkSession, path: str, symbol: str = "symbol") -> DataFrame:
    """A gene list or gene ranges from Parquet or delimited text, with upper-cased symbol and annot_sym."""
    df = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.option("header", True).option("sep", separator(path)).csv(path)
    own = df.withColumn("symbol", F.upper(F.col(symbol)))
    return own if "annot_sym" in own.columns else own.withColumn("annot_sym", F.col("symbol"))


def multihit_tables(spark: SparkSession, path, pattern: str = "*.parquet") -> DataFrame:
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).parquet(path)


def runs(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Assimilated reads of several runs, with run_set."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p).withColumn("run_set", F.lit(name)) for name, p in paths.items()])


def sequence_for(sample_info: list[dict], choice: str) -> dict[str, str]:
    """sampleName -> sequence: a constant, or 'sampleInfo:column' to look it up in the sheet."""
    if choice.startswith("sampleInfo:"):
        column = choice.partition(":")[2]
        return {r["sampleName"]: r[column] for r in sample_info}
    return {r["sampleName"]: choice for r in sample_info}

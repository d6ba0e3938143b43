"""Writers: FASTQ and FASTA text by sample, delimited tables, stat files, evaluation folders, text reports."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fastq(reads: DataFrame, path: str, by: list[str] = (), gzip: bool = True) -> None:
    """Four lines a record, in a folder for each value of `by`."""
    text = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual")
    _text(reads.select(text.alias("value"), *by), path, by, gzip)


def fastq_by_sample(reads: DataFrame, path: str, rows_a_file: int = 1 << 22) -> None:
    """Gzip FASTQ in a folder for each sampleName, in files of some rows_a_file records.

    A sample is dealt over as many tasks as its count asks for, so that no task holds a large sample and a small one is
    one file.
    """
    counts = reads.groupBy("sampleName").agg(F.count("*").alias("__n"))  # a row a sample
    salts = F.greatest(F.lit(1), F.ceil(F.col("__n") / rows_a_file))
    dealt = reads.join(F.broadcast(counts.select("sampleName", salts.alias("__salts"))), "sampleName").withColumn("__salt", F.pmod(F.xxhash64("read_id"), "__salts"))
    tasks = counts.agg(F.sum(salts)).first()[0] or 1
    text = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual")
    dealt = dealt.repartition(int(tasks), "sampleName", "__salt").select(text.alias("value"), "sampleName")
    dealt.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", 2 * rows_a_file).partitionBy("sampleName").text(path)


def fasta(reads: DataFrame, path: str, by: list[str] = (), gzip: bool = True) -> None:
    _text(reads.select(F.concat_ws("\n", F.concat(F.lit(">"), "read_id"), "seq").alias("value"), *by), path, by, gzip)


def _text(df: DataFrame, path: str, by, gzip: bool) -> None:
    out = df.write.mode("overwrite").option("compression", "gzip" if gzip else "none")
    (out.partitionBy(*by) if by else out).text(path)


def table(df: DataFrame, path: str) -> None:
    """CSV, TSV or Parquet by the path's extension, header included."""
    out = df.write.mode("overwrite")
    if path.endswith(".parquet"):
        out.parquet(path)
    else:
        out.option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").csv(path)


def one_csv(frames: list[DataFrame], path: str) -> None:
    """The rows of all frames, by column name, as one CSV file with one header; the driver writes it, a partition at a time."""
    import csv

    every = frames[0]
    for df in frames[1:]:
        every = every.unionByName(df, allowMissingColumns=True)
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(every.columns)
        out.writerows(["" if v is None else v for v in r] for r in every.toLocalIterator())


def empty(schema: str, path: str, spark: SparkSession) -> None:
    """A table without rows that has its columns: what a stage leaves that has nothing to do."""
    table(spark.createDataFrame([], schema).coalesce(1), path)


def tables(frames: dict[str, DataFrame], folder: str, extension: str = "parquet") -> None:
    for name, df in frames.items():
        table(df, f"{folder}/{name}.{extension}")


def stats(df: DataFrame, path: str) -> None:
    """(sampleName, metric, count) lines without a header."""
    df.select("sampleName", "metric", "count").write.mode("overwrite").option("header", False).csv(path)


def evaluation(frames: dict[str, DataFrame], folder: str, about: dict) -> None:
    """A Parquet table for each frame, and what the run was in about.json beside them."""
    tables(frames, folder)
    spark = next(iter(frames.values())).sparkSession
    spark.createDataFrame([(json.dumps(about, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/about.json")


def load_evaluation(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


SHOWN = 200


def _head(df: DataFrame, limit: int) -> tuple[list, str]:
    """At most `limit` rows, and how many are left out; rows of longer tables are in order."""
    rows = df.limit(limit + 1).collect()
    if len(rows) <= limit:
        return rows, ""
    keys = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct", "variant")]
    return df.orderBy(*keys).limit(limit).collect(), f"{df.count() - limit} more rows are left out here"


def text_table(df: DataFrame, title: str, limit: int = SHOWN) -> str:
    """A summary table as aligned text; at most `limit` rows, as reports are read by people, and how many more there are."""
    rows, more = _head(df, limit)
    cells = [df.columns, *[["NA" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v) for v in r] for r in rows]]
    width = [max(len(r[i]) for r in cells) for i in range(len(df.columns))]
    lines = ["  ".join(c.ljust(w) for c, w in zip(r, width)).rstrip() for r in cells]
    return "\n".join([title, "-" * max(len(title), 3), *lines, *([more] if more else []), ""])


def html_table(df: DataFrame, title: str, limit: int = SHOWN) -> str:
    import html

    rows, more = _head(df, limit)
    cell = lambda v, tag="td": f"<{tag}>{html.escape('NA' if v is None else str(v))}</{tag}>"
    head = "".join(cell(c, "th") for c in df.columns)
    return f"<h2>{html.escape(title)}</h2><table><tr>{head}</tr>" + "".join("<tr>" + "".join(map(cell, r)) + "</tr>" for r in rows) + "</table>" + (f"<p>{more}</p>" if more else "")


def report(frames: dict[str, DataFrame], path: str, kind: str = "txt", whole: str | None = None, title: str = "", template: str | None = None) -> None:
    """The tables as one text or HTML file on the driver; each says how many of its rows the report leaves out.

    `whole` names a folder for every table as CSV with all of its rows.  template: HTML with {{title}} and {{tables}}.
    """
    import html

    if whole:
        for name, df in frames.items():
            plain = [F.concat_ws(";", c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
            table(df.select(*(e.alias(c) for e, c in zip(plain, df.columns))), f"{whole}/{re.sub(r'[^A-Za-z0-9]+', '_', name).strip('_')}.csv")
    body = "\n".join((html_table if kind == "html" else text_table)(df, name) for name, df in frames.items())
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    if kind == "html":
        page = template or "<html><head><title>{{title}}</title></head><body>{{tables}}</body></html>"
        if "{{tables}}" not in page:
            raise ValueError("a template needs {{tables}}")
        body = page.replace("{{title}}", html.escape(title)).replace("{{tables}}", body)
    elif title:
        body = f"{title}\n{'=' * len(title)}\n\n{body}"
    with open(path, "w") as f:
        f.write(body)


BAM_ROWS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "MD"]


def bam(df: DataFrame, path: str, refs: list[tuple[str, int]]) -> DataFrame:
    """Block-compressed BAM files below path, one a task, of (qname, flag, rname, pos, mapq, cigar, MD); sequences are blank.

    refs: contigs with their lengths; a name that isn't among them is an error, and * is no contig.  Gives (uri, size) of
    the files, a row each; a retried task replaces its file.
    """
    from . import blocks

    blocks.register(df.sparkSession)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        places = {n: i for i, (n, _) in enumerate(refs)} | {"*": -1}

        def chunks():
            yield blocks.bam_header(refs)
            for batch in batches:
                yield from blocks.bam_bytes(batch, places)

        uri, size = blocks.write_part(path, f"part-{TaskContext.get().partitionId():06d}.bam", chunks())
        yield pa.RecordBatch.from_pydict({"uri": [uri], "size": [size]})

    return df.select(*BAM_ROWS).mapInArrow(write, "uri string, size long")

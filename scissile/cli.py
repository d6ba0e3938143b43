"""Command line: python -m scissile.cli COMMAND ...

list_samples SHEET [--support CSV]     specimens and their replicates
run CONFIG.json -o FOLDER              raw reads to trimmed sequences by sample, and with alignments to reads for eval
eval READS SPECIMENS CONTIGS GENES -c CONFIG.json... -o FOLDER [-s SUPPORT]
                                       one run, or several as comma lists with a configuration each
report FOLDER [-o FILE] [-t html|txt] [--title T] [--template HTML] [-b] [-f] [-d]
                                       the main tables of an evaluation; beside them whole tables (-b), the rows
                                       behind figures (-f) and what the report shows as data (-d)
stats CORE EVALUATION READS -o FILE    reads through a run's stages, outcomes of alignment, incorporations, by sample
summary FOLDER [-o FILE] [--power-filter PCT] [--mesl-filter PCT] [--csv FOLDER] [--html]
genome CONTIGS FILE                    a genome as .2bit or .fasta
setup FOLDER / clean FOLDER [--remove] a run's folder tree
"""

from __future__ import annotations

import argparse
import json
import os
import shutil
import sys
from functools import reduce

from pyspark.sql import SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .operators import alignments, evaluation as ev
from .operators.staging import scope, staged
from .plans.evaluate import Config, assimilate, evaluate, reconcile
from .plans.run_stats import run_stats
from .plans.run import RunConfig, from_samples, process_reads, write_demultiplexed, write_run
from .plans.summary import NEEDED, summary_tables
from .sources import binary, readers, writers
from .sources.genome import pieces

FOLDERS = ["input_data", "logs", "process_data", "output", "reports"]
FIGURES = ["distance_histogram", "density", "inclusion"]
SUMMARIES = ["combos", "specimen_totals", "on_target", "off_target", "inclusion", "pileup_summary", "matched_summary", "off_target_sequences"]


def session() -> SparkSession:
    return SparkSession.builder.appName("scissile").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="scissile", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    x = sub.add_parser("setup")
    x.add_argument("folder")
    x = sub.add_parser("clean")
    x.add_argument("folder")
    x.add_argument("--remove", action="store_true", help="the whole folder, not just intermediates")
    x.add_argument("--keep-input", action="store_true")
    x = sub.add_parser("list_samples")
    x.add_argument("sheet")
    x.add_argument("--support")
    x = sub.add_parser("eval")
    for name in ("reads", "specimens", "contigs", "genes"):
        x.add_argument(name)
    x.add_argument("-c", "--config", required=True, nargs="+")
    x.add_argument("-s", "--support")
    x.add_argument("--override", action="store_true", help="evaluate runs of different versions together")
    x.add_argument("-o", "--output", required=True)
    x = sub.add_parser("run")
    x.add_argument("config")
    x.add_argument("-o", "--output", required=True)
    x = sub.add_parser("genome")
    x.add_argument("contigs")
    x.add_argument("file")
    x = sub.add_parser("summary")
    x.add_argument("folder")
    x.add_argument("-o", "--output", default="summary.txt")
    x.add_argument("--power-filter", type=float, default=0.0)
    x.add_argument("--mesl-filter", type=float, default=0.0)
    x.add_argument("--csv", help="a folder for the whole tables")
    x.add_argument("--html", action="store_true")
    x = sub.add_parser("report")
    x.add_argument("folder")
    x.add_argument("-o", "--output", default="report.txt")
    x.add_argument("--html", action="store_true")
    x.add_argument("-t", "--format", choices=["html", "txt"], help="appended to the output's name where it has another end")
    x.add_argument("--title", default="Report")
    x.add_argument("--template", help="an HTML file that has {{title}} and {{tables}} where they go")
    x.add_argument("-b", "--tables", action="store_true", help="every table whole, as CSV")
    x.add_argument("-f", "--figures", action="store_true", help="the rows behind figures, as CSV")
    x.add_argument("-d", "--savedata", action="store_true", help="every table as Parquet")
    x = sub.add_parser("stats")
    x.add_argument("core", help="statistics of a run's stages, a comma list")
    x.add_argument("evaluation", help="an evaluation's folder")
    x.add_argument("reads", help="assembled reads")
    x.add_argument("-o", "--output", required=True)
    x.add_argument("--csv", help="a folder for the whole tables")
    x.add_argument("--html", action="store_true")
    x.add_argument("--no-umis", action="store_true")
    x.add_argument("--no-consolidation", action="store_true")
    x.add_argument("--alternate-umis", action="store_true", help="the primer was trimmed from R1")
    return p


def in_order(sheet):
    """A sheet with `ord`, its own or the place of each line; a sheet is a few rows, numbered on the driver."""
    if "ord" in sheet.columns:
        return sheet.withColumn("ord", F.col("ord").cast("int"))
    rows = [tuple(r) for r in sheet.coalesce(1).collect()]
    return sheet.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{', '.join(f'`{c}` string' for c in sheet.columns)}, ord int")


def genome(spark, path: str):
    return binary.twobit(spark, path) if path.endswith(".2bit") else readers.contigs(spark, path)


def reads_of(spark, path: str):
    """FASTQ by many tasks a file: text is split anywhere, gzip where it is block-compressed."""
    return binary.fastq_blocks(spark, path) if path.endswith(".gz") else readers.fastq(spark, path)


def run(path: str, folder: str) -> None:
    """The read-handling stages, then, where the configuration names alignments of their output, the reads for an evaluation.

    Paths are relative to the configuration's folder.
    """
    spark = session()
    with open(path) as f:
        raw = json.load(f)
    at = lambda name: os.path.join(os.path.dirname(os.path.abspath(path)), raw[name])
    ends = ("R1", "R2", "I1", "I2")
    if "R1" in raw:
        fastq = {n: reads_of(spark, at(n)) for n in ends if n in raw}
        sheet = readers.sample_sheet(spark, at("samples"))
        tables = process_reads(fastq["R1"], fastq["R2"], fastq["I1"], fastq.get("I2"), sheet, RunConfig.of(raw))
        write_run(tables, folder)
        write_demultiplexed(fastq, tables["assigned"], f"{folder}/demulti")
    elif "demultiplexed" in raw:  # sample -> its files by end
        root = os.path.dirname(os.path.abspath(path))
        files = {sample: {n: reads_of(spark, os.path.join(root, x[n])) for n in ends if n in x} for sample, x in raw["demultiplexed"].items()}
        whole = {n: reduce(lambda a, b: a.unionByName(b), [x[n] for x in files.values()]) for n in ends if all(n in x for x in files.values())}
        sheet = readers.sample_sheet(spark, at("samples"))
        write_run(process_reads(whole["R1"], whole["R2"], None, whole.get("I2"), sheet, RunConfig.of(raw), from_samples(files)), folder)
    if "anchor_psl" in raw:
        own = lambda end: readers.keys(spark, at(f"{end}_keys")) if f"{end}_keys" in raw else readers.keys(spark, f"{folder}/{ {'anchor': 'r2', 'adrift': 'r1'}[end]}_keys.csv")
        keys = alignments.join_keys(own("anchor"), own("adrift"))
        umis = spark.read.parquet(f"{folder}/reads.parquet").select(F.col("read_id").alias("ID"), "umitag") if raw.get("umis") else None
        out = assimilate(readers.psl(spark, at("anchor_psl")), readers.psl(spark, at("adrift_psl")), keys, Config.of(raw), umis)
        writers.stats(out.pop("stats"), f"{folder}/align.stat")
        writers.tables(out, folder)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "setup":
        for name in FOLDERS:
            os.makedirs(os.path.join(a.folder, name), exist_ok=True)
    elif a.command == "clean":
        gone = [a.folder] if a.remove else [os.path.join(a.folder, n) for n in FOLDERS if n in ("process_data", "logs") or n == "input_data" and not a.keep_input]
        for path in gone:
            shutil.rmtree(path, ignore_errors=True)
    elif a.command == "list_samples":
        spark = session()
        support = readers.sample_sheet(spark, a.support) if a.support else None
        print(writers.text_table(ev.sample_list(readers.sample_sheet(spark, a.sheet), support=support), "samples"))
    else:
        spark = session()
        with scope(spark):  # what a command stages is gone when it ends
            on_spark(spark, a)
    return 0


def on_spark(spark, a) -> None:
    if a.command == "run":
        run(a.config, a.output)
    elif a.command == "genome":
        binary.write_genome(genome(spark, a.contigs), a.file)
    elif a.command == "eval":
        raw = []
        for path in a.config:
            with open(path) as f:
                raw.append(json.load(f))
        reads, sheets = a.reads.split(","), a.specimens.split(",")
        if not len(reads) == len(sheets) == len(raw):
            raise SystemExit("as many reads and specimens as configurations are needed")
        config = reconcile([Config.of(r) for r in raw])
        names = [r.get("name") or f"run{i + 1}" for i, r in enumerate(raw)]
        versions = {n: str(r.get("version", "")) for n, r in zip(names, raw)}
        every = ev.run_union({n: spark.read.parquet(p) for n, p in zip(names, reads)}, versions, a.override).drop("run_set")
        specimens = ev.run_union({n: in_order(readers.sample_sheet(spark, p)) for n, p in zip(names, sheets)})
        specimens = specimens.withColumn("ord", F.row_number().over(W.orderBy("run_set", F.col("ord").cast("int"))))  # a sheet's few rows
        support = in_order(readers.sample_sheet(spark, a.support)) if a.support else None
        genes = readers.reference_set(spark, a.genes).withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long"))
        out = evaluate(every, specimens, pieces(spark, a.contigs), genes, config, support)
        writers.evaluation(out, a.output, {"tables": sorted(out), "runs": names})
    elif a.command == "summary":
        frames = writers.load_evaluation(spark, a.folder, NEEDED)
        writers.report(summary_tables(frames, a.power_filter, a.mesl_filter), a.output, "html" if a.html else "txt", a.csv)
    elif a.command == "report":
        report(spark, a)
    elif a.command == "stats":
        core = spark.read.schema(readers.STATS).csv(a.core.split(","))
        own = writers.load_evaluation(spark, a.evaluation, ["incorporation_stats"])["incorporation_stats"]
        tables = run_stats(core, own, spark.read.parquet(a.reads), not a.no_umis, not a.no_consolidation, a.alternate_umis)
        titles = {"attrition": "1. Reads after each stage", "outcomes": "2. Outcomes of alignment", "incorporation": "3. Incorporations by criterion"}
        writers.report({titles[n]: staged(df.coalesce(1)) for n, df in tables.items()}, a.output, "html" if a.html else "txt", a.csv)


def report(spark, a) -> None:
    kind = a.format or ("html" if a.html or a.template else "txt")
    path = a.output if not a.format or a.output.endswith(f".{kind}") else f"{a.output}.{kind}"
    beside = os.path.splitext(path)[0]
    frames = writers.load_evaluation(spark, a.folder, SUMMARIES)
    template = None
    if a.template:
        with open(a.template) as f:
            template = f.read()
    writers.report(frames, path, kind, f"{beside}_tables" if a.tables else None, a.title, template)
    if a.figures:
        writers.tables(writers.load_evaluation(spark, a.folder, FIGURES), f"{beside}_figures", "csv")
    if a.savedata:
        writers.evaluation(frames, f"{beside}_data", {"title": a.title, "tables": sorted(frames)})


if __name__ == "__main__":
    sys.exit(main())

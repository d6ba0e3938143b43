"""Batches of reads add up to the fragments of all of them."""

from scissile.operators.evaluation import fragments
from scissile.streaming.ingest import follow_reads, fragments_so_far

KIND = "seqnames string, start long, end long, strand string, specimen string, sampleName string, umitag string, contrib double"


def test_batches(spark, tmp_path, rows):
    parts = [[("c", 1, 9, "+", "A", "A-1", "u", 0.5)], [("c", 1, 9, "+", "A", "A-1", "u", 1.0), ("c", 2, 9, "-", "A", "A-1", None, 1.0)]]
    whole = None
    for i, part in enumerate(parts):
        df = spark.createDataFrame(part, KIND)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        whole = df if whole is None else whole.union(df)
        follow_reads(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    order = ["seqnames", "start", "end", "strand", "sampleName", "count", "umitag", "contrib"]
    assert rows(fragments_so_far(spark, str(tmp_path / "out")).select(order)) == rows(fragments(whole).select(order))

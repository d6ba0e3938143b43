"""The shared folder, whichever way spark.checkpoint.dir names it."""

import pytest

from scissile.llm import storage


@pytest.mark.parametrize(
    ("default", "folder", "uri"),
    [
        ("file:///", "/shared/a", "file:///shared/a"),
        ("file:///", "file:/shared/a", "file:///shared/a"),
        ("file:///", "file:///shared/a", "file:///shared/a"),
        ("hdfs://localhost:9", "/shared/a", "hdfs://localhost:9/shared/a"),
        ("hdfs://localhost:9", "file:///shared/a", "file:///shared/a"),
    ],
)
def test_paths_are_taken_as_spark_takes_them(spark, default, folder, uri):
    hadoop = spark._jsc.hadoopConfiguration()
    usual = hadoop.get("fs.defaultFS")
    try:
        hadoop.set("fs.defaultFS", default)
        assert storage.qualified(spark, folder) == uri
    finally:
        hadoop.set("fs.defaultFS", usual)


def test_staged_tables_come_back_and_go(spark):
    table, uri = storage.staged_at(spark.createDataFrame([(1, "a"), (2, None)], "id long, text string"), "test")
    assert uri.startswith("file:///") and sorted(table.collect()) == [(1, "a"), (2, None)]
    storage.forget(spark, uri)
    assert uri not in storage._held


def test_bytes_written_by_uri_are_read_back(spark):
    uri = f"{storage.workdir(spark, 'test')}/x"
    assert storage.put_file(uri, [b"ab", b"", b"c"]) == 3
    assert storage.get_file(uri) == b"abc" and storage.get_file(uri + "y") is None

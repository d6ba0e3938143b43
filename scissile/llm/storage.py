"""The folder that driver and executors share, and tables and files in it."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session as a URI; one of our own only where that is unset and driver and executors are one process, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints/scissile"
        os.makedirs(root.removeprefix("file://"), exist_ok=True)
    return qualified(spark, root)


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder's URI; a path without a scheme is the default filesystem's, as Spark itself takes it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    return f"file://{uri.removeprefix('file:')}" if uri.startswith("file:/") and not uri.startswith("file://") else uri


def workdir(spark: SparkSession, tag: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/scissile-{tag}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_held: list[str] = []


def staged_at(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """df written once as Parquet in the shared folder and read back: a cut in the lineage that survives lost executors; and where it stands."""
    spark = df.sparkSession
    uri = workdir(spark, tag)
    df.write.option("compression", "zstd").parquet(uri)
    _held.append(uri)
    return spark.read.schema(df.schema).parquet(uri), uri


def staged(df: DataFrame, tag: str) -> DataFrame:
    return staged_at(df, tag)[0]


def forget(spark: SparkSession, uri: str) -> None:
    """Deletes a staged table that nothing will read again."""
    delete(spark, uri)
    if uri in _held:
        _held.remove(uri)


def settled(build, tag: str) -> DataFrame:
    """The table that build() gives, staged; whatever was staged on the way to it is deleted."""
    before = set(_held)
    out, uri = staged_at(build(), tag)
    for other in [x for x in _held if x not in before and x != uri]:
        forget(out.sparkSession, other)
    return out


def release(spark: SparkSession) -> None:
    """Deletes every table that this process has staged and not forgotten: to be called when the results have been read or written."""
    for uri in list(_held):
        forget(spark, uri)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken, name = {c.lower() for c in df.columns}, f"__{name}"
    while name in taken:
        name += "_"
    return name


def filesystem(uri: str):
    """(filesystem, path) of a URI for Python workers: local mounts, and the stores that Arrow speaks."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def put_file(uri: str, chunks) -> int:
    """Writes a file under a name of its own and moves it into place, so that a retried task never leaves half a file."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part, size = f"{path}.{uuid.uuid4().hex}.tmp", 0
    with fs.open_output_stream(part, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(part, path)
    return size


def get_file(uri: str) -> bytes | None:
    fs, path = filesystem(uri)
    try:
        with fs.open_input_stream(path, compression=None) as f:
            return f.read()
    except FileNotFoundError:
        return None


_shipped: set[str] = set()


def ship(df: DataFrame) -> DataFrame:
    """df, after handing this package to the session's Python workers, unless their PYTHONPATH has it."""
    root, context = Path(__file__).resolve().parents[2], df.sparkSession.sparkContext
    found = {os.path.realpath(x) for x in os.environ.get("PYTHONPATH", "").split(os.pathsep) if x}
    if str(root) not in found and context.applicationId not in _shipped:
        package, held = Path(__file__).resolve().parents[1], io.BytesIO()
        with zipfile.ZipFile(held, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(root))
        archive = f"{workdir(df.sparkSession, 'code')}/{package.name}.zip"
        put_file(archive, [held.getvalue()])
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return df

"""Session defaults, the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "edupanel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are designed for.

    Adaptive execution sizes the reduce side, turns joins into broadcast joins once the
    real size of a side is known to be small, and splits skewed join partitions. No other
    setting is needed, so the operators also run on a session made elsewhere.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="edupanel-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier call has returned."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_collecting: list[list[str]] = []


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """The paths of all tables staged within the block, for ``drop_paths`` once nothing reads them any more."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting.remove(paths)


def stage(
    df: DataFrame, label: str, partition_by: str | None = None, compression: str | None = None, max_records: int = 0,
) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and unlike a checkpoint
    later queries read only the columns and year folders they need. ``max_records`` bounds the rows of a file.
    """
    path = new_path(df.sparkSession, label)
    for paths in _collecting:
        paths.append(path)
    if partition_by:
        # many tasks per value: adaptive execution splits a large value and merges small ones
        df = df.hint("rebalance", partition_by)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def drop_staged(*dfs: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in dfs:
        folder = shared_dir(df.sparkSession)
        names = {f.split(folder, 1)[1].strip("/").split("/")[0] for f in df.inputFiles() if folder in f}
        drop_paths(df.sparkSession, [f"{folder}/{name}" for name in names])


def drop_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders, those that are there."""
    configured = spark.sparkContext._jsc.hadoopConfiguration()
    path_type = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in paths:
        path = path_type(name)
        path.getFileSystem(configured).delete(path, True)

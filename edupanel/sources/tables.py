"""Raw scans, Parquet tables, CSV export."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupanel.functions.numbers import na_map, plain_number
from edupanel.sources import census, sheets


class MissingSourceError(FileNotFoundError):
    def __init__(self, table: str, path: str):
        super().__init__(f"{table}: nothing found at {path}; check the name and the folder")
        self.table, self.path = table, path


class MissingColumnsError(ValueError):
    def __init__(self, table: str, columns: Sequence[str], path: str | None = None):
        super().__init__(f"{table} lacks the columns {list(columns)}" + (f" in {path}" if path else ""))
        self.columns, self.path = list(columns), path


def scan_table(
    spark: SparkSession,
    table: str,
    paths: str | Sequence[str],
    columns: Sequence[str],
    fmt: str = "parquet",
    skip_rows: int = 0,
    na_tokens: Sequence[str] = (),
    sheets_named: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """The named columns of a raw table as text, plus ``_row``, ``_source`` and ``_sheet``.

    ``sheet`` reads CSV exports or workbooks with rows above the header. ``parquet`` and
    ``csv`` read a landing zone that already carries ``_row`` (and ``_sheet``); its files may have their columns in
    any order, and types of their own. A missing path is an error, and so is a column that any file lacks, which
    names the file; fields equal to a token of ``na_tokens`` become null. CSV
    exports are cut at line breaks; where fields hold line breaks they fail, and ``multiline="true"``
    reads each file in one piece. With ``sheets_named`` the sheet of a CSV export is its file's name,
    or the group of the option ``sheetPattern``; a named sheet without a file is an error.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "sheet":
        raw = _scan_sheets(spark, table, paths, columns, skip_rows, sheets_named, options)
    elif skip_rows:
        raise ValueError("only the sheet format can skip rows")
    else:
        raw = _scan_landing(spark, table, paths, columns, fmt, sheets_named, options)
    if not na_tokens:
        return raw
    kept = {c: na_map(F.col(f"`{c}`"), na_tokens) for c in columns}
    return raw.withColumns(kept)


def _scan_sheets(spark, table, paths, columns, skip_rows, sheets_named, options) -> DataFrame:
    try:
        sheets.list_files(paths)
    except FileNotFoundError as error:
        raise MissingSourceError(table, str(error)) from None
    sheets.register(spark)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    schema = schema.add("_row", "long").add("_source", "string").add("_sheet", "string")
    reader = spark.read.format(sheets.FORMAT).schema(schema)
    reader = reader.option("paths", json.dumps(paths)).option("skipRows", str(skip_rows))
    if sheets_named is not None:
        reader = reader.option("sheets", json.dumps(list(sheets_named)))
    return reader.options(**options).load()


def _scan_landing(spark, table, paths, columns, fmt, sheets_named, options) -> DataFrame:
    """Columns by name: files whose header or types differ are scanned apart, each group natively, and united."""
    needed = [*columns, "_row"]
    try:
        groups = census.headers(spark, paths, fmt, options, wanted=[*needed, "_sheet"])
        if len(groups) <= 1:
            frames = [_reader(spark, fmt, options).format(fmt).load(paths)]
        else:
            roots = [r for r in (census.under(spark, p) for p in paths) if r]
            frames = [f for g in groups if not g.missing(needed) for f in _group_frames(spark, fmt, options, g, roots)]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingSourceError(table, ", ".join(paths)) from None
        raise
    for group in groups:
        if missing := group.missing(needed):
            raise MissingColumnsError(table, missing, group.files[0])
    united = None
    for frame in frames:
        if missing := [c for c in needed if c not in frame.columns]:  # no file with a line
            raise MissingColumnsError(table, missing)
        sheet = F.col("_sheet") if "_sheet" in frame.columns else F.lit(None)
        named = frame.select(
            *[F.col(f"`{c}`").cast("string").alias(c) for c in columns],
            F.col("_row").cast("long").alias("_row"),
            F.col("_metadata.file_path").alias("_source"),
            sheet.cast("string").alias("_sheet"),
        )
        united = named if united is None else united.unionByName(named)
    return united.where(F.col("_sheet").isin(*sheets_named)) if sheets_named is not None else united


def _reader(spark, fmt, options):
    # within a group columns go by position, so a file whose header has changed since the census has to fail
    strict = {"header": "true", "enforceSchema": "false"}
    return spark.read.options(**{**strict, **options}) if fmt == "csv" else spark.read


def _group_frames(spark, fmt, options, group, roots) -> list[DataFrame]:
    """The group's files, those below each root together, so that the names of folders still count as columns."""
    by_root: dict[str | None, list[str]] = {}
    for path in group.files:
        root = next((r for r in roots if path.startswith(r + "/")), None)
        by_root.setdefault(root, []).append(census.literal(path))
    frames = []
    for root, files in by_root.items():
        reader = _reader(spark, fmt, options)
        if root:
            reader = reader.option("basePath", root)
        if fmt == "csv":
            reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in group.names]))
        frames.append(reader.format(fmt).load(files))
    return frames


def list_raw(spark: SparkSession, table: str, paths: str | Sequence[str]) -> DataFrame:
    """(path, length, changed) of the files of a raw table, without reading them."""
    try:
        files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingSourceError(table, str(paths)) from None
        raise
    return files.select("path", "length", F.col("modificationTime").alias("changed"))


def read_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A processed Parquet table; its absence is an error that names the table."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        df = reader.parquet(path)
        return df.select(*schema.fieldNames()) if schema else df
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingSourceError(table, path) from None
        raise


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, observed: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace a processed table; ``partition_by`` gives one folder per value.

    ``observed`` gets the frame as it is written, behind all shuffles, and gives back the one to write.

    The table is written beside the old one and takes its place when it is whole, so a job that dies while it
    writes leaves the old table. For a moment between two moves of folders there is none; ``VersionedTable`` has no such moment.
    """
    beside = f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}"
    try:
        # one folder per value without one task per value
        df = df.hint("rebalance", partition_by) if partition_by else df
        df = observed(df) if observed else df
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(beside)
    except Exception:
        _move(df.sparkSession, beside, None)
        raise
    _move(df.sparkSession, path, beside.replace(".writing-", ".old-"))
    _move(df.sparkSession, beside, path)
    _move(df.sparkSession, beside.replace(".writing-", ".old-"), None)


def _move(spark: SparkSession, path: str, target: str | None) -> None:
    """Move a folder if it is there; without a target it is deleted."""
    path_type = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    here = path_type(path)
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(here):
        return
    if target is None:
        fs.delete(here, True)
    elif not fs.rename(here, path_type(target)):
        raise OSError(f"can't move {path} to {target}")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, UTF-8, missing fields empty, numbers without exponent."""
    shown = [
        plain_number(F.col(name)).alias(name) if dtype in ("double", "float") else F.col(name)
        for name, dtype in df.dtypes
    ]
    df.select(*shown).write.mode("overwrite").csv(path, header=True, encoding="UTF-8", escape='"')

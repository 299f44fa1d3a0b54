"""Header census: which columns every file of a landing zone has, before any of them is scanned.

A job reads the first record of each CSV file, or the footer of each Parquet file, and groups the files by what it finds.
Each group can then be scanned natively under its own header, and a file that lacks a column is known by name.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupanel.sources import sheets

#: Larger than any file, so that each file is one task, of which the first lines are read.
_WHOLE_FILE = str(1 << 44)
_FIRST_LINES = "64"
#: Characters that mean more than themselves in a path given to a reader.
_GLOB = re.compile(r"([\[\]{}*?\\])")


@dataclass(frozen=True)
class Group:
    """Files under one header: pairs of name and type, in the files' order."""

    header: tuple[tuple[str, str], ...]
    files: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.header]

    def missing(self, columns: Sequence[str]) -> list[str]:
        """Columns that neither the header nor the names of the folders have."""
        folders = {part.split("=")[0] for part in self.files[0].split("/")[:-1] if "=" in part}
        return [c for c in columns if c not in self.names and c not in folders]


def headers(
    spark: SparkSession, paths: Sequence[str], fmt: str, options: Mapping[str, str] | None = None,
    wanted: Sequence[str] | None = None,
) -> list[Group]:
    """The groups of files by header, the largest group first; CSV files without any line are in none.

    With ``wanted`` only these columns tell Parquet files apart, so that a column nobody reads splits no scan.
    """
    if fmt == "csv":
        found = _csv_headers(spark, list(paths), {k.lower(): v for k, v in (options or {}).items()})
    else:
        found = _parquet_headers(spark, list(paths))
        if wanted is not None:
            chosen = F.array(*[F.lit(c) for c in wanted])
            found = found.withColumn("header", F.filter("header", lambda f: F.array_contains(chosen, f["name"])))
    groups = {}
    for row in found.groupBy("header").agg(F.collect_list("path").alias("files")).collect():
        if row.header is not None:
            groups.setdefault(tuple((f["name"], f["type"]) for f in row.header), []).extend(row.files)
            continue
        for path in row.files:  # the executors could not open these, the driver asks Spark
            fields = [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(literal(path)).schema]
            groups.setdefault(tuple(f for f in fields if wanted is None or f[0] in wanted), []).append(path)
    made = [Group(header, tuple(sorted(files))) for header, files in groups.items()]
    return sorted(made, key=lambda g: (-len(g.files), g.files))


_HEADER = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType())]))
_FOUND = T.StructType([T.StructField("path", T.StringType()), T.StructField("header", _HEADER)])


def _batch(path: str, header: Sequence[tuple[str, str]] | None) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
    fields = None if header is None else [{"name": name, "type": type_} for name, type_ in header]
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([fields], kind)], ["path", "header"])


def _by_value() -> None:
    """Workers need no copy of this package."""
    import edupanel.sources.census as module

    for held in (module, sheets):
        cloudpickle.register_pickle_by_value(held)


def _csv_headers(spark: SparkSession, paths: list[str], options: Mapping[str, str]) -> DataFrame:
    """Spark's own text reader gives the first lines, so any file system it knows will do."""
    _by_value()
    separator, quote = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')

    def first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []
        for batch in batches:
            for line, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines.append(line)
                text = "\n".join(lines)
                # a quoted name may hold line breaks
                if text.strip() and text.count(quote) % 2 == 0:
                    text = text.removeprefix("\ufeff").strip("\n")
                    names = next(csv.reader(io.StringIO(text, newline=""), delimiter=separator, quotechar=quote))
                    yield _batch(unquote(path), [(name, "string") for name in names])
                    return

    # settings of a session of its own, so that those of the caller's stay as they are
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    session.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _FIRST_LINES)
    lines = session.read.text(paths).select("value", "_metadata.file_path")
    return lines.mapInArrow(first_record, _FOUND)


def _parquet_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Footers are read on the executors; the header is null where they can't open the file."""
    _by_value()

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    fs, inner = sheets.open_fs(path)
                    with fs.open_input_file(inner) as file:
                        schema = pq.read_schema(file)
                except (OSError, ValueError):
                    yield _batch(path, None)
                else:
                    yield _batch(path, [(f.name, str(f.type)) for f in schema])

    # listing only: the column with the files' content is not asked for
    return spark.read.format("binaryFile").load(paths).select("path").mapInArrow(footers, _FOUND)


def literal(path: str) -> str:
    """The path as a reader has to get it, so that nothing in it is taken for a pattern."""
    return _GLOB.sub(r"\\\1", path)


def under(spark: SparkSession, root: str) -> str | None:
    """The full name of a folder, as file paths begin with it; None for a file or a pattern."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    if _GLOB.search(root) or not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        return None
    return fs.makeQualified(path).toString().rstrip("/")

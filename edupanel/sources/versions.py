"""Versioned Parquet tables: folders that never change, and a manifest that names those in force.

    <root>/data/<folder of a write>/[<column>=<value>/]part-*.parquet
    <root>/manifests/00000012.json

A write puts its files in a folder of its own. Only then a manifest is moved into place under the next number, which
fails if another writer took the number. Readers follow the manifest with the highest number, so they see a write
whole or not at all, and a job that dies while it writes leaves the table as it was. A version may take most of its
partitions over from the one before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: The part of a table without partitions.
WHOLE = ""
_FOLDER = "write"


class VersionConflictError(RuntimeError):
    """Another writer published the version first."""


@dataclass(frozen=True)
class Manifest:
    """What a version consists of: the folder that holds each part, and what its writer knew about it."""

    version: int
    schema: str
    partition_by: str | None
    parts: dict[str, str]
    info: dict = field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path().getFileSystem(self._conf)

    # --- reading -------------------------------------------------------------------------
    def versions(self) -> list[int]:
        names = [n.removesuffix(".json") for n in self._names("manifests") if n.endswith(".json")]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The manifest of a version, of the one in force by default; None if there is none."""
        known = self.versions()
        if not known or version is not None and version not in known:
            return None
        stream = self._fs.open(self._path("manifests", _file(version or known[-1])))
        try:
            return Manifest(**json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version. A frame goes on reading the version it was made for."""
        manifest = self.manifest(version)
        if manifest is None:
            raise FileNotFoundError(f"{self.root} has no version" + (f" {version}" if version else ""))
        return self._frame(manifest)

    def _frame(self, manifest: Manifest) -> DataFrame:
        schema = manifest.struct()
        if not manifest.parts:
            return self.spark.createDataFrame([], schema)
        paths = [
            "/".join(p for p in (self.root, "data", folder, part) if p) for part, folder in manifest.parts.items()]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*schema.fieldNames())

    # --- writing -------------------------------------------------------------------------
    def write(
        self, df: DataFrame, partition_by: str | None = None, replace: Sequence[object] | None = None,
        info: dict | Callable[[DataFrame], dict] | None = None,
    ) -> Manifest:
        """Publish a version that holds ``df``.

        With ``replace`` only the partitions of these values are written anew, or dropped where ``df`` has no such rows;
        all others are taken over from the version in force. ``info`` is kept in the manifest; a function gets the
        written rows. The schema has to stay that of the version before where partitions are taken over.
        """
        held = self.manifest()
        if replace is not None and partition_by is None:
            raise ValueError("only partitions can be replaced")
        kept: dict[str, str] = {}
        if replace is not None and held is not None:
            if held.partition_by != partition_by or _fields(held.struct()) != _fields(df.schema):
                raise ValueError(f"{self.root}: partitions can be replaced only in a table of the same columns")
            gone = {_part(partition_by, value) for value in replace}
            kept = {part: folder for part, folder in held.parts.items() if part not in gone}
        folder = f"{_FOLDER}={(held.version if held else 0) + 1:08d}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/data/{folder}"
        if partition_by:
            # one folder per value without one task per value
            df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
            written = {name: folder for name in self._names("data", folder) if "=" in name}
        else:
            df.write.parquet(path)
            written = {WHOLE: folder}
        if replace is not None:
            others = sorted(set(written) - {_part(partition_by, value) for value in replace})
            if others:
                raise ValueError(f"{self.root}: rows of {others[0]}, which was not to be replaced")
        manifest = Manifest(
            (held.version if held else 0) + 1, df.schema.json(), partition_by, {**kept, **written},
            info if isinstance(info, dict) else {})
        if callable(info):
            rows = self._frame(Manifest(0, manifest.schema, partition_by, written))
            manifest = Manifest(**{**asdict(manifest), "info": info(rows)})
        self._publish(manifest)
        return manifest

    def describe(self, info: dict) -> Manifest:
        """Publish a version of the same files with other ``info``."""
        held = self.manifest()
        manifest = Manifest(**{**asdict(held), "version": held.version + 1, "info": info})
        self._publish(manifest)
        return manifest

    def _publish(self, manifest: Manifest) -> None:
        text = json.dumps(asdict(manifest), ensure_ascii=False, sort_keys=True)
        self._fs.mkdirs(self._path("manifests"))
        draft, final = self._path("manifests", f".{uuid.uuid4().hex}"), self._path("manifests", _file(manifest.version))
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        option = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(draft, final, self.spark.sparkContext._gateway.new_array(option, 0))
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise VersionConflictError(f"{self.root}: version {manifest.version} is there already") from None
            raise

    # --- cleaning up ---------------------------------------------------------------------
    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` versions, and the folders no version left names; returns those folders.

        Run it while no writer is at work: the folder of an unfinished write looks like that of a dead one.
        """
        if keep < 1:
            raise ValueError("at least the version in force stays")
        known = self.versions()
        used = {folder for version in known[-keep:] for folder in self.manifest(version).parts.values()}
        gone = sorted(set(self._names("data")) - used)
        for version in known[:-keep]:
            self._fs.delete(self._path("manifests", _file(version)), False)
        for folder in gone:
            self._fs.delete(self._path("data", folder), True)
        return gone

    # --- files ---------------------------------------------------------------------------
    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _names(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        if not self._fs.exists(path):
            return []
        return [entry.getPath().getName() for entry in self._fs.listStatus(path)]


def _file(version: int) -> str:
    return f"{version:08d}.json"


def _part(column: str, value: object) -> str:
    """The folder of a partition; values that Spark would escape are not supported."""
    name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
    if not name or any(not (ch.isalnum() or ch in "_-.") for ch in name):
        raise ValueError(f"{column}: {name!r} can't be a partition to replace")
    return f"{column}={name}"


def _fields(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]

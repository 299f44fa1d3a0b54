"""Named frames kept in memory, each for the version that is in force."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from edupanel.sources.versions import VersionedTable


@dataclass
class _Held:
    version: int
    frame: DataFrame


class TableCache:
    """Keeps one frame per name and table; a newly published version takes the place of the one held.

    ``make`` turns the table into what is kept, for example the serving panel. The old frame's memory is given
    back once the new one is there; frames that callers still hold go on working, from the files of their version.
    What does not fit the memory goes to disk, so a large panel costs time, not the session.
    """

    def __init__(self, spark: SparkSession, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self.spark, self.level = spark, level
        self._held: dict[tuple[str, str], _Held] = {}
        self._lock = Lock()

    def get(
        self, root: str, name: str = "", make: Callable[[DataFrame], DataFrame] = lambda df: df
    ) -> DataFrame:
        """The kept frame of the version in force; it is made and kept if there is none, or an older one."""
        table = VersionedTable(self.spark, root)
        key = (table.root, name)
        with self._lock:
            known = table.versions()
            if not known:
                raise FileNotFoundError(f"{root} has no version")
            held = self._held.get(key)
            if held is None or held.version != known[-1]:
                frame = make(table.read(known[-1])).persist(self.level)
                self._held[key] = _Held(known[-1], frame)
                if held is not None:
                    held.frame.unpersist()
            return self._held[key].frame

    def version(self, root: str, name: str = "") -> int | None:
        held = self._held.get((root.rstrip("/"), name))
        return held.version if held else None

    def release(self, root: str | None = None, name: str | None = None) -> int:
        """Give back the memory of the frames of that table and name, of all by default; returns how many."""
        with self._lock:
            gone = [k for k in self._held if (root is None or k[0] == root.rstrip("/")) and (name is None or k[1] == name)]
            for key in gone:
                self._held.pop(key).frame.unpersist()
        return len(gone)

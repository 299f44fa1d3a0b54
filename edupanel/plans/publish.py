"""Incremental publishing of the panel: only years whose input changed are joined and written again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.operators.fingerprint import fingerprint
from edupanel.plans.panel import join_panel
from edupanel.sources.versions import VersionedTable

#: Treated tables whose rows belong to a year; the territory counts for all years.
YEARLY = (C.TABLE_GDP, C.TABLE_SCORE, C.TABLE_PROJECTS, C.TABLE_DISTORTION)
_ALL = "*"


@dataclass(frozen=True)
class Published:
    """The version in force after a run, the tables it cleaned and the panel years it wrote or dropped."""

    version: int
    cleaned: list[str]
    years: list[int]


def _content(rows: DataFrame, by: str | None) -> dict[str, str]:
    """Mark of each year, or of the whole table."""
    marks = fingerprint(rows, by)
    return {
        _ALL if by is None else str(r[by]): f"{r['rows']}:{r['mark']}"
        for r in marks.collect()  # a row a year
    }


def _treated(
    spark: SparkSession, name: str, make: Callable[[], DataFrame], out: str, source: str | None
) -> tuple[DataFrame, dict[str, str], bool]:
    """The stored table, its marks, and whether it had to be cleaned."""
    table = VersionedTable(spark, f"{out}/{name}")
    held = table.manifest()
    if held is not None and source is not None and held.info.get("source") == source:
        return table.read(held.version), held.info["marks"], False
    by = "ano" if name in YEARLY else None
    new = table.write(make(), info=lambda rows: {"source": source, "marks": _content(rows, by)})
    return table.read(new.version), new.info["marks"], True


def publish(
    spark: SparkSession, makers: Mapping[str, Callable[[], DataFrame]], out: str,
    sources: Mapping[str, str] | None = None,
) -> Published:
    """Bring the treated tables and the panel in ``out`` up to date, each in one step that readers see whole.

    ``makers`` gives the treated tables by name, lazily; ``sources`` a fingerprint of what each is made of. A table
    whose source is that of its stored version is not read again. Of all others the rows are fingerprinted by year
    once they are written. The panel years whose GDP, score, project or distortion rows differ, or all if the
    territory does, are joined and written; other years' folders are taken over. The result is that of a full build.
    """
    out, sources = out.rstrip("/"), sources or {}
    stored, marks, cleaned = {}, {}, []
    for name, make in makers.items():
        stored[name], marks[name], fresh = _treated(spark, name, make, out, sources.get(name))
        if fresh:
            cleaned.append(name)
    place = marks[C.TABLE_TERRITORY][_ALL]
    # a panel row is a GDP row, so its years are those of the GDP
    wanted = {
        year: hashlib.sha256(json.dumps([place, *[marks[name].get(year) for name in YEARLY]]).encode()).hexdigest()
        for year in marks[C.TABLE_GDP]
    }
    table = VersionedTable(spark, f"{out}/{C.TABLE_PANEL}")
    held = table.manifest()
    before = held.info["years"] if held else {}
    changed = sorted(int(y) for y in wanted.keys() | before.keys() if wanted.get(y) != before.get(y))
    if held is not None and not changed:
        return Published(held.version, cleaned, [])

    def of_years(name: str) -> DataFrame:
        return stored[name].where(F.col("ano").isin(*changed)) if held is not None else stored[name]

    joined = join_panel(
        of_years(C.TABLE_GDP), of_years(C.TABLE_SCORE), stored[C.TABLE_TERRITORY], of_years(C.TABLE_PROJECTS),
        of_years(C.TABLE_DISTORTION), checked=True,
    )
    new = table.write(joined, "ano", None if held is None else changed, info={"years": wanted})
    return Published(new.version, cleaned, changed)


def published_panel(spark: SparkSession, out: str, version: int | None = None) -> DataFrame:
    """The panel of a version, of the one in force by default, in its column order."""
    return VersionedTable(spark, f"{out.rstrip('/')}/{C.TABLE_PANEL}").read(version).select(*C.PANEL_COLUMNS)

"""The batch job: raw files in, six processed tables out.

    spark-submit --py-files edupanel.zip edupanel/plans/job.py --raw <folder> --out <folder>

or ``python -m edupanel.plans.job``. The raw folder holds one entry per table; each can also
lie elsewhere, e.g. ``--distortion 'data/raw/INEP/TDI_MUNICIPIOS_*.xlsx'``.
"""

from __future__ import annotations

import argparse
import json
import re
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from edupanel import config as C
from edupanel.operators import ObservedProfile, fingerprint
from edupanel.plans import clean, panel
from edupanel.plans import publish as publishing
from edupanel.session import drop_staged, get_spark, stage
from edupanel.sources import list_raw, read_table, scan_table, write_table


@dataclass(frozen=True)
class RawPaths:
    """Where the raw tables lie and how they are stored (``sheet``, ``csv``, ``parquet``)."""

    territory: str
    score: str
    projects: str
    gdp: str
    distortion: str
    fmt: str = "sheet"

    @classmethod
    def under(cls, folder: str, fmt: str = "sheet") -> RawPaths:
        names = ("territory", "score", "projects", "gdp", "distortion")
        return cls(*[f"{folder.rstrip('/')}/{name}" for name in names], fmt=fmt)


class DuplicateKeysError(ValueError):
    """A join would multiply rows: its right side holds a key more than once."""


def scan_raw(
    spark: SparkSession, raw: RawPaths, project_sheets: Sequence[str] = C.PROJECT_SHEETS
) -> dict[str, DataFrame]:
    """The five raw tables, lazily; missing paths or columns fail with the table's name.

    Project sheets are those of the workbooks, or CSV exports whose names end in the year.
    """
    dashes = C.DEFAULT_NA_TOKENS + C.DASH_NA_TOKENS
    notes = [f"{C.SCORE_SOURCE_PREFIX}{y}" for y in C.SCORE_YEARS]
    layout = {
        "territory": (raw.territory, C.TERRITORY_NAMES, C.TERRITORY_SKIP, C.DEFAULT_NA_TOKENS),
        "score": (raw.score, [*C.SCORE_NAMES, *notes], C.SCORE_SKIP, dashes),
        "gdp": (raw.gdp, C.GDP_NAMES, C.GDP_SKIP, dashes),
        "distortion": (raw.distortion, C.DISTORTION_NAMES, C.DISTORTION_SKIP, dashes),
    }
    tables = {}
    for table, (path, columns, skip, tokens) in layout.items():
        skip = skip if raw.fmt == "sheet" else 0
        tables[table] = scan_table(
            spark, table, path, list(columns), raw.fmt, skip_rows=skip, na_tokens=tokens
        )
    projects = scan_table(
        spark, "projects", raw.projects, list(C.PROJECT_NAMES), raw.fmt,
        skip_rows=C.PROJECT_SKIP if raw.fmt == "sheet" else 0, na_tokens=dashes,
        sheets_named=project_sheets,
        **({"sheetPattern": r"(\d{4})\D*$"} if raw.fmt == "sheet" else {}),
    )
    # the sheet name is the year
    tables["projects"] = projects.withColumnRenamed("_sheet", "ano")
    return tables


@contextmanager
def _duplicates_named():
    """The plan's own error for rows that share a key, as DuplicateKeysError."""
    try:
        yield
    except PySparkException as error:
        found = re.search(r"USER_RAISED_EXCEPTION\] (.*key more than once: .*)", str(error))
        if not found:
            raise
        raise DuplicateKeysError(found[1].strip()) from error


def _makers(
    tables: Mapping[str, DataFrame], state_names: Mapping[str, str] | None, target_years: list[int] | None,
    until: int, staged: list[DataFrame],
) -> dict[str, Callable[[], DataFrame]]:
    """The treated tables, each made when it is called for; staged tables are added to ``staged``."""

    def gdp() -> DataFrame:
        # staged before its last year is found, so the raw GDP is read and cleaned once
        staged.append(stage(clean.clean_gdp_base(tables["gdp"]), "gdp-base"))
        return clean.replicate_forward(
            staged[-1], target_years=target_years, until=None if target_years is not None else until)

    return {
        C.TABLE_TERRITORY: lambda: clean.clean_territory(tables["territory"]),
        C.TABLE_SCORE: lambda: clean.clean_score(tables["score"]),
        C.TABLE_PROJECTS: lambda: clean.clean_projects(tables["projects"], state_names),
        C.TABLE_GDP: gdp,
        C.TABLE_DISTORTION: lambda: clean.clean_distortion(tables["distortion"]),
    }


def run(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    out: str,
    state_names: Mapping[str, str] | None = None,
    target_years: list[int] | None = None,
    until: int = C.GDP_REPLICATE_UNTIL,
    profiles: dict[str, list[tuple]] | None = None,
) -> DataFrame:
    """Clean the raw tables, write the treated ones, join and write the panel.

    Each treated table is written once and read back for the joins. Score and distortion rows that share place
    and year are an error, which the joins find themselves. ``profiles`` is filled with the profile of each of the
    six tables, gathered while they are written.
    """
    out = out.rstrip("/")

    def write(df: DataFrame, name: str, partition_by: str | None = None) -> None:
        seen: list[ObservedProfile] = []

        def watched(rows: DataFrame) -> DataFrame:
            seen.append(ObservedProfile(rows))
            return seen[0].df

        write_table(df, f"{out}/{name}", partition_by, watched if profiles is not None else None)
        if profiles is not None:
            profiles[name] = seen[0].rows()

    stored, staged = {}, []
    for name, make in _makers(tables, state_names, target_years, until, staged).items():
        df = make()
        write(df, name)
        stored[name] = read_table(spark, name, f"{out}/{name}", df.schema)
    for df in staged:
        drop_staged(df)
    joined = panel.join_panel(
        stored[C.TABLE_GDP], stored[C.TABLE_SCORE], stored[C.TABLE_TERRITORY],
        stored[C.TABLE_PROJECTS], stored[C.TABLE_DISTORTION], checked=True,
    )
    with _duplicates_named():
        write(joined, C.TABLE_PANEL, partition_by="ano")
    return load_panel(spark, out)


def publish(
    spark: SparkSession,
    raw: RawPaths,
    out: str,
    state_names: Mapping[str, str] | None = None,
    target_years: list[int] | None = None,
    until: int = C.GDP_REPLICATE_UNTIL,
    project_sheets: Sequence[str] = C.PROJECT_SHEETS,
) -> publishing.Published:
    """Bring published tables up to date: raw tables whose files and settings are as they were are not read.

    A file counts as changed when its path, size or time of change differs.
    """
    settings = {
        "projects": [state_names, list(project_sheets)],
        "gdp": [target_years, until],
    }
    names = {
        "territory": C.TABLE_TERRITORY, "score": C.TABLE_SCORE, "projects": C.TABLE_PROJECTS, "gdp": C.TABLE_GDP,
        "distortion": C.TABLE_DISTORTION,
    }
    sources = {}
    for name, treated in names.items():
        files = fingerprint(list_raw(spark, name, getattr(raw, name))).first()
        sources[treated] = json.dumps([files["rows"], files["mark"], raw.fmt, settings.get(name)])
    staged: list[DataFrame] = []
    makers = _makers(scan_raw(spark, raw, project_sheets), state_names, target_years, until, staged)
    with _duplicates_named():
        done = publishing.publish(spark, makers, out, sources)
    for df in staged:
        drop_staged(df)
    return done


def load_panel(spark: SparkSession, out: str, cached: bool = False) -> DataFrame:
    """The written panel in its column order; ``cached`` keeps it for a dashboard session."""
    path = f"{out.rstrip('/')}/{C.TABLE_PANEL}"
    spark.catalog.refreshByPath(path)
    df = read_table(spark, C.TABLE_PANEL, path).select(*C.PANEL_COLUMNS)
    return df.cache() if cached else df


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the municipality-by-year panel")
    parser.add_argument("--raw", required=True, help="folder with one entry per raw table")
    parser.add_argument("--out", required=True, help="folder for the processed tables")
    parser.add_argument("--format", default="sheet", choices=["sheet", "csv", "parquet"])
    for name in ("territory", "score", "projects", "gdp", "distortion"):
        parser.add_argument(f"--{name}", help=f"path of {name} outside the raw folder")
    parser.add_argument("--target-years", type=int, nargs="+", help="years to repeat the last GDP year for")
    parser.add_argument("--until", type=int, default=C.GDP_REPLICATE_UNTIL, help="repeat the last GDP year up to this one")
    parser.add_argument("--project-sheets", nargs="+", default=list(C.PROJECT_SHEETS), help="project years to read")
    parser.add_argument("--states", type=json.loads, help="state names by code, as JSON text")
    parser.add_argument("--profile", action="store_true", help="print the profiles of the written tables")
    parser.add_argument("--publish", action="store_true", help="versioned tables; only what changed is made anew")
    args = parser.parse_args(argv)
    standard = RawPaths.under(args.raw, args.format)
    raw = RawPaths(
        *[
            getattr(args, name) or getattr(standard, name)
            for name in ("territory", "score", "projects", "gdp", "distortion")
        ],
        fmt=args.format,
    )
    spark = get_spark("edupanel-job")
    if args.publish:
        done = publish(spark, raw, args.out, args.states, args.target_years, args.until, args.project_sheets)
        print(f"version {done.version}: cleaned {done.cleaned}, wrote the years {done.years}")
        return
    tables = scan_raw(spark, raw, args.project_sheets)
    profiles = {} if args.profile else None
    run(spark, tables, args.out, args.states, args.target_years, args.until, profiles)
    for name, rows in (profiles or {}).items():
        print(name, *("  {1} {2}: {3} of {4}, {5} to {6}, about {7} different".format(*r) for r in rows), sep="\n")


if __name__ == "__main__":
    main()

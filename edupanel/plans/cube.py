"""A stored cube over the serving panel, from which the dashboard's figures come without reading the panel.

Two tables hold what can be merged. ``cells`` has a row per year, state, segment bands and project status, with the number of
rows, sums, and per indicator how many values there are, their sum and extremes. ``places`` has the sets of
municipalities by year, state and status as bitmaps, so distinct counts of any union are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.operators import drop_null_keys
from edupanel.plans.dashboard import SCORE, in_states, year_and_states
from edupanel.sources.versions import VersionedTable

SEGMENTS = ("faixa_populacao", "faixa_pib", "faixa_pib_per_capita")
TOTALS = ("nr_projetos", "nr_beneficiados")
INDICATORS = (SCORE, *C.DISTORTION_MEASURES, "pib_mil_reais", "pib_per_capita", "populacao")
KEYS = ("ano", "sg_uf", "status_projeto", *[f"{s}{end}" for s in SEGMENTS for end in ("", "_ord")])
PLACE_KEYS = ("ano", "sg_uf", "status_projeto")


@dataclass(frozen=True)
class Cube:
    cells: DataFrame
    places: DataFrame


def _parts(indicator: str) -> dict[str, Column]:
    value = F.col(indicator)
    return {"n": F.count(value), "sum": F.sum(value), "min": F.min(value), "max": F.max(value)}


def build_cube(serving: DataFrame) -> Cube:
    """Both tables; every task merges its rows before anything is shuffled.

    Null keys are kept as keys of their own, so the cube answers for rows with and without a state or band. A bitmap holds
    the ids of one bucket of whole numbers; rows without an id count as rows but as no place. An id that is no whole
    number fails the job.
    """
    values = [F.count(F.lit(1)).alias("rows"), *[F.sum(t).alias(t) for t in TOTALS]]
    values += [part.alias(f"{i}__{name}") for i in INDICATORS for name, part in _parts(i).items()]
    cells = serving.groupBy(*KEYS).agg(*values)
    place = F.col("id_municipio").cast("long")
    known = serving.where(F.col("id_municipio").isNotNull())
    places = known.groupBy(*PLACE_KEYS, F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("ids"))
    return Cube(cells, places)


def store_cube(serving: DataFrame, root: str) -> Cube:
    """Write the cube by year as versioned tables and give it back as stored.

    The bands are quartiles over all rows, so a changed panel makes a new cube, not new years of the old one.
    """
    spark, root = serving.sparkSession, root.rstrip("/")
    made = build_cube(serving)
    for name in ("cells", "places"):
        VersionedTable(spark, f"{root}/{name}").write(getattr(made, name), "ano")
    return load_cube(spark, root)


def load_cube(spark: SparkSession, root: str) -> Cube:
    return Cube(*[VersionedTable(spark, f"{root.rstrip('/')}/{name}").read() for name in ("cells", "places")])


def mean(indicator: str) -> Column:
    """Mean over the rows behind the cells, null where none has a value."""
    values = F.sum(f"{indicator}__n")
    return F.when(values > 0, F.sum(f"{indicator}__sum") / values)


def kpi_overview(cube: Cube, year: int, states: Sequence[str] | None = None) -> DataFrame:
    """The row of key figures that the question over the panel gives."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    def rows_with(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status_projeto") == status, F.col("rows"))), F.lit(0))

    figures = year_and_states(cube.cells, year, states).agg(
        rows_with(C.WITH_PROJECTS).alias("com_projetos"),
        rows_with(C.WITHOUT_PROJECTS).alias("sem_projetos"),
        total("nr_projetos").alias("projetos_ativos"),
        total("nr_beneficiados").alias("estudantes_beneficiados"),
        mean(SCORE).alias("ideb_medio"),
        F.min(f"{SCORE}__min").alias("ideb_min"),
        F.max(f"{SCORE}__max").alias("ideb_max"),
    )
    places = distinct_places(year_and_states(cube.places, year, states)).select(
        F.col("places").alias("total_municipios"))
    # one row on either side
    return figures.withColumn("total_municipios", places.scalar()).select("total_municipios", *figures.columns)


def distinct_places(places: DataFrame, *keys: str) -> DataFrame:
    """(keys, places): how many municipalities the chosen rows have together, by the keys or in all."""
    merged = places.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    counted = merged.groupBy(*keys) if keys else merged.groupBy()
    return counted.agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).alias("places"))


def _known(indicator: str, segment: str) -> None:
    if indicator not in INDICATORS or segment not in SEGMENTS:
        raise ValueError(f"the cube has {list(INDICATORS)} by {list(SEGMENTS)}, not {indicator} by {segment}")


def impact_score(
    cube: Cube, segment: str, first_year: int, last_year: int,
    states: Sequence[str] | None = None, indicator: str = SCORE,
) -> DataFrame:
    """Mean indicator by segment, year and project status for two years."""
    _known(indicator, segment)
    if first_year >= last_year:
        raise ValueError("the first year must lie before the last year")
    rows = cube.cells.where(F.col("ano").isin(first_year, last_year) & (F.col(f"{indicator}__n") > 0))
    rows = drop_null_keys(in_states(rows, states), [segment])
    return rows.groupBy(segment, f"{segment}_ord", "ano", "status_projeto").agg(mean(indicator).alias(indicator))


def context_by_segment(
    cube: Cube, year: int, indicator: str, segment: str, states: Sequence[str] | None = None,
) -> DataFrame:
    """Mean indicator by segment and status in one year; null where no row has a value."""
    _known(indicator, segment)
    rows = drop_null_keys(year_and_states(cube.cells, year, states), [segment, "status_projeto"])
    return rows.groupBy(segment, f"{segment}_ord", "status_projeto").agg(mean(indicator).alias("valor_medio"))


def evolution(cube: Cube, states: Sequence[str] | None = None) -> DataFrame:
    """Per year the places, the rows with projects, the projects and the mean score: the overview of all years at once."""
    rows = in_states(cube.cells, states)
    with_projects = F.sum(F.when(F.col("status_projeto") == C.WITH_PROJECTS, F.col("rows")))
    figures = rows.groupBy("ano").agg(
        F.coalesce(with_projects, F.lit(0)).alias("com_projetos"),
        F.coalesce(F.sum("nr_projetos"), F.lit(0)).cast("long").alias("projetos_ativos"),
        mean(SCORE).alias("ideb_medio"),
    )
    places = distinct_places(in_states(cube.places, states), "ano").select(
        F.col("ano").alias("_year"), F.col("places").alias("total_municipios"))
    # the places' years are among those of the cells
    return figures.join(places, F.col("ano").eqNullSafe(F.col("_year")), "left").drop("_year").fillna(0, ["total_municipios"])


def year_options(cube: Cube, not_null: Sequence[str] = ()) -> DataFrame:
    """Years on offer, newest first, those in which each of the indicators has a value somewhere."""
    rows = cube.cells.where(F.col("ano").isNotNull())
    have = [F.max(F.col(f"{i}__n")) > 0 for i in not_null]
    years = rows.groupBy("ano").agg(F.lit(True).alias("_all"), *[h.alias(f"_{n}") for n, h in enumerate(have)])
    for n in range(len(have)):
        years = years.where(F.col(f"_{n}"))
    return years.select("ano").orderBy(F.desc("ano"))


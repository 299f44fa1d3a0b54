"""Questions over the serving panel, one function per dashboard table or chart.

``states`` lists the chosen states; None stands for all of them. Rows without a state are
never shown, as in a choice of all listed states.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.functions import fixed_decimals, matches, thousands
from edupanel.functions.numbers import nan_to_null
from edupanel.operators import densify, drop_null_keys, wide_by_value
from edupanel.operators.search_index import SearchIndex
from edupanel.sources import write_csv

NAME, SCORE, RATE = "nome_municipio_formatado", "ideb_nota", "taxa_distorcao_total_fun"


def in_states(panel: DataFrame, states: Sequence[str] | None) -> DataFrame:
    if states is None:
        return panel.where(F.col("sg_uf").isNotNull())
    return panel.where(F.col("sg_uf").isin(*states) if states else F.lit(False))


def year_and_states(
    panel: DataFrame, year: int, states: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one year in the chosen states; the year prunes the folders that are read."""
    return in_states(panel.where(F.col("ano") == year), states)


# --- options -----------------------------------------------------------------------------
def year_options(panel: DataFrame, not_null: Sequence[str] = (), newest_first: bool = True):
    """Years on offer, those with a value in every ``not_null`` column."""
    years = panel.na.drop("any", subset=["ano", *not_null]).select("ano").distinct()
    return years.orderBy(F.desc("ano") if newest_first else F.asc("ano"))


def state_options(panel: DataFrame) -> DataFrame:
    return panel.select("sg_uf").na.drop().distinct().orderBy("sg_uf")


def name_options(panel: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    return in_states(panel, states).select(NAME).na.drop().distinct().orderBy(NAME)


# --- overview ----------------------------------------------------------------------------
def kpi_overview(panel: DataFrame, year: int, states: Sequence[str] | None = None) -> DataFrame:
    """One row of key figures; the distinct count merges per task before it shuffles."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    def rows_with(status: str) -> Column:
        return F.count_if(F.col("status_projeto") == status)

    return year_and_states(panel, year, states).agg(
        F.countDistinct("id_municipio").alias("total_municipios"),
        rows_with(C.WITH_PROJECTS).alias("com_projetos"),
        rows_with(C.WITHOUT_PROJECTS).alias("sem_projetos"),
        total("nr_projetos").alias("projetos_ativos"),
        total("nr_beneficiados").alias("estudantes_beneficiados"),
        F.avg(SCORE).alias("ideb_medio"),
        F.min(SCORE).alias("ideb_min"),
        F.max(SCORE).alias("ideb_max"),
    )


def kpi_labels(overview: DataFrame) -> DataFrame:
    """The key figures as shown."""
    return overview.select(
        F.col("total_municipios").cast("string").alias("total_municipios"),
        F.col("projetos_ativos").cast("string").alias("projetos_ativos"),
        thousands(F.col("estudantes_beneficiados")).alias("estudantes_beneficiados"),
        *[fixed_decimals(F.col(c)).alias(c) for c in ("ideb_medio", "ideb_min", "ideb_max")],
    )


def ranking(
    panel: DataFrame, year: int, indicator: str, best: bool = True,
    states: Sequence[str] | None = None, size: int = 5,
) -> DataFrame:
    """Best places first or worst places first; high scores and low rates are good.

    Ties go by name and id. Each task keeps ``size`` rows, so nothing is sorted in full.
    """
    other = RATE if indicator == SCORE else SCORE
    rows = year_and_states(panel, year, states).na.drop(subset=[indicator])
    high_first = (indicator == SCORE) == best
    order = F.desc(indicator) if high_first else F.asc(indicator)
    top = rows.orderBy(order, NAME, "id_municipio").limit(size)
    return top.select(NAME, indicator, other)


# --- map ---------------------------------------------------------------------------------
def map_layer(
    panel: DataFrame, features: DataFrame, year: int, states: Sequence[str] | None = None
) -> DataFrame:
    """Places of the year with an outline, and what the map shows on them."""
    rows = year_and_states(panel, year, states)
    shown = rows.select("id_municipio", "status_projeto", *C.HOVER_COLUMNS)
    outlines = features.select(F.col("id").alias("id_municipio"), "geometry")
    return shown.join(outlines, "id_municipio", "inner")


# --- impact ------------------------------------------------------------------------------
def _period(panel, indicator, segment, first_year, last_year, states) -> DataFrame:
    if first_year >= last_year:
        raise ValueError("the first year must lie before the last year")
    rows = in_states(panel.where(F.col("ano").isin(first_year, last_year)), states)
    return rows.na.drop(subset=[indicator, segment])


def impact_score(
    panel: DataFrame, segment: str, first_year: int, last_year: int,
    states: Sequence[str] | None = None, indicator: str = SCORE,
) -> DataFrame:
    """Mean indicator by segment, year and project status for two years."""
    rows = _period(panel, indicator, segment, first_year, last_year, states)
    keys = [segment, f"{segment}_ord", "ano", "status_projeto"]
    return rows.groupBy(*keys).agg(F.avg(indicator).alias(indicator))


def impact_variation(
    panel: DataFrame, segment: str, first_year: int, last_year: int,
    states: Sequence[str] | None = None, indicator: str = RATE, by_id_only: bool = False,
) -> DataFrame:
    """Mean change between two years by segment and project status.

    A place counts while its segment and status are the same in both years. ``by_id_only``
    follows the place alone and files it under the segment and status of the last year.
    """
    rows = _period(panel, indicator, segment, first_year, last_year, states)
    keys = [segment, f"{segment}_ord", "status_projeto"]
    names = {first_year: "_first", last_year: "_last"}
    rows = drop_null_keys(rows, ["id_municipio"])
    if by_id_only:
        last = F.when(F.col("ano") == last_year, F.struct(*keys))
        means = [
            F.avg(F.when(F.col("ano") == y, F.col(indicator))).alias(out)
            for y, out in names.items()
        ]
        wide = rows.groupBy("id_municipio").agg(*means, F.max(last).alias("_at_last"))
        wide = wide.select("_first", "_last", "_at_last.*")
    else:
        ids = ["id_municipio", *keys]
        wide = wide_by_value(rows, ids, "ano", names, F.avg, F.col(indicator))
    change = wide.na.drop(subset=["_first", "_last"])
    variation = F.avg(F.col("_last") - F.col("_first"))
    return change.groupBy(*keys).agg(variation.alias("variacao"))


def context_by_segment(
    panel: DataFrame, year: int, indicator: str, segment: str,
    states: Sequence[str] | None = None,
) -> DataFrame:
    """Mean indicator by segment and status in one year; null where no row has a value."""
    rows = drop_null_keys(year_and_states(panel, year, states), [segment, "status_projeto"])
    grouped = rows.groupBy(segment, f"{segment}_ord", "status_projeto")
    return grouped.agg(F.avg(indicator).alias("valor_medio"))


def context_dense(context: DataFrame, segment: str, labels: Sequence[str]) -> DataFrame:
    """The context with a null row for every empty pair of segment and status."""
    return dense(context, segment, labels, {"status_projeto": C.STATUS_LABELS})


def dense(
    grouped: DataFrame, segment: str, labels: Sequence[str], others: Mapping[str, Sequence[object]]
) -> DataFrame:
    """Any answer by segment with a null row for every combination of labels without rows."""
    filled = densify(grouped.drop(f"{segment}_ord"), {segment: labels, **others})
    position = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(segment))
    return filled.withColumn(f"{segment}_ord", position.cast("int"))


# --- history, scatter, detail --------------------------------------------------------------
def history_series(
    panel: DataFrame, names: Sequence[str] | DataFrame, indicator: str,
    highlight_year: int | None = None, by: str = NAME,
) -> DataFrame:
    """Indicator by year for the chosen places, given as a list or as a frame of names.

    Places are chosen by name, so places of the same name in other states come along; choose
    ``by="id_municipio"`` to tell them apart.
    """
    rows = panel.na.drop(subset=[indicator])
    if isinstance(names, DataFrame):
        rows = rows.join(names.select(by), by, "left_semi")
    else:
        rows = rows.where(F.col(by).isin(*names) if names else F.lit(False))
    highlight = F.lit(False) if highlight_year is None else F.col("ano") == highlight_year
    return rows.select("ano", NAME, indicator, highlight.alias("destaque"))


def scatter_points(
    panel: DataFrame, x: str, y: str, year: int, states: Sequence[str] | None = None
) -> DataFrame:
    """Points with both axes present, for places with projects to be drawn last."""
    unknown = [axis for axis in (x, y) if axis not in C.SCATTER_AXES]
    if unknown:
        raise ValueError(f"no axes: {unknown}; choose from {list(C.SCATTER_AXES)}")
    rows = year_and_states(panel, year, states).na.drop(subset=[x, y])
    return rows.select(
        NAME, F.col(x).alias("x"), F.col(y).alias("y"), "populacao", "status_projeto",
        "tem_projeto",
    )


def draw_order(points: DataFrame) -> DataFrame:
    """Sorted so that places with projects come last; for delivery only."""
    return points.orderBy("tem_projeto")


def correlation_by_year(panel: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation coefficient of two columns by year and project status.

    Null where an axis is constant or holds an infinite value.
    """
    rows = drop_null_keys(panel, [x, y, "ano"])
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return rows.groupBy("ano", "status_projeto").agg(
        nan_to_null(F.try_divide(F.covar_pop(x, y), spread)).alias("correlacao"),
        F.count(F.lit(1)).alias("pontos"),
    )


def correlations_by_year(panel: DataFrame, axes: Sequence[str], y: str) -> DataFrame:
    """``correlation_by_year`` of every axis with ``y``, in one pass: ano, status_projeto, eixo, correlacao, pontos.

    One aggregate holds the co-moments of all axes. A year and status without a point on an axis has no row for it.
    """
    rows = drop_null_keys(panel, [y, "ano"])
    moments = []
    for n, axis in enumerate(axes):
        x, other = F.col(axis), F.when(F.col(axis).isNotNull(), F.col(y))
        moments += [
            F.covar_pop(x, other).alias(f"_c{n}"), F.stddev_pop(x).alias(f"_x{n}"), F.stddev_pop(other).alias(f"_y{n}"),
            F.count(x).alias(f"_n{n}")]
    found = [
        F.struct(
            F.lit(axis).alias("eixo"),
            nan_to_null(F.try_divide(F.col(f"_c{n}"), F.col(f"_x{n}") * F.col(f"_y{n}"))).alias("correlacao"),
            F.col(f"_n{n}").alias("pontos"))
        for n, axis in enumerate(axes)
    ]
    grouped = rows.groupBy("ano", "status_projeto").agg(*moments)
    return grouped.select("ano", "status_projeto", F.inline(F.array(*found))).where("pontos > 0")


def detail_table(
    panel: DataFrame, year: int, states: Sequence[str] | None = None, search: str = "",
    literal: bool = False, index: SearchIndex | None = None,
) -> DataFrame:
    """The detail columns, and the flag that marks rows of places with projects.

    With an ``index`` of the panel's names the search is done there and its names are joined to the rows.
    """
    rows = year_and_states(panel, year, states)
    if search and index is not None:
        rows = rows.join(index.search(search, literal).withColumnRenamed("name", NAME), NAME, "left_semi")
    elif search:
        rows = rows.where(matches(F.col(NAME), search, literal))
    return rows.select(*C.DETAIL_COLUMNS, "tem_projeto")


def export_detail(detail: DataFrame, year: int, folder: str) -> str:
    """Write the detail columns as CSV; the path returned carries the year."""
    path = f"{folder.rstrip('/')}/dados_detalhados_{year}.csv"
    write_csv(detail.select(*C.DETAIL_COLUMNS), path)
    return path

"""Exploratory questions over the panel: presence of projects, wealth, size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.functions import round_half_even
from edupanel.operators import (
    densify,
    drop_null_keys,
    fixed_bands,
    quantile_bands,
    wide_by_value,
    wide_to_long,
)

FLAG, WEALTH, SIZE = "tem_projeto_ia", "categoria_pib", "porte_municipio"
SCORE = "ideb_nota"


def presence_flag(panel: DataFrame) -> DataFrame:
    """'Sim' where a project row matched, even one whose counts are all 0."""
    flag = F.when(F.col("nr_projetos").isNotNull(), C.PRESENT).otherwise(C.ABSENT)
    return panel.withColumn(FLAG, flag)


def wealth_bands(panel: DataFrame) -> DataFrame:
    """Quartiles of GDP per capita; left out when the edges coincide."""
    bands = [("pib_per_capita", WEALTH, C.WEALTH_BANDS)]
    return quantile_bands(panel, bands, on_duplicate_edges="skip")


def size_bands(panel: DataFrame) -> DataFrame:
    band = fixed_bands(F.col("populacao"), C.SIZE_LIMITS, C.SIZE_LABELS, C.SIZE_UNDEFINED)
    return panel.withColumn(SIZE, band)


def exploration_panel(panel: DataFrame) -> DataFrame:
    return size_bands(wealth_bands(presence_flag(panel)))


def by_flag(
    df: DataFrame, keys: Sequence[str], cell: Callable[[Column], Column], value: Column
) -> DataFrame:
    """Keys down, 'Não' and 'Sim' across; a cell without rows is null."""
    rows = drop_null_keys(df, keys)
    return wide_by_value(rows, keys, FLAG, {v: v for v in C.PRESENCE_LABELS}, cell, value)


def flag_by_year(df: DataFrame) -> DataFrame:
    def rows(value: Column) -> Column:
        # a combination that does not occur is null, not 0
        return F.nullif(F.count(value), F.lit(0))

    return by_flag(df, ["ano"], rows, F.lit(1))


def wealth_frequencies(df: DataFrame) -> DataFrame:
    """Rows per wealth band; empty bands show 0."""
    counts = drop_null_keys(df, [WEALTH]).groupBy(WEALTH).agg(F.count(F.lit(1)).alias("linhas"))
    return densify(counts, {WEALTH: C.WEALTH_BANDS}).fillna(0, subset=["linhas"])


def size_frequencies(df: DataFrame) -> DataFrame:
    return df.groupBy(SIZE).agg(F.count(F.lit(1)).alias("linhas"))


def score_by_wealth(df: DataFrame, empty: bool = False) -> DataFrame:
    """Mean score by wealth band and presence of projects; with ``empty`` also a row for every band without rows."""

    def mean(value: Column) -> Column:
        return round_half_even(F.avg(value))

    table = by_flag(df, [WEALTH], mean, F.col(SCORE))
    return densify(table, {WEALTH: C.WEALTH_BANDS}) if empty else table


def score_by_wealth_long(crosstab: DataFrame) -> DataFrame:
    return wide_to_long(crosstab, [WEALTH], C.PRESENCE_LABELS, FLAG, SCORE)


def projects_by_size(df: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("nr_projetos"), F.lit(0.0))
    return df.groupBy(SIZE).agg(total.alias("nr_projetos"))


def score_by_size_and_wealth(df: DataFrame, empty: bool = False) -> DataFrame:
    """Mean score by size, wealth band and presence; with ``empty`` also a row for every pair without rows."""

    def mean(value: Column) -> Column:
        return round_half_even(F.avg(value))

    table = by_flag(df, [SIZE, WEALTH], mean, F.col(SCORE))
    return densify(table, {SIZE: (*C.SIZE_LABELS, C.SIZE_UNDEFINED), WEALTH: C.WEALTH_BANDS}) if empty else table

"""The consolidated panel and the serving panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.operators import assert_unique, quantile_bands


def join_panel(
    gdp: DataFrame, score: DataFrame, territory: DataFrame, projects: DataFrame,
    distortion: DataFrame, checked: bool = False,
) -> DataFrame:
    """GDP rows with score, territory, projects and distortion where they match.

    With ``checked`` score or distortion rows that share place and year, which would multiply rows, fail the job;
    the other right sides hold one row per key by the way they are made.

    The right sides are aggregated or de-duplicated before they get here. No side is
    broadcast by hint: Spark does so once statistics or the finished shuffle show that it
    is small. Neighbouring joins use different keys. Two joins on (id, year) in a row would
    save one shuffle of the panel, but adaptive execution splits a skewed join only where a
    shuffle follows, and a key may hold a large share of the rows.
    """
    key = ["id_municipio", "ano"]
    if checked:
        score = assert_unique(score, key, C.TABLE_SCORE)
        distortion = assert_unique(distortion, key, C.TABLE_DISTORTION)
    joined = (
        gdp.join(score.drop("nome_municipio_formatado"), key, "left")
        .join(territory.drop("nome_municipio_formatado"), "id_municipio", "left")
        .join(distortion.drop("nome_municipio_formatado"), key, "left")
    )
    return join_projects(joined, projects).select(*C.PANEL_COLUMNS)


def join_projects(panel: DataFrame, projects: DataFrame) -> DataFrame:
    """Left join on place name, state name and year.

    A missing state name matches a missing state name; that is an equality Spark can hash,
    not a filter after a join on fewer keys.
    """
    right = projects.drop("sg_uf").withColumnsRenamed(
        {"nome_municipio_formatado": "_name", "nome_uf": "_state", "ano": "_year"}
    )
    same = (
        (panel["nome_municipio_formatado"] == right["_name"])
        & panel["nome_uf"].eqNullSafe(right["_state"])
        & (panel["ano"] == right["_year"])
    )
    return panel.join(right, same, "left").drop("_name", "_state", "_year")


def project_flags(panel: DataFrame) -> DataFrame:
    """Missing project counts as 0, and whether the place has projects in that year."""
    filled = panel.fillna(0, subset=["nr_projetos", "nr_beneficiados"])
    has = F.col("nr_projetos") > 0
    status = F.when(has, C.WITH_PROJECTS).otherwise(C.WITHOUT_PROJECTS)
    return filled.withColumns({"tem_projeto": has, "status_projeto": status})


def serving_panel(panel: DataFrame, method: str = "exact") -> DataFrame:
    """The panel with flags, text ids and quartile bands.

    Quartiles are taken over all rows of the panel, every year and state together.
    """
    flagged = project_flags(panel).withColumn("id_municipio", F.col("id_municipio").cast("string"))
    bands = [
        ("populacao", "faixa_populacao", C.POPULATION_BANDS),
        ("pib_mil_reais", "faixa_pib", C.GDP_BANDS),
        ("pib_per_capita", "faixa_pib_per_capita", C.GDP_PER_CAPITA_BANDS),
    ]
    return quantile_bands(flagged, bands, method=method)

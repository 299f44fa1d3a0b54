"""Cleaning jobs: one raw table in, one treated table out.

Raw fields are text as scanned; a key or measure that already is a number is taken as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.functions import coerce_numeric, normalize_name, parse_key, ratio
from edupanel.functions.numbers import nan_to_null, parse_number
from edupanel.operators import dedup_keep_first, drop_null_keys, replicate_forward, unpivot_years


def measure(df: DataFrame, name: str) -> Column:
    """A measure as double with null for missing; text that is no number fails the job."""
    if dict(df.dtypes)[name] == "string":
        return parse_number(F.col(name), name)
    return nan_to_null(F.col(name).cast("double"))


def key(df: DataFrame, name: str) -> Column:
    """A whole-number key as LONG."""
    if dict(df.dtypes)[name] in ("int", "bigint"):
        return F.col(name).cast("long")
    return parse_key(F.col(name))


def year(df: DataFrame, name: str) -> Column:
    """A year as INT, also from '2021.0'."""
    return key(df, name).cast("int")


def clean_territory(raw: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """One row per municipality, the first by file and row."""
    if order is None:
        order = [c for c in ("_source", "_row") if c in raw.columns]
    named = raw.withColumnsRenamed(C.TERRITORY_NAMES)
    keyed = named.withColumns(
        {"id_municipio": key(named, "id_municipio"), "id_uf": key(named, "id_uf").cast("int")}
    )
    return dedup_keep_first(keyed, ["id_municipio"], order).select(
        "id_uf",
        "nome_uf",
        "nome_rgi",
        "id_municipio",
        normalize_name(F.col("nome_municipio")).alias("nome_municipio_formatado"),
    )


def clean_score(
    raw: DataFrame, years: Sequence[int] = C.SCORE_YEARS, network: str = C.PUBLIC_NETWORK
) -> DataFrame:
    """Yearly score columns of one network as rows; years without a score stay as null."""
    yearly = {f"{C.SCORE_SOURCE_PREFIX}{y}": f"{C.SCORE_PREFIX}{y}" for y in years}
    named = raw.withColumnsRenamed({**C.SCORE_NAMES, **yearly})
    public = drop_null_keys(named.where(F.col("rede") == network), ["id_municipio"])
    wide = public.select(
        key(public, "id_municipio").alias("id_municipio"),
        normalize_name(F.col("nome_municipio")).alias("nome_municipio_formatado"),
        *[measure(public, name).alias(name) for name in yearly.values()],
    )
    long = unpivot_years(
        wide, ["id_municipio", "nome_municipio_formatado"], C.SCORE_PREFIX, years, "ideb_nota"
    )
    return long.select("id_municipio", "ideb_nota", "ano", "nome_municipio_formatado")


def clean_projects(
    raw: DataFrame, state_names: Mapping[str, str] | None = None, year_column: str = "ano"
) -> DataFrame:
    """Project counts per place, state and year; the state name where the mapping has it.

    Rows without a state are not municipalities. Counts that are all missing sum to 0.
    """
    state_names = C.STATE_NAMES if state_names is None else state_names
    named = raw.withColumnsRenamed(C.PROJECT_NAMES)
    valid = named.where(F.col("sg_uf").isNotNull()).select(
        normalize_name(F.col("nome_municipio")).alias("nome_municipio_formatado"),
        "sg_uf",
        year(named, year_column).alias("ano"),
        *[measure(named, name).alias(name) for name in C.PROJECT_MEASURES],
    )
    keys = ["nome_municipio_formatado", "sg_uf", "ano"]
    totals = [
        F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in C.PROJECT_MEASURES
    ]
    summed = drop_null_keys(valid, keys).groupBy(*keys).agg(*totals)
    lookup = F.create_map(*[F.lit(part) for pair in state_names.items() for part in pair])
    return summed.withColumn("nome_uf", lookup[F.col("sg_uf")])


def clean_gdp_base(raw: DataFrame) -> DataFrame:
    """GDP rows with a usable id, total and per-capita value, and the derived population."""
    named = raw.withColumnsRenamed(C.GDP_NAMES)
    types = dict(named.dtypes)

    def lenient(name: str) -> Column:
        text = F.col(name)
        return coerce_numeric(text) if types[name] == "string" else nan_to_null(text.cast("double"))

    typed = named.select(
        # notes below the table have no id, and no year to parse
        F.when(F.col("id_municipio").isNotNull(), year(named, "ano")).alias("ano"),
        "regiao",
        key(named, "id_municipio").alias("id_municipio"),
        "sg_uf",
        lenient("pib_mil_reais").alias("pib_mil_reais"),
        lenient("pib_per_capita").alias("pib_per_capita"),
        normalize_name(F.col("nome_municipio")).alias("nome_municipio_formatado"),
    )
    kept = typed.na.drop("any", subset=["id_municipio", "pib_mil_reais", "pib_per_capita"])
    people = ratio(F.col("pib_mil_reais") * 1000, F.col("pib_per_capita"))
    return kept.withColumn("populacao", people)


def clean_gdp(
    raw: DataFrame,
    target_years: Sequence[int] | None = None,
    until: int | None = C.GDP_REPLICATE_UNTIL,
) -> DataFrame:
    """Cleaned GDP with the last year repeated up to ``until`` or for ``target_years``."""
    base = clean_gdp_base(raw)
    return replicate_forward(
        base, target_years=target_years, until=None if target_years is not None else until
    )


def clean_distortion(raw: DataFrame, network: str = C.PUBLIC_NETWORK) -> DataFrame:
    """Simple mean of the three rates per municipality and year, however the files are cut."""
    named = raw.withColumnsRenamed(C.DISTORTION_NAMES)
    public = named.where(F.col("rede") == network)
    rows = public.select(
        key(public, "id_municipio").alias("id_municipio"),
        year(public, "ano").alias("ano"),
        normalize_name(F.col("nome_municipio")).alias("nome_municipio_formatado"),
        *[measure(public, name).alias(name) for name in C.DISTORTION_MEASURES],
    )
    keys = ["id_municipio", "ano", "nome_municipio_formatado"]
    means = [F.avg(name).alias(name) for name in C.DISTORTION_MEASURES]
    # a yearly file is a year's rows, in as many part files as it was written
    return drop_null_keys(rows, keys).groupBy(*keys).agg(*means)

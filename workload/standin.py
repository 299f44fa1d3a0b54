"""Raw tables in the shape the cleaning jobs expect, derived from the order tables.

A customer plays a municipality, its nation the state, an order year the year. All are lazy.
They cover the whole tables, but for two that the panel takes narrower: urgent orders as projects, and rates of
the later years, so that some places and years have none. Facts are aggregated per customer and year (or per order)
before they meet the customers, so an order or customer that holds a large share of the
rows is merged in every task before anything is shuffled for a join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupanel import config as C
from edupanel.operators import replicate_forward
from edupanel.plans import clean, panel
from edupanel.plans.cube import Cube, store_cube
from edupanel.session import new_path, stage

SCORE_YEARS = (1995, 1997, 1999, 2001)
DISTORTION_YEARS = tuple(range(1997, 2002))
REPLICATED_YEARS = (2002, 2003, 2004, 2005)
LAST_YEAR = 2001
# the states a name is known for; the others have none
STATE_NAMES = {f"NATION_{n}": f"NATION_{n}" for n in range(20)}
_GDP_HEADERS = {name: header for header, name in C.GDP_NAMES.items()}
GDP_TOTAL, GDP_PER_CAPITA = _GDP_HEADERS["pib_mil_reais"], _GDP_HEADERS["pib_per_capita"]


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; its schema is taken from the files once per session."""
    path = f"{sf_dir}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _schemas:
        _schemas[known] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[known]).parquet(path)


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("ano", F.year("o_orderdate"))


def places(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def raw_gdp(spark, sf_dir) -> DataFrame:
    spent = (
        orders(spark, sf_dir)
        .groupBy("o_custkey", "ano")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    )
    per_capita = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).otherwise("-")
    return spent.join(places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("ano").alias("Ano"),
        F.col("r_name").alias("Nome da Grande Região"),
        F.col("c_custkey").cast("string").alias("Código do Município"),
        F.col("c_name").alias("Nome do Município"),
        F.col("n_name").alias("Sigla da Unidade da Federação"),
        F.col("total").cast("double").alias(GDP_TOTAL),
        per_capita.alias(GDP_PER_CAPITA),
    )


def raw_score(spark, sf_dir) -> DataFrame:
    network = (
        F.when(F.col("o_orderstatus") == "F", C.PUBLIC_NETWORK)
        .when(F.col("o_orderstatus") == "O", "Municipal")
        .otherwise("Estadual")
    )
    best = [
        F.max(F.when(F.col("ano") == y, F.col("o_totalprice"))).alias(f"VL_OBSERVADO_{y}")
        for y in SCORE_YEARS
    ]
    wide = (
        orders(spark, sf_dir)
        .where(F.col("ano").isin(*SCORE_YEARS))
        .groupBy("o_custkey", network.alias("REDE"))
        .agg(*best)
    )
    name = F.format_string("Município nº %d", F.col("o_custkey"))
    return wide.select(
        F.col("o_custkey").alias("CO_MUNICIPIO"),
        name.alias("NO_MUNICIPIO"),
        "REDE",
        *[f"VL_OBSERVADO_{y}" for y in SCORE_YEARS],
    )


def raw_projects(spark, sf_dir, all_orders: bool = False) -> DataFrame:
    """One row per urgent order, or per order: a project with its line items and pieces."""
    chosen, items = orders(spark, sf_dir), table(spark, sf_dir, "lineitem")
    if not all_orders:
        chosen = chosen.where(F.col("o_orderpriority") == "1-URGENT")
        keys = chosen.select(F.col("o_orderkey").alias("l_orderkey"))
        items = items.join(keys, "l_orderkey", "left_semi")
    items = items.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("pieces"))
    return (
        chosen.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_name").alias("CIDADES"),
            F.col("n_name").alias("ESTADO"),
            F.lit(1.0).alias("Nº de Projetos"),
            F.col("items").cast("double").alias("Nº de Instituições"),
            F.col("pieces").alias("Nº de Beneficiados"),
            "ano",
        )
    )


def raw_territory(spark, sf_dir) -> DataFrame:
    """Two editions of the list of places; the later one names places a second time."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    known = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "O")
        .groupBy("o_custkey")
        .agg(F.max(urgent).alias("in_first"))
    )

    def edition(region_name, first_row: int):
        return F.struct(
            region_name.alias("Nome Região Geográfica Imediata"),
            (F.col("c_custkey") + first_row).alias("_row"),
        )

    second = edition(F.lower("c_mktsegment"), 10**15)
    both = F.array(second, edition(F.col("c_mktsegment"), 0))
    return (
        places(spark, sf_dir)
        .join(known, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            F.col("n_nationkey").alias("UF"),
            F.col("n_name").alias("Nome_UF"),
            F.col("c_custkey").alias("Código Município Completo"),
            F.col("c_name").alias("Nome_Município"),
            F.inline(F.when(F.col("in_first"), both).otherwise(F.array(second))),
        )
    )


def raw_distortion(spark, sf_dir, years: tuple[int, ...] | None = DISTORTION_YEARS) -> DataFrame:
    """One row per order, year and return flag; whole-number rates keep the means exact."""
    rates = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_returnflag")
        .agg(
            F.round(F.max("l_discount") * 100).alias("FUN_CAT_0"),
            F.round(F.max("l_tax") * 100).alias("FUN_AI_CAT_0"),
            F.max("l_quantity").alias("FUN_AF_CAT_0"),
        )
    )
    network = (
        F.when(F.col("l_returnflag") == "R", C.PUBLIC_NETWORK)
        .when(F.col("l_returnflag") == "A", "Municipal")
        .otherwise("Privada")
    )
    counted = orders(spark, sf_dir)
    if years is not None:
        counted = counted.where(F.col("ano").isin(*years))
    return rates.join(counted, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("ano").alias("NU_ANO_CENSO"),
        F.col("o_custkey").alias("CO_MUNICIPIO"),
        F.format_string("Município nº %d", F.col("o_custkey")).alias("NO_MUNICIPIO"),
        network.alias("NO_DEPENDENCIA"),
        "FUN_CAT_0",
        "FUN_AI_CAT_0",
        "FUN_AF_CAT_0",
    )


def territory(spark, sf_dir) -> DataFrame:
    return clean.clean_territory(raw_territory(spark, sf_dir))


def score(spark, sf_dir) -> DataFrame:
    return clean.clean_score(raw_score(spark, sf_dir), SCORE_YEARS)


def projects(spark, sf_dir, all_orders: bool = False) -> DataFrame:
    return clean.clean_projects(raw_projects(spark, sf_dir, all_orders), STATE_NAMES)


def gdp_base(spark, sf_dir, fresh: bool = False) -> DataFrame:
    """Cleaned GDP rows, staged: finding the last year must not compute them again. Once per session, or ``fresh``."""

    def base() -> DataFrame:
        return clean.clean_gdp_base(raw_gdp(spark, sf_dir))

    return stage(base(), "gdp-base") if fresh else _once("gdp-base", spark, sf_dir, base)


def gdp(spark, sf_dir, fresh: bool = False) -> DataFrame:
    return replicate_forward(gdp_base(spark, sf_dir, fresh), target_years=REPLICATED_YEARS)


def distortion(spark, sf_dir, years: tuple[int, ...] | None = DISTORTION_YEARS) -> DataFrame:
    return clean.clean_distortion(raw_distortion(spark, sf_dir, years))


def treated(spark, sf_dir) -> dict[str, Callable[[], DataFrame]]:
    """The treated tables by name, each made when it is called for."""
    makers = {
        C.TABLE_TERRITORY: territory, C.TABLE_SCORE: score, C.TABLE_PROJECTS: projects, C.TABLE_GDP: gdp,
        C.TABLE_DISTORTION: distortion,
    }
    return {name: (lambda make=make: make(spark, sf_dir)) for name, make in makers.items()}


def build(spark, sf_dir) -> DataFrame:
    """The panel straight from the tables."""
    return panel.join_panel(
        gdp(spark, sf_dir, fresh=True),
        score(spark, sf_dir),
        territory(spark, sf_dir),
        projects(spark, sf_dir),
        distortion(spark, sf_dir),
    )


_written: dict[tuple[str, str, str], object] = {}


def _once(kind: str, spark, sf_dir, make) -> DataFrame:
    known = (kind, spark.sparkContext.applicationId, sf_dir)
    if known not in _written:
        _written[known] = stage(make(), kind, partition_by="ano")
    return _written[known]


def stored_cube(spark, sf_dir) -> Cube:
    """The cube over the serving panel, stored once per session."""
    known = ("cube", spark.sparkContext.applicationId, sf_dir)
    if known not in _written:
        _written[known] = store_cube(stored_serving(spark, sf_dir), new_path(spark, "cube"))
    return _written[known]


def refresh() -> None:
    """Forget the stored panels, so that the next question builds them from the tables."""
    _written.clear()


def stored_panel(spark, sf_dir) -> DataFrame:
    """The panel as the job leaves it: written once per session, partitioned by year."""
    return _once("panel", spark, sf_dir, lambda: build(spark, sf_dir))


def stored_serving(spark, sf_dir) -> DataFrame:
    """The serving panel as a dashboard session holds it: quartile edges found once, over the stored panel.

    What it adds to the panel is a plain expression per row, so no second copy of the panel is dealt out and written.
    """
    known = ("serving", spark.sparkContext.applicationId, sf_dir)
    if known not in _written:
        _written[known] = panel.serving_panel(stored_panel(spark, sf_dir))
    return _written[known]

"""The registered queries: every operator and report over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.functions import (
    coerce_numeric,
    matches,
    na_map,
    normalize_name,
    parse_key,
    ratio,
    round_half_even,
)
from edupanel.operators import (
    ObservedProfile,
    at_last_year,
    check_unique,
    dedup_keep_first,
    profile,
    quantile_bands,
    unpivot_years,
)
from edupanel.operators.search_index import SearchIndex
from edupanel.plans import cube as K
from edupanel.plans import dashboard as D
from edupanel.plans import exploration as X
from edupanel.plans import panel as P
from edupanel.plans.bucketed import bucket_tables
from edupanel.plans.publish import publish, published_panel
from edupanel.session import new_path, stage
from edupanel.sources import TableCache, VersionedTable, read_geojson, read_table, scan_table, write_table
from workload import standin as S
from workload import workbooks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

YEAR = 2001
FIRST_YEAR = 1997
CHANGED_YEAR = 2000
BUCKETS = 8
STATES = ("NATION_1", "NATION_3", "NATION_8", "NATION_22")
SCORE, RATE = D.SCORE, D.RATE
SIZE_SEGMENT, GDP_SEGMENT = "faixa_populacao", "faixa_pib"
TEXT_QUERY = r"mento[iu]|\batre"
NAME_QUERY = "tomer#0+1"


def query(function: Query, name: str | None = None) -> Query:
    QUERIES[name or function.__name__] = function
    return function


def named(name: str) -> Callable[[Query], Query]:
    return lambda function: query(function, name)


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    """Means without the last digits, which depend on the order of addition."""
    return df.withColumns({n: round_half_even(F.col(n), digits) for n in names})


# --- sources and sinks -------------------------------------------------------------------
def _write_sheets(df: DataFrame, path: str, junk_rows: int) -> None:
    """CSV files with lines above the header in each, as an exported sheet has them."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    line = F.concat_ws(",", *fields)
    top = "\n".join([f"note {n}" for n in range(junk_rows)] + [",".join(df.columns)])
    # the low bits number the rows of each written file
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    text = F.when(first, F.concat(F.lit(top + "\n"), line)).otherwise(line)
    df.select(text.alias("value")).write.text(path)


@query
def scan_header_offset(spark, sf_dir):
    path = new_path(spark, "sheets")
    _write_sheets(S.table(spark, sf_dir, "customer"), path, C.TERRITORY_SKIP)
    raw = scan_table(
        spark, "customer", path, ["c_custkey", "c_name", "c_acctbal"], "sheet",
        skip_rows=C.TERRITORY_SKIP,
    )
    return raw.select(
        F.col("c_custkey").cast("long"), "c_name", F.col("c_acctbal").cast("double")
    )


@query
def scan_multi_file(spark, sf_dir):
    orders = S.orders(spark, sf_dir).select("o_orderkey", "ano", "o_orderpriority")
    orders = stage(orders, "by-year", partition_by="ano")  # each year's file then reads that year's folder only
    paths = []
    # as many files as the data has years
    for (year,) in orders.select("ano").distinct().collect():
        paths.append(new_path(spark, f"sheets-{year}"))
        _write_sheets(orders.where(F.col("ano") == year), paths[-1], C.DISTORTION_SKIP)
    raw = scan_table(
        spark, "orders", paths, ["o_orderkey", "ano", "o_orderpriority"], "sheet",
        skip_rows=C.DISTORTION_SKIP,
    )
    return raw.select(F.col("o_orderkey").cast("long"), F.col("ano").cast("int"), "o_orderpriority")


@query
def scan_mixed_headers(spark, sf_dir):
    """CSV files with their columns in three orders, one of them with a column more, and Parquet files of two types."""
    orders = S.orders(spark, sf_dir).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.col("o_orderkey").alias("_row"), "ano")
    layouts = (
        ["o_orderkey", "o_totalprice", "o_orderpriority", "_row"], ["_row", "o_orderpriority", "o_orderkey", "o_totalprice"],
        ["o_orderpriority", "ano", "o_totalprice", "_row", "o_orderkey"],
    )
    landing = new_path(spark, "landing")
    for n, names in enumerate(layouts):
        orders.where(F.col("ano") % len(layouts) == n).select(*names).write.csv(f"{landing}/{n}", header=True)
    typed = new_path(spark, "landing")
    for n, kind in enumerate(("bigint", "string")):
        part = orders.where(F.col("ano") % 2 == n)
        part.withColumn("o_orderkey", F.col("o_orderkey").cast(kind)).write.parquet(f"{typed}/{n}")
    wanted = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    read = [
        scan_table(spark, "orders", [f"{landing}/{n}" for n in range(3)], wanted, "csv"),
        scan_table(spark, "orders", [f"{typed}/{n}" for n in range(2)], wanted),
    ]
    return read[0].withColumn("fmt", F.lit("csv")).unionByName(read[1].withColumn("fmt", F.lit("parquet"))).select(
        F.col("o_orderkey").cast("long"), F.col("o_totalprice").cast("double"), "o_orderpriority", "_row", "fmt")


@query
def scan_multi_sheet(spark, sf_dir):
    path = new_path(spark, "landing")
    orders = S.orders(spark, sf_dir).select(
        "o_orderkey", "o_totalprice", F.col("o_orderkey").alias("_row"), F.col("ano").alias("_sheet")
    )
    orders.write.partitionBy("_sheet").csv(path, header=True)
    raw = scan_table(
        spark, "orders", path, ["o_orderkey", "o_totalprice"], "csv",
        sheets_named=[str(r.ano) for r in S.orders(spark, sf_dir).select("ano").distinct().collect()],
    )
    return raw.select(
        F.col("o_orderkey").cast("long"),
        F.col("o_totalprice").cast("double"),
        F.col("_sheet").cast("int").alias("ano"),
    )


@query
def scan_workbook(spark, sf_dir):
    """Workbooks with one sheet per market segment; the sheet name becomes a column."""
    path = new_path(spark, "workbooks")
    customer = S.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("_sheet")
    )
    segments = sorted(r[0] for r in customer.select("_sheet").distinct().collect())
    workbooks.write_all(customer, path, segments, C.SCORE_SKIP)
    raw = scan_table(
        spark, "customer", path, ["c_custkey", "c_acctbal"], "sheet",
        skip_rows=C.SCORE_SKIP, sheets_named=segments,
    )
    return raw.select(
        parse_key(F.col("c_custkey")).alias("c_custkey"),
        coerce_numeric(F.col("c_acctbal")).alias("c_acctbal"),
        F.col("_sheet").alias("c_mktsegment"),
    )


@query
def scan_columns(spark, sf_dir):
    path = new_path(spark, "landing")
    S.table(spark, sf_dir, "part").withColumn("_row", F.col("p_partkey")).write.parquet(path)
    raw = scan_table(spark, "part", path, ["p_partkey", "p_brand"])
    return raw.select("p_partkey", "p_brand", "_row")


@query
def na_tokens(spark, sf_dir):
    note = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "--")
        .when(F.col("o_orderpriority") == "5-LOW", "N/A")
        .when(F.col("o_orderpriority") == "3-MEDIUM", " - ")
        .otherwise(F.col("o_orderpriority"))
    )
    return S.table(spark, sf_dir, "orders").select("o_orderkey", na_map(note).alias("note"))


@query
def parquet_roundtrip(spark, sf_dir):
    path = new_path(spark, "orders")
    orders = S.orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice", "ano")
    write_table(orders, path, partition_by="ano")
    return read_table(spark, "orders", path, orders.schema)


def _outlines(spark, sf_dir) -> DataFrame:
    """Outlines of the places in the territory list, one feature per line."""
    path = new_path(spark, "outlines")
    point = F.struct(
        F.lit("Point").alias("type"),
        F.array(F.col("c_nationkey"), F.col("n_regionkey")).alias("coordinates"),
    )
    known = S.territory(spark, sf_dir).select(F.col("id_municipio").alias("c_custkey"))
    S.places(spark, sf_dir).join(known, "c_custkey", "left_semi").select(
        F.lit("Feature").alias("type"),
        F.struct(F.col("c_custkey").cast("string").alias("id")).alias("properties"),
        point.alias("geometry"),
    ).write.json(path)
    return read_geojson(spark, path, layout="lines")


@query
def geojson_features(spark, sf_dir):
    return _outlines(spark, sf_dir)


@query
def csv_export(spark, sf_dir):
    detail = D.detail_table(S.stored_serving(spark, sf_dir), YEAR)
    path = D.export_detail(detail, YEAR, new_path(spark, "export"))
    return spark.read.schema(detail.select(*C.DETAIL_COLUMNS).schema).csv(path, header=True)


@query
def profile_panel(spark, sf_dir):
    return profile(S.stored_panel(spark, sf_dir))


@query
def profile_observed(spark, sf_dir):
    """The same profile with extremes, gathered while the panel is written; text of decimals is left out."""
    panel = S.stored_panel(spark, sf_dir)
    seen = []

    def watched(rows: DataFrame) -> DataFrame:
        seen.append(ObservedProfile(rows))
        return seen[0].df

    write_table(panel, new_path(spark, "observed"), "ano", watched)
    found = seen[0].frame(spark).drop("distinct_about")
    whole = F.col("dtype") != "double"
    return found.withColumns({c: F.when(whole, F.col(c)) for c in ("low", "high")})


@query
def cached_panel(spark, sf_dir):
    """A kept panel before and after a new version is published, of which one year is new."""
    panel = S.stored_panel(spark, sf_dir)
    table = VersionedTable(spark, new_path(spark, "cached"))
    cache = TableCache(spark)
    table.write(panel.where(F.col("ano") < YEAR), "ano")
    before = cache.get(table.root).groupBy("ano").agg(F.count(F.lit(1)).alias("linhas")).withColumn("versao", F.lit(1))
    before = stage(before, "before")
    table.write(panel.where(F.col("ano") == YEAR), "ano", replace=[YEAR])
    after = cache.get(table.root).groupBy("ano").agg(F.count(F.lit(1)).alias("linhas")).withColumn("versao", F.lit(2))
    after = stage(after, "after")
    cache.release()
    return before.unionByName(after)


# --- projections and filters -------------------------------------------------------------
@query
def rename_map(spark, sf_dir):
    return S.raw_gdp(spark, sf_dir).withColumnsRenamed(C.GDP_NAMES)


@query
def filter_network(spark, sf_dir):
    raw = S.raw_score(spark, sf_dir)
    return raw.where(F.col("REDE") == C.PUBLIC_NETWORK)


@query
def dropna_subset(spark, sf_dir):
    rows = S.stored_panel(spark, sf_dir).na.drop("any", subset=[SCORE, RATE])
    return rows.select("id_municipio", "ano", SCORE, RATE)


@query
def filter_year_state(spark, sf_dir):
    return D.year_and_states(S.stored_panel(spark, sf_dir), YEAR, STATES)


@query
def search_name(spark, sf_dir):
    documents = S.table(spark, sf_dir, "documents")
    return documents.where(matches(F.col("text"), TEXT_QUERY)).select("doc_id")


@query
def cast_keys(spark, sf_dir):
    as_read = F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    year = F.date_format("o_orderdate", "yyyy")
    return S.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        parse_key(as_read).alias("id_municipio"),
        year.cast("int").alias("ano"),
        parse_key(as_read).cast("string").alias("id_texto"),
    )


@named("coerce_numeric")
def coerce_numeric_text(spark, sf_dir):
    number = F.col("c_acctbal").cast("string")
    text = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit(" "), number, F.lit(" ")))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(number, F.lit("d")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.replace(number, F.lit("."), F.lit(",")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(number, F.lit("e2")))
        .otherwise(number)
    )
    return S.table(spark, sf_dir, "customer").select(
        "c_custkey", coerce_numeric(text).alias("valor")
    )


@query
def derive_population(spark, sf_dir):
    spent = S.orders(spark, sf_dir).groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )
    customer = S.table(spark, sf_dir, "customer")
    per_capita = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    return customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", ratio(F.col("total") * 1000, per_capita).alias("populacao")
    )


@query
def project_flags(spark, sf_dir):
    flagged = P.project_flags(S.stored_panel(spark, sf_dir))
    return flagged.select(
        "id_municipio", "ano", "nr_projetos", "nr_instituicoes", "nr_beneficiados", "tem_projeto",
        "status_projeto",
    )


@query
def project_flag_presence(spark, sf_dir):
    return X.presence_flag(S.stored_panel(spark, sf_dir)).select("id_municipio", "ano", X.FLAG)


@query
def map_lookup(spark, sf_dir):
    names = F.create_map(*[F.lit(part) for pair in S.STATE_NAMES.items() for part in pair])
    return S.places(spark, sf_dir).select("c_custkey", names[F.col("n_name")].alias("nome_uf"))


@query
def band_fixed(spark, sf_dir):
    return X.size_bands(S.stored_panel(spark, sf_dir)).select("id_municipio", "ano", X.SIZE)


@named("round_half_even")
def round_half_even_prices(spark, sf_dir):
    value = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", round_half_even(value).alias("valor")
    )


@named("normalize_name")
def normalize_name_texts(spark, sf_dir):
    name = normalize_name(F.col("text")).alias("nome")
    return S.table(spark, sf_dir, "documents").select("doc_id", name)


# --- quartile bands ----------------------------------------------------------------------
def _bands(spark, sf_dir, column: str, out: str, labels) -> DataFrame:
    panel = S.stored_panel(spark, sf_dir).select("id_municipio", "ano", column)
    banded = quantile_bands(panel, [(column, out, labels)])
    return banded.select("id_municipio", "ano", out, f"{out}_ord")


@query
def band_quartile_population(spark, sf_dir):
    return _bands(spark, sf_dir, "populacao", "faixa_populacao", C.POPULATION_BANDS)


@query
def band_quartile_gdp(spark, sf_dir):
    return _bands(spark, sf_dir, "pib_mil_reais", "faixa_pib", C.GDP_BANDS)


@query
def band_quartile_gdp_pc(spark, sf_dir):
    return _bands(spark, sf_dir, "pib_per_capita", "faixa_pib_per_capita", C.GDP_PER_CAPITA_BANDS)


@query
def band_quartile_by_year(spark, sf_dir):
    panel = S.stored_panel(spark, sf_dir).select("id_municipio", "ano", "populacao")
    bands = [("populacao", "faixa_populacao", C.POPULATION_BANDS)]
    return quantile_bands(panel, bands, partition_by="ano").drop("populacao")


@query
def band_quartile_sketch(spark, sf_dir):
    """Bands of three columns from two passes."""
    panel = S.stored_panel(spark, sf_dir).select("id_municipio", "ano", "populacao", "pib_mil_reais", "pib_per_capita")
    bands = [("populacao", "faixa_populacao", C.POPULATION_BANDS), ("pib_mil_reais", "faixa_pib", C.GDP_BANDS),
             ("pib_per_capita", "faixa_pib_per_capita", C.GDP_PER_CAPITA_BANDS)]
    return quantile_bands(panel, bands, method="sketch").drop("populacao", "pib_mil_reais", "pib_per_capita")


@query
def band_duplicate_edges(spark, sf_dir):
    """Quartiles of project counts, most of them equal, leave the column out; those of the GDP stay."""
    panel = P.project_flags(S.stored_panel(spark, sf_dir)).select("id_municipio", "ano", "nr_projetos", "pib_mil_reais")
    bands = [("nr_projetos", "faixa_projetos", C.GDP_BANDS), ("pib_mil_reais", "faixa_pib", C.GDP_BANDS)]
    banded = quantile_bands(panel, bands, on_duplicate_edges="skip")
    return banded.select("id_municipio", "ano", *[c for c in banded.columns if c.startswith("faixa_")])


@query
def band_quartile_category(spark, sf_dir):
    panel = S.stored_panel(spark, sf_dir).select("id_municipio", "ano", "pib_per_capita")
    return X.wealth_bands(panel).select("id_municipio", "ano", X.WEALTH)


# --- reshape, sets, keys -----------------------------------------------------------------
@query
def melt_years(spark, sf_dir):
    raw = S.raw_score(spark, sf_dir)
    return unpivot_years(raw, ["CO_MUNICIPIO", "REDE"], "VL_OBSERVADO_", S.SCORE_YEARS, SCORE)


@query
def replicate_forward(spark, sf_dir):
    return S.gdp(spark, sf_dir)


@query
def last_year_rows(spark, sf_dir):
    return at_last_year(S.gdp_base(spark, sf_dir)).select("id_municipio", "ano", "pib_mil_reais")


@query
def union_years(spark, sf_dir):
    """Two tables with their columns in another order; equal rows are all kept."""
    customer = S.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("uf"), F.round("c_acctbal", -3).alias("valor")
    )
    supplier = S.table(spark, sf_dir, "supplier").select(
        F.round("s_acctbal", -3).alias("valor"), F.col("s_nationkey").alias("uf")
    )
    return customer.unionByName(supplier)


@named("dedup_keep_first")
def dedup_keep_first_rows(spark, sf_dir):
    raw = S.raw_territory(spark, sf_dir).withColumnsRenamed(C.TERRITORY_NAMES)
    return dedup_keep_first(raw, ["id_municipio"], ["_row"]).select(
        "id_municipio", "nome_rgi", "_row"
    )


@query
def unique_keys(spark, sf_dir):
    return check_unique(S.raw_territory(spark, sf_dir), ["Código Município Completo"])


# --- joins -------------------------------------------------------------------------------
@query
def join_left_two_keys(spark, sf_dir):
    gdp = S.gdp(spark, sf_dir).select("id_municipio", "ano", "pib_mil_reais")
    score = S.score(spark, sf_dir).drop("nome_municipio_formatado")
    return gdp.join(score, ["id_municipio", "ano"], "left")


@query
def join_left_dim(spark, sf_dir):
    gdp = S.gdp(spark, sf_dir).select("id_municipio", "ano", "sg_uf")
    territory = S.territory(spark, sf_dir).drop("nome_municipio_formatado")
    return gdp.join(territory, "id_municipio", "left")


@query
def join_left_null_safe(spark, sf_dir):
    gdp = S.gdp(spark, sf_dir).select("id_municipio", "ano", "nome_municipio_formatado")
    states = S.territory(spark, sf_dir).select("id_municipio", "nome_uf")
    return P.join_projects(gdp.join(states, "id_municipio", "left"), S.projects(spark, sf_dir))


@query
def join_left_two_keys_b(spark, sf_dir):
    gdp = S.gdp(spark, sf_dir).select("id_municipio", "ano", "pib_per_capita")
    rates = S.distortion(spark, sf_dir).drop("nome_municipio_formatado")
    return gdp.join(rates, ["id_municipio", "ano"], "left")


@query
def map_layer(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    return D.map_layer(serving, _outlines(spark, sf_dir), YEAR)


# --- cleaning jobs and panel -------------------------------------------------------------
@query
def clean_territory(spark, sf_dir):
    return S.territory(spark, sf_dir)


@query
def clean_score(spark, sf_dir):
    return S.score(spark, sf_dir)


@query
def clean_projects(spark, sf_dir):
    """All orders as projects; the panel takes the urgent ones."""
    return S.projects(spark, sf_dir, all_orders=True)


@query
def agg_sum_projects(spark, sf_dir):
    return S.projects(spark, sf_dir, all_orders=True).drop("nome_uf")


@query
def clean_gdp(spark, sf_dir):
    return S.gdp(spark, sf_dir, fresh=True)


@query
def clean_distortion(spark, sf_dir):
    """All years; the panel takes the later ones."""
    return S.distortion(spark, sf_dir, years=None)


@query
def agg_mean_rates(spark, sf_dir):
    return S.distortion(spark, sf_dir, years=None).select("id_municipio", "ano", *C.DISTORTION_MEASURES)


@query
def build_panel(spark, sf_dir):
    return S.build(spark, sf_dir)


@query
def serving_panel(spark, sf_dir):
    return P.serving_panel(S.stored_panel(spark, sf_dir))


@query
def build_panel_bucketed(spark, sf_dir):
    """The same panel from tables bucketed by place."""
    treated = {name: make() for name, make in S.treated(spark, sf_dir).items()}
    tables = bucket_tables(spark, treated, new_path(spark, "bucketed"), BUCKETS)
    return tables.panel(treated[C.TABLE_PROJECTS])


@query
def publish_incremental(spark, sf_dir):
    """Published twice; of the first edition one year's rates differ, so the second run writes that year only."""
    out = new_path(spark, "published")
    tables = S.treated(spark, sf_dir)

    def earlier() -> DataFrame:
        rates = S.distortion(spark, sf_dir)
        shifted = {c: F.when(F.col("ano") == CHANGED_YEAR, F.col(c) + 1).otherwise(F.col(c)) for c in C.DISTORTION_MEASURES}
        return rates.withColumns(shifted)

    sources = {name: "unchanged" for name in tables}
    publish(spark, {**tables, C.TABLE_DISTORTION: earlier}, out, {**sources, C.TABLE_DISTORTION: "earlier"})
    done = publish(spark, tables, out, sources)
    panel = published_panel(spark, out)
    return panel.withColumn("written_again", F.col("ano").isin(*done.years))


# --- dashboard ---------------------------------------------------------------------------
@query
def kpi_overview(spark, sf_dir):
    overview = D.kpi_overview(S.stored_serving(spark, sf_dir), YEAR)
    return rounded(overview, "ideb_medio")


@query
def kpi_labels(spark, sf_dir):
    return D.kpi_labels(D.kpi_overview(S.stored_serving(spark, sf_dir), YEAR))


def _ranking(indicator: str, best: bool) -> Query:
    return lambda spark, sf_dir: D.ranking(
        S.stored_serving(spark, sf_dir), YEAR, indicator, best=best
    )


QUERIES["rank_top_score"] = _ranking(SCORE, True)
QUERIES["rank_bottom_score"] = _ranking(SCORE, False)
QUERIES["rank_top_rate"] = _ranking(RATE, True)
QUERIES["rank_bottom_rate"] = _ranking(RATE, False)


@query
def opt_years(spark, sf_dir):
    return D.year_options(S.stored_serving(spark, sf_dir))


@query
def opt_states(spark, sf_dir):
    return D.state_options(S.stored_serving(spark, sf_dir))


@query
def opt_valid_years(spark, sf_dir):
    return D.year_options(S.stored_serving(spark, sf_dir), [SCORE], newest_first=False)


@query
def opt_valid_years_pair(spark, sf_dir):
    return D.year_options(S.stored_serving(spark, sf_dir), ["pib_per_capita", RATE])


@query
def opt_names(spark, sf_dir):
    return D.name_options(S.stored_serving(spark, sf_dir), STATES)


@query
def impact_score(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    return rounded(D.impact_score(serving, GDP_SEGMENT, FIRST_YEAR, YEAR), SCORE)


@query
def impact_variation(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    return rounded(D.impact_variation(serving, SIZE_SEGMENT, FIRST_YEAR, YEAR), "variacao")


@query
def impact_variation_by_id(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    change = D.impact_variation(serving, SIZE_SEGMENT, FIRST_YEAR, YEAR, by_id_only=True)
    return rounded(change, "variacao")


@query
def context_by_segment(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    return rounded(D.context_by_segment(serving, YEAR, SCORE, SIZE_SEGMENT), "valor_medio")


@query
def context_by_segment_dense(spark, sf_dir):
    """An even year has no scores at all and the replicated ones no projects."""
    serving = S.stored_serving(spark, sf_dir)
    context = D.context_by_segment(serving, 2005, "pib_mil_reais", SIZE_SEGMENT)
    return rounded(D.context_dense(context, SIZE_SEGMENT, C.POPULATION_BANDS), "valor_medio")


# --- the same figures from the stored cube -------------------------------------------------
@query
def cube_kpi_overview(spark, sf_dir):
    return rounded(K.kpi_overview(S.stored_cube(spark, sf_dir), YEAR), "ideb_medio")


@query
def cube_impact_score(spark, sf_dir):
    return rounded(K.impact_score(S.stored_cube(spark, sf_dir), GDP_SEGMENT, FIRST_YEAR, YEAR), SCORE)


@query
def cube_context_by_segment(spark, sf_dir):
    context = K.context_by_segment(S.stored_cube(spark, sf_dir), YEAR, SCORE, SIZE_SEGMENT)
    return rounded(context, "valor_medio")


@query
def cube_evolution(spark, sf_dir):
    return rounded(K.evolution(S.stored_cube(spark, sf_dir)), "ideb_medio")


@query
def history_series(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    return D.history_series(serving, D.name_options(serving, STATES), SCORE, YEAR)


@query
def scatter_points(spark, sf_dir):
    return D.scatter_points(S.stored_serving(spark, sf_dir), "pib_per_capita", RATE, YEAR)


@query
def corr_by_year(spark, sf_dir):
    correlation = D.correlation_by_year(S.stored_serving(spark, sf_dir), "pib_mil_reais", SCORE)
    return rounded(correlation, "correlacao", digits=6)


@query
def corr_by_year_axes(spark, sf_dir):
    """Every axis against the score; one of them is constant where there are no projects."""
    serving = S.stored_serving(spark, sf_dir)
    return rounded(D.correlations_by_year(serving, C.SCATTER_AXES[1:], SCORE), "correlacao", digits=6)


@query
def impact_score_dense(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    impact = D.impact_score(serving, GDP_SEGMENT, FIRST_YEAR, YEAR)
    others = {"ano": (FIRST_YEAR, YEAR), "status_projeto": C.STATUS_LABELS}
    return rounded(D.dense(impact, GDP_SEGMENT, C.GDP_BANDS, others), SCORE)


@query
def impact_variation_dense(spark, sf_dir):
    serving = S.stored_serving(spark, sf_dir)
    change = D.impact_variation(serving, SIZE_SEGMENT, FIRST_YEAR, YEAR)
    others = {"status_projeto": C.STATUS_LABELS}
    return rounded(D.dense(change, SIZE_SEGMENT, C.POPULATION_BANDS, others), "variacao")


@query
def detail_table(spark, sf_dir):
    return D.detail_table(S.stored_serving(spark, sf_dir), YEAR, search=NAME_QUERY)


@query
def detail_table_indexed(spark, sf_dir):
    """The same search by way of an index of all names."""
    serving = S.stored_serving(spark, sf_dir)
    index = SearchIndex.build(serving, D.NAME, new_path(spark, "names"))
    return D.detail_table(serving, YEAR, search=NAME_QUERY, index=index)


# --- exploration -------------------------------------------------------------------------
def _exploration(spark, sf_dir) -> DataFrame:
    return X.exploration_panel(S.stored_panel(spark, sf_dir))


@query
def flag_by_year(spark, sf_dir):
    return X.flag_by_year(X.presence_flag(S.stored_panel(spark, sf_dir)))


@query
def freq_gdp_category(spark, sf_dir):
    return X.wealth_frequencies(X.wealth_bands(S.stored_panel(spark, sf_dir)))


@query
def freq_size(spark, sf_dir):
    return X.size_frequencies(X.size_bands(S.stored_panel(spark, sf_dir)))


@query
def score_by_gdp_flag(spark, sf_dir):
    return X.score_by_wealth(_exploration(spark, sf_dir))


@query
def score_by_gdp_flag_dense(spark, sf_dir):
    # one digit less than shown, as the last one may depend on the order of addition
    return rounded(X.score_by_wealth(_exploration(spark, sf_dir), empty=True), *C.PRESENCE_LABELS, digits=1)


@query
def score_by_size_gdp_flag_dense(spark, sf_dir):
    return rounded(X.score_by_size_and_wealth(_exploration(spark, sf_dir), empty=True), *C.PRESENCE_LABELS, digits=1)


@query
def score_by_gdp_flag_long(spark, sf_dir):
    return X.score_by_wealth_long(X.score_by_wealth(_exploration(spark, sf_dir)))


@query
def projects_by_size(spark, sf_dir):
    return X.projects_by_size(X.size_bands(S.stored_panel(spark, sf_dir)))


@query
def score_by_size_gdp_flag(spark, sf_dir):
    return X.score_by_size_and_wealth(_exploration(spark, sf_dir))

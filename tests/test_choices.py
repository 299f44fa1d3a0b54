"""Bucketed joins, observed profiles, the named cache, one-pass correlations and dense crosstabs."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.operators import ObservedProfile, profile
from edupanel.plans import bucketed as B
from edupanel.plans import dashboard as D
from edupanel.plans import exploration as X
from edupanel.sources import TableCache, VersionedTable, write_table
from workload import standin

SF = "/root/testdata/sf0.001"


def bag(df):
    return Counter(map(tuple, df.collect()))


# --- bucketed joins ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    treated = {name: make() for name, make in standin.treated(spark, SF).items()}
    return treated, B.bucket_tables(spark, treated, str(tmp_path_factory.mktemp("buckets")), 4)


def test_bucketed_panel_is_the_panel(spark, tables):
    treated, stored = tables
    assert bag(stored.panel(treated[C.TABLE_PROJECTS])) == bag(standin.build(spark, SF))
    assert bag(stored.panel(treated[C.TABLE_PROJECTS], checked=True)) == bag(standin.build(spark, SF))


def test_no_exchange_and_no_sort_below_the_joins_by_place(tables):
    treated, stored = tables
    stored.session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gdp, score, territory, distortion = (stored.read(name) for name in B.PLACED)
        key = ["id_municipio", "ano"]
        joined = gdp.join(score.drop("nome_municipio_formatado"), key, "left").join(
            territory.drop("nome_municipio_formatado"), "id_municipio", "left").join(
            distortion.drop("nome_municipio_formatado"), key, "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        assert re.search(r"SortMergeJoin \[id_municipio#\d+L\], \[id_municipio#\d+L\], LeftOuter\s*\n(?!.*Sort)", plan) or "Bucketed: true" in plan
        whole = stored.panel(treated[C.TABLE_PROJECTS])._jdf.queryExecution().executedPlan().toString()
        joins = whole.count("SortMergeJoin")
        # the one exchange on the panel's side is that of the join by name
        assert joins >= 4 and whole.count("Bucketed: true") == 4
    finally:
        stored.session.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_plain_session_keeps_its_settings(spark, tables):
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert tables[1].session.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"


def test_a_bucket_is_one_file(spark, tables):
    files = tables[1].read(C.TABLE_GDP).inputFiles()
    assert len(files) <= 4 and len(files) == len({re.search(r"_(\d{5})\.", f)[1] for f in files})


def test_bucketed_tables_replace_and_refuse(spark, tables, tmp_path):
    made = B.BucketedTables(spark, str(tmp_path), 2)
    rows = spark.range(10).selectExpr("id as id_municipio", "1 as v")
    made.write("t", rows)
    made.write("t", rows.where("id_municipio < 3"))
    assert made.read("t").count() == 3
    made.drop("t")
    with pytest.raises(KeyError):
        made.read("t")
    with pytest.raises(ValueError):
        made.write("t", rows.withColumn("id_municipio", F.lit("1")))
    with pytest.raises(ValueError):
        B.BucketedTables(spark, str(tmp_path), 0)


# --- observed profiles -----------------------------------------------------------------------
def test_observed_profile_is_the_profile(spark, tmp_path):
    panel = standin.stored_panel(spark, SF)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source, seen = panel.mapInArrow(counted, panel.schema), []
    write_table(source, str(tmp_path / "t"), "ano", lambda df: seen.append(ObservedProfile(df)) or seen[0].df)
    found = seen[0].frame(spark)
    assert reads.value == panel.count()  # no second scan
    assert bag(found.select(*profile(panel).columns)) == bag(profile(panel))
    low, high = panel.agg(F.min("populacao").cast("string"), F.max("populacao").cast("string")).first()
    row = found.where("column = 'populacao'").first()
    assert (row.low, row.high) == (low, high)
    places = panel.select("id_municipio").distinct().count()
    assert abs(found.where("column = 'id_municipio'").first().distinct_about - places) <= 0.15 * places


def test_observed_profile_of_odd_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, [1], None, "a b"), (2, None, None, "é")], "`x.y` int, list array<int>, none string, `q``t` string")
    watched = ObservedProfile(df)
    watched.df.write.parquet(str(tmp_path / "t"))
    assert [r[1:7] for r in watched.rows()] == [
        ("x.y", "int", 2, 2, "1", "2"), ("list", "array<int>", 1, 2, None, None), ("none", "string", 0, 2, None, None),
        ("q`t", "string", 2, 2, "a b", "é")]
    empty = ObservedProfile(df.limit(0))
    empty.df.write.parquet(str(tmp_path / "e"))
    assert {r[3:5] for r in empty.rows()} == {(0, 0)}


# --- the named cache ---------------------------------------------------------------------------
def kept_bytes(spark):
    infos = spark.sparkContext._jsc.sc().getRDDStorageInfo()
    return sum(i.memSize() + i.diskSize() for i in infos)


def test_cache_follows_the_published_version(spark, tmp_path):
    table, cache = VersionedTable(spark, str(tmp_path / "t")), TableCache(spark)
    with pytest.raises(FileNotFoundError):
        cache.get(table.root)
    before = kept_bytes(spark)
    table.write(spark.range(100_000).selectExpr("rand(1) as id", "1 as v"))
    first = cache.get(table.root)
    assert first.agg(F.sum("v")).first()[0] == 100_000 and cache.get(table.root) is first
    held = kept_bytes(spark) - before
    assert held > 0 and cache.version(table.root) == 1
    table.write(spark.range(100).selectExpr("rand(2) as id", "2 as v"))
    second = cache.get(table.root + "/")
    assert second.agg(F.sum("v")).first()[0] == 200 and cache.version(table.root) == 2
    assert kept_bytes(spark) - before < held / 10  # the old frame's memory is free
    assert not first.is_cached and first.count() == 100_000  # it still reads its own version
    doubled = cache.get(table.root, "doubled", lambda df: df.withColumn("v", F.col("v") * 2))
    assert doubled.agg(F.sum("v")).first()[0] == 400
    assert cache.release(name="doubled") == 1 and cache.release() == 1 and cache.release() == 0
    assert kept_bytes(spark) == before


# --- correlations and crosstabs ------------------------------------------------------------------
def test_correlations_of_all_axes_in_one_scan(spark):
    serving = standin.stored_serving(spark, SF)
    axes = C.SCATTER_AXES[1:]
    found = D.correlations_by_year(serving, axes, D.SCORE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Location: ") == 1 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1

    def shown(df):
        return {(r.eixo, r.ano, r.status_projeto): (r.pontos, r.correlacao and round(r.correlacao, 9)) for r in df.collect()}

    wanted = {}
    for axis in axes:
        wanted |= shown(D.correlation_by_year(serving, axis, D.SCORE).withColumn("eixo", F.lit(axis)))
    assert shown(found) == wanted


def test_correlations_over_odd_values(spark):
    rows = [(1, "a", 1.0, 1.0, None), (1, "a", 2.0, float("inf"), 3.0), (1, "a", 3.0, 2.0, 3.0), (2, "a", None, 1.0, 1.0), (None, "a", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "ano int, status_projeto string, y double, x1 double, x2 double")
    found = {(r.ano, r.eixo): (r.correlacao, r.pontos) for r in D.correlations_by_year(df, ["x1", "x2"], "y").collect()}
    assert found == {(1, "x1"): (None, 3), (1, "x2"): (None, 2)}


def test_dense_crosstabs(spark):
    rows = [("Pequeno", "Baixo", "Sim", 4.0), ("Pequeno", "Baixo", "Não", 3.0), ("Grande", None, "Sim", 5.0)]
    df = spark.createDataFrame(rows, f"{X.SIZE} string, {X.WEALTH} string, {X.FLAG} string, {X.SCORE} double")
    assert X.score_by_wealth(df).count() == 1
    assert bag(X.score_by_wealth(df, empty=True)) == Counter(
        [("Baixo", 3.0, 4.0)] + [(b, None, None) for b in C.WEALTH_BANDS[1:]])
    dense = X.score_by_size_and_wealth(df, empty=True)
    assert dense.count() == 16 and dense.where("`Sim` is not null").count() == 1

import numpy as np
import pytest
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.operators import (
    DuplicateEdgesError,
    approximate_quantiles,
    at_last_year,
    check_unique,
    dedup_keep_first,
    densify,
    exact_quantiles,
    fixed_bands,
    profile,
    quantile_bands,
    quantiles,
    replicate_forward,
    unpivot_years,
    wide_by_value,
    wide_to_long,
)
from edupanel.plans import exploration as X


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def column(spark, numbers):
    return spark.createDataFrame([(x,) for x in numbers], "x double")


# --- quantiles ---------------------------------------------------------------------------
def test_quartile_example(spark):
    data = column(spark, [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, None])
    assert exact_quantiles(data, ["x"])["x"] == [1.0, 2.25, 4.5, 6.75, 9.0]
    banded = quantile_bands(data, [("x", "band", "ABCD")])
    found = rows(banded.select("x", "band", "band_ord"))
    bands = [r[1] for r in sorted(found, key=lambda r: (r[0] is None, r[0]))]
    assert bands == ["A", "A", "A", "B", "B", "C", "C", "D", "D", "D", None]
    assert {(r[1], r[2]) for r in found} == {("A", 1), ("B", 2), ("C", 3), ("D", 4), (None, None)}


SAMPLES = {
    "smooth": lambda rng: rng.lognormal(10, 3, 5000),
    "both signs": lambda rng: rng.normal(0, 1e-3, 4001),
    "ties": lambda rng: rng.integers(0, 40, 5000).astype(float),
    "one hot value": lambda rng: np.concatenate([np.full(2000, 5.25), rng.random(3000) * 10]),
    "hot quartile": lambda rng: np.concatenate([np.full(4000, 1 / 3), rng.random(1001)]),
    "nearly equal": lambda rng: 1e15 + rng.integers(0, 3000, 4000) / 8,
    "huge and tiny": lambda rng: np.concatenate([10.0 ** rng.uniform(-300, 300, 3000), [0.0, 5e-324]]),
    "two values": lambda rng: np.array([3.0, 8.0]),
    "one value": lambda rng: np.array([3.0]),
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("few_rows", [False, True])
def test_exact_quantiles_equal_sorted_definition(spark, monkeypatch, name, few_rows):
    if few_rows:  # force every round of splitting
        monkeypatch.setattr(quantiles, "DIRECT_ROWS", 3)
        monkeypatch.setattr(quantiles, "SPLITS", 16)
    sample = SAMPLES[name](np.random.default_rng(11))
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    data = column(spark, [float(x) for x in sample] + [None, float("nan")])
    expected = np.quantile(sample, probabilities).tolist()
    assert exact_quantiles(data, ["x"], probabilities)["x"] == expected


def test_columns_share_the_passes_and_may_be_empty(spark):
    data = spark.createDataFrame([(1, 5.0, None), (2, 6.0, None)], "a int, b double, c double")
    found = exact_quantiles(data, ["a", "b", "c"], [0.0, 0.5, 1.0])
    assert found == {"a": [1.0, 1.5, 2.0], "b": [5.0, 5.5, 6.0], "c": None}


def test_edges_per_partition(spark):
    rows_in = [(y, y * 1000.0 + n) for y in (1, 2) for n in range(8)] + [(None, 5.0)]
    data = spark.createDataFrame(rows_in, "ano int, x double")
    banded = quantile_bands(data, [("x", "band", "ABCD")], partition_by="ano")
    found = {(r.ano, r.x % 1000): r.band for r in banded.collect()}
    assert [found[y, n] for y in (1, 2) for n in range(8)] == list("AABBCCDD" * 2)
    assert found[None, 5.0] is None
    pooled = quantile_bands(data.na.drop(), [("x", "band", "ABCD")])
    assert {(r.ano, r.band) for r in pooled.collect()} == {(1, "A"), (1, "B"), (2, "C"), (2, "D")}


def test_edges_of_many_partitions_of_any_type(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SPLITS", 16)  # several rounds
    data = spark.range(21_000).selectExpr(
        "date_add(date'2020-01-01', CAST(id % 1000 AS INT)) AS d", "pow(id DIV 1000, 3) + id % 1000 AS x",
        "CAST(id AS INT) AS id")
    banded = quantile_bands(data, [("x", "band", "ABCD"), ("id", "half", "LH")], partition_by="d")
    assert banded.columns == ["d", "x", "id", "band", "band_ord", "half", "half_ord"]
    expected = [(k, "AAAAAABBBBBCCCCCDDDDD"[k], "LLLLLLLLLLLHHHHHHHHHH"[k], 1000) for k in range(21)]
    found = banded.selectExpr("id DIV 1000 AS k", "band", "half").groupBy("k", "band", "half").count()
    assert sorted(map(tuple, found.collect())) == expected


def test_edges_of_a_partition_that_coincide(spark):
    data = spark.createDataFrame([(1, float(n)) for n in range(8)] + [(2, 1.0)] * 5, "g int, x double")
    with pytest.raises(DuplicateEdgesError, match="1 values of g"):
        quantile_bands(data, [("x", "band", "ABCD")], partition_by="g")
    assert quantile_bands(data, [("x", "band", "ABCD")], "skip", partition_by="g").columns == ["g", "x"]
    near = quantile_bands(data.where("g = 1"), [("x", "band", "AB")], method="approx", partition_by="g")
    assert near.where("x < 3").distinct().count() == near.where("x < 3 and band = 'A'").count()


def test_infinity_falls_in_the_top_band(spark):
    data = column(spark, [1.0, 2.0, 3.0, 4.0, 5.0, float("inf")])
    banded = quantile_bands(data, [("x", "band", "ABCD")])
    assert banded.where("x = double('inf')").first().band == "D"
    assert exact_quantiles(data, ["x"], [1.0])["x"] == [float("inf")]


def test_duplicate_edges(spark):
    data = column(spark, [1.0] * 9 + [2.0])
    with pytest.raises(DuplicateEdgesError):
        quantile_bands(data, [("x", "band", "ABCD")])
    skipped = quantile_bands(data, [("x", "band", "ABCD")], on_duplicate_edges="skip")
    assert skipped.columns == ["x"]
    with pytest.raises(DuplicateEdgesError):
        quantile_bands(column(spark, [None]), [("x", "band", "ABCD")])


def test_approximate_quantiles_are_values_near_the_rank(spark):
    data = column(spark, [float(x) for x in range(1001)])
    assert approximate_quantiles(data, ["x"], [0.5])["x"] == [500.0]


def test_rounds_read_only_open_ranges(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "x")
    spark.range(20000).select((F.col("id") * 1.5).alias("x"), F.lit("wide").alias("y")).write.parquet(path)
    plans = []
    original = quantiles._stacked

    def spy(df, *args):
        stacked = original(df, *args)
        plans.append(stacked._jdf.queryExecution().executedPlan().toString())
        return stacked

    monkeypatch.setattr(quantiles, "_stacked", spy)
    exact_quantiles(spark.read.parquet(path), ["x"])
    assert len(plans) == 2
    assert all("ReadSchema: struct<x:double>" in p for p in plans)
    assert "GreaterThanOrEqual(x," in plans[1]


# --- keys --------------------------------------------------------------------------------
def test_dedup_keeps_the_first_row_and_one_null_key(spark):
    data = spark.createDataFrame(
        [(5, 1, "late"), (2, 1, "first"), (9, None, "b"), (1, None, "a"), (3, 2, "only")],
        "_row long, id long, name string",
    )
    kept = dedup_keep_first(data, ["id"], ["_row"])
    assert rows(kept.select("id", "name")) == rows(
        spark.createDataFrame([(1, "first"), (None, "a"), (2, "only")], "id long, name string")
    )


def test_check_unique(spark):
    data = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    assert tuple(check_unique(data, ["k"]).first()) == (2, 1, 3)


def test_profile(spark):
    data = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, `b c` string")
    assert rows(profile(data)) == [(0, "a", "int", 2, 3), (1, "b c", "string", 1, 3)]


# --- replicate ---------------------------------------------------------------------------
def test_replicate_forward(spark):
    data = spark.createDataFrame([(1, 2020, "a"), (1, 2021, "b"), (2, 2021, "c")], "id int, ano int, v string")
    literal = replicate_forward(data, target_years=[2022, 2023])
    assert literal.columns == data.columns
    assert rows(literal) == sorted(
        [(1, 2020, "a")] + [(i, y, v) for i, v in ((1, "b"), (2, "c")) for y in (2021, 2022, 2023)],
        key=repr,
    )
    assert rows(replicate_forward(data, until=2023)) == rows(literal)
    assert rows(replicate_forward(data, until=2021)) == rows(data)
    # the literal list repeats a year the data already has
    again = replicate_forward(data, target_years=[2021])
    assert again.count() == 5
    with pytest.raises(ValueError):
        replicate_forward(data)


def test_at_last_year(spark):
    data = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2021)], "id int, ano int")
    assert rows(at_last_year(data)) == [(2, 2021), (3, 2021)]


# --- reshape -----------------------------------------------------------------------------
def test_melt_keeps_nulls_and_pivot_restores_it(spark):
    wide = spark.createDataFrame(
        [(1, 4.5, None), (2, None, None), (3, 1.0, 2.0)], "id int, ideb_2005 double, ideb_2007 double"
    )
    long = unpivot_years(wide, ["id"], "ideb_", [2005, 2007], "nota")
    assert rows(long.select("id", "ano", "nota")) == [
        (1, 2005, 4.5), (1, 2007, None), (2, 2005, None), (2, 2007, None),
        (3, 2005, 1.0), (3, 2007, 2.0),
    ]
    names = {2005: "ideb_2005", 2007: "ideb_2007"}
    back = wide_by_value(long, ["id"], "ano", names, F.avg, F.col("nota"))
    assert rows(back) == rows(wide)


def test_wide_to_long(spark):
    wide = spark.createDataFrame([("a", 1.0, None)], "k string, `Não` double, Sim double")
    assert rows(wide_to_long(wide, ["k"], ["Não", "Sim"], "f", "v")) == [
        ("a", "Não", 1.0), ("a", "Sim", None)
    ]


def test_densify(spark):
    data = spark.createDataFrame([("x", 1, 5.0)], "a string, b int, v double")
    assert rows(densify(data, {"a": ["x", "y"], "b": [1, 2]})) == [
        ("x", 1, 5.0), ("x", 2, None), ("y", 1, None), ("y", 2, None)
    ]


def test_fixed_bands(values):
    def band(c):
        return fixed_bands(c, C.SIZE_LIMITS, C.SIZE_LABELS, C.SIZE_UNDEFINED)

    numbers = [0.0, 20000.0, 20000.5, 100000.0, 100000.5, float("inf"), None]
    assert values(band, numbers, "double") == [
        "Pequeno", "Pequeno", "Médio", "Médio", "Grande", "Grande", "Não definido"
    ]


def test_counts_by_flag_leave_absent_combinations_null(spark):
    data = spark.createDataFrame(
        [(2020, "Sim"), (2020, "Sim"), (2020, "Não"), (2021, "Não"), (None, "Sim")],
        "ano int, tem_projeto_ia string",
    )
    assert rows(X.flag_by_year(data)) == [(2020, 1, 2), (2021, 1, None)]

"""Quantiles from two passes: the same edges as the rounds of selection."""

import math
import random

import pytest
from pyspark.sql import functions as F

from edupanel.operators import ChangedInputError, bracketed_quantiles, exact_quantiles, quantile_bands
from edupanel.operators import quantiles as Q


def by_definition(values, probabilities):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    if not values:
        return None
    found = []
    for p in probabilities:
        at = (len(values) - 1) * p
        low, high = values[math.floor(at)], values[math.ceil(at)]
        found.append(low if low == high or at == math.floor(at) else low + (high - low) * (at - math.floor(at)))
    return found


def data(name, n=20_000):
    rng = random.Random(name)
    return {
        "even": lambda: [rng.random() for _ in range(n)],
        "third": lambda: [0.5 if rng.random() < 1 / 3 else rng.random() for _ in range(n)],
        "at an edge": lambda: [1.0] * (n // 4) + [2.0] * (n // 4) + [rng.uniform(2, 3) for _ in range(n // 2)],
        "few": lambda: [float(rng.randrange(4)) for _ in range(n)],
        "spread": lambda: [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(n)],
        "gaps": lambda: [None if i % 3 == 0 else math.nan if i % 3 == 1 else rng.gauss(0, 1) for i in range(n)],
        "infinite": lambda: [math.inf if i % 2 else -math.inf if i % 5 == 0 else float(i) for i in range(n)],
        "one": lambda: [7.0] * 100,
        "two": lambda: [1.0, 2.0],
        "single": lambda: [3.0],
        "none": lambda: [None, math.nan],
    }[name]()


@pytest.mark.parametrize("name", ["even", "third", "at an edge", "few", "spread", "gaps", "infinite", "one", "two", "single", "none"])
@pytest.mark.parametrize("size", [64, Q.SKETCH_SIZE])
def test_edges_by_definition(spark, name, size):
    values = data(name)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    for probabilities in (Q.QUARTILES, (0.1, 0.999)):
        found = bracketed_quantiles(df, ["v"], probabilities, size)
        assert found == exact_quantiles(df, ["v"], probabilities)
        wanted = by_definition(values, probabilities)
        if not any(map(math.isinf, wanted or [])):
            assert found["v"] == (wanted if wanted is None else pytest.approx(wanted, rel=1e-12))


def counted(spark, df):
    """``df`` as a table that cannot be pruned, and the number of rows read of it."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(rows, df.schema), seen


@pytest.mark.parametrize("few_rows", [8, 8192])
def test_three_columns_in_two_scans(spark, monkeypatch, few_rows):
    monkeypatch.setattr(Q, "DIRECT_ROWS", few_rows)
    n = 200_000
    df = spark.range(n).select(
        F.rand(1).alias("a"), F.when(F.rand(2) < 1 / 3, 0.25).otherwise(F.rand(3)).alias("b"), (F.rand(4) * 1e9).alias("c"))
    from edupanel.session import stage
    table = stage(df, "columns")
    read, seen = counted(spark, table)
    found = bracketed_quantiles(read, ["a", "b", "c"])
    assert seen.value == 2 * n
    assert found == exact_quantiles(table, ["a", "b", "c"])


def test_little_is_staged_where_one_value_fills_a_third(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(Q, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    kept = []
    monkeypatch.setattr(Q, "drop_staged", lambda df: kept.append(df.count()))
    from edupanel.session import stage
    n = 300_000
    values = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(5)).alias("v"))
    table = stage(values, "third")
    assert bracketed_quantiles(table, ["v"]) == exact_quantiles(table, ["v"])
    assert kept and kept[0] < n / 50


def test_missed_brackets_are_noticed(spark, monkeypatch):
    monkeypatch.setattr(Q, "SKETCH_MARGIN", 0.0)  # as if every sketch missed its rank
    df = spark.range(50_000).select(F.hash("id").cast("double").alias("v"))
    assert bracketed_quantiles(df, ["v"], size=16) == exact_quantiles(df, ["v"])


def test_rows_that_change_between_passes(spark):
    calls = spark.sparkContext.accumulator(0)

    def fewer(batches):
        for batch in batches:
            yield batch.slice(0, batch.num_rows - int.from_bytes(__import__("os").urandom(2), "big") % 40)

    df = spark.range(4000, numPartitions=1).select(F.hash("id").cast("double").alias("v")).mapInArrow(fewer, "v double")
    with pytest.raises(ChangedInputError):
        for _ in range(20):
            bracketed_quantiles(df, ["v"])
    with pytest.raises(ChangedInputError):
        for _ in range(20):
            Q.exact_quantiles(df.repartition(3), ["v"])
    assert calls.value == 0


def test_bands_by_sketch(spark):
    df = spark.range(5000).select((F.hash("id") % 1000).cast("double").alias("v"))
    bands = [("v", "band", ["a", "b", "c", "d"])]
    exact, sketch = (quantile_bands(df, bands, method=m).groupBy("band", "band_ord").count() for m in ("exact", "sketch"))
    assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, sketch.collect()))
    with pytest.raises(ValueError):
        quantile_bands(df.withColumn("v", F.lit(1.0)), bands, method="sketch")

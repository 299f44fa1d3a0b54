"""Mixing sources to target weights along a curriculum that changes over training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from edupanel.session import stage

from .common import WORD, numbered, text_of

WEIGHTS = (5.0, 2.0, 1.0)
#: Knots (time, factor) of each weight's course, linear in between; they repeat like the weights.
CURRICULUM = (
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.5), (1.0, 0.5)),
)
MAX_REPEATS = 3
SALTS = 64


def word_count(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def integral(knots: Sequence[tuple[float, float]]) -> float:
    """Area under a course of straight lines."""
    return sum((t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:]))


def inverse(knots: Sequence[tuple[float, float]], share: Column) -> Column:
    """The time by which ``share`` of a course's area has passed."""
    area, passed, result = integral(knots), 0.0, F.lit(None).cast("double")
    pieces = []
    for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
        rest = share * area - passed
        slope = (f1 - f0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(f0 * f0) + F.lit(2 * slope) * rest))
        # area from t0 to t is f0 d + slope d d / 2; this form has no cancellation
        time = F.lit(t0) + F.lit(2.0) * rest / (F.lit(f0) + root)
        time = F.when(rest <= 0, F.lit(t0)).otherwise(F.least(F.lit(t1), time))
        passed += (t1 - t0) * (f0 + f1) / 2
        pieces.append((passed, time))
    for upto, time in reversed(pieces):
        result = F.when(share * area <= upto, time).otherwise(F.coalesce(result, F.lit(knots[-1][0])))
    return result


def targets(sizes: DataFrame, weights, curriculum, max_repeats: int, share: float) -> DataFrame:
    """(source, source_size, target, course) from one row per source with its size.

    Sources stand in code point order, null last. A target is the level times the integrated
    weight, or ``max_repeats`` sizes where that is less. With sources in the order of size by
    weight, the level that uses all words is the largest of those that result when the first
    0, 1, 2, ... sources are filled up. Windows here span one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(w * integral(curriculum[i % len(curriculum)])) for i, w in enumerate(weights)]),
        (F.col("rank") % len(weights) + 1).cast("int"))
    full = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "rank")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("rank", rank).withColumn("weight", weight).withColumn(
        "cap", (F.col("source_size") * max_repeats).cast("double"))
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything).cast("double") * share
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max("level").over(everything)
    return ranked.withColumn("level", left / open_weight).withColumn("level", level).select(
        "source", "source_size",
        F.least("cap", F.col("level") * F.col("weight")).alias("target"),
        (F.col("rank") % len(curriculum)).alias("course"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, curriculum=CURRICULUM, max_repeats: int = MAX_REPEATS,
    share: float = 1.0, row_col: str | None = None,
) -> DataFrame:
    """Words each document gives to the mix, and when in training, in training order.

    Within a source documents stand in the order of the MD5 of their id. A source's target is
    taken from the start of that order, again and again. The words before a document are a sum
    over three levels of buckets (leading MD5 digits), so no task gets a whole source; rows of one id are counted by size and salt,
    so neither does one get all rows of an id. The share
    of the source's target that lies before a document, put into the inverse of the source's
    integrated weight course, is its training position (0 to 1); the result is range-sorted by it.

    Returns doc_id, size, source_size, target, taken, position (of the first word, null where
    nothing is taken), passes (times a document is begun) and row. ``share`` is the length of the
    mix in parts of all words. Null text has size 0, null sources form one source, which comes
    last. Documents without words take nothing. Repeated rows count each. An empty table gives an
    empty result. Other columns are not read.
    """
    placed = _placed(docs, id_col, text_col, source_col, weights, curriculum, max_repeats, share, row_col)
    position = F.when(F.col("taken") > 0, _position(curriculum, F.col("start")))
    return placed.withColumn("position", position).orderBy(
        F.col("position").asc_nulls_last(), "key", "row").select(
        "doc_id", "size", "source_size", "target", "taken", "position", "passes", "row")


def repeat(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, curriculum=CURRICULUM, max_repeats: int = MAX_REPEATS,
    share: float = 1.0,
) -> DataFrame:
    """The mix itself: whole rows of ``docs``, as often as ``mix`` begins them, in training order.

    A numbered copy of the rows is staged. A document that the end of its source's target cuts stays whole. Rows
    without words are not part of a mix.
    """
    rows = numbered(docs)
    narrow = rows.select("row", *[F.col("doc")[c].alias(c) for c in dict.fromkeys((id_col, text_col, source_col))])
    placed = _placed(narrow, id_col, text_col, source_col, weights, curriculum, max_repeats, share, "row")
    begun = placed.where("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes").cast("int") - 1)))
    begun = begun.withColumn("position", _position(curriculum, F.col("start") + F.col("pass") * F.col("source_size")))
    return rows.join(begun.select("row", "position", "key"), "row").orderBy("position", "key", "row").select("doc.*")


def _position(curriculum, start: Column) -> Column:
    """When the word after ``start`` words of a source is due."""
    position = F.lit(None).cast("double")
    for i, knots in enumerate(curriculum):
        position = F.when(F.col("course") == i, inverse(knots, start / F.col("target"))).otherwise(position)
    return position


def _placed(docs, id_col, text_col, source_col, weights, curriculum, max_repeats, share, row_col) -> DataFrame:
    """Every row with the words of its source before it, its source's target, and what is taken of it."""
    number = F.col(row_col) if row_col else F.monotonically_increasing_id()
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(text_col).alias("size"), number.cast("long").alias("row"), key.alias("key"),
    ).withColumn("high", F.substring("key", 1, 2)).withColumn("low", F.substring("key", 3, 2)), "sizes")

    def before(group: list[str], order: list[str]) -> Column:
        window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("size").over(window), F.lit(0))

    low = rows.groupBy("source", "high", "low").agg(F.sum("size").alias("size"))
    high = low.groupBy("source", "high").agg(F.sum("size").alias("size"))
    sizes = high.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, curriculum, max_repeats, share)
    high = high.withColumn("above", before(["source"], ["high"])).drop("size")
    low = low.withColumn("beside", before(["source", "high"], ["low"])).drop("size")

    def meet(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
        right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
        on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        return left.join(right, on).drop(*[f"_{k}" for k in keys])

    starts = meet(meet(low, high, "source", "high"), goal, "source")
    # rows that share id and size are counted by salt; of those in one place only the row number is sought
    same = ["source", "high", "low", "key", "doc_id", "size"]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    alike = salted.groupBy(*same, "salt").agg((F.count("*") * F.col("size")).alias("words"))
    earlier = Window.partitionBy("source", "high", "low").orderBy("key", "doc_id", "size", "salt").rowsBetween(
        Window.unboundedPreceding, -1)
    alike = alike.withColumn("ahead", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    nth = F.row_number().over(Window.partitionBy(*same, "salt").orderBy("row")) - 1
    numbered_rows = salted.withColumn("nth", nth)
    inside = meet(numbered_rows, alike, *same, "salt").withColumn("inside", F.col("ahead") + F.col("nth") * F.col("size"))
    placed = meet(inside, starts, "source", "high", "low").withColumn(
        "start", F.col("above") + F.col("beside") + F.col("inside"))
    quota = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(F.lit(0))
    placed = placed.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.greatest(F.lit(0), F.least("size", quota - F.col("whole") * F.col("source_size") - F.col("start"))))
    taken = F.col("whole") * F.col("size") + F.col("rest")
    return placed.select(
        "doc_id", "size", "source_size", "target", "course", "start", taken.cast("long").alias("taken"),
        F.when(taken > 0, F.col("whole") + (F.col("rest") > 0).cast("long")).otherwise(0).alias("passes"),
        "row", "key")

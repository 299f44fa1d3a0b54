"""Table profiles: in one pass over a table, or gathered while a job writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(df: DataFrame) -> DataFrame:
    """Column name, type, non-null count and row count, one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column"),
            F.lit(dtype).alias("dtype"),
            F.col(f"`{name}`").alias("non_null"),
            F.col("_rows").alias("rows"),
        )
        for position, (name, dtype) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


PROFILE = T.StructType([
    T.StructField("position", T.IntegerType(), False), T.StructField("column", T.StringType(), False),
    T.StructField("dtype", T.StringType(), False), T.StructField("non_null", T.LongType(), False),
    T.StructField("rows", T.LongType(), False), T.StructField("low", T.StringType()), T.StructField("high", T.StringType()),
    T.StructField("distinct_about", T.LongType()),
])
_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


class ObservedProfile:
    """The profile of the rows that pass through ``df`` in the next action, without a scan of its own.

    Besides what ``profile`` tells, every column has its extremes as text (null for types without an order) and
    about how many distinct values there are, from a sketch that tasks merge. Write ``df`` as it is, with no shuffle
    behind it: Spark takes the results of the tasks that write once each, also where executors are lost.
    """

    def __init__(self, df: DataFrame):
        self._types = df.dtypes
        self._ordered = [isinstance(f.dataType, _ORDERED) for f in df.schema.fields]
        self._watch = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        for n, field in enumerate(df.schema.fields):
            value = F.col("`" + field.name.replace("`", "``") + "`")
            metrics.append(F.count(value).alias(f"n{n}"))
            if self._ordered[n]:
                metrics += [
                    F.min(value).cast("string").alias(f"low{n}"), F.max(value).cast("string").alias(f"high{n}"),
                    F.approx_count_distinct(value).alias(f"d{n}")]
        self.df = df.observe(self._watch, *metrics)

    def rows(self) -> list[tuple]:
        """A row per column, once the action has run."""
        seen = self._watch.get
        return [
            (n, name, dtype, seen[f"n{n}"], seen["rows"], seen.get(f"low{n}"), seen.get(f"high{n}"), seen.get(f"d{n}"))
            for n, (name, dtype) in enumerate(self._types)
        ]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), PROFILE)

"""Treated tables bucketed by place, so that the panel's joins on the place need no shuffle.

A choice beside the plain order of joins: it saves the shuffles of the GDP rows where the panel is built often and no place holds
a large share of the rows. A bucket is one task, which adaptive execution can't split, so with hot places the plain tables
are better.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from edupanel import config as C
from edupanel.plans.panel import join_panel

KEY = "id_municipio"
#: Tables with the place in their join keys; projects are joined by name.
PLACED = (C.TABLE_GDP, C.TABLE_SCORE, C.TABLE_TERRITORY, C.TABLE_DISTORTION)


def bucketed_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which a join on place and year may use buckets by place.

    Each bucket is one file, so its rows need not be sorted again. The settings of ``spark`` stay as they are.
    """
    session = spark.newSession()
    for name, value in {
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        "spark.sql.sources.bucketing.enabled": "true",
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
    }.items():
        session.conf.set(name, value)
    return session


class BucketedTables:
    """Treated tables stored in buckets below ``root``, all in the same number of them."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        if buckets < 1:
            raise ValueError("at least one bucket")
        self.session, self.root, self.buckets = bucketed_session(spark), root.rstrip("/"), buckets
        self._names: dict[str, str] = {}
        self._run = uuid.uuid4().hex[:12]

    def write(self, name: str, df: DataFrame) -> None:
        """Store a table, one sorted file per bucket; a table of that name is replaced.

        Rows are dealt out by the hash that buckets go by, so every task writes one bucket.
        """
        if dict(df.dtypes)[KEY] != "bigint":
            raise ValueError(f"{name}: {KEY} has to be a whole number in all tables, so that equal ids share a bucket")
        self.drop(name)
        known = f"edupanel_{name.lower()}_{self._run}"
        dealt = df.repartition(self.buckets, KEY)
        writer = dealt.write.format("parquet").mode("error").bucketBy(self.buckets, KEY).sortBy(KEY)
        writer.option("path", f"{self.root}/{name}-{uuid.uuid4().hex[:12]}").saveAsTable(known)
        self._names[name] = known

    def read(self, name: str) -> DataFrame:
        return self.session.table(self._names[name])

    def drop(self, name: str) -> None:
        """Forget a table; its files stay until their folder is cleared."""
        if name in self._names:
            self.session.sql(f"DROP TABLE IF EXISTS {self._names.pop(name)}")

    def panel(self, projects: DataFrame, checked: bool = False) -> DataFrame:
        """The panel that ``join_panel`` gives. Up to the projects, rows stay where they were written."""
        gdp, score, territory, distortion = (self.read(name) for name in PLACED)
        return join_panel(gdp, score, territory, projects, distortion, checked=checked)


def bucket_tables(spark: SparkSession, treated: Mapping[str, DataFrame], root: str, buckets: int) -> BucketedTables:
    """Store the tables that are joined by place."""
    tables = BucketedTables(spark, root, buckets)
    for name in PLACED:
        tables.write(name, treated[name])
    return tables

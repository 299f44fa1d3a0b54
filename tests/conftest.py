import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from edupanel.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.sql.shuffle.partitions": "8",
        # whole plan texts for the plan tests
        "spark.sql.debug.maxToStringFields": "1000",
        "spark.sql.maxMetadataStringLength": "10000",
    }
    session = get_spark("tests", "local[*]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate one column expression over a list of inputs, in order."""

    def evaluate(function, inputs, dtype="string"):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, v {dtype}")
        result = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
        return [row.r for row in result]

    return evaluate

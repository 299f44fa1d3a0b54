"""Municipality outlines from GeoJSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edupanel.sources.tables import MissingSourceError

FEATURE = "struct<properties: struct<id: string>, geometry: string>"


def read_geojson(
    spark: SparkSession, path: str, layout: str = "document", required: bool = True
) -> DataFrame | None:
    """(id, geometry) per feature, the geometry as JSON text.

    ``document``: each file is one collection and one task, so convert a very large one to
    Parquet once. ``lines``: one feature per line, with or without the lines of a collection
    around them; such files are split at line breaks and load in parallel, and a line that
    does not fit the layout fails the job. With ``required=False`` a missing path gives
    None: the map is then simply not offered.
    """
    if layout not in ("document", "lines"):
        raise ValueError("layout must be 'document' or 'lines'")
    try:
        if layout == "document":
            schema = f"features array<{FEATURE}>"
            files = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")
            features = files.select(F.explode("features").alias("f"))
        else:
            features = _one_per_line(spark.read.text(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if required:
            raise MissingSourceError("geojson", path) from None
        return None
    return features.select("f.properties.id", "f.geometry")


def _one_per_line(lines: DataFrame) -> DataFrame:
    line = F.col("value")
    feature = line.contains('"Feature"')
    misplaced = F.when(feature, line.contains('"FeatureCollection"'))
    misplaced = misplaced.otherwise(line.contains('"geometry"'))
    checked = F.when(misplaced, F.raise_error("not one feature per line").cast("string"))
    text = checked.otherwise(F.regexp_replace(line, r"[,\s]+$", ""))
    return lines.where(feature | misplaced).select(
        F.from_json(text, FEATURE, {"mode": "FAILFAST"}).alias("f")
    )

"""Boundary features: a GeoJSON feature collection as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Geometry is left out: only the code joins, shapes are drawn elsewhere.
COLLECTION = (
    "type string, metadata struct<datasetName:string,version:string,license:string,attribution:string,"
    "disputedTerritoryTreatment:string>, features array<struct<type:string,properties:struct<iso:string,name:string>>>"
)


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """(iso, name) per feature of the GeoJSON files at a path."""
    return _explode(spark.read.schema(COLLECTION).json(path, multiLine=True))


def parse_boundaries(documents: DataFrame, content_col: str = "content") -> DataFrame:
    """The same for documents already in a column."""
    return _explode(documents.select(F.from_json(content_col, COLLECTION).alias("d")).select("d.*"))


def _explode(collections: DataFrame) -> DataFrame:
    return collections.select(F.explode("features").alias("f")).select("f.properties.iso", "f.properties.name")

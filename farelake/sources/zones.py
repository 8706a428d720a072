"""Zone names from a GeoJSON feature collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Only the properties are parsed; geometry is skipped by the reader.
_FEATURES = (
    "features array<struct<properties:struct<LocationID:bigint,zone:string,borough:string>>>"
)


def zone_source(spark: SparkSession, path: str) -> DataFrame:
    """(location_id, zone, borough); features without an id are skipped, missing names defaulted."""
    collection = spark.read.schema(_FEATURES).option("multiLine", True).json(path)
    p = collection.select(F.explode("features.properties").alias("p")).select("p.*")
    return p.filter(F.col("LocationID").isNotNull()).select(
        F.col("LocationID").alias("location_id"),
        F.coalesce("zone", F.concat(F.lit("Zone "), F.col("LocationID").cast("string"))).alias("zone"),
        F.coalesce("borough", F.lit("Unknown")).alias("borough"),
    )

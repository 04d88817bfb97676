"""Airport reference file -> ground stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.functions.geo import feet_to_metres
from trackmart.schemas import AIRPORTS

# The airport types that count as ground stations.
STATION_TYPES = ["large_airport", "medium_airport"]


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """A landed world airport CSV (header, quoted fields that may hold line breaks).

    Columns are taken by name, so the file may carry more of them in any order. Fields with
    line breaks mean that one task reads a file; it is as long as the world has airports.
    """
    text = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, inferSchema=False)
    return text.select(*[F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) for f in AIRPORTS])


def airports_in_region(airports: DataFrame, bbox: dict[str, float]) -> DataFrame:
    """Airports of a station type inside the box, both ends inclusive."""
    return airports.where(
        F.col("type").isin(STATION_TYPES)
        & F.col("latitude_deg").between(bbox["lamin"], bbox["lamax"])
        & F.col("longitude_deg").between(bbox["lomin"], bbox["lomax"])
    )


def stations_from_airports(airports: DataFrame, bbox: dict[str, float]) -> DataFrame:
    """Stations of a region with height in metres; airports without height are dropped."""
    return (
        airports_in_region(airports, bbox)
        .where(F.col("elevation_ft").isNotNull())
        .select(
            F.col("ident").alias("station_id"),
            "name",
            F.col("type").alias("station_type"),
            F.col("latitude_deg").alias("lat"),
            F.col("longitude_deg").alias("lon"),
            feet_to_metres(F.col("elevation_ft")).alias("h"),
        )
    )

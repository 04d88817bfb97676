"""Cleaning and telemetry enrichment of track points, and the wide table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.functions import geo
from trackmart.runtime import load_time


def states_in_bbox(states: DataFrame, bbox: dict[str, float]) -> DataFrame:
    """Points inside a region, both ends inclusive; points without position are out."""
    return states.where(
        F.col("latitude").between(bbox["lamin"], bbox["lamax"])
        & F.col("longitude").between(bbox["lomin"], bbox["lomax"])
    )


def clean_points(states: DataFrame) -> DataFrame:
    """Usable points: position and speed known, height (after fallback) not below zero.

    The null filters come first so that they reach the Parquet scan.
    """
    located = states.where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("velocity").isNotNull()
    )
    return located.withColumns(
        {
            "height": geo.altitude(F.col("geo_altitude"), F.col("baro_altitude")),
            "vertical_rate": F.coalesce(F.col("vertical_rate"), F.lit(0.0)),
        }
    ).where(F.col("height") >= 0)


def enrich_points(points: DataFrame) -> DataFrame:
    """Add ECEF position, distance to the earth's centre, Mach, phase and minute."""
    position = geo.ecef(F.col("latitude"), F.col("longitude"), F.col("height"))
    return points.withColumns(
        {
            "x_ecef": position.x,
            "y_ecef": position.y,
            "z_ecef": position.z,
            "mach": geo.mach(F.col("velocity"), F.col("height")),
            "flight_phase": geo.flight_phase(F.col("on_ground"), F.col("vertical_rate")),
            "time_window": geo.minute_bucket(F.col("snapshot_ts")),
            "event_time": F.timestamp_seconds("snapshot_ts"),
        }
    ).withColumn("r_to_earth", geo.norm(F.col("x_ecef"), F.col("y_ecef"), F.col("z_ecef")))


def enrich_stations(stations: DataFrame) -> DataFrame:
    """Stations with ECEF position, one row per ``station_id``.

    A station without usable geometry cannot be nearest to anything and is left out.
    Among rows that share an id the smallest attribute tuple is kept.
    """
    one_each = dedup_stations(
        stations.withColumns({c: F.col(c).cast("double") for c in ("lat", "lon", "h")}).where(
            F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("h").isNotNull()
        )
    )
    position = geo.ecef(F.col("lat"), F.col("lon"), F.col("h"))
    return one_each.withColumns(
        {"station_x": position.x, "station_y": position.y, "station_z": position.z}
    )


def dedup_stations(stations: DataFrame) -> DataFrame:
    """One row per ``station_id``: the smallest (name, type, lat, lon, h)."""
    attrs = ["name", "station_type", "lat", "lon", "h"]
    return (
        stations.groupBy("station_id")
        .agg(F.min(F.struct(*attrs)).alias("kept"))
        .select("station_id", *[F.col(f"kept.{a}").alias(a) for a in attrs])
    )


def flight_points(nearest: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """The point-level wide table (26 columns)."""
    return nearest.select(
        "icao24",
        F.trim("callsign").alias("callsign"),
        "origin_country",
        "snapshot_ts",
        "event_time",
        "time_window",
        "flight_phase",
        "on_ground",
        "latitude",
        "longitude",
        "height",
        "x_ecef",
        "y_ecef",
        "z_ecef",
        "velocity",
        "mach",
        "vertical_rate",
        "true_track",
        "r_to_earth",
        "r_to_station",
        "station_id",
        F.col("name").alias("station_name"),
        F.col("lat").alias("station_lat"),
        F.col("lon").alias("station_lon"),
        F.col("h").alias("station_h"),
        load_time(as_of).alias("event_ts"),
    )

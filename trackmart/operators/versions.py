"""Versioned stores: fact projection, latest version per key, retention, lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart.runtime import broadcast_if_small, load_time
from trackmart.schemas import FACT_KEY

LOAD_SEQ = "load_seq"
MONTH = "month"

# Fixed value: how long versioned rows are kept.
RETENTION = "INTERVAL 1 YEAR"


def to_seconds(ts: Column) -> Column:
    """Whole seconds: the precision of the stores."""
    return F.date_trunc("second", ts)


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def fact_projection(points: DataFrame) -> DataFrame:
    """Keys and measures only (19 columns); attributes live in the dimensions."""
    return points.select(
        to_seconds(F.col("event_ts")).alias("event_ts"),
        "icao24",
        "station_id",
        F.col("event_time").alias("snapshot_time"),
        F.timestamp_seconds("time_window").alias("time_window"),
        "flight_phase",
        F.col("on_ground").cast("int").alias("on_ground"),
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
    )


def latest(df: DataFrame, key: list[str], version: str = "event_ts", tie: str | None = LOAD_SEQ) -> DataFrame:
    """The newest row per key; among equal versions the later load.

    Rows of a key share their month, so on a month store the months are ranked on their own.
    The rank-one filter is pushed below the shuffle as a partial group limit, so a key
    repeated in many loads leaves each task once.
    """
    order = [F.desc(version)] + ([F.desc(tie)] if tie else [])
    newest = Window.partitionBy(*([MONTH] if MONTH in df.columns else []), *key).orderBy(*order)
    return df.withColumn("place", F.row_number().over(newest)).where("place = 1").drop("place")


def retain(df: DataFrame, ts: str, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows whose retention has not run out: kept while ``ts`` + 1 year is after ``as_of``.

    The exact rule cannot be pushed into a scan (a leap day shifts), so two coarser ones
    that it implies go with it: whole months on a month-partitioned store, and a bound on
    the plain column for file statistics.
    """
    now = load_time(as_of)
    cutoff = now - F.expr(RETENTION)
    kept = df.where(F.col(ts) + F.expr(RETENTION) > now).where(F.col(ts) > cutoff - F.expr("INTERVAL 2 DAYS"))
    return kept.where(F.col(MONTH) >= month_of(cutoff)) if MONTH in df.columns else kept


def current_facts(store: DataFrame, key: list[str], ts: str, as_of: datetime | Column | None = None) -> DataFrame:
    """What readers of a store see: unexpired rows, the newest of each key, without load and month."""
    return latest(retain(store, ts, as_of), key).drop(LOAD_SEQ, MONTH)


def lookup(facts: DataFrame, dim: DataFrame, key: str, defaults: dict[str, tuple[str, str | float]]) -> DataFrame:
    """Left lookup; a missing key or a null attribute gives the default.

    ``defaults`` maps the result column to (dimension column, default). The dimension is
    broadcast if its counted size allows.
    """
    side = dim.select(key, *[F.col(source).alias(f"{name}__dim") for name, (source, _) in defaults.items()])
    return facts.join(broadcast_if_small(side), key, "left").select(
        "*", *[F.coalesce(f"{name}__dim", F.lit(default)).alias(name) for name, (_, default) in defaults.items()]
    )


def obt_view(
    facts: DataFrame, dim_flight: DataFrame, dim_station: DataFrame, as_of: datetime | Column | None = None
) -> DataFrame:
    """The latest version of every fact with the attributes of today's dimensions (26 columns).

    Facts that have outlived their retention at ``as_of`` (default: now) are hidden. Only
    current station versions are looked up: old facts of a closed station show the defaults.
    For a part of the time, read the store with ``between``.
    """
    with_flight = lookup(
        current_facts(facts, FACT_KEY, "snapshot_time", as_of),
        dim_flight,
        "icao24",
        {"callsign": ("callsign", ""), "origin_country": ("origin_country", "")},
    )
    with_station = lookup(
        with_flight,
        dim_station.where("is_current"),
        "station_id",
        {
            "station_name": ("name", ""),
            "station_type": ("station_type", ""),
            "station_lat": ("lat", 0.0),
            "station_lon": ("lon", 0.0),
            "station_h": ("h", 0.0),
        },
    )
    return with_station.select(
        "event_ts",
        "icao24",
        "callsign",
        "origin_country",
        "snapshot_time",
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
        "station_name",
        "station_type",
        "station_lat",
        "station_lon",
        "station_h",
    )

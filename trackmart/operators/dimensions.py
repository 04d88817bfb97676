"""Dimension loads as joins: overwrite (SCD1) and history-keeping (SCD2).

Both are pure functions from the old dimension and the new input to the new dimension.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart.operators.enrich import dedup_stations
from trackmart.runtime import broadcast_if_small, load_time

# Fixed value: end of validity of a version that is still open.
OPEN_END = "9999-12-31 23:59:59"

ROWS_PER_BUCKET = 100_000

STATION_ATTRS = ["lat", "lon", "h", "name", "station_type"]


def flight_dimension_input(points: DataFrame) -> DataFrame:
    """One row per aircraft: the callsign and country it sent last, and when.

    Points are first reduced to one row per distinct combination (hash aggregation on a
    single long), so the ranking below sees a few rows per aircraft, not its points.
    """
    combos = points.groupBy("icao24", "callsign", "origin_country").agg(F.max("snapshot_ts").alias("last_ts"))
    return combos.groupBy("icao24").agg(F.min(_newest_first()).alias("kept")).select("icao24", *_kept_columns())


def _newest_first(side: str = "") -> Column:
    """Sorts before every older sighting; equal times by the attributes."""
    prefix = f"{side}." if side else ""
    age = F.negative(F.col(f"{prefix}last_ts")).alias("age")
    return F.struct(age, *[F.col(f"{prefix}{c}") for c in ("callsign", "origin_country")])


def _kept_columns() -> list[Column]:
    return [F.col("kept.callsign"), F.col("kept.origin_country"), F.negative("kept.age").alias("last_ts")]


def station_dimension_input(stations: DataFrame) -> DataFrame:
    """One row per station with its six attributes."""
    return dedup_stations(stations).select("station_id", "name", "station_type", "lat", "lon", "h")


def scd1_upsert(dim: DataFrame, new: DataFrame, key: str, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``dim`` with the same key; others stay."""
    stamped = new.withColumn("updated_at", load_time(as_of)).select(*dim.columns)
    return dim.join(new, key, "left_anti").unionByName(stamped)


def newer_sightings(dim: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` that the flight dimension does not yet have, or has from an older sighting.

    Applying loads in any order, also repeatedly, therefore ends in the same dimension.
    """
    pairs = new.alias("new").join(dim.alias("old"), "icao24", "left")
    wins = F.col("old.updated_at").isNull() | (_newest_first("new") < _newest_first("old"))
    return pairs.where(wins).select("new.*")


def current(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def _changed(old: str, new: str, attrs: list[str]) -> Column:
    """Any attribute differs. A change to or from null is, on its own, not seen."""
    differs = [F.col(f"{old}.{a}") != F.col(f"{new}.{a}") for a in attrs]
    return F.coalesce(reduce(lambda a, b: a | b, differs), F.lit(False))


def new_keys(dim: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key has no current version."""
    return new.join(current(dim), key, "left_anti")


def vanished_keys(dim: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Current versions whose key is gone from ``new``."""
    return current(dim).join(new, key, "left_anti")


def highest_number(dim: DataFrame, surrogate: str = "station_sk") -> Column:
    """The highest surrogate key given so far, 0 before the first."""
    return dim.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("long")).scalar()


def scd2_load(
    versions: DataFrame,
    new: DataFrame,
    last: Column,
    key: str = "station_id",
    attrs: list[str] | None = None,
    as_of: datetime | Column | None = None,
    surrogate: str = "station_sk",
) -> tuple[DataFrame, DataFrame]:
    """From the open versions and a load to the versions open after it and those it closes.

    Changed and vanished versions close; every new or changed key opens one, numbered from
    ``last`` on. ``new`` holds one row per key. Closing and opening use the same instant, so
    versions of a key meet without gap. A key that comes back gets a new version; an empty
    ``new`` closes everything.
    """
    attrs = STATION_ATTRS if attrs is None else attrs
    now = load_time(as_of)
    matched = (
        versions.alias("old")
        .join(new.withColumn("present", F.lit(True)).alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "left")
        .withColumn("ends", F.col("new.present").isNull() | _changed("old", "new", attrs))
        .select("old.*", "ends")
    )
    kept = matched.where("NOT ends").drop("ends")
    closed = matched.where("ends").drop("ends").withColumns({"valid_to": now, "is_current": F.lit(False)})
    opened = new.join(kept, key, "left_anti").withColumns(
        {
            "valid_from": now,
            "valid_to": F.lit(OPEN_END).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )
    numbered = number_rows(opened, key).withColumn(surrogate, last + F.col("number")).select(*versions.columns)
    return kept.unionByName(numbered), closed


def scd2_apply(
    dim: DataFrame,
    new: DataFrame,
    key: str = "station_id",
    attrs: list[str] | None = None,
    as_of: datetime | Column | None = None,
    surrogate: str = "station_sk",
) -> DataFrame:
    """The whole dimension after a load; history rows take no part in any join."""
    is_current = F.coalesce("is_current", F.lit(False))
    after, closed = scd2_load(dim.where(is_current), new, highest_number(dim, surrogate), key, attrs, as_of, surrogate)
    return dim.where(~is_current).unionByName(after).unionByName(closed)


def number_rows(df: DataFrame, key: str) -> DataFrame:
    """Number rows 1, 2, … without sending them all through one task.

    Rows are spread over hash buckets, more of them for more rows, and numbered inside each;
    only the bucket sizes are accumulated globally.
    """
    count = df.agg(F.count("*")).first()[0]
    buckets = max(1, count // ROWS_PER_BUCKET)
    bucketed = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = bucketed.groupBy("bucket").agg(F.count("*").alias("size"))
    before = F.coalesce(
        F.sum("size").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("bucket", before.alias("offset"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy(key))
    return (
        bucketed.withColumn("inside", inside)
        .join(broadcast_if_small(offsets), "bucket")
        .withColumn("number", F.col("offset") + F.col("inside"))
        .drop("bucket", "inside", "offset")
    )

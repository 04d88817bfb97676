"""Minute aggregates in parts that add up.

A part holds, per minute, phase and block of aircraft addresses, the sums and counts of its points
and a bitmap of the aircraft. Sums add, bitmaps unite, so parts of batches, days or phases merge
into exact figures without going back to points; the number of distinct aircraft too.

An address of six hexadecimal digits in lower case is a 24-bit number: its bit lies in one of 512
blocks of 32 768. Any other address stands in a row of its own, under its text. Points without
address count as points and as no aircraft.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.runtime import load_time
from trackmart.schemas import MINUTE_PARTIALS, TIME_AGG

MEASURES = ["height", "velocity", "mach", "r_to_station"]
_KEY = ["minute", "flight_phase", "block", "other"]


def minute_partials(points: DataFrame) -> DataFrame:
    """Parts of enriched points; ``minute`` is the start of the minute in seconds."""
    address = F.when(F.col("icao24").rlike("^[0-9a-f]{6}$"), F.conv("icao24", 16, 10).cast("long"))
    keyed = points.select(
        F.col("time_window").alias("minute"),
        "flight_phase",
        F.bitmap_bucket_number(address).alias("block"),
        F.when(address.isNull(), F.col("icao24")).alias("other"),
        F.bitmap_bit_position(address).alias("bit"),
        *MEASURES,
    )
    sums = [f(c).alias(f"{name}_{c}") for c in MEASURES for name, f in (("sum", F.sum), ("known", F.count))]
    parts = keyed.groupBy(*_KEY).agg(F.count("*").alias("points"), *sums, F.bitmap_construct_agg("bit").alias("aircraft"))
    return parts.withColumn("aircraft", F.when(F.col("block").isNotNull(), F.col("aircraft"))).select(*MINUTE_PARTIALS.names)


def merge_partials(parts: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One part per key; without ``flight_phase`` in ``key`` the phases are united."""
    key = _KEY if key is None else key
    added = ["points", *[f"{name}_{c}" for c in MEASURES for name in ("sum", "known")]]
    return parts.groupBy(*key).agg(*[F.sum(c).alias(c) for c in added], F.bitmap_or_agg("aircraft").alias("aircraft"))


def _aircraft() -> Column:
    """Distinct aircraft of merged parts: bits, and addresses that are none."""
    return (F.sum(F.bitmap_count("aircraft")) + F.count("other")).cast("long")


def time_agg_of(parts: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """The minute aggregate (9 columns), as from the points themselves."""
    means = [F.try_divide(F.sum(f"sum_{c}"), F.sum(f"known_{c}")).alias(f"avg_{c}") for c in MEASURES]
    minutes = merge_partials(parts).groupBy("minute", "flight_phase").agg(
        F.sum("points").alias("points_in_window"), _aircraft().alias("flights_in_window"), *means
    )
    stamped = minutes.withColumns({"event_ts": load_time(as_of), "time_window": F.timestamp_seconds("minute")})
    return stamped.select(*TIME_AGG.names)


def traffic_of(parts: DataFrame, seconds: int = 60) -> DataFrame:
    """Points and distinct aircraft per stretch of time, over all phases."""
    start = (F.floor(F.col("minute") / seconds) * seconds).alias("start")
    united = merge_partials(parts.withColumn("start", start), ["start", "block", "other"])
    traffic = united.groupBy("start").agg(F.sum("points").alias("points"), _aircraft().alias("aircraft"))
    return traffic.select(F.timestamp_seconds("start").alias("time_window"), "points", "aircraft")

"""The stored flight dimension: what a load of points changes in it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame

from trackmart.operators.dimensions import flight_dimension_input, newer_sightings, scd1_upsert
from trackmart.runtime import checkpointed
from trackmart.schemas import DIM_FLIGHT
from trackmart.sources.buckets import buckets_of, read_buckets


def changed_flights(points: DataFrame, path: str, as_of: datetime | Column | None = None) -> DataFrame:
    """All rows, as they are after this load, of the buckets in which it changes an aircraft.

    Materialised; empty if every sighting is already known or older than the one kept.
    """
    spark, key = points.sparkSession, "icao24"
    seen = checkpointed(flight_dimension_input(points))
    newer = checkpointed(newer_sightings(read_buckets(spark, path, DIM_FLIGHT, buckets_of(seen, key)), seen))
    before = read_buckets(spark, path, DIM_FLIGHT, buckets_of(newer, key))
    return checkpointed(scd1_upsert(before, newer, key, as_of))

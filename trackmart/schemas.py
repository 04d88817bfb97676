"""Explicit schemas of every table that enters or leaves the engine.

Nothing is ever inferred from text: an all-digit ``icao24`` stays a string and
``squawk`` keeps its leading zeros.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
_BOOL, _INT, _TS = T.BooleanType(), T.IntegerType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The position of each attribute inside a snapshot's state vector.
# The list of receivers ("sensors", position 12) is not kept.
VECTOR_POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "true_track": 10,
    "vertical_rate": 11,
    "geo_altitude": 13,
    "squawk": 14,
    "spi": 15,
    "position_source": 16,
    "category": 17,
}

STATES = _struct(
    ("snapshot_ts", _LONG),
    ("icao24", _STRING),
    ("callsign", _STRING),
    ("origin_country", _STRING),
    ("time_position", _LONG),
    ("last_contact", _LONG),
    ("longitude", _DOUBLE),
    ("latitude", _DOUBLE),
    ("baro_altitude", _DOUBLE),
    ("on_ground", _BOOL),
    ("velocity", _DOUBLE),
    ("true_track", _DOUBLE),
    ("vertical_rate", _DOUBLE),
    ("geo_altitude", _DOUBLE),
    ("squawk", _STRING),
    ("spi", _BOOL),
    ("position_source", _INT),
    ("category", _INT),
)

STATIONS = _struct(
    ("station_id", _STRING),
    ("name", _STRING),
    ("station_type", _STRING),
    ("lat", _DOUBLE),
    ("lon", _DOUBLE),
    ("h", _DOUBLE),
)

AIRPORTS = _struct(
    ("ident", _STRING),
    ("type", _STRING),
    ("name", _STRING),
    ("latitude_deg", _DOUBLE),
    ("longitude_deg", _DOUBLE),
    ("elevation_ft", _DOUBLE),
)

# ``last_ts`` is when the attributes were sent; an older sighting never replaces a newer one.
DIM_FLIGHT = _struct(
    ("icao24", _STRING),
    ("callsign", _STRING),
    ("origin_country", _STRING),
    ("last_ts", _LONG),
    ("updated_at", _TS),
)

DIM_STATION = _struct(
    ("station_sk", _LONG),
    ("station_id", _STRING),
    ("name", _STRING),
    ("station_type", _STRING),
    ("lat", _DOUBLE),
    ("lon", _DOUBLE),
    ("h", _DOUBLE),
    ("valid_from", _TS),
    ("valid_to", _TS),
    ("is_current", _BOOL),
)

# The three versioned stores; on disk each row also has its load and its month.
FACTS = _struct(
    ("event_ts", _TS),
    ("icao24", _STRING),
    ("station_id", _STRING),
    ("snapshot_time", _TS),
    ("time_window", _TS),
    ("flight_phase", _STRING),
    ("on_ground", _INT),
    *[(name, _DOUBLE) for name in (
        "latitude", "longitude", "height", "x_ecef", "y_ecef", "z_ecef", "velocity", "mach", "vertical_rate",
        "true_track", "r_to_earth", "r_to_station",
    )],
)

FLIGHTS_AGG = _struct(
    ("event_ts", _TS),
    ("icao24", _STRING),
    ("callsign", _STRING),
    ("origin_country", _STRING),
    ("total_points", _LONG),
    ("first_seen", _TS),
    ("last_seen", _TS),
    ("tracked_sec", _LONG),
    *[(name, _DOUBLE) for name in (
        "max_height", "max_velocity", "max_mach", "avg_velocity", "min_r_to_station", "avg_r_to_station", "distance_km",
    )],
    ("dominant_station", _STRING),
)

TIME_AGG = _struct(
    ("event_ts", _TS),
    ("time_window", _TS),
    ("flight_phase", _STRING),
    ("points_in_window", _LONG),
    ("flights_in_window", _LONG),
    *[(f"avg_{name}", _DOUBLE) for name in ("height", "velocity", "mach", "r_to_station")],
)

# Parts of minute aggregates, which add up.
MINUTE_PARTIALS = _struct(
    ("minute", _LONG),
    ("flight_phase", _STRING),
    ("block", _LONG),
    ("other", _STRING),
    ("points", _LONG),
    *[(f"{name}_{c}", kind) for c in ("height", "velocity", "mach", "r_to_station") for name, kind in (("sum", _DOUBLE), ("known", _LONG))],
    ("aircraft", T.BinaryType()),
)

# Longest value each dimension attribute may hold.
DIM_FLIGHT_LENGTHS = {"icao24": 6, "callsign": 16, "origin_country": 128}
DIM_STATION_LENGTHS = {"station_id": 16, "name": 255, "station_type": 32}

# Business keys of the three versioned stores.
FACT_KEY = ["icao24", "snapshot_time"]
FLIGHTS_KEY = ["icao24", "first_seen"]
TIME_KEY = ["time_window", "flight_phase"]

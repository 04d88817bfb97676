"""Landed snapshot payloads -> aircraft states.

A payload is one line of JSON, ``{"time": <epoch>, "states": [[…], …]}``; the vectors are
positional and mix types, so they are read as arrays of text and cast by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.runtime import broadcast_if_small, checkpointed
from trackmart.schemas import STATES, VECTOR_POSITIONS

# What a poll is ordered by: its file's time and name, then its place in the file.
ARRIVAL = ["file_time", "file", "block", "line"]

_PAYLOAD = "time BIGINT, states ARRAY<ARRAY<STRING>>"


def _no_nan(column: Column, kind: T.DataType) -> Column:
    return F.nanvl(column, F.lit(None)) if isinstance(kind, T.DoubleType) else column


def parse_snapshots(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row per state vector; other columns of ``raw`` are carried along.

    Missing or null ``states`` give no rows. Short vectors are padded with nulls, surplus
    positions ignored, values that do not fit their type become null.
    """
    carried = [c for c in raw.columns if c != value]
    vectors = raw.select(*carried, F.from_json(value, _PAYLOAD).alias("payload")).select(
        *carried, F.col("payload.time").alias("snapshot_ts"), F.explode("payload.states").alias("vector")
    )
    attributes = [
        _no_nan(F.get("vector", F.lit(position)).try_cast(STATES[name].dataType), STATES[name].dataType).alias(name)
        for name, position in VECTOR_POSITIONS.items()
    ]
    return vectors.select("snapshot_ts", *attributes, *carried)


def read_polls(spark: SparkSession, landing: str, by_name: bool = False) -> DataFrame:
    """Landed payload lines in ``value``, with ``arrival``: a struct that orders the polls.

    Lines of one file are in the order of the file; files go by the time they were written, or
    by name alone where files have been copied since.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(landing)
    return with_arrival(file_lines(lines), by_name)


def file_lines(lines: DataFrame) -> DataFrame:
    """Lines of text files with the file they stand in."""
    places = {"file_time": "file_modification_time", "file": "file_path", "block": "file_block_start"}
    return lines.select("value", *[F.col(f"_metadata.{source}").alias(name) for name, source in places.items()])


def with_arrival(lines: DataFrame, by_name: bool = False) -> DataFrame:
    """``value`` and ``arrival``. Within a block of a file the running id follows the lines."""
    time = F.lit(None).cast("timestamp") if by_name else F.col("file_time")
    parts = [time, F.col("file"), F.col("block"), F.monotonically_increasing_id()]
    return lines.select("value", F.struct(*[p.alias(n) for p, n in zip(parts, ARRIVAL)]).alias("arrival"))


def poll_time(value: str = "value") -> Column:
    """Snapshot time of a payload line, without parsing its states."""
    return F.get_json_object(value, "$.time").try_cast("bigint")


def readable(value: str = "value") -> Column:
    """True for lines that are JSON throughout."""
    return F.get_json_object(value, "$").isNotNull()


def first_polls(polls: DataFrame) -> DataFrame:
    """Of the lines with one snapshot time the one that arrived first.

    Works on lines: the aggregation sees one row per poll and two narrow columns; states are
    parsed later, once, from the lines that are left. Lines without time are none of them.
    """
    timed = polls.withColumn("snapshot_ts", poll_time()).where("snapshot_ts IS NOT NULL")
    return lines_of(timed, earliest(timed))


def earliest(timed: DataFrame) -> DataFrame:
    """``snapshot_ts`` and the ``arrival`` of its first poll, for lines whose time is known."""
    return checkpointed(timed.groupBy("snapshot_ts").agg(F.min("arrival").alias("arrival")))


def lines_of(timed: DataFrame, polls: DataFrame) -> DataFrame:
    """The lines of some polls."""
    return timed.join(broadcast_if_small(polls), ["snapshot_ts", "arrival"], "left_semi").drop("snapshot_ts")


def dedup_snapshots(states: DataFrame, arrival: str = "arrival") -> DataFrame:
    """``first_polls`` on states already parsed: the first arrival of a snapshot, whole.

    ``arrival`` numbers the requests. Needed only where the lines are gone.
    """
    first = checkpointed(states.groupBy("snapshot_ts").agg(F.min(arrival).alias(arrival)))
    return states.join(broadcast_if_small(first), ["snapshot_ts", arrival], "left_semi")

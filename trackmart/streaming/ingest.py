"""Streams: ingestion, minute aggregate, nearest station, upsert sink.

A stream is a file stream of payload lines and a list of steps. Each micro-batch is reduced to
the polls that are first for their snapshot, over the whole stream, and stored under its number;
the steps then work on the stored rows. A replayed batch writes the same folder again and every
step is repeatable, so results do not depend on how lines are cut into batches, nor on the order
in which batches arrive.

What is remembered between batches is cut by time (``sources.slots``): the snapshots seen, by the
hour, and the parts of minute aggregates, by ten minutes. A batch opens the slots it touches, so
its cost does not grow with the age of the stream, and nothing is too late to be taken. Spark's
own state for dropping repeats would take any poll of a batch, not the first one, and lose polls
behind its watermark.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from trackmart.operators.enrich import clean_points, enrich_points
from trackmart.operators.nearest import StationIndex
from trackmart.operators.partials import minute_partials, time_agg_of
from trackmart.operators.quality import marked, payload_rules, require, run_rules, state_rules
from trackmart.runtime import broadcast_if_small, checkpointed
from trackmart.schemas import MINUTE_PARTIALS, STATES, TIME_KEY
from trackmart.sources.buckets import replace_buckets
from trackmart.sources.files import append_facts, exists
from trackmart.sources.flights import changed_flights
from trackmart.sources.slots import EPOCH, read_slots, slots_in, write_slots
from trackmart.sources.snapshots import earliest, file_lines, lines_of, parse_snapshots, poll_time, with_arrival

HOUR, TEN_MINUTES = 3600, 600

Step = Callable[[DataFrame, int], None]


def landed_payloads(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Unbounded frame of payload lines with the file they stand in."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return file_lines(reader.load(landing))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches with their number; none before the first batch."""
    stored = T.StructType([*schema.fields, T.StructField(EPOCH, T.IntegerType())])
    return spark.read.schema(stored).parquet(path) if exists(spark, path) else spark.createDataFrame([], stored)


def ingested_states(spark: SparkSession, path: str) -> DataFrame:
    """All states that a stream has stored below ``path``."""
    return _stored(spark, f"{path}/states", STATES).select(*STATES.names)


def refused_lines(spark: SparkSession, path: str) -> DataFrame:
    """Payload lines that could not be used, with the rule they broke."""
    schema = T.StructType().add("rule", T.StringType()).add("value", T.StringType())
    return _stored(spark, f"{path}/refused", schema).drop(EPOCH)


def ingest(payloads: DataFrame, path: str, *steps: Step, by_name: bool = False) -> DataStreamWriter:
    """Store the states of every first poll below ``path`` and hand each batch of them on.

    Of polls with one snapshot time the first wins whole: within a batch by arrival, between
    batches the earlier batch. The snapshot times seen are a table of one row per snapshot, of
    which a batch reads the hours that its polls lie in. Lines that are not JSON or have no time are set aside
    below ``path``; an aircraft named twice in one line, or a state against the rules, stops
    the stream.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # all that is asked of the lines is worked out as they are kept; one more parse yields the states
        judged, rules = marked(with_arrival(batch, by_name).withColumn("snapshot_ts", poll_time()), payload_rules())
        broken, wrong = rules[:2], rules[2:]
        lines, states = judged.persist(), None
        try:
            reasons = F.coalesce(*[F.when(r.broken, F.lit(r.name)) for r in broken])
            refused = lines.select(reasons.alias("rule"), "value").where("rule IS NOT NULL")
            refused.write.mode("overwrite").parquet(f"{path}/refused/{EPOCH}={epoch}")
            good = lines.where(reasons.isNull())
            require(run_rules(good, wrong))
            times = T.StructType().add("snapshot_ts", T.LongType())
            timed = good.select("value", "arrival", "snapshot_ts")
            slots = slots_in(timed, F.col("snapshot_ts"), HOUR)
            known = read_slots(spark, f"{path}/seen", times, slots)
            # measured and joined, but its files, one per hour and batch, are opened once
            seen = checkpointed(known.where(F.col(EPOCH) < epoch).select("snapshot_ts").distinct())
            first = earliest(timed.join(broadcast_if_small(seen), "snapshot_ts", "left_anti"))
            states = parse_snapshots(lines_of(timed, first)).drop("arrival").persist()
            require(run_rules(states, state_rules()))
            states.write.mode("overwrite").parquet(f"{path}/states/{EPOCH}={epoch}")
            write_slots(first.select("snapshot_ts"), f"{path}/seen", F.col("snapshot_ts"), HOUR, epoch, len(slots))
        finally:
            lines.unpersist()
            if states is not None:
                states.unpersist()
        stored = spark.read.schema(STATES).parquet(f"{path}/states/{EPOCH}={epoch}")
        if not stored.isEmpty():
            for step in steps:
                step(stored, epoch)

    return payloads.writeStream.foreachBatch(write)


def run_for(start: Callable[[dict], StreamingQuery], interval: str, window: float) -> None:
    """Poll every ``interval`` for ``window`` seconds, then take what has landed by then and end.

    ``start`` starts the stream with a trigger, each time on the same checkpoint. A batch cut
    short by the end of the window is taken again by the last run, which every step allows.
    """
    query = start({"processingTime": interval})
    if not query.awaitTermination(window):
        query.stop()
    start({"availableNow": True}).awaitTermination()


def minute_step(path: str, store: str, stations: DataFrame | None = None, as_of: datetime | Column | None = None) -> Step:
    """Keep the minute aggregate of a stream in a month store, trailing minutes included.

    A batch adds parts of its own points; the minutes it touches are put together from all parts
    stored so far and appended as load ``epoch``. Readers take the latest load per minute and
    phase. Without ``stations`` distances are unknown.
    """
    parts, kept = f"{path}/minutes", []

    def step(states: DataFrame, epoch: int) -> None:
        spark, minute = states.sparkSession, F.col("minute")
        points = enrich_points(clean_points(states))
        if stations is None:
            points = points.withColumn("r_to_station", F.lit(None).cast("double"))
        else:
            if not kept:
                kept.append(StationIndex(f"{path}/station-index", stations))
            points = kept[0].nearest(points, epoch)
        slots = slots_in(states, F.col("snapshot_ts"), TEN_MINUTES)
        write_slots(minute_partials(points), parts, minute, TEN_MINUTES, epoch, len(slots))
        near = read_slots(spark, parts, MINUTE_PARTIALS, slots).where(F.col(EPOCH) <= epoch)
        touched = checkpointed(near.where(F.col(EPOCH) == epoch).select("minute").distinct())
        whole = near.join(broadcast_if_small(touched), "minute", "left_semi")
        append_facts(time_agg_of(whole, as_of), store, "time_window", TIME_KEY, epoch)

    return step


def nearest_step(path: str, stations: DataFrame, sink: Step) -> Step:
    """Clean, enrich and locate each batch and hand it to ``sink``.

    The lists of candidate stations are kept below ``path`` and outlive the job; a batch over
    cells that were occupied before only looks them up.
    """
    kept: list[StationIndex] = []

    def step(states: DataFrame, epoch: int) -> None:
        if not kept:
            kept.append(StationIndex(f"{path}/station-index", stations))
        sink(kept[0].nearest(enrich_points(clean_points(states)), epoch), epoch)

    return step


def upsert_step(dim_path: str, as_of: datetime | Column | None = None) -> Step:
    """Keep the flight dimension up to date.

    Sightings replace older ones only, so the dimension after a set of batches is the same in
    any order and after replays. Versions are in one sequence with those of the daily run. A
    batch reads the buckets of its aircraft, and rewrites those in which it changes one.
    """

    def step(states: DataFrame, epoch: int) -> None:
        points = clean_points(states).withColumn("callsign", F.trim("callsign"))
        replace_buckets(changed_flights(points, dim_path, as_of), dim_path, "icao24")

    return step

"""The daily batch: load landed files, run one day, publish it.

``python -m trackmart.plans.daily --date 2024-01-01 --data-dir s3a://bucket/flights``

Session settings (file system endpoints, keys, memory) belong to the submitter.
"""

from __future__ import annotations

import argparse
import json
import time
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.operators.dimensions import (
    highest_number,
    scd2_load,
    station_dimension_input,
)
from trackmart.operators.enrich import clean_points, enrich_points, enrich_stations, flight_points, states_in_bbox
from trackmart.operators.marts import flights_agg, time_agg
from trackmart.operators.nearest import nearest_station
from trackmart.operators.quality import (
    Violation,
    dim_flight_checks,
    dim_station_checks,
    geometry_rules,
    observed,
    payload_rules,
    require,
    require_rows,
    run_checks,
    run_rules,
    source_checks,
    target_rules,
    target_violations,
)
from trackmart.operators.versions import fact_projection, to_seconds
from trackmart.plans.reports import phase_distribution, run_summary, top_flights
from trackmart.runtime import checkpointed
from trackmart.schemas import DIM_STATION, FACT_KEY, FLIGHTS_KEY, TIME_KEY
from trackmart.sources.buckets import replace_buckets
from trackmart.sources.files import (
    append_facts,
    day_path,
    drop_expired_months,
    publish,
    read_states,
    read_stations,
    write_day,
)
from trackmart.sources.flights import changed_flights
from trackmart.sources.history import read_closed, read_open, write_history
from trackmart.sources.snapshots import first_polls, parse_snapshots, read_polls
from trackmart.sources.stations import airports_in_region, read_airports, stations_from_airports

# Default region of observation, degrees.
DEFAULT_BBOX = {"lamin": 50.0, "lomin": 4.0, "lamax": 53.0, "lomax": 11.0}


class DayRun(NamedTuple):
    """Frames a run leaves behind, for reports."""

    points: DataFrame
    flights: DataFrame
    top: DataFrame
    phases: DataFrame
    summary: DataFrame
    advice: list[Violation]


def load_day(
    spark: SparkSession,
    landing: str,
    airports_csv: str,
    root: str,
    ds: str,
    bbox: dict[str, float] = DEFAULT_BBOX,
    by_name: bool = False,
) -> None:
    """Landed payload files and the airport file -> the day's inputs.

    Every line is one poll; of polls with one snapshot time the first one counts, in the order
    of files (by time, or by name) and of lines. Broken lines, lines without time and lines
    that name an aircraft twice stop the load. Both extracts fail when the region yields
    nothing; stations are looked at before those without height are dropped.
    """
    airports = read_airports(spark, airports_csv)
    require_rows(airports_in_region(airports, bbox), "no_stations_in_region")
    write_day(stations_from_airports(airports, bbox), f"{root}/stations", ds)

    polls = read_polls(spark, landing, by_name)
    require(run_rules(polls, payload_rules()))
    states = states_in_bbox(parse_snapshots(first_polls(polls)).drop("arrival"), bbox)
    require_rows(states, "no_points_collected")
    write_day(states, f"{root}/states", ds)


def _settle(df: DataFrame, path: str, ds: str) -> DataFrame:
    """Write a day's frame and go on from the written table."""
    write_day(df, path, ds)
    return df.sparkSession.read.parquet(day_path(path, ds))


def run_day(
    spark: SparkSession, root: str, ds: str, as_of: datetime | None = None, load_seq: int | None = None
) -> DayRun:
    """Checks, enrichment, nearest station, dimensions, facts and aggregates for one day.

    The wide table and the aggregates are written once, the wide table's checks being counted
    while it is written, and everything after them reads those
    tables: nothing large is cached and a lost executor costs one file read. Dimensions, stores
    and the curated table are touched only after all checks have passed, those of the new
    dimensions included: of those, the buckets of aircraft and the stations that the day changes.
    Running a day again replaces its curated partition and supersedes its facts. Dimensions go on from their newest version, whatever ``as_of`` says. Months that have
    outlived their retention at ``as_of`` are removed from the stores.
    """
    as_of = as_of or datetime.now(timezone.utc)
    load_seq = load_seq if load_seq is not None else time.time_ns() // 1_000_000
    states, stations = read_states(spark, root, ds), read_stations(spark, root, ds)
    require(run_checks(source_checks(states, stations)))
    advice = run_rules(stations, geometry_rules())

    clean, before = observed(clean_points(states))
    work, located = f"{root}/work/flight_points", enrich_stations(stations)
    wide, after = observed(flight_points(nearest_station(enrich_points(clean), located), as_of), target_rules())
    points = _settle(wide, work, ds)
    require(target_violations(before, after))

    flight_path, station_path = f"{root}/dim_flight", f"{root}/dim_station"
    flights_after = changed_flights(points, flight_path, as_of)
    open_before, closed_before = (read(spark, station_path, DIM_STATION) for read in (read_open, read_closed))
    last = highest_number(open_before.unionByName(closed_before))
    # all stations, also those that cannot be located: a lost coordinate is no end of a station
    open_after, closed_now = map(checkpointed, scd2_load(open_before, station_dimension_input(stations), last, as_of=as_of))
    stations_after = open_after.unionByName(closed_now)
    require(run_checks(dim_flight_checks(flights_after)) + run_checks(dim_station_checks(stations_after)))
    replace_buckets(flights_after, flight_path, "icao24")
    write_history(open_after, closed_now, station_path)

    flights = _settle(flights_agg(points, as_of), f"{root}/work/flights_agg", ds)
    minutes = _settle(time_agg(points, as_of), f"{root}/work/time_agg", ds)
    stored_ts = {"event_ts": to_seconds(F.col("event_ts"))}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as many as a ranking would have tasks
    stores = [
        (fact_projection(points), "fact_flight_points", "snapshot_time", FACT_KEY, buckets),
        (flights.withColumns(stored_ts), "flights_agg", "first_seen", FLIGHTS_KEY, buckets),
        (minutes.withColumns(stored_ts), "time_agg", "time_window", TIME_KEY, None),
    ]
    for rows, name, ts, key, dealt in stores:
        append_facts(rows, f"{root}/{name}", ts, key, load_seq, dealt)
        drop_expired_months(spark, f"{root}/{name}", as_of)
    publish(spark, work, f"{root}/curated/flight_points", ds)
    return DayRun(points, flights, top_flights(flights), phase_distribution(points), run_summary(flights), advice)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load and run one day.")
    parser.add_argument("--date", required=True, help="run label, YYYY-MM-DD")
    parser.add_argument("--data-dir", required=True, help="root of all tables, any file system URI")
    parser.add_argument("--landing", help="folder of payload files; with --airports the day is loaded first")
    parser.add_argument("--airports", help="airport CSV")
    parser.add_argument("--bbox", type=json.loads, default=DEFAULT_BBOX, help="JSON with lamin, lomin, lamax, lomax")
    parser.add_argument("--files-by-name", action="store_true", help="order landed files by name, not by their time")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="load time; default: now")
    parser.add_argument("--publish-to", help="also publish the curated day below this URI")
    args = parser.parse_args(argv)

    spark = (
        SparkSession.builder.appName("trackmart").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    if args.landing and args.airports:
        load_day(spark, args.landing, args.airports, args.data_dir, args.date, args.bbox, args.files_by_name)
    as_of = args.as_of
    if as_of is not None and as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    run = run_day(spark, args.data_dir, args.date, as_of)
    for report in (run.top, run.phases, run.summary):
        report.show(truncate=False)
    for rule, rows in run.advice:
        print(f"note: {rule} in {rows} row(s)")
    if args.publish_to:
        publish(spark, f"{args.data_dir}/curated/flight_points", f"{args.publish_to}/flight_points", args.date)


if __name__ == "__main__":
    main()

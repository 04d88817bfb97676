"""One registered query per operator; ``checks/oracle.py`` holds the same answers in SQL.

Metres are compared to 3 decimals, Mach numbers and degrees to 6. Means of round numbers may lie
on a rounding tie, which the order of summing decides; a little is added to them before rounding,
here and in the SQL.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from trackmart.functions import geo
from trackmart.operators import dimensions as dims
from trackmart.operators import enrich, marts, partials, quality, versions
from trackmart.operators.nearest import nearest_station as find_nearest
from trackmart.operators.nearest import nearest_station_window, station_distance
from trackmart.plans import daily, reports
from trackmart.runtime import scratch_path
from trackmart.schemas import DIM_FLIGHT, DIM_STATION, FACT_KEY, FACTS, FLIGHTS_AGG, FLIGHTS_KEY, STATES, STATIONS, TIME_AGG, TIME_KEY
from trackmart.sources import buckets, files, history
from trackmart.sources.snapshots import dedup_snapshots, first_polls, parse_snapshots, read_polls
from trackmart.sources.stations import airports_in_region, read_airports, stations_from_airports
from trackmart.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "2024-01-01"
SMALL_REGION = '{"lamin": 50.5, "lomin": 5.0, "lamax": 52.0, "lomax": 9.0}'
NOWHERE = {"lamin": -10.0, "lomin": 4.0, "lamax": -9.0, "lomax": 11.0}


def decimals(name: str) -> int:
    return 6 if any(part in name for part in ("mach", "lat", "lon")) else 3


def comparable(name: str, expression: str) -> str:
    """SQL text for both engines: the rounded value, means moved off rounding ties."""
    places = decimals(name)
    moved = f"{expression} + 3.14159e-{places + 3}" if name.startswith("avg_") else expression
    return f"round({moved}, {places}) AS {name}"


def rounded(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[comparable(f.name, f.name) if isinstance(f.dataType, T.DoubleType) else f.name for f in df.schema])


def query(fn: Query) -> Query:
    """Register under the function's name; ``q_`` keeps imported operators reachable."""
    QUERIES[fn.__name__.removeprefix("q_")] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
    return fn


# --- sources and sinks ---------------------------------------------------------------


@query
def scan_states(spark, sf_dir):
    root = scratch_path(spark, "scan")
    files.write_day(fx.states(spark, sf_dir), f"{root}/states", DAY)
    return files.read_states(spark, root, DAY)


@query
def scan_stations(spark, sf_dir):
    root = scratch_path(spark, "scan")
    files.write_day(fx.stations(spark, sf_dir), f"{root}/stations", DAY)
    return files.read_stations(spark, root, DAY)


@query
def csv_to_parquet(spark, sf_dir):
    root = scratch_path(spark, "convert")
    files.write_csv(fx.states(spark, sf_dir), f"{root}/states.csv")
    files.csv_to_parquet(spark, f"{root}/states.csv", f"{root}/states", DAY, STATES)
    return files.read_states(spark, root, DAY)


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(fx.stations(spark, sf_dir), path)
    return files.read_csv(spark, path, STATIONS)


@query
def dq_csv(spark, sf_dir):
    """Values of an extract that do not fit their columns."""
    path = scratch_path(spark, "csv")
    wrong = {"velocity": F.when(F.col("spi"), "fast").otherwise(F.col("velocity").cast("string")), "snapshot_ts": F.when(F.col("spi"), "1e3x").otherwise(F.col("snapshot_ts").cast("string"))}
    files.write_csv(fx.states(spark, sf_dir).withColumns(wrong), path)
    return files.unfit_values(spark, path, STATES).where("rule IN ('velocity', 'snapshot_ts', 'squawk', 'latitude')")


@query
def q_stations_from_airports(spark, sf_dir):
    path = scratch_path(spark, "airports")
    files.write_csv(fx.airports(spark, sf_dir), path)
    return stations_from_airports(read_airports(spark, path), fx.BBOX).orderBy("station_id")



@query
def q_parse_snapshots(spark, sf_dir):
    return parse_snapshots(fx.payloads(spark, sf_dir).select("value"))



@query
def q_dedup_snapshots(spark, sf_dir):
    """From landed files, which hold several polls each."""
    polls = read_polls(spark, fx.landing(spark, sf_dir))
    return parse_snapshots(first_polls(polls)).drop("arrival")


@query
def dedup_states(spark, sf_dir):
    return dedup_snapshots(fx.arrivals(spark, sf_dir))


@query
def dq_payloads(spark, sf_dir):
    return quality.rule_counts(fx.damaged_payloads(spark, sf_dir), quality.payload_rules())



@query
def curated_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "curated")
    wide = fx.stored_wide(spark, sf_dir)
    files.write_day(wide, path, "2024-01-02")
    files.write_day(wide.where("on_ground"), path, DAY)
    files.write_day(wide, path, DAY)  # the second run of a day replaces the first
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count("*").alias("points"), F.sum("r_to_station").alias("total_r")
    )


@query
def publish_guard(spark, sf_dir):
    root = scratch_path(spark, "publish")
    files.write_day(fx.states(spark, sf_dir), f"{root}/curated", DAY)
    files.publish(spark, f"{root}/curated", f"{root}/public", DAY)
    refused = {}
    for case, source, ds in (("empty", "curated", "2024-01-02"), ("missing", "nowhere", DAY)):
        try:
            files.publish(spark, f"{root}/{source}", f"{root}/public", ds)
            refused[case] = False
        except (quality.DataQualityError, PySparkException):
            refused[case] = True
    published = spark.read.parquet(f"{root}/public").groupBy(F.col("date").cast("string").alias("date"))
    return published.agg(
        F.count("*").alias("points"),
        F.lit(refused["empty"]).alias("empty_refused"),
        F.lit(refused["missing"]).alias("missing_refused"),
    )


@query
def fact_append(spark, sf_dir):
    store = fx.fact_store(spark, sf_dir)
    return store.groupBy(F.col("month").cast("string").alias("month"), "event_ts", "load_seq").agg(
        F.count("*").alias("facts"), F.sum("velocity").alias("total_velocity")
    )


# --- points --------------------------------------------------------------------------


@query
def states_in_bbox(spark, sf_dir):
    return enrich.states_in_bbox(fx.states(spark, sf_dir), json.loads(SMALL_REGION))


@query
def clean_points(spark, sf_dir):
    return enrich.clean_points(fx.states(spark, sf_dir)).select(
        "icao24", "snapshot_ts", "latitude", "longitude", "velocity", "height", "vertical_rate"
    )


@query
def enrich_points(spark, sf_dir):
    return fx.enriched(spark, sf_dir).select(
        "icao24", "snapshot_ts", "event_time", "time_window", "flight_phase", "height",
        "x_ecef", "y_ecef", "z_ecef", "r_to_earth", "mach",
    )


@query
def ecef_points(spark, sf_dir):
    p = fx.enriched(spark, sf_dir)
    return p.select(
        "icao24", "snapshot_ts", "x_ecef", "y_ecef", "z_ecef", "r_to_earth",
        geo.prime_vertical_radius(F.col("latitude")).alias("prime_vertical"),
    )


@query
def ecef_stations(spark, sf_dir):
    return fx.enriched_stations(spark, sf_dir).select("station_id", "station_x", "station_y", "station_z")


@query
def mach_points(spark, sf_dir):
    h = F.col("height")
    return enrich.clean_points(fx.states(spark, sf_dir)).select(
        "icao24",
        "snapshot_ts",
        geo.isa_temperature(h).alias("temperature"),
        geo.speed_of_sound(h).alias("speed_of_sound"),
        geo.mach(F.col("velocity"), h).alias("mach"),
    )


@query
def flight_phase(spark, sf_dir):
    return enrich.clean_points(fx.states(spark, sf_dir)).select(
        "icao24", "snapshot_ts", geo.flight_phase(F.col("on_ground"), F.col("vertical_rate")).alias("flight_phase")
    )


@query
def minute_bucket(spark, sf_dir):
    return fx.states(spark, sf_dir).groupBy(geo.minute_bucket(F.col("snapshot_ts")).alias("minute")).agg(
        F.count("*").alias("points")
    )


@query
def nearest_station(spark, sf_dir):
    return fx.nearest(spark, sf_dir).select("icao24", "snapshot_ts", "station_id", "r_to_station")


@query
def q_nearest_station_window(spark, sf_dir):
    return nearest_station_window(fx.enriched(spark, sf_dir), fx.enriched_stations(spark, sf_dir)).select(
        "icao24", "snapshot_ts", "station_id", "r_to_station"
    )



@query
def nearest_crowded(spark, sf_dir):
    points, stations = fx.crowd(spark, sf_dir)
    return find_nearest(points, stations).select("icao24", "snapshot_ts", "station_id", "r_to_station")


@query
def point_station_distances(spark, sf_dir):
    return station_distance(fx.wide(spark, sf_dir), fx.enriched_stations(spark, sf_dir)).select(
        "icao24", "snapshot_ts", "station_id", "r_to_station", "station_distance"
    )


@query
def flight_points(spark, sf_dir):
    return fx.wide(spark, sf_dir)


# --- aggregates and reports ----------------------------------------------------------


@query
def dominant_station(spark, sf_dir):
    return marts.dominant_station(fx.wide(spark, sf_dir))


def _flights(spark, sf_dir):
    return marts.flights_agg(fx.stored_wide(spark, sf_dir), fx.AS_OF)


@query
def flights_agg(spark, sf_dir):
    return _flights(spark, sf_dir)


@query
def time_agg(spark, sf_dir):
    return reports.time_report(marts.time_agg(fx.wide(spark, sf_dir), fx.AS_OF))


@query
def top_flights_by_height(spark, sf_dir):
    return reports.top_flights(_flights(spark, sf_dir))


@query
def phase_distribution(spark, sf_dir):
    return reports.phase_distribution(fx.enriched(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return reports.run_summary(_flights(spark, sf_dir))


@query
def poll_summary(spark, sf_dir):
    arrivals = fx.arrivals(spark, sf_dir)
    return reports.poll_summary(arrivals, dedup_snapshots(arrivals))


@query
def map_positions(spark, sf_dir):
    return reports.map_positions(fx.enriched(spark, sf_dir))


@query
def traffic_by_minute(spark, sf_dir):
    return reports.traffic_by_minute(fx.enriched(spark, sf_dir))


def _parts(spark, sf_dir) -> DataFrame:
    """Parts of three loads, stored apart."""
    wide = fx.stored_wide(spark, sf_dir)
    loads = [fx.stored(partials.minute_partials(wide.where(F.expr(f"snapshot_ts div 20 % 3 = {i}")))) for i in range(3)]
    return reduce(DataFrame.unionByName, loads)


@query
def time_agg_merged(spark, sf_dir):
    """From parts of several loads, without going back to the points."""
    return partials.time_agg_of(_parts(spark, sf_dir), fx.AS_OF)


@query
def traffic_merged(spark, sf_dir):
    """Distinct aircraft over all phases and loads, from bitmaps."""
    return partials.traffic_of(_parts(spark, sf_dir))


@query
def traffic_by_hour(spark, sf_dir):
    return partials.traffic_of(_parts(spark, sf_dir), 3600)


@query
def traffic_by_country(spark, sf_dir):
    return reports.traffic_by_country(fx.enriched(spark, sf_dir))


@query
def traffic_by_station(spark, sf_dir):
    return reports.traffic_by_station(fx.wide(spark, sf_dir))


@query
def qc_ground_at_altitude(spark, sf_dir):
    return reports.ground_at_altitude(fx.enriched(spark, sf_dir)).select("icao24", "snapshot_ts", "height")


# --- quality -------------------------------------------------------------------------


@query
def dq_source(spark, sf_dir):
    stations = fx.stations(spark, sf_dir)
    clean = quality.source_checks(fx.states(spark, sf_dir), stations).unionByName(
        quality.rule_counts(stations, quality.geometry_rules())
    )
    faulty = quality.source_checks(fx.faulty_states(spark, sf_dir), stations)
    return clean.withColumn("input", F.lit("clean")).unionByName(faulty.withColumn("input", F.lit("faulty")))


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_keys(fx.arrivals(spark, sf_dir), ["icao24", "snapshot_ts"])


@query
def dq_target(spark, sf_dir):
    clean = enrich.clean_points(fx.states(spark, sf_dir))
    whole = quality.target_checks(clean, fx.stored_wide(spark, sf_dir))
    no_stations = fx.enriched_stations(spark, sf_dir).where(F.lit(False))
    lost = quality.target_checks(clean, fx.nearest_station(fx.enriched(spark, sf_dir), no_stations))
    return whole.withColumn("input", F.lit("stations")).unionByName(lost.withColumn("input", F.lit("no stations")))


@query
def dq_guards(spark, sf_dir):
    airports, states = fx.airports(spark, sf_dir), fx.states(spark, sf_dir)
    checks = [
        quality.guard(airports_in_region(airports, fx.BBOX), "stations_in_region"),
        quality.guard(airports_in_region(airports, NOWHERE), "stations_nowhere"),
        quality.guard(enrich.states_in_bbox(states, fx.BBOX), "points_in_region"),
        quality.guard(enrich.states_in_bbox(states, NOWHERE), "points_nowhere"),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2]).unionByName(checks[3])


@query
def dq_dimensions(spark, sf_dir):
    flights = quality.dim_flight_checks(fx.stored(_scd1(spark, sf_dir)))
    stations = quality.dim_station_checks(fx.stored(_scd2(spark, sf_dir)))
    return flights.withColumn("dimension", F.lit("flight")).unionByName(
        stations.withColumn("dimension", F.lit("station"))
    )


# --- dimensions ----------------------------------------------------------------------


@query
def dim_flight_input(spark, sf_dir):
    return dims.flight_dimension_input(fx.sightings(spark, sf_dir))


@query
def dim_station_input(spark, sf_dir):
    return dims.station_dimension_input(fx.stations(spark, sf_dir))


def _scd1(spark, sf_dir):
    points = fx.sightings(spark, sf_dir)
    new = dims.flight_dimension_input(points.where("origin_country < 'NATION_2'"))
    return dims.scd1_upsert(fx.previous_dim_flight(points), new, "icao24", fx.AS_OF)


@query
def scd1_flight(spark, sf_dir):
    return _scd1(spark, sf_dir)


@query
def scd1_whole_load(spark, sf_dir):
    points = fx.sightings(spark, sf_dir)
    return dims.scd1_upsert(fx.previous_dim_flight(points), dims.flight_dimension_input(points), "icao24", fx.AS_OF)


@query
def scd1_newest(spark, sf_dir):
    """A load that holds older sightings as well; those leave the dimension as it is."""
    points = fx.sightings(spark, sf_dir)
    old = fx.previous_dim_flight(points)
    new = dims.flight_dimension_input(points.where("origin_country < 'NATION_2'"))
    return dims.scd1_upsert(old, dims.newer_sightings(old, new), "icao24", fx.AS_OF)


def _scd2(spark, sf_dir):
    new = dims.station_dimension_input(fx.stations(spark, sf_dir))
    return dims.scd2_apply(fx.previous_dim_station(spark, sf_dir), new, as_of=fx.AS_OF)


def _readable(dim: DataFrame) -> DataFrame:
    """Validity as text: the open end lies outside the range of common timestamp types."""
    text = dim.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("valid_from", "valid_to")})
    # how new versions are numbered is left open; ``station_numbers`` checks what is promised
    return text.withColumn("station_sk", F.when(F.col("valid_from") != "2024-06-01 00:00:00", F.col("station_sk")))


@query
def station_numbers(spark, sf_dir):
    """New surrogate keys: dense, unique and above all old ones."""
    dim = _scd2(spark, sf_dir)
    old = dim.where(F.col("valid_from") != F.lit(fx.AS_OF)).agg(F.max("station_sk").alias("top"))
    new = dim.where(F.col("valid_from") == F.lit(fx.AS_OF)).agg(
        F.count("*").alias("opened"),
        F.countDistinct("station_sk").alias("numbers"),
        F.min("station_sk").alias("low"),
        F.max("station_sk").alias("high"),
    )
    return new.withColumn("top", old.scalar()).select(
        "opened", "numbers", (F.col("low") - F.col("top")).alias("first_step"), (F.col("high") - F.col("top")).alias("last_step")
    )


@query
def scd2_station(spark, sf_dir):
    return _readable(_scd2(spark, sf_dir))


@query
def new_stations(spark, sf_dir):
    new = dims.station_dimension_input(fx.stations(spark, sf_dir))
    return dims.new_keys(fx.previous_dim_station(spark, sf_dir), new, "station_id").select("station_id", "name")


@query
def vanished_stations(spark, sf_dir):
    new = dims.station_dimension_input(fx.stations(spark, sf_dir))
    return dims.vanished_keys(fx.previous_dim_station(spark, sf_dir), new, "station_id").select("station_id", "name")


@query
def dim_station_current(spark, sf_dir):
    """What lookups read after a load: the open versions, without the archive beside them."""
    path, before = scratch_path(spark, "dim"), fx.previous_dim_station(spark, sf_dir)
    history.write_history(dims.current(before), before.where("NOT is_current"), path)
    after = _scd2(spark, sf_dir)
    history.write_history(dims.current(after), after.where("NOT is_current").join(history.read_closed(spark, path, DIM_STATION), "station_sk", "left_anti").select(*after.columns), path)
    return _readable(history.read_open(spark, path, DIM_STATION))


# --- stores --------------------------------------------------------------------------


@query
def fact_projection(spark, sf_dir):
    return versions.fact_projection(fx.wide(spark, sf_dir))


@query
def fact_latest(spark, sf_dir):
    store = fx.fact_store(spark, sf_dir)
    return versions.latest(store, FACT_KEY).drop("load_seq", "month")


@query
def flights_agg_latest(spark, sf_dir):
    path = scratch_path(spark, "flights")
    flights = fx.stored(_flights(spark, sf_dir))
    again = flights.where("total_points >= 5").withColumns(
        {"event_ts": F.lit(fx.SECOND_AS_OF), "total_points": F.col("total_points") + 1}
    )
    files.append_facts(flights, path, "first_seen", FLIGHTS_KEY, 1)
    files.append_facts(again, path, "first_seen", FLIGHTS_KEY, 2)
    return versions.current_facts(files.read_store(spark, path, FLIGHTS_AGG), FLIGHTS_KEY, "first_seen", fx.AS_OF)


@query
def time_agg_latest(spark, sf_dir):
    path = scratch_path(spark, "minutes")
    minutes = fx.stored(marts.time_agg(fx.wide(spark, sf_dir), fx.AS_OF))
    again = minutes.where("flight_phase = 'climb'").withColumns(
        {"event_ts": F.lit(fx.SECOND_AS_OF), "points_in_window": F.col("points_in_window") + 1}
    )
    files.append_facts(minutes, path, "time_window", TIME_KEY, 1)
    files.append_facts(again, path, "time_window", TIME_KEY, 2)
    return versions.current_facts(files.read_store(spark, path, TIME_AGG), TIME_KEY, "time_window", fx.AS_OF)


@query
def retention(spark, sf_dir):
    store = fx.fact_store(spark, sf_dir)
    return versions.retain(store, "snapshot_time", fx.RETENTION_AS_OF).select(
        "icao24", "snapshot_time", "load_seq", "velocity"
    )


def _obt(spark, sf_dir, as_of, between=None):
    store = fx.fact_store(spark, sf_dir, between)
    points = fx.stored_wide(spark, sf_dir)
    return versions.obt_view(store, fx.previous_dim_flight(points), fx.previous_dim_station(spark, sf_dir), as_of)


@query
def obt_view(spark, sf_dir):
    return _obt(spark, sf_dir, fx.AS_OF)


@query
def obt_view_unexpired(spark, sf_dir):
    return _obt(spark, sf_dir, fx.RETENTION_AS_OF)


@query
def obt_view_range(spark, sf_dir):
    return _obt(spark, sf_dir, fx.AS_OF, fx.SOME_MINUTES)


@query
def fact_latest_unexpired(spark, sf_dir):
    return versions.current_facts(fx.fact_store(spark, sf_dir), FACT_KEY, "snapshot_time", fx.RETENTION_AS_OF)


# --- the whole day -------------------------------------------------------------------


def _day(spark, sf_dir) -> str:
    root = scratch_path(spark, "day")
    files.write_csv(fx.airports(spark, sf_dir), f"{root}/airports.csv")
    before = fx.previous_dim_station(spark, sf_dir)
    history.write_history(dims.current(before), before.where("NOT is_current"), f"{root}/dim_station")
    daily.load_day(spark, fx.landing(spark, sf_dir), f"{root}/airports.csv", root, DAY, fx.BBOX)
    daily.run_day(spark, root, DAY, fx.AS_OF, load_seq=1)
    return root


@query
def daily_run(spark, sf_dir):
    """Landed files to the curated day."""
    return spark.read.parquet(f"{_day(spark, sf_dir)}/curated/flight_points").drop("date")


@query
def daily_run_tables(spark, sf_dir):
    """Rows of every table that the run leaves behind."""
    root = _day(spark, sf_dir)
    facts = files.read_store(spark, f"{root}/fact_flight_points", FACTS)
    flights = files.read_store(spark, f"{root}/flights_agg", FLIGHTS_AGG)
    minutes = files.read_store(spark, f"{root}/time_agg", TIME_AGG)
    tables = {
        "facts": versions.current_facts(facts, FACT_KEY, "snapshot_time", fx.AS_OF),
        "flights": versions.current_facts(flights, FLIGHTS_KEY, "first_seen", fx.AS_OF),
        "minutes": versions.current_facts(minutes, TIME_KEY, "time_window", fx.AS_OF),
        "dim_flight": buckets.read_buckets(spark, f"{root}/dim_flight", DIM_FLIGHT),
        "dim_station": history.read_history(spark, f"{root}/dim_station", DIM_STATION),
        "open_stations": history.read_open(spark, f"{root}/dim_station", DIM_STATION),
    }
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


# --- streams -------------------------------------------------------------------------


def _drain(writer, spark, checkpoint=None) -> None:
    stream = writer.option("checkpointLocation", checkpoint or scratch_path(spark, "stream")).trigger(availableNow=True).start()
    stream.awaitTermination()


def _ingest(spark, sf_dir, *steps, max_files=None, path=None) -> str:
    path = path or scratch_path(spark, "ingested")
    payloads = ingest.landed_payloads(spark, fx.landing(spark, sf_dir), max_files)
    _drain(ingest.ingest(payloads, path, *steps), spark)
    return path


@query
def stream_ingest(spark, sf_dir):
    return ingest.ingested_states(spark, _ingest(spark, sf_dir, max_files=3))


@query
def stream_refused(spark, sf_dir):
    """Lines that a stream sets aside."""
    source, path = scratch_path(spark, "damaged"), scratch_path(spark, "ingested")
    fx.damaged_payloads(spark, sf_dir).write.text(source)
    _drain(ingest.ingest(ingest.landed_payloads(spark, source), path), spark)
    return ingest.refused_lines(spark, path).groupBy("rule").agg(F.count("*").alias("rows"))


@query
def stream_time_agg(spark, sf_dir):
    path, store = scratch_path(spark, "ingested"), scratch_path(spark, "minutes")
    _ingest(spark, sf_dir, ingest.minute_step(path, store, as_of=fx.AS_OF), max_files=3, path=path)
    minutes = versions.current_facts(files.read_store(spark, store, TIME_AGG), TIME_KEY, "time_window", fx.AS_OF)
    return minutes.drop("event_ts", "avg_r_to_station")


@query
def stream_nearest(spark, sf_dir):
    out = scratch_path(spark, "located")

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    path = scratch_path(spark, "ingested")
    _ingest(spark, sf_dir, ingest.nearest_step(path, fx.enriched_stations(spark, sf_dir), sink), max_files=3, path=path)
    return spark.read.parquet(out).select("icao24", "snapshot_ts", "station_id", "r_to_station")


@query
def stream_upsert(spark, sf_dir):
    """On top of a daily version, with batches that land out of order: each third is one batch."""
    dim, source, path, state = (scratch_path(spark, n) for n in ("dim", "landing", "ingested", "stream"))
    buckets.replace_buckets(fx.previous_dim_flight(fx.sightings(spark, sf_dir)), dim, "icao24")
    lines = fx.payloads(spark, sf_dir).withColumn("part", F.expr("(snapshot_ts div 20) % 90 div 30"))
    for part in (2, 0, 1):
        lines.where(F.col("part") == part).select("value").write.text(f"{source}/{part}")
        _drain(ingest.ingest(ingest.landed_payloads(spark, source), path, ingest.upsert_step(dim, fx.AS_OF)), spark, state)
    return buckets.read_buckets(spark, dim, DIM_FLIGHT)

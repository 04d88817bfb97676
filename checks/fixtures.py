"""Flight data derived from the driver tables with Spark.

Every event becomes one track point and every supplier one airport, so the fixture grows
with the tables. ``checks/oracle.py`` states the same derivation in SQL.

Fifty consecutive events form one snapshot, ninety snapshots (half an hour) one run with a
fleet of its own; (aircraft, snapshot) is therefore unique and the fleet grows with the data.
One aircraft flies in every snapshot and has many times the points of any other.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.operators.dimensions import flight_dimension_input
from trackmart.operators.enrich import clean_points, enrich_points, enrich_stations, flight_points
from trackmart.operators.nearest import nearest_station
from trackmart.operators.versions import fact_projection
from trackmart.runtime import scratch_path
from trackmart.schemas import FACT_KEY, FACTS
from trackmart.sources.files import append_facts, read_store
from trackmart.sources.stations import STATION_TYPES, stations_from_airports

BBOX = {"lamin": 50.0, "lomin": 4.0, "lamax": 53.0, "lomax": 11.0}
AS_OF = datetime(2024, 6, 1, tzinfo=timezone.utc)
SECOND_AS_OF = datetime(2024, 6, 1, 1, tzinfo=timezone.utc)
SOME_MINUTES = (datetime(2024, 1, 1, 0, 3, tzinfo=timezone.utc), datetime(2024, 1, 1, 0, 8, tzinfo=timezone.utc))
RETENTION_AS_OF = datetime(2025, 1, 1, 0, 5, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "1704067200 + (event_id div 50) * 20 AS snapshot_ts",
        """CASE WHEN event_id % 50 = 7 THEN 'ffffff'
           ELSE lpad(lower(hex(((event_id div 4500) * 50 + event_id % 50) % 16777215)), 6, '0') END AS icao24""",
        """CASE event_id % 50 WHEN 13 THEN NULL WHEN 17 THEN '        '
           ELSE concat('  CS', event_id % 40 + CASE WHEN event_type = 'signup' THEN 100 ELSE 0 END, '  ')
           END AS callsign""",
        "concat('NATION_', event_id % 25) AS origin_country",
        "1704067199 + (event_id div 50) * 20 AS time_position",
        "1704067199 + (event_id div 50) * 20 AS last_contact",
        "CASE WHEN event_id % 101 <> 0 THEN 4 + (event_id * 104729 % 70001) / 1e4D END AS longitude",
        "CASE WHEN event_id % 97 <> 0 THEN 50 + (event_id * 7919 % 30001) / 1e4D END AS latitude",
        "CASE WHEN event_id % 7 <> 0 THEN (event_id * 37 % 40001) * 0.3048D END AS baro_altitude",
        "CASE WHEN event_id % 53 <> 0 THEN event_type = 'view' END AS on_ground",
        "CASE WHEN event_id % 89 <> 0 THEN value * 0.514444D END AS velocity",
        "CASE WHEN event_id % 29 <> 0 THEN (event_id * 17 % 3600) / 10D END AS true_track",
        "CASE WHEN event_id % 11 <> 0 THEN (event_id % 41 - 20) * 0.5D END AS vertical_rate",
        "CASE WHEN event_id % 5 <> 0 THEN ((event_id * 31 % 43001) - 150) * 0.3048D END AS geo_altitude",
        "lpad(CAST(event_id % 8000 AS STRING), 4, '0') AS squawk",
        "event_type = 'error' AS spi",
        "CAST(event_id % 4 AS INT) AS position_source",
        "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 20 AS INT) END AS category",
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States as polled: every third snapshot is delivered again, with other speeds."""
    number = F.expr("(snapshot_ts - 1704067200) div 20")
    first = states(spark, sf_dir).withColumn("arrival", 2 * number)
    again = (
        states(spark, sf_dir)
        .where(number % 3 == 0)
        .withColumns({"arrival": 2 * number + 1, "velocity": F.col("velocity") + 5})
    )
    return first.unionByName(again)


def faulty_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As polled, with missing addresses and negative speeds."""
    return arrivals(spark, sf_dir).withColumns(
        {
            "icao24": F.when(F.col("spi") & F.col("on_ground").isNull(), None).otherwise(F.col("icao24")),
            "velocity": F.when(F.col("spi"), -F.col("velocity")).otherwise(F.col("velocity")),
        }
    )


def payload_lines(polls: DataFrame) -> DataFrame:
    """One line of JSON per poll: 17 or 18 positions, a list of receivers at 12."""
    quoted = [F.when(F.col(c).isNotNull(), F.concat(F.lit('"'), c, F.lit('"'))) for c in ("icao24", "callsign", "origin_country")]
    before = [F.col(c).cast("string") for c in (
        "time_position", "last_contact", "longitude", "latitude", "baro_altitude", "on_ground",
        "velocity", "true_track", "vertical_rate")]
    receivers = F.when(F.col("on_ground"), F.lit("[7,11]"))
    squawk = F.concat(F.lit('"'), "squawk", F.lit('"'))
    after = [F.col(c).cast("string") for c in ("spi", "position_source")]
    values = [*quoted, *before, receivers, F.col("geo_altitude").cast("string"), squawk, *after]
    vector = F.concat_ws(",", *[F.coalesce(v, F.lit("null")) for v in values])
    with_category = F.concat(F.lit("["), vector, F.coalesce(F.concat(F.lit(","), F.col("category").cast("string")), F.lit("")), F.lit("]"))
    return (
        polls.groupBy("snapshot_ts", "arrival")
        .agg(F.array_join(F.collect_list(with_category), ",").alias("vectors"))  # 50 per poll
        .select(
            "snapshot_ts",
            "arrival",
            F.concat(F.lit('{"time":'), F.col("snapshot_ts").cast("string"), F.lit(',"states":['), "vectors", F.lit("]}")).alias("value")
        )
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot polled once."""
    return payload_lines(states(spark, sf_dir).withColumn("arrival", F.lit(0)))


def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some break off and some have lost their time."""
    number = "(snapshot_ts - 1704067200) div 20"
    return payloads(spark, sf_dir).selectExpr(
        f"""CASE WHEN {number} % 7 = 3 THEN left(value, length(value) - 5)
             WHEN {number} % 11 = 4 THEN replace(value, '"time":', '"when":') ELSE value END AS value"""
    )


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Landed payload files. Every third snapshot is polled again, with other speeds: every
    other time in the next line of its file, else in a file that lands later."""
    path = scratch_path(spark, "landing")
    lines = payload_lines(arrivals(spark, sf_dir)).withColumn("number", F.expr("arrival div 2"))
    late = F.expr("arrival % 2 = 1 AND number % 2 = 1")
    for name, part in (("1", lines.where(~late)), ("2", lines.where(late))):
        ordered = part.repartitionByRange(4, "number").sortWithinPartitions("arrival")
        ordered.select("value").write.text(f"{path}/{name}")
    return path


def crowd(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Points three kilometres above one village that holds all stations."""
    sites = table(spark, sf_dir, "supplier").selectExpr(
        "concat('V', lpad(CAST(s_suppkey AS STRING), 8, '0')) AS station_id",
        "s_name AS name",
        "'large_airport' AS station_type",
        "52 + (s_suppkey * 7907 % 10007) / 1e6D AS lat",
        "6 + (s_suppkey * 5003 % 15013) / 1e6D AS lon",
        "CAST(s_suppkey % 30 AS DOUBLE) AS h",
    )
    above = states(spark, sf_dir).selectExpr(
        "icao24", "snapshot_ts", "52 + (snapshot_ts * 7919 + position_source * 911) % 10007 / 1e6D AS latitude",
        "6 + (snapshot_ts * 104729 + conv(icao24, 16, 10) * 31) % 15013 / 1e6D AS longitude",
        "CAST(3000 + conv(icao24, 16, 10) % 20 AS DOUBLE) AS height", "coalesce(velocity, 0D) AS velocity",
        "coalesce(vertical_rate, 0D) AS vertical_rate", "on_ground",
    )
    return enrich_points(above), enrich_stations(sites)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport file; it carries columns nobody asked for."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey",
        "s_acctbal",
        "concat('ST', lpad(CAST(s_suppkey AS STRING), 8, '0')) AS ident",
        """CASE s_nationkey % 3 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport'
           ELSE 'small_airport' END AS type""",
        "s_name AS name",
        "49.5D + (s_suppkey * 7907 % 40001) / 1e4D AS latitude_deg",
        "3.5D + (s_suppkey * 5003 % 80001) / 1e4D AS longitude_deg",
        "CASE WHEN s_suppkey % 17 <> 3 THEN CAST(s_suppkey * 37 % 5000 - 100 AS DOUBLE) END AS elevation_ft",
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations_from_airports(airports(spark, sf_dir), BBOX)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_points(clean_points(states(spark, sf_dir)))


def enriched_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_stations(stations(spark, sf_dir))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_station(enriched(spark, sf_dir), enriched_stations(spark, sf_dir))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight_points(nearest(spark, sf_dir), AS_OF)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once and read back, as the daily run does with what it reads again."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_KEPT: dict[tuple[str, str, str], DataFrame] = {}


def kept(name: str, spark: SparkSession, sf_dir: str, make) -> DataFrame:
    """An input of several queries, made once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT:
        _KEPT[key] = stored(make())
    return _KEPT[key]


def stored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept("wide", spark, sf_dir, lambda: wide(spark, sf_dir))


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the wide table the flight dimension needs; no station is looked up."""
    return enriched(spark, sf_dir).withColumn("callsign", F.trim("callsign"))


def previous_dim_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station dimension before the run: a wider region, some stations not yet known,
    some surveyed at another height, and closed versions of a few."""
    known = airports(spark, sf_dir).where(
        (F.col("s_acctbal") >= 0)
        & (F.col("s_suppkey") % 5 != 0)
        & F.col("type").isin(STATION_TYPES)
        & F.col("elevation_ft").isNotNull()
    )
    base = known.select(
        (F.col("s_suppkey") + 1).alias("station_sk"),
        F.col("ident").alias("station_id"),
        "name",
        F.col("type").alias("station_type"),
        F.col("latitude_deg").alias("lat"),
        F.col("longitude_deg").alias("lon"),
        F.expr("round(elevation_ft * 0.3048D, 1) + CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END").alias("h"),
        F.timestamp_seconds(F.lit(1704067200)).alias("valid_from"),
        F.lit("9999-12-31 23:59:59").cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        "s_acctbal",
    )
    closed = base.where("s_acctbal > 8000").withColumns(
        {
            "station_sk": F.col("station_sk") + 1000000000,
            "h": F.col("h") + 2,
            "valid_from": F.timestamp_seconds(F.lit(1672531200)),
            "valid_to": F.timestamp_seconds(F.lit(1704067200)),
            "is_current": F.lit(False),
        }
    )
    return base.unionByName(closed).drop("s_acctbal")


def previous_dim_flight(points: DataFrame) -> DataFrame:
    """The flight dimension before the run: some countries, as last seen on the ground."""
    seen = points.where((F.col("flight_phase") == "ground") & (F.col("origin_country") > "NATION_12"))
    return flight_dimension_input(seen).withColumn("updated_at", F.timestamp_seconds(F.lit(1704067200)))


def fact_loads(spark: SparkSession, sf_dir: str) -> str:
    """A fact store after three loads, made once per session. The third has the second's version
    stamp, and every row twice."""
    key = (spark.sparkContext.applicationId, sf_dir, "facts")
    if key not in _LOADS:
        path = scratch_path(spark, "facts")
        facts = fact_projection(stored_wide(spark, sf_dir))
        second = facts.withColumn("event_ts", F.lit(SECOND_AS_OF))
        third = second.where("flight_phase = 'descent'").withColumn("velocity", F.col("velocity") + 2)
        append_facts(facts, path, "snapshot_time", FACT_KEY, 1, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
        append_facts(
            second.where("flight_phase <> 'cruise'").withColumn("velocity", F.col("velocity") + 1),
            path, "snapshot_time", FACT_KEY, 2,
        )
        append_facts(third.unionByName(third), path, "snapshot_time", FACT_KEY, 3)
        _LOADS[key] = path
    return _LOADS[key]


_LOADS: dict[tuple[str, str, str], str] = {}


def fact_store(spark: SparkSession, sf_dir: str, between: tuple[datetime, datetime] | None = None) -> DataFrame:
    return read_store(spark, fact_loads(spark, sf_dir), FACTS, "snapshot_time", between)

import pytest
from pyspark.sql import functions as F

from trackmart.operators import quality
from trackmart.schemas import STATES, STATIONS


def row(icao24, ts=1, velocity=1.0):
    values = dict(icao24=icao24, snapshot_ts=ts, velocity=velocity)
    return tuple(values.get(c) for c in STATES.names)


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(
        [("S1", "n", "large_airport", 1.0, 1.0, 1.0), (None, "m", "large_airport", None, 1.0, 1.0)], STATIONS
    )


def test_source_rules_count_and_order(spark, stations):
    bad = spark.createDataFrame(
        [row("a"), row("a"), row("a"), row("b"), row("b"), row(None), row("c", velocity=-1.0), row("d", velocity=None),
         row("e", velocity=float("nan"))],
        STATES,
    )
    found = quality.run_checks(quality.source_checks(bad, stations))
    assert found == [
        ("states_icao24_null", 1),
        ("states_velocity_negative", 1),
        ("states_point_repeated", 2),
        ("stations_id_null", 1),
    ]
    with pytest.raises(quality.DataQualityError, match="states_icao24_null") as error:
        quality.require(found)
    assert len(error.value.violations) == 4


def test_clean_source_passes(spark, stations):
    good = spark.createDataFrame([row("a"), row("a", ts=2), row("b", velocity=0.0)], STATES)
    quality.require(quality.run_checks(quality.source_checks(good, stations.where("station_id = 'S1'"))))


def test_geometry_rule_is_advisory(stations):
    assert quality.run_rules(stations, quality.geometry_rules()) == [("stations_geometry_null", 1)]


def test_target_rules(spark):
    clean = spark.range(5)
    points = spark.range(4).select(F.when(F.col("id") > 0, F.lit("S")).alias("station_id"))
    assert quality.run_checks(quality.target_checks(clean, points)) == [
        ("points_count_changed", 1),
        ("points_station_null", 1),
    ]
    assert quality.run_checks(quality.target_checks(clean, points.where("false"))) == [("points_count_changed", 5)]


def test_payload_rule(spark):
    lines = ['{"time":1,"states":[["a"],["b"]]}', '{"time":2,"states":[["a"],["a"]]}', '{"time":3,"states":null}', '{"time":4}']
    raw = spark.createDataFrame([(v,) for v in lines], "value string")
    assert quality.run_rules(raw, quality.payload_rules()) == [("payload_aircraft_repeated", 1)]


def test_dimension_rules(spark):
    dim = spark.createDataFrame(
        [("abcdef", "C" * 17, "x", None), ("abcdefg", "c", "x", None), ("abcdefg", "c", "x", None)],
        "icao24 string, callsign string, origin_country string, updated_at timestamp",
    )
    assert dict(quality.run_checks(quality.dim_flight_checks(dim))) == {
        "icao24_too_long": 2, "callsign_too_long": 1, "icao24_repeated": 1,
    }


def test_require_rows(spark):
    quality.require_rows(spark.range(1), "nothing")
    with pytest.raises(quality.DataQualityError, match="nothing"):
        quality.require_rows(spark.range(0), "nothing")

from datetime import datetime, timezone

import pytest

from trackmart.operators.enrich import (
    clean_points,
    enrich_points,
    enrich_stations,
    flight_points,
    states_in_bbox,
)
from trackmart.operators.nearest import nearest_station
from trackmart.schemas import STATES, STATIONS

BASE = dict(
    snapshot_ts=1704067200, icao24="abc001", callsign="  AB1 ", latitude=51.0, longitude=6.0, velocity=100.0,
    geo_altitude=1000.0, on_ground=False, vertical_rate=0.0,
)


def states(spark, *rows):
    return spark.createDataFrame([tuple({**BASE, **r}.get(c) for c in STATES.names) for r in rows], STATES)


def test_clean_keeps_located_points_at_or_above_zero(spark):
    cleaned = clean_points(
        states(
            spark,
            dict(icao24="a1", geo_altitude=0.0),
            dict(icao24="a2", geo_altitude=-0.1),
            dict(icao24="a3", geo_altitude=None, baro_altitude=50.0),
            dict(icao24="a4", geo_altitude=None, baro_altitude=None),
            dict(icao24="a5", latitude=None),
            dict(icao24="a6", longitude=None),
            dict(icao24="a7", velocity=None),
            dict(icao24="a8", geo_altitude=None, baro_altitude=-5.0),
        )
    )
    assert {r.icao24: r.height for r in cleaned.collect()} == {"a1": 0.0, "a3": 50.0, "a4": 0.0}


def test_missing_vertical_rate_is_level_flight(spark):
    row = enrich_points(clean_points(states(spark, dict(vertical_rate=None, on_ground=None)))).first()
    assert (row.vertical_rate, row.flight_phase) == (0.0, "cruise")


def test_bbox_is_inclusive_and_drops_unplaced(spark):
    box = {"lamin": 50.0, "lomin": 4.0, "lamax": 53.0, "lomax": 11.0}
    kept = states_in_bbox(
        states(
            spark,
            dict(icao24="in1", latitude=50.0, longitude=4.0),
            dict(icao24="in2", latitude=53.0, longitude=11.0),
            dict(icao24="out", latitude=53.01),
            dict(icao24="nul", latitude=None),
        ),
        box,
    )
    assert sorted(r.icao24 for r in kept.collect()) == ["in1", "in2"]


def test_stations_without_geometry_are_dropped_and_ids_made_unique(spark):
    rows = [
        ("S1", "b", "large_airport", 50.0, 5.0, 10.0),
        ("S1", "a", "large_airport", 51.0, 5.0, 10.0),
        ("S2", "c", "large_airport", None, 5.0, 10.0),
        ("S3", "d", "large_airport", 50.0, 5.0, None),
    ]
    kept = enrich_stations(spark.createDataFrame(rows, STATIONS)).collect()
    assert [(r.station_id, r.name) for r in kept] == [("S1", "a")]


def test_wide_table_columns_and_trim(spark):
    stations = enrich_stations(spark.createDataFrame([("S1", "n", "large_airport", 51.0, 6.0, 30.0)], STATIONS))
    points = enrich_points(clean_points(states(spark, {}, dict(icao24="abc002", callsign="        "))))
    wide = flight_points(nearest_station(points, stations), datetime(2024, 6, 1, tzinfo=timezone.utc))
    rows = {r.icao24: r for r in wide.collect()}
    assert len(wide.columns) == 26
    assert rows["abc001"].callsign == "AB1" and rows["abc002"].callsign == ""
    assert rows["abc001"].station_name == "n"
    assert rows["abc001"].r_to_station == pytest.approx(970.0, abs=1e-3)


def test_null_filters_reach_the_scan(spark, tmp_path):
    states(spark, {}).write.parquet(str(tmp_path / "s"))
    plan = clean_points(spark.read.schema(STATES).parquet(str(tmp_path / "s"))).select("icao24", "height")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(latitude)" in text and "IsNotNull(velocity)" in text
    assert "squawk" not in text.split("ReadSchema")[1]

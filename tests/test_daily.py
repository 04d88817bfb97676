import json
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from trackmart.operators.quality import DataQualityError
from trackmart.operators.versions import latest, obt_view
from trackmart.plans import daily
from trackmart.schemas import DIM_FLIGHT, DIM_STATION, FACT_KEY, FACTS
from trackmart.runtime import checkpointed
from trackmart.sources.buckets import read_buckets
from trackmart.sources.files import read_states, read_stations, read_store, versions_of, write_day
from trackmart.sources.history import read_history

START = 1704067200
AS_OF = datetime(2024, 6, 1, tzinfo=timezone.utc)
DS = "2024-01-01"
AIRPORTS = (
    "ident,type,name,latitude_deg,longitude_deg,elevation_ft\n"
    "ST1,large_airport,One,51,6,100\nST2,medium_airport,Two,52,9,200\nST3,small_airport,Three,51,6,100\n"
)


def vector(icao24, lat, lon, velocity=100.0):
    return [icao24, f" {icao24} ", "X", 1, 1, lon, lat, 500.0, False, velocity, 0.0, 3.0, None, 500.0, None, False, 0]


def land(folder, name, t, *vectors):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"time": t, "states": vectors}))
    time.sleep(0.02)  # arrival order is file time


@pytest.fixture()
def root(tmp_path):
    (tmp_path / "airports.csv").write_text(AIRPORTS)
    landing = tmp_path / "landing"
    land(landing, "1.json", START, vector("a", 51.0, 6.1), vector("b", 52.0, 9.1), vector("out", 40.0, 9.0))
    land(landing, "2.json", START, vector("a", 51.0, 6.1, velocity=555.0))  # the same snapshot again
    land(landing, "3.json", START + 20, vector("a", 51.0, 6.2), vector("b", 52.0, 9.2))
    return tmp_path


def prepare(spark, root):
    daily.load_day(spark, str(root / "landing"), str(root / "airports.csv"), str(root), DS)


def test_whole_day_and_rerun(spark, root):
    prepare(spark, root)
    run = daily.run_day(spark, str(root), DS, AS_OF)
    assert run.points.count() == 4
    assert {(r.icao24, r.station_id) for r in run.points.collect()} == {("a", "ST1"), ("b", "ST2")}
    assert run.points.agg({"velocity": "max"}).first()[0] == 100.0
    assert run.summary.first().total_points == 4 and run.top.count() == 2
    assert [(r.flight_phase, r.pct) for r in run.phases.collect()] == [("climb", 100.0)]

    daily.run_day(spark, str(root), DS, AS_OF + timedelta(hours=1))
    facts = read_store(spark, str(root / "fact_flight_points"), FACTS)
    assert facts.count() == 8
    newest = latest(facts, FACT_KEY)
    assert newest.count() == 4 and {r.event_ts.hour for r in newest.collect()} == {1}
    assert spark.read.parquet(str(root / "curated/flight_points")).count() == 4
    stations = read_history(spark, str(root / "dim_station"), DIM_STATION)
    assert [(r.station_sk, r.is_current) for r in stations.orderBy("station_sk").collect()] == [(1, True), (2, True)]
    flights = read_buckets(spark, str(root / "dim_flight"), DIM_FLIGHT)
    view = obt_view(facts, flights, stations, AS_OF)
    assert len(view.columns) == 26
    assert {(r.callsign, r.station_name, r.station_type) for r in view.collect()} == {("a", "One", "large_airport"), ("b", "Two", "medium_airport")}


@pytest.mark.parametrize(
    "line,rule",
    [
        (json.dumps({"time": START + 40, "states": [vector("a", 51.0, 6.1), vector("a", 51.0, 6.1)]}), "payload_aircraft_repeated"),
        ('{"time": 17040', "payload_unreadable"),
        ('{"states": []}', "payload_time_missing"),
    ],
)
def test_wrong_lines_stop_the_load(spark, root, line, rule):
    (root / "landing" / "4.json").write_text(line)
    with pytest.raises(DataQualityError, match=rule):
        prepare(spark, root)


def test_failed_checks_leave_no_output(spark, root):
    prepare(spark, root)
    states = read_states(spark, str(root), DS)
    write_day(checkpointed(states.unionByName(states)), str(root / "states"), DS)
    with pytest.raises(DataQualityError, match="states_point_repeated"):
        daily.run_day(spark, str(root), DS, AS_OF)
    assert not (root / "curated").exists() and not (root / "fact_flight_points").exists()
    assert versions_of(spark, str(root / "dim_flight")) == []


def test_dimension_rows_against_the_rules_are_refused(spark, root):
    land(root / "landing", "4.json", START + 40, vector("c" * 7, 51.0, 6.1))
    prepare(spark, root)
    with pytest.raises(DataQualityError, match="icao24_too_long"):
        daily.run_day(spark, str(root), DS, AS_OF)
    assert versions_of(spark, str(root / "dim_flight")) == versions_of(spark, str(root / "dim_station")) == []


def test_a_station_that_loses_a_coordinate_stays_open(spark, root):
    prepare(spark, root)
    daily.run_day(spark, str(root), DS, AS_OF)
    stations = read_stations(spark, str(root), DS)
    lost = stations.withColumn("lat", F.when(F.col("station_id") != "ST2", F.col("lat")))
    write_day(checkpointed(lost), str(root / "stations"), DS)
    run = daily.run_day(spark, str(root), DS, AS_OF + timedelta(hours=1))
    dim = read_history(spark, str(root / "dim_station"), DIM_STATION)
    assert [(r.station_id, r.lat, r.is_current) for r in dim.orderBy("station_id").collect()] == [("ST1", 51.0, True), ("ST2", 52.0, True)]
    assert [(v.rule, v.rows) for v in run.advice] == [("stations_geometry_null", 1)]


def test_an_earlier_load_time_still_goes_on_from_the_newest_dimension(spark, root):
    prepare(spark, root)
    daily.run_day(spark, str(root), DS, AS_OF)
    (root / "airports.csv").write_text(AIRPORTS + "ST4,large_airport,Four,51.5,7,100\n")
    prepare(spark, root)
    daily.run_day(spark, str(root), DS, AS_OF - timedelta(days=1))
    dim = read_history(spark, str(root / "dim_station"), DIM_STATION)
    assert {r.station_id for r in dim.collect()} == {"ST1", "ST2", "ST4"}


def test_stations_close_into_an_archive_that_is_only_added_to(spark, root):
    def archived():
        return {p: p.stat().st_mtime_ns for p in (root / "dim_station" / "closed").rglob("part-*")}

    def run(airports, hours):
        (root / "airports.csv").write_text(airports)
        prepare(spark, root)
        daily.run_day(spark, str(root), DS, AS_OF + timedelta(hours=hours))
        dim = read_history(spark, str(root / "dim_station"), DIM_STATION)
        return [(r.station_sk, r.station_id, r.name, r.is_current) for r in dim.orderBy("station_sk").collect()]

    run(AIRPORTS, 0)
    renamed = AIRPORTS.replace("Two", "Deux")
    expected = [(1, "ST1", "One", True), (2, "ST2", "Two", False), (3, "ST2", "Deux", True)]
    assert run(renamed, 1) == expected
    before = archived()
    assert before and run(renamed, 2) == expected and archived() == before
    # the newest number was closed: the next one still lies above it
    assert run(AIRPORTS, 3)[-2:] == [(3, "ST2", "Deux", False), (4, "ST2", "Two", True)]
    assert before.items() < archived().items()


def test_expired_months_go(spark, root):
    prepare(spark, root)
    daily.run_day(spark, str(root), DS, AS_OF)
    assert read_store(spark, str(root / "fact_flight_points"), FACTS).count() == 4
    daily.run_day(spark, str(root), DS, AS_OF + timedelta(days=800))
    assert read_store(spark, str(root / "fact_flight_points"), FACTS).count() == 0


def test_stations_without_any_height_pass_loading_and_fail_the_target_check(spark, root):
    (root / "airports.csv").write_text("ident,type,name,latitude_deg,longitude_deg,elevation_ft\nST1,large_airport,One,51,6,\n")
    prepare(spark, root)
    with pytest.raises(DataQualityError, match="points_count_changed"):
        daily.run_day(spark, str(root), DS, AS_OF)
    assert not (root / "curated").exists()


def test_guards(spark, root):
    nowhere = {"lamin": -10.0, "lomin": 4.0, "lamax": -9.0, "lomax": 11.0}
    with pytest.raises(DataQualityError, match="no_stations_in_region"):
        daily.load_day(spark, str(root / "landing"), str(root / "airports.csv"), str(root), DS, nowhere)
    (root / "airports.csv").write_text(AIRPORTS + "ST9,large_airport,Nine,-9.5,5,10\n")
    with pytest.raises(DataQualityError, match="no_points_collected"):
        daily.load_day(spark, str(root / "landing"), str(root / "airports.csv"), str(root), DS, nowhere)


def test_command_line(spark, root):
    daily.main(
        ["--date", DS, "--data-dir", str(root), "--landing", str(root / "landing"), "--airports", str(root / "airports.csv"),
         "--bbox", '{"lamin": 50, "lomin": 4, "lamax": 53, "lomax": 11}', "--as-of", "2024-06-01",
         "--publish-to", str(root / "bucket")]
    )
    assert spark.read.parquet(str(root / "bucket/flight_points")).count() == 4

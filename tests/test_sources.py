import json
import time

import pytest

from trackmart.operators import quality
from trackmart.operators.quality import DataQualityError
from trackmart.schemas import AIRPORTS, STATES, STATIONS
from trackmart.sources import files, jdbc, snapshots
from trackmart.sources.snapshots import dedup_snapshots, parse_snapshots
from trackmart.sources.stations import read_airports, stations_from_airports

VECTOR = ["abc001", " AB1 ", "X", 1, 2, 6.5, 51, None, False, 100.25, 12, -2.5, [3, 4], 1000, "0021", True, 0]
BOX = {"lamin": 50.0, "lomin": 4.0, "lamax": 53.0, "lomax": 11.0}


def parse(spark, *lines):
    raw = spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in lines], "value string")
    return parse_snapshots(raw)


def test_vectors_of_any_length(spark):
    rows = parse(
        spark,
        {"time": 10, "states": [VECTOR, ["b"] + VECTOR[1:] + [5], ["c"] + VECTOR[1:] + [5, "surplus"], ["d", "short"]]},
    ).collect()
    by = {r.icao24: r for r in rows}
    assert [by[k].category for k in ("abc001", "b", "c", "d")] == [None, 5, 5, None]
    a = by["abc001"]
    assert a.snapshot_ts == 10 and a.callsign == " AB1 " and a.squawk == "0021"
    assert (a.latitude, a.geo_altitude, a.velocity, a.vertical_rate) == (51.0, 1000.0, 100.25, -2.5)
    assert a.on_ground is False and a.spi is True and a.position_source == 0 and a.baro_altitude is None
    assert by["d"].velocity is None


def test_schema_is_the_declared_one(spark):
    df = parse(spark, {"time": 1, "states": [VECTOR]})
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in STATES]


def test_no_states_no_rows(spark):
    assert parse(spark, '{"time": 1, "states": null}', '{"time": 2}', '{"time": 3, "states": []}').count() == 0


def test_unfit_values_become_null(spark):
    bad = list(VECTOR)
    bad[5], bad[9] = "east", "NaN"
    row = parse(spark, {"time": 1, "states": [bad]}).first()
    assert row.longitude is None and row.velocity is None


def test_first_arrival_wins_whole(spark):
    rows = [(1, "a", 1), (1, "b", 1), (1, "a", 2), (1, "c", 2), (2, "a", 3), (2, "a", 3)]
    df = spark.createDataFrame(rows, "snapshot_ts long, icao24 string, arrival long")
    kept = sorted((r.snapshot_ts, r.icao24) for r in dedup_snapshots(df).collect())
    assert kept == [(1, "a"), (1, "b"), (2, "a"), (2, "a")]  # a repeat inside one snapshot stays


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    values = dict(snapshot_ts=1, icao24="001234", callsign="        ", origin_country='say "hi", ok', squawk="0007", latitude=1.5)
    df = spark.createDataFrame([tuple(values.get(c) for c in STATES.names)], STATES)
    files.write_csv(df, str(tmp_path / "c"))
    assert files.read_csv(spark, str(tmp_path / "c"), STATES).collect() == df.collect()


def test_csv_from_elsewhere(spark, tmp_path):
    path = tmp_path / "states.csv"
    path.write_text("icao24,time_position,on_ground,extra,velocity,category\n000012,1704067199.0,True,x,NaN,3.0\n00e1,,False,y,7,\n")
    first, second = files.read_csv(spark, str(path), STATES_SUBSET).orderBy("icao24").collect()
    assert tuple(first) == ("000012", 1704067199, True, None, 3)
    assert tuple(second) == ("00e1", None, False, 7.0, None)


STATES_SUBSET = type(STATES)([STATES[c] for c in ("icao24", "time_position", "on_ground", "velocity", "category")])


def test_a_day_is_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "stations")
    rows = [("S%d" % i, "n", "large_airport", 1.0, 1.0, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, STATIONS)
    files.write_day(df, path, "2024-01-01")
    files.write_day(df, path, "2024-01-02")
    files.write_day(df.limit(2), path, "2024-01-01")
    one = files.read_day(spark, path, "2024-01-01", STATIONS)
    assert one.count() == 2 and files.read_day(spark, path, "2024-01-02", STATIONS).count() == 5
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()


def test_publish(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    files.write_day(spark.range(10), source, "2024-01-01")
    files.publish(spark, source, target, "2024-01-01")
    files.write_day(spark.range(3), source, "2024-01-01")
    files.publish(spark, source, target, "2024-01-01")
    assert spark.read.parquet(target).count() == 3
    with pytest.raises(DataQualityError, match="nothing_to_publish"):
        files.publish(spark, source, target, "2024-01-09")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.publish(spark, str(tmp_path / "nowhere"), target, "2024-01-01")
    assert spark.read.parquet(target).count() == 3


def test_published_day_is_replaced_whole(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    files.write_day(spark.range(3), source, "2024-01-01")
    files.publish(spark, source, target, "2024-01-01")
    files.write_day(spark.range(5), source, "2024-01-01")
    monkeypatch.setattr(files, "require_rows", lambda df, name: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        files.publish(spark, source, target, "2024-01-01")
    assert spark.read.parquet(target).count() == 3
    monkeypatch.undo()
    files.publish(spark, source, target, "2024-01-01")
    assert spark.read.parquet(target).count() == 5
    assert [p.name for p in (tmp_path / "target").iterdir() if p.is_dir()] == ["date=2024-01-01"]


def test_a_write_that_fails_leaves_the_published_day(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "source", str(tmp_path / "target")
    for ds, n in (("2024-01-01", 3), ("2024-01-02", 2)):
        files.write_day(spark.range(n), str(source), ds)
        files.publish(spark, str(source), target, ds)
    files.write_day(spark.range(50).repartition(5), str(source), "2024-01-01")
    part = sorted((source / "date=2024-01-01").glob("part-*"))[-1]
    part.write_bytes(part.read_bytes()[:20])
    monkeypatch.setattr(files, "require_rows", lambda df, name: None)
    with pytest.raises(Exception, match="part-"):
        files.publish(spark, str(source), target, "2024-01-01")
    found = {str(r.date): r["count"] for r in spark.read.parquet(target).groupBy("date").count().collect()}
    assert found == {"2024-01-01": 3, "2024-01-02": 2}


def test_versions(spark, tmp_path):
    path = str(tmp_path / "dim")
    schema = spark.range(1).schema
    assert files.read_version(spark, path, schema).count() == 0
    assert [files.write_version(spark.range(n), path, keep=2) for n in (1, 2)] == [1, 2]
    (tmp_path / "dim" / "version=3").mkdir()  # a write that never finished
    assert files.versions_of(spark, path) == [1, 2]
    assert files.read_version(spark, path, schema).count() == 2
    assert files.write_version(spark.range(3), path, keep=2) == 3
    assert files.versions_of(spark, path) == [2, 3] and files.read_version(spark, path, schema).count() == 3


def test_polls_are_ordered_by_file_and_line(spark, tmp_path):
    def line(time, velocity):
        return json.dumps({"time": time, "states": [["a", None, None, 1, 1, 1.0, 1.0, 1.0, False, velocity]]})

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "b.json").write_text("\n".join([line(1, 1.0), line(1, 2.0), line(2, 3.0)]))
    time.sleep(0.02)
    (landing / "a.json").write_text("\n".join([line(2, 4.0), line(3, 5.0)]))

    def speeds(**order):
        polls = snapshots.read_polls(spark, str(landing), **order)
        return {r.snapshot_ts: r.velocity for r in parse_snapshots(snapshots.first_polls(polls)).collect()}

    assert speeds() == {1: 1.0, 2: 3.0, 3: 5.0}
    assert speeds(by_name=True) == {1: 1.0, 2: 4.0, 3: 5.0}


def test_first_polls_are_chosen_before_states_are_parsed(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"time": 1, "states": []}')
    plan = snapshots.first_polls(snapshots.read_polls(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "from_json" not in plan


def test_broken_lines_are_counted(spark):
    lines = ['{"time": 1, "states": []}', '{"time": 1, "sta', "", "no", '{"states": []}', '{"time": "x"}']
    counts = quality.rule_counts(spark.createDataFrame([(x,) for x in lines], "value string"), quality.payload_rules())
    assert {r.rule: r.violations for r in counts.collect()} == {
        "payload_unreadable": 3, "payload_time_missing": 2, "payload_aircraft_repeated": 0,
    }


def test_airport_file(spark, tmp_path):
    path = tmp_path / "airports.csv"
    path.write_text(
        'id,ident,type,name,latitude_deg,longitude_deg,elevation_ft\n'
        '1,EDDK,large_airport,"Cologne ""CGN"", Bonn",50.0,4.0,302\n'
        '2,EHAM,large_airport,"Two\nlines",53.0,11.0,-11\n'
        '3,XXXX,medium_airport,No height,51,5,\n'
        '4,SMAL,small_airport,Small,51,5,10\n'
        '5,FARA,large_airport,Far,53.1,5,10\n'
    )
    airports = read_airports(spark, str(path))
    assert airports.columns == AIRPORTS.names
    rows = stations_from_airports(airports, BOX).orderBy("station_id").collect()
    assert [(r.station_id, r.name, r.h) for r in rows] == [("EDDK", 'Cologne "CGN", Bonn', 92.0), ("EHAM", "Two\nlines", -3.4)]


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:db://host/x", "t", user="u", password="p", batch_rows=5, connections=2)
    assert options == {"url": "jdbc:db://host/x", "dbtable": "t", "user": "u", "password": "p", "batchsize": "5", "numPartitions": "2"}


def test_jdbc_writes_go_to_the_right_table(monkeypatch):
    calls = []

    class Writer:
        def __getattr__(self, name):
            def call(*args, **kwargs):
                calls.append((name, args, kwargs))
                return self
            return call

    class Frame:
        write = Writer()

    jdbc.stage(Frame(), "jdbc:db://h/x", "dim_flight")
    jdbc.append(Frame(), "jdbc:db://h/x", "facts")
    tables = [kwargs["dbtable"] for name, _, kwargs in calls if name == "options"]
    modes = [args[0] for name, args, _ in calls if name == "mode"]
    assert tables == ["stg_dim_flight", "facts"] and modes == ["overwrite", "append"]

import json
import threading
import time
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.compare import DATA
from trackmart.operators.enrich import clean_points, enrich_points, enrich_stations
from trackmart.operators.marts import time_agg
from trackmart.operators.nearest import nearest_station
from trackmart.operators.versions import current_facts
from trackmart.plans import live
from trackmart.runtime import scratch_path
from trackmart.schemas import DIM_FLIGHT, STATIONS, TIME_AGG, TIME_KEY
from trackmart.sources.buckets import bucket_of, read_buckets, replace_buckets
from trackmart.sources.files import read_store, versions_of
from trackmart.sources.snapshots import parse_snapshots
from trackmart.streaming import ingest

START = 1704067200
AS_OF = datetime(2024, 6, 1, tzinfo=timezone.utc)


def vector(icao24, rate=0.0, callsign="C", velocity=100.0):
    return [icao24, callsign, "X", 1, 1, 6.0, 51.0, 500.0, False, velocity, 0.0, rate, None, 500.0, None, False, 0]


def land(folder, name, *snapshots):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"time": t, "states": v}) for t, v in snapshots))


def drain(writer, checkpoint):
    query = writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing"
    for i in range(12):
        snapshot = (START + i * 20, [vector("a"), vector("b", rate=5.0 if i % 2 else 0.0)])
        land(folder, f"f{i:02d}.json", *([snapshot, snapshot] if i % 3 == 0 else [snapshot]))
    land(folder, "f99.json", (START + 20, [vector("a"), vector("b", rate=5.0)]))  # polled again later
    return folder


def run(spark, landing, tmp_path, *steps, max_files=None, name="in"):
    path = str(tmp_path / name)
    payloads = ingest.landed_payloads(spark, str(landing), max_files)
    drain(ingest.ingest(payloads, path, *steps), tmp_path / f"{name}-state")
    return ingest.ingested_states(spark, path)


def unique(spark, landing):
    lines = spark.read.text(str(landing)).distinct()
    return parse_snapshots(lines).dropDuplicates(["icao24", "snapshot_ts"])


@pytest.mark.parametrize("max_files", [None, 1, 5])
def test_ingest_equals_batch_without_repeats(spark, landing, tmp_path, max_files):
    states = run(spark, landing, tmp_path, max_files=max_files)
    assert sorted(map(str, states.collect())) == sorted(map(str, unique(spark, landing).collect()))
    # nothing new has landed: a second run adds nothing
    assert run(spark, landing, tmp_path, max_files=max_files).count() == 24


@pytest.mark.parametrize("max_files", [None, 1])
def test_the_first_poll_of_a_snapshot_wins_whole(spark, tmp_path, max_files):
    landing = tmp_path / "landing"
    land(landing, "1.json", (START, [vector("a", velocity=1.0)]), (START, [vector("a", velocity=2.0), vector("b")]))
    time.sleep(0.02)
    land(landing, "2.json", (START, [vector("a", velocity=3.0), vector("c")]), (START + 20, [vector("a", velocity=4.0)]))
    states = run(spark, landing, tmp_path, max_files=max_files)
    assert {(r.icao24, r.snapshot_ts - START, r.velocity) for r in states.collect()} == {("a", 0, 1.0), ("a", 20, 4.0)}


def test_however_late_nothing_is_lost(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.json", (START + 7200, [vector("a")]))
    run(spark, landing, tmp_path)
    land(landing, "2.json", (START, [vector("a")]))
    assert run(spark, landing, tmp_path).count() == 2


def test_broken_lines_are_set_aside(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.json", (START, [vector("a")]))
    (landing / "2.json").write_text('{"time": 1, "st\n{"states": []}\n')
    assert run(spark, landing, tmp_path).count() == 1
    refused = ingest.refused_lines(spark, str(tmp_path / "in"))
    assert {r.rule for r in refused.collect()} == {"payload_unreadable", "payload_time_missing"}


def test_checks_of_a_batch_do_not_parse_it_again(spark, landing, tmp_path, monkeypatch):
    checked, run_rules = [], ingest.run_rules

    def recorded(df, rules):
        plan = df._jdf.queryExecution().executedPlan().toString()
        checked.append(("InMemoryTableScan" in plan, any("json" in str(r.broken) for r in rules)))
        return run_rules(df, rules)

    monkeypatch.setattr(ingest, "run_rules", recorded)
    run(spark, landing, tmp_path)
    assert checked == [(True, False)] * 2  # the lines, and the states


@pytest.mark.parametrize("max_files", [None, 2])
def test_minutes_equal_batch_to_the_last(spark, landing, tmp_path, max_files):
    store = str(tmp_path / "store")
    run(spark, landing, tmp_path, ingest.minute_step(str(tmp_path / "in"), store, as_of=AS_OF), max_files=max_files)
    found = current_facts(read_store(spark, store, TIME_AGG), TIME_KEY, "time_window", AS_OF)
    points = enrich_points(clean_points(unique(spark, landing))).withColumn("r_to_station", F.lit(None).cast("double"))
    assert sorted(map(str, found.collect())) == sorted(map(str, time_agg(points, AS_OF).collect()))


def test_nearest_equals_batch(spark, landing, tmp_path):
    stations = enrich_stations(
        spark.createDataFrame([("S1", "n", "large_airport", 51.0, 6.1, 0.0), ("S2", "n", "large_airport", 51.0, 5.0, 0.0)], STATIONS)
    )
    out = str(tmp_path / "out")

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    run(spark, landing, tmp_path, ingest.nearest_step(str(tmp_path / "in"), stations, sink), max_files=5)
    streamed = spark.read.parquet(out).select("icao24", "snapshot_ts", "station_id", "r_to_station")
    expected = nearest_station(enrich_points(clean_points(unique(spark, landing))), stations).select(streamed.columns)
    assert sorted(streamed.collect()) == sorted(expected.collect())


def test_upsert_goes_on_from_a_daily_version_in_any_order(spark, tmp_path):
    landing, dim = tmp_path / "landing", str(tmp_path / "dim")
    replace_buckets(spark.createDataFrame([("a", "DAY", "X", START + 10, None), ("d", "D", "X", 1, None)], DIM_FLIGHT), dim, "icao24")
    land(landing, "1.json", (START + 20, [vector("a", callsign=" TWO "), vector("c")]))
    time.sleep(0.02)
    land(landing, "2.json", (START, [vector("a", callsign="ONE"), vector("b")]))  # older, lands later
    run(spark, landing, tmp_path, ingest.upsert_step(dim, AS_OF), max_files=1)
    expected = {"a": "TWO", "b": "C", "c": "C", "d": "D"}
    assert {r.icao24: r.callsign for r in read_buckets(spark, dim, DIM_FLIGHT).collect()} == expected
    assert versions_of(spark, dim) == [1, 2, 3]
    # a stream that starts again from nothing repeats its batches and changes nothing
    run(spark, landing, tmp_path, ingest.upsert_step(dim, AS_OF), max_files=1, name="again")
    assert {r.icao24: r.callsign for r in read_buckets(spark, dim, DIM_FLIGHT).collect()} == expected


def test_an_upsert_opens_and_rewrites_only_the_buckets_it_changes(spark, tmp_path):
    landing, dim = tmp_path / "landing", str(tmp_path / "dim")
    many = spark.range(500).selectExpr("hex(id) AS icao24", "'OLD' AS callsign", "'X' AS origin_country", f"{START}L AS last_ts", "timestamp_seconds(0) AS updated_at")
    replace_buckets(many, dim, "icao24")

    def files():
        return {p for p in (tmp_path / "dim" / "rows").rglob("part-*")}

    before = files()
    land(landing, "1.json", (START + 20, [vector("1F", callsign="NEW"), vector("new")]), (START - 20, [vector("2A", callsign="OLDER")]))
    run(spark, landing, tmp_path, ingest.upsert_step(dim, AS_OF), max_files=1)
    keys = spark.createDataFrame([("1F",), ("new",)], "icao24 string")
    touched = {r[0] for r in keys.select(bucket_of("icao24")).collect()}
    assert before < files()
    assert {p.parent.name for p in files() - before} == {f"bucket={b}" for b in touched}
    found = {r.icao24: r.callsign for r in read_buckets(spark, dim, DIM_FLIGHT).collect()}
    assert len(found) == 501 and found["1F"] == "NEW" and found["2A"] == "OLD"
    opened = read_buckets(spark, dim, DIM_FLIGHT, sorted(touched)).inputFiles()
    assert {Path(f).parent.name for f in opened} == {f"bucket={b}" for b in touched}


def test_the_upsert_query_writes_its_landing_files_in_many_tasks(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: made.setdefault(name, scratch_path(spark, name)))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        queries.QUERIES["stream_upsert"](spark, f"{DATA}/sf0.01").collect()
    finally:
        spark.conf.set(coalesce, before)
    assert all(len(list(Path(made["landing"].removeprefix("file:"), part).glob("part-*"))) > 1 for part in "201")
    assert versions_of(spark, made["dim"]) == [1, 2, 3, 4]  # one batch a part, whatever its files


def test_a_repeated_aircraft_stops_the_stream(spark, tmp_path):
    landing, dim = tmp_path / "landing", str(tmp_path / "dim")
    land(landing, "1.json", (START, [vector("a"), vector("a")]))
    with pytest.raises(Exception, match="payload_aircraft_repeated"):
        run(spark, landing, tmp_path, ingest.upsert_step(dim, AS_OF))
    assert versions_of(spark, dim) == []


def test_streaming_job(spark, landing, tmp_path):
    stations, root = str(tmp_path / "stations"), str(tmp_path / "live")
    spark.createDataFrame([("S1", "n", "large_airport", 51.0, 6.1, 0.0)], STATIONS).write.parquet(stations)
    live.main(["--landing", str(landing), "--data-dir", root, "--stations", stations, "--max-files", "4"])
    assert ingest.ingested_states(spark, f"{root}/ingested").count() == 24
    assert read_buckets(spark, f"{root}/dim_flight", DIM_FLIGHT).count() == 2
    assert read_store(spark, f"{root}/time_agg", TIME_AGG).count() > 0


def test_a_poll_window_takes_what_lands_and_ends(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "in")
    land(landing, "1.json", (START, [vector("a")]))

    def start(trigger):
        writer = ingest.ingest(ingest.landed_payloads(spark, str(landing)), path).trigger(**trigger)
        return writer.option("checkpointLocation", str(tmp_path / "state")).start()

    later = threading.Timer(4, land, (landing, "2.json", (START + 20, [vector("a"), vector("b")])))
    later.start()
    began = time.time()
    ingest.run_for(start, "1 second", 8)
    later.join()
    assert ingest.ingested_states(spark, path).count() == 3
    assert 8 <= time.time() - began < 90 and not spark.streams.active


def test_a_batch_opens_the_snapshots_seen_once(spark, tmp_path, monkeypatch):
    plans = []

    def spy(df, *args):
        plans.append(df._jdf.queryExecution().toString())
        return broadcast_if_small(df, *args)

    broadcast_if_small = ingest.broadcast_if_small
    monkeypatch.setattr(ingest, "broadcast_if_small", spy)
    for name in ("1.json", "2.json"):
        land(tmp_path / "landing", name, (START, [vector("a")]), (START + 20 * int(name[0]), [vector("a")]))
        run(spark, tmp_path / "landing", tmp_path)
    assert len(plans) == 2 and not any("FileScan" in plan for plan in plans)
    assert ingest.ingested_states(spark, f"{tmp_path}/in").count() == 3

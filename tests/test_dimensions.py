import itertools
from datetime import datetime, timedelta, timezone

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trackmart.operators import dimensions as dims
from trackmart.schemas import DIM_FLIGHT, DIM_STATION, STATIONS

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T1 = datetime(2024, 6, 1, tzinfo=timezone.utc)


def naive(t):
    return t.replace(tzinfo=None)


def station(sid, name="n", h=1.0, lat=1.0, kind="large_airport"):
    return (sid, name, kind, lat, 2.0, h)


def load(spark, *rows):
    return spark.createDataFrame(list(rows), STATIONS)


def empty_dim(spark):
    return spark.createDataFrame([], DIM_STATION)


def apply(dim, new, as_of=T0):
    return dims.scd2_apply(dim, new, as_of=as_of)


def state(dim):
    return sorted((r.station_id, r.h, r.valid_from, r.is_current) for r in dim.collect())


@pytest.fixture(scope="module")
def first(spark):
    rows = [station("A"), station("B"), station("C"), station("D")]
    dim = apply(empty_dim(spark), load(spark, *rows)).cache()
    return spark.createDataFrame(dim.collect(), DIM_STATION)


def test_first_load_opens_everything(first):
    rows = first.collect()
    assert sorted(r.station_sk for r in rows) == [1, 2, 3, 4]
    assert all(r.is_current and r.valid_to == datetime(9999, 12, 31, 23, 59, 59) for r in rows)


def test_unchanged_changed_vanished_new(spark, first):
    new = load(spark, station("A"), station("B", h=9.0), station("C", h=None), station("E"))
    after = apply(first, new, T1).collect()
    by = {(r.station_id, r.is_current): r for r in after}
    assert len(after) == 6
    assert by["A", True].valid_from == naive(T0)
    assert by["B", False].valid_to == naive(T1) == by["B", True].valid_from and by["B", True].h == 9.0
    assert by["C", True].h == 1.0  # a change to null alone is not seen
    assert by["D", False].valid_to == naive(T1) and ("D", True) not in by
    assert sorted(r.station_sk for r in after) == [1, 2, 3, 4, 5, 6]


def test_same_input_again_changes_nothing(spark, first):
    new = load(spark, station("A"), station("B"), station("C"), station("D"))
    assert state(apply(first, new, T1)) == state(first)


def test_empty_input_closes_everything_and_reappearing_opens(spark, first):
    closed = apply(first, spark.createDataFrame([], STATIONS), T1)
    assert not any(r.is_current for r in closed.collect())
    back = apply(closed, load(spark, station("A")), T1 + timedelta(days=1)).where("station_id = 'A'").collect()
    assert sorted(r.is_current for r in back) == [False, True]


def test_current_new_and_vanished(spark, first):
    new = load(spark, station("A"), station("E"))
    assert [r.station_id for r in dims.new_keys(first, new, "station_id").collect()] == ["E"]
    assert sorted(r.station_id for r in dims.vanished_keys(first, new, "station_id").collect()) == ["B", "C", "D"]
    assert dims.current(first).count() == 4


THREE_STEPS = [
    """UPDATE dim SET valid_to = TIMESTAMP '2024-06-01', is_current = false FROM stg
       WHERE dim.station_id = stg.station_id AND dim.is_current
         AND (dim.lat <> stg.lat OR dim.lon <> stg.lon OR dim.h <> stg.h OR dim.name <> stg.name
              OR dim.station_type <> stg.station_type)""",
    """INSERT INTO dim SELECT NULL, s.station_id, s.name, s.station_type, s.lat, s.lon, s.h, TIMESTAMP '2024-06-01',
              TIMESTAMP '9999-12-31 23:59:59', true
       FROM stg s LEFT JOIN dim d ON d.station_id = s.station_id AND d.is_current WHERE d.station_id IS NULL""",
    """UPDATE dim SET valid_to = TIMESTAMP '2024-06-01', is_current = false
       WHERE is_current AND NOT EXISTS (SELECT 1 FROM stg WHERE stg.station_id = dim.station_id)""",
]

maybe = st.sampled_from([None, 1.0, 2.0])
loads = st.dictionaries(st.sampled_from("ABCDEF"), st.tuples(st.sampled_from([None, "n", "m"]), maybe, maybe), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=loads, new=loads)
def test_one_pass_equals_three_statements(spark, old, new):
    def rows(d):
        return [station(k, name=n, h=h, lat=lat) for k, (n, h, lat) in d.items()]

    dim = apply(empty_dim(spark), spark.createDataFrame(rows(old), STATIONS))
    dim = spark.createDataFrame(dim.collect(), DIM_STATION)
    staged = spark.createDataFrame(rows(new), STATIONS)
    ours = apply(dim, staged, T1)

    db = duckdb.connect()
    db.execute(
        "CREATE TABLE dim (station_sk BIGINT, station_id VARCHAR, name VARCHAR, station_type VARCHAR, lat DOUBLE, "
        "lon DOUBLE, h DOUBLE, valid_from TIMESTAMP, valid_to TIMESTAMP, is_current BOOLEAN)"
    )
    db.execute("CREATE TABLE stg AS SELECT station_id, name, station_type, lat, lon, h FROM dim")
    if old:
        db.executemany("INSERT INTO dim VALUES (?,?,?,?,?,?,?,?,?,?)", [tuple(r) for r in dim.collect()])
    if new:
        db.executemany("INSERT INTO stg VALUES (?,?,?,?,?,?)", [tuple(r) for r in staged.collect()])
    for step in THREE_STEPS:
        db.execute(step)

    key = lambda r: tuple(str(v) for v in r)
    expected = sorted((tuple(r[1:]) for r in db.execute("SELECT * FROM dim").fetchall()), key=key)
    found = ours.collect()
    assert sorted((tuple(r)[1:] for r in found), key=key) == expected
    assert len({r.station_sk for r in found}) == len(found)
    assert all(n == 1 for n in pd.Series([r.station_id for r in found if r.is_current]).value_counts())


def test_scd1_replaces_by_key(spark):
    schema = "icao24 string, callsign string, origin_country string, updated_at timestamp"
    dim = spark.createDataFrame([("a", "old", "X", naive(T0)), ("b", "old", "X", naive(T0))], schema)
    new = spark.createDataFrame([("a", "new", "Y"), ("c", None, "Z")], "icao24 string, callsign string, origin_country string")
    after = {r.icao24: (r.callsign, r.updated_at) for r in dims.scd1_upsert(dim, new, "icao24", T1).collect()}
    assert after == {"a": ("new", naive(T1)), "b": ("old", naive(T0)), "c": (None, naive(T1))}


def test_flight_input_takes_the_last_seen(spark):
    rows = [("a", "first", "X", 1), ("a", None, "X", 5), ("a", "mid", "X", 3), ("b", "only", "Y", 2)]
    points = spark.createDataFrame(rows, "icao24 string, callsign string, origin_country string, snapshot_ts long")
    found = {r.icao24: (r.callsign, r.last_ts) for r in dims.flight_dimension_input(points).collect()}
    assert found == {"a": (None, 5), "b": ("only", 2)}


def test_loads_in_any_order_end_in_one_dimension(spark):
    rows = [("a", "one", "X", 1), ("a", "two", "X", 2), ("b", None, "X", 1), ("b", "n", "X", 3), ("c", "z", None, 2), ("a", "old", "X", 0)]
    points = "icao24 string, callsign string, origin_country string, snapshot_ts long"
    results = set()
    for order in itertools.permutations(range(0, 6, 2)):
        dim = spark.createDataFrame([], DIM_FLIGHT)
        for start in [*order, order[0]]:  # one load comes twice
            new = dims.flight_dimension_input(spark.createDataFrame(rows[start : start + 2], points))
            dim = dims.scd1_upsert(dim, dims.newer_sightings(dim, new), "icao24", T1)
            dim = spark.createDataFrame(dim.collect(), DIM_FLIGHT)
        results.add(tuple(sorted((r.icao24, r.callsign, r.last_ts) for r in dim.collect())))
    assert results == {(("a", "two", 2), ("b", "n", 3), ("c", "z", 2))}


def test_station_input_is_one_row_per_id(spark):
    rows = dims.station_dimension_input(load(spark, station("A", name="z"), station("A", name="b"), station("B"))).collect()
    assert sorted((r.station_id, r.name) for r in rows) == [("A", "b"), ("B", "n")]


def test_numbers_are_dense_and_spread(spark):
    numbered = dims.number_rows(spark.range(5000).selectExpr("cast(id as string) AS k"), "k")
    assert sorted(r.number for r in numbered.collect()) == list(range(1, 5001))

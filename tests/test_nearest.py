import numpy as np
import pytest

from pyspark.sql import functions as F

from trackmart import runtime
from trackmart.operators import nearest
from trackmart.operators.enrich import enrich_points, enrich_stations
from trackmart.operators.nearest import candidate_lists, nearest_station, nearest_station_window

LIMITS = {"usual": {}, "short lists": dict(leaf_stations=6), "single": dict(leaf_stations=1)}


def make_points(spark, positions):
    rows = [(f"{i:06x}", 1704067200, float(la), float(lo), float(h), 100.0, 0.0, False) for i, (la, lo, h) in enumerate(positions)]
    schema = (
        "icao24 string, snapshot_ts long, latitude double, longitude double, height double, velocity double, "
        "vertical_rate double, on_ground boolean"
    )
    return enrich_points(spark.createDataFrame(rows, schema).repartition(4))


def make_stations(spark, positions, ids=None):
    ids = ids or [f"S{i:05d}" for i in range(len(positions))]
    rows = [(s, f"name {s}", "large_airport", float(la), float(lo), float(h)) for s, (la, lo, h) in zip(ids, positions)]
    return enrich_stations(
        spark.createDataFrame(rows, "station_id string, name string, station_type string, lat double, lon double, h double")
    )


def brute_force(points, stations):
    p = sorted(points.select("icao24", "x_ecef", "y_ecef", "z_ecef").collect())
    s = sorted(stations.select("station_id", "station_x", "station_y", "station_z").collect())
    ps, ss = np.array([r[1:] for r in p]), np.array([r[1:] for r in s])
    d = np.sqrt(((ps[:, None, :] - ss[None, :, :]) ** 2).sum(axis=2))
    return {r[0]: (s[k][0], d[i, k]) for i, (r, k) in enumerate(zip(p, d.argmin(axis=1)))}


def answer(df):
    return {r.icao24: (r.station_id, r.r_to_station) for r in df.collect()}


def agree(found, expected):
    assert found.keys() == expected.keys()
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    assert all(found[k][1] == pytest.approx(expected[k][1], abs=1e-6) for k in found)


def scattered(rng, n, box=(50, 53, 4, 11), top=13000):
    return np.column_stack([rng.uniform(box[0], box[1], n), rng.uniform(box[2], box[3], n), rng.uniform(0, top, n)])


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the stations crowds one village, another third shares one position, a
    third of the points sits on one spot; some points fly far away from all of it."""
    rng = np.random.default_rng(7)
    stations = np.vstack(
        [
            scattered(rng, 60, top=300),
            scattered(rng, 60, box=(52.0, 52.02, 6.0, 6.02), top=50),
            np.tile([51.0, 7.0, 40.0], (60, 1)),
        ]
    )
    points = np.vstack(
        [
            scattered(rng, 150),
            np.tile([52.011, 6.013, 900.0], (150, 1)),
            scattered(rng, 100, box=(52.0, 52.02, 6.0, 6.02), top=2000),
            scattered(rng, 60, box=(-90, 90, -180, 180), top=40000),
        ]
    )
    p, s = make_points(spark, points).cache(), make_stations(spark, stations).cache()
    return p, s, brute_force(p, s)


@pytest.mark.parametrize("limits", LIMITS)
def test_brute_force_answer(skewed, limits):
    points, stations, expected = skewed
    agree(answer(nearest_station(points, stations, **LIMITS[limits])), expected)


def test_shuffled_lookup_gives_the_same(skewed, monkeypatch):
    points, stations, expected = skewed
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 0)
    spark = points.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = nearest_station(points, stations, leaf_stations=6)
        agree(answer(found), expected)
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_window_form_gives_the_same(skewed):
    points, stations, expected = skewed
    agree(answer(nearest_station_window(points, stations)), expected)


def test_world_wide(spark):
    rng = np.random.default_rng(11)
    points = make_points(spark, np.vstack([scattered(rng, 300, box=(-90, 90, -180, 180)), [[90, 0, 0], [-90, 0, 0], [0, 180, 0], [0, -180, 10]]]))
    stations = make_stations(spark, scattered(rng, 150, box=(-90, 90, -180, 180), top=3000))
    expected = brute_force(points, stations)
    agree(answer(nearest_station(points, stations, leaf_stations=6)), expected)


def test_tie_goes_to_the_smaller_id(spark):
    stations = make_stations(spark, [(50, 5, 0), (50, 7, 0), (50, 5, 0), (-50, 5, 0)], ["B", "A", "C", "D"])
    points = make_points(spark, [(50, 5, 1000), (50, 6, 1000)])
    found = answer(nearest_station(points, stations))
    assert found["000000"][0] == "B"
    agree(found, brute_force(points, stations))


def test_crowded_stations_under_high_points(spark):
    """Seven hundred stations in one village, points three kilometres above it."""
    rng = np.random.default_rng(5)
    village = (52.0, 52.01, 6.0, 6.015)
    stations = make_stations(spark, scattered(rng, 700, box=village, top=30)).cache()
    high = scattered(rng, 4000, box=village, top=20) + [0, 0, 3000]
    points = make_points(spark, high).cache()
    agree(answer(nearest_station(points, stations)), brute_force(points, stations))
    entries = candidate_lists(points, stations).entries
    sizes = [r["n"] for r in entries.groupBy("edge", "cell_x", "cell_y", "cell_z").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= nearest.LEAF_STATIONS
    assert len(sizes) < 4000 / 4


@pytest.mark.parametrize("first_pairs", [0, 1000, 1 << 40])
def test_lists_may_begin_at_any_level(spark, first_pairs):
    rng = np.random.default_rng(8)
    stations, points = make_stations(spark, scattered(rng, 150)), make_points(spark, scattered(rng, 500, top=9000))
    found = candidate_lists(points, stations, first_pairs=first_pairs)
    lists = nearest._arrays(found.entries, found.sites)
    met = nearest._keyed(points, found.edges).join(lists, ["edge", *nearest._CELL])
    agree(answer(nearest._closest(met.select(*points.columns, "candidates"), points.columns)), brute_force(points, stations))


def test_an_index_grows_with_the_space_that_points_occupy(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(11)
    village = (52.0, 52.01, 6.0, 6.015)
    sites = np.concatenate([scattered(rng, 300, box=village, top=30), scattered(rng, 60)])
    stations = make_stations(spark, sites).cache()
    high = scattered(rng, 900, box=village, top=20) + [0, 0, 3000]
    far = scattered(rng, 300, top=9000)
    batches = [make_points(spark, part).cache() for part in (high[:400], high[:400], high[400:], np.concatenate([far, high[300:500]]))]
    index = nearest.StationIndex(str(tmp_path), stations, leaf_stations=16)
    refined = []
    monkeypatch.setattr(nearest, "lists_of", lambda *a, known=nearest.lists_of: refined.append(1) or known(*a))
    steps = []
    for epoch, batch in enumerate(batches):
        steps.append(index.extend(batch, epoch))
        agree(answer(index.nearest(batch, epoch)), brute_force(batch, stations))
    # new tiles; nothing; new cells in tiles that are cut; new tiles
    assert steps[:2] == [1, 0] and steps[2] >= 1 and steps[3] >= 1
    assert len(refined) <= 3
    again = nearest.StationIndex(str(tmp_path), stations, leaf_stations=16)  # a job that starts anew
    assert again.extend(batches[3], 9) == 0
    other = nearest.StationIndex(str(tmp_path), stations.where("station_id < 'S00100'"), leaf_stations=16)
    assert other.path != index.path


def test_nothing_to_join(spark):
    points, stations = make_points(spark, [(50, 5, 0)]), make_stations(spark, [(50, 5, 0), (51, 5, 0)])
    assert nearest_station(points, stations.where("false")).count() == 0
    assert nearest_station(points.where("false"), stations).count() == 0


def test_points_are_not_shuffled(skewed):
    points, stations, _ = skewed
    plan = nearest_station(points, stations)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan.split("InMemoryRelation")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lookup_keys_are_no_filter_of_the_points(spark, skewed):
    """A filter by the keys would work out positions a second time, below the projections."""
    points, stations, expected = skewed
    raw = points.select("icao24", "snapshot_ts", "latitude", "longitude", "height", "velocity", "vertical_rate", "on_ground")
    lost = raw.limit(1).withColumns({"icao24": F.lit("lost"), "latitude": F.lit(None).cast("double")})
    found = nearest_station(enrich_points(raw.unionByName(lost)), stations, leaf_stations=6)
    assert "isnotnull(FLOOR" not in found._jdf.queryExecution().optimizedPlan().toString()
    agree(answer(found), expected)


def test_lists_are_refined_by_rows_not_by_bytes(skewed, monkeypatch):
    points, stations, expected = skewed
    monkeypatch.setattr(nearest, "TASK_ROWS", 16)
    dealt, real = [], nearest._spread
    monkeypatch.setattr(nearest, "_spread", lambda lists: dealt.append((lists.count(), real(lists))) or dealt[-1][1])
    agree(answer(nearest_station(points, stations, leaf_stations=6)), expected)
    assert any(n > 16 for n, _ in dealt)
    assert all(df.rdd.getNumPartitions() == -(-n // 16) for n, df in dealt if n > 16)

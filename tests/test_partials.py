from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from trackmart.operators.marts import time_agg
from trackmart.operators.partials import merge_partials, minute_partials, time_agg_of, traffic_of
from trackmart.plans.reports import traffic_by_minute
from trackmart.schemas import MINUTE_PARTIALS
from trackmart.sources.slots import read_slots, slots_in, write_slots

AS_OF = datetime(2024, 6, 1, tzinfo=timezone.utc)
# the least and the greatest address, both sides of a block, and texts that are no addresses
ADDRESSES = ["000000", "000001", "008000", "008001", "ffffff", "ABCDEF", "abcdef", "abc", "", "~tisb1", None, "0abcdef"]


@pytest.fixture(scope="module")
def points(spark):
    rows = [
        (ADDRESSES[i * 7 % len(ADDRESSES)], i, i // 40 * 60, ("cruise", "climb")[i % 2], *[None if i % 5 == j else float(i * j) for j in range(4)])
        for i in range(400)
    ]
    names = "icao24 string, snapshot_ts long, time_window long, flight_phase string, height double, velocity double, mach double, r_to_station double"
    return spark.createDataFrame(rows, names)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("loads", [1, 7])
def test_merged_parts_equal_the_points(points, loads):
    parts = [minute_partials(points.where(F.col("snapshot_ts") % loads == i)) for i in range(loads)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(merge_partials(part))
    assert rows(time_agg_of(merged, AS_OF)) == rows(time_agg(points, AS_OF))
    assert rows(traffic_of(merged)) == rows(traffic_by_minute(points))


def test_distinct_aircraft_of_longer_stretches(points):
    expected = points.agg(F.count("*"), F.countDistinct("icao24")).first()
    hours = traffic_of(minute_partials(points), 3600).collect()
    assert [(r.points, r.aircraft) for r in hours] == [tuple(expected)]
    assert minute_partials(points).dtypes == [(f.name, f.dataType.simpleString()) for f in MINUTE_PARTIALS]
    assert traffic_of(minute_partials(points.limit(0))).collect() == []


def test_a_batch_opens_only_the_slots_it_touches(spark, points, tmp_path):
    path = str(tmp_path / "parts")
    part = minute_partials(points).withColumn("minute", F.col("minute") % 600)
    opened = []
    for epoch in range(12):  # each batch lies ten minutes later than the one before
        moved = part.withColumn("minute", F.col("minute") + 600 * epoch)
        write_slots(moved, path, F.col("minute"), 600, epoch)
        slots = slots_in(moved, F.col("minute"), 600)
        assert slots == [epoch]
        opened.append(len(read_slots(spark, path, MINUTE_PARTIALS, slots).inputFiles()))
    assert opened == [1] * 12
    late = part.limit(3)
    write_slots(late, path, F.col("minute"), 600, 12)
    found = read_slots(spark, path, MINUTE_PARTIALS, [0])
    assert found.count() == part.count() + 3
    write_slots(late, path, F.col("minute"), 600, 12)  # a replay replaces what it wrote
    assert read_slots(spark, path, MINUTE_PARTIALS, [0]).count() == part.count() + 3
    assert "PartitionFilters: [isnotnull(slot" in found._jdf.queryExecution().toString()
    assert read_slots(spark, path, MINUTE_PARTIALS, [99]).count() == 0


def test_many_slots_are_written_by_several_tasks(spark, tmp_path):
    seconds = spark.range(100).select((F.col("id") * 600).alias("snapshot_ts"))
    write_slots(seconds, str(tmp_path / "slots"), F.col("snapshot_ts"), 600, 1, 100)
    written = {f.name.split("-")[1] for f in (tmp_path / "slots").rglob("part-*.parquet")}
    assert len(written) > 1
    assert read_slots(spark, str(tmp_path / "slots"), seconds.schema, list(range(100))).count() == 100

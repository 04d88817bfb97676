import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from trackmart.operators import versions
from trackmart.sources import files


def ts(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


LOADS = "k string, event_ts timestamp, load_seq long, v int"


def test_latest_prefers_version_then_load(spark):
    rows = [
        ("a", ts(2024, 1, 1), 1, 1),
        ("a", ts(2024, 1, 2), 2, 2),
        ("b", ts(2024, 1, 1), 1, 3),
        ("b", ts(2024, 1, 1), 2, 4),
        ("c", ts(2024, 1, 2), 1, 5),
        ("c", ts(2024, 1, 1), 2, 6),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept = versions.latest(spark.createDataFrame(rows, LOADS).repartition(3), ["k"])
        assert {r.k: r.v for r in kept.collect()} == {"a": 2, "b": 4, "c": 5}


def test_a_hot_key_leaves_each_task_once(spark):
    hot = spark.range(0, 5000, 1, 4).select(F.when(F.col("id") >= 0, "hot").alias("k"), F.timestamp_seconds("id").alias("event_ts"), F.col("id").alias("load_seq"))
    kept = versions.latest(hot, ["k"])
    assert [r.load_seq for r in kept.collect()] == [4999]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


@pytest.mark.parametrize(
    "row, as_of, kept",
    [
        (ts(2024, 1, 1, 0, 5), ts(2025, 1, 1, 0, 5), False),  # exactly one year old
        (ts(2024, 1, 1, 0, 5, 1), ts(2025, 1, 1, 0, 5), True),
        (ts(2024, 2, 29, 6), ts(2025, 2, 28, 12), False),  # one year after a leap day is 28 February
        (ts(2024, 2, 29, 18), ts(2025, 2, 28, 12), True),
        (ts(2023, 2, 28, 12), ts(2024, 2, 29, 12), False),
        (ts(2023, 3, 1, 12), ts(2024, 2, 29, 12), True),
    ],
)
def test_retention_boundary(spark, row, as_of, kept):
    df = spark.createDataFrame([(row,)], "ts timestamp")
    assert versions.retain(df, "ts", as_of).count() == int(kept)
    by_month = df.withColumn("month", versions.month_of(F.col("ts")))
    assert versions.retain(by_month, "ts", as_of).count() == int(kept)


def test_retention_prunes_months(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(ts(2022, m, 1), "k") for m in range(1, 13)], "ts timestamp, k string")
    files.append_facts(df, path, "ts", ["k"], 1)
    kept = versions.retain(files.read_store(spark, path, df.schema), "ts", ts(2023, 6, 15))
    assert kept.count() == 6
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "GreaterThan(ts" in plan


def test_expired_months_are_deleted(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(ts(2022, m, 10), "k") for m in range(1, 13)], "ts timestamp, k string")
    files.append_facts(df, path, "ts", ["k"], 1)
    as_of = ts(2023, 3, 20)
    before = sorted(versions.retain(files.read_store(spark, path, df.schema), "ts", as_of).collect())
    assert files.drop_expired_months(spark, path, as_of) == ["202201", "202202"]
    store = files.read_store(spark, path, df.schema)
    assert store.count() == 10 and sorted(versions.retain(store, "ts", as_of).collect()) == before
    assert files.drop_expired_months(spark, str(tmp_path / "none"), as_of) == []


def test_append_keeps_loads_apart_and_sorted(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.range(0, 2000, 1, 4).select(
        F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("ts"), F.lpad((F.col("id") * 37 % 2000).cast("string"), 4, "0").alias("k")
    )
    files.append_facts(df, path, "ts", ["k"], 1)
    files.append_facts(df.limit(10), path, "ts", ["k"], 2)
    store = files.read_store(spark, path, df.schema)
    assert {r.load_seq: r.n for r in store.groupBy("load_seq").agg(F.count("*").alias("n")).collect()} == {1: 2000, 2: 10}
    assert {r.month for r in store.select("month").distinct().collect()} == {"202401", "202402", "202403"}
    for file in store.inputFiles()[:3]:
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_lookup_defaults(spark):
    facts = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "k string")
    dim = spark.createDataFrame([("a", "x", 1.5), ("b", None, None)], "k string, name string, lat double")
    found = versions.lookup(facts, dim, "k", {"n": ("name", ""), "l": ("lat", 0.0)})
    assert {r.k: (r.n, r.l) for r in found.collect()} == {"a": ("x", 1.5), "b": ("", 0.0), "z": ("", 0.0), None: ("", 0.0)}


def test_lookup_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(versions, "broadcast_if_small", lambda df: df.hint("merge"))
    facts = spark.range(100).select((F.col("id") % 3).cast("string").alias("k"))
    dim = spark.createDataFrame([("1", "x")], "k string, name string")
    found = versions.lookup(facts, dim, "k", {"n": ("name", "-")})
    assert {(r.n, r.c) for r in found.groupBy("n").agg(F.count("*").alias("c")).collect()} == {("x", 33), ("-", 67)}


def test_a_time_range_prunes_months(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(ts(2022, m, d), "k") for m in range(1, 13) for d in (1, 15)], "ts timestamp, k string")
    files.append_facts(df.withColumn("event_ts", F.lit(ts(2022, 1, 1))), path, "ts", ["k"], 1)
    schema = df.withColumn("event_ts", F.lit(ts(2022, 1, 1))).schema
    some = files.read_store(spark, path, schema, "ts", (ts(2022, 3, 10), ts(2022, 5, 1)))
    found = versions.latest(some, ["k", "ts"])
    assert sorted(r.ts.month * 100 + r.ts.day for r in found.collect()) == [315, 401, 415]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*month", plan) and "GreaterThanOrEqual(ts" in plan


def test_a_store_not_yet_written_is_empty(spark, tmp_path):
    store = files.read_store(spark, str(tmp_path / "none"), spark.range(1).schema)
    assert store.columns == ["id", "load_seq", "month"] and store.count() == 0


def loads(spark, path, buckets):
    df = spark.range(0, 3000, 1, 4).select(
        F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("ts"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("k"),
        F.lit(ts(2024, 1, 1)).alias("event_ts"),
        F.col("id").alias("v"),
    )
    files.append_facts(df, path, "ts", ["k", "ts"], 1, buckets)
    later = df.where("v % 5 = 0").withColumns({"event_ts": F.lit(ts(2024, 1, 2)), "v": F.col("v") + 1})
    files.append_facts(later.select("v", "event_ts", "k", "ts"), path, "ts", ["k", "ts"], 2)  # other order of columns
    files.append_facts(df.where("v % 10 = 0").withColumn("event_ts", F.lit(ts(2024, 1, 2))), path, "ts", ["k", "ts"], 3)
    return df.schema


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_a_bucketed_store_needs_no_exchange(spark, tmp_path):
    plain, dealt = str(tmp_path / "plain"), str(tmp_path / "it's dealt")
    schema = loads(spark, plain, None)
    loads(spark, dealt, 6)
    kept = versions.latest(files.read_store(spark, dealt, schema), ["k", "ts"])
    assert "Exchange" not in plan_of(kept)
    assert sorted(map(str, kept.collect())) == sorted(map(str, versions.latest(files.read_store(spark, plain, schema), ["k", "ts"]).collect()))
    between = (ts(2024, 2, 3), ts(2024, 3, 9))
    some = versions.latest(files.read_store(spark, dealt, schema, "ts", between), ["k", "ts"])
    assert "Exchange" not in plan_of(some) and re.search(r"PartitionFilters: \[[^]]*month", plan_of(some))
    assert some.count() == kept.where(F.col("ts").between(between[0], ts(2024, 3, 8, 23))).count() > 0
    with pytest.raises(ValueError, match="bucketed by"):
        files.append_facts(spark.table(files._bucketed_table(spark, dealt, files._stored(schema.fields), files.Layout(6, ["k", "ts"]))), dealt, "ts", ["k"], 4)


def test_a_hot_key_is_dealt_to_all_buckets(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = loads(spark, path, 6)
    store = files.read_store(spark, path, schema)
    hot = store.where("k = 'hot'").groupBy(F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1).alias("b")).count().collect()
    assert len(hot) == 6 and max(r["count"] for r in hot) < 2 * min(r["count"] for r in hot)


def test_a_bucketed_store_outlives_its_catalog_entry(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = loads(spark, path, 4)
    before = files.read_store(spark, path, schema).count()
    for table in spark.catalog.listTables(pattern="store_*"):
        spark.sql(f"DROP TABLE {table.name}")
    assert files.read_store(spark, path, schema).count() == before
    assert files.drop_expired_months(spark, path, ts(2025, 3, 20)) == ["202401", "202402"]
    assert {r.month for r in files.read_store(spark, path, schema).select("month").distinct().collect()} == {"202403", "202404", "202405"}

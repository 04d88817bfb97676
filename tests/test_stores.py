"""Bucketed tables and dimensions with an archive: what a load writes, what readers see."""

from pyspark.sql import functions as F

from trackmart.sources.buckets import bucket_of, buckets_of, read_buckets, replace_buckets
from trackmart.sources.files import exists, versions_of
from trackmart.sources.history import read_history, read_open, write_history

SCHEMA = "k string, v long"


def table(spark, keys, v):
    return spark.createDataFrame([(k, v) for k in keys], SCHEMA)


def values(spark, path):
    return {r.k: r.v for r in read_buckets(spark, path, table(spark, [], 0).schema).collect()}


def test_buckets_of_an_absent_and_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert values(spark, path) == {}
    assert replace_buckets(table(spark, [], 0), path, "k") == 1
    assert values(spark, path) == {} and versions_of(spark, path) == [1]


def test_unnamed_buckets_go_with_the_last_version_that_names_them(spark, tmp_path):
    path, one = str(tmp_path / "t"), ["a"]
    replace_buckets(table(spark, ["a", "b", "c", "d"], 0), path, "k", keep=2)
    for v in (1, 2, 3):
        replace_buckets(table(spark, one, v), path, "k", keep=2)
    assert values(spark, path) == {"a": 3, "b": 0, "c": 0, "d": 0}
    held = buckets_of(table(spark, one, 0), "k")[0]
    # those of the two versions kept; the first load lost this bucket and kept the others
    assert len(list((tmp_path / "t" / "rows").glob(f"*/bucket={held}"))) == 2
    others = {r[0] for r in table(spark, ["b", "c", "d"], 0).select(bucket_of("k")).collect()} - {held}
    assert all(len(list((tmp_path / "t" / "rows").glob(f"*/bucket={b}"))) == 1 for b in others)


def test_a_load_that_was_not_committed_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_buckets(table(spark, ["a", "b"], 0), path, "k")
    left = table(spark, ["a"], 9).withColumn("bucket", bucket_of("k"))
    left.write.partitionBy("bucket").parquet(f"{path}/rows/load=dead")
    assert values(spark, path) == {"a": 0, "b": 0}


def test_a_null_key_has_a_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_buckets(spark.createDataFrame([(None, 1), ("", 2)], SCHEMA), path, "k")
    assert values(spark, path) == {None: 1, "": 2}


def test_history_without_its_failed_load(spark, tmp_path):
    path, schema = str(tmp_path / "h"), table(spark, [], 0).schema
    assert read_history(spark, path, schema).count() == 0
    write_history(table(spark, ["a"], 1), table(spark, [], 0), path)
    assert not exists(spark, f"{path}/closed")
    table(spark, ["lost"], 7).write.parquet(f"{path}/closed/load=2")  # a load that ended before its commit
    assert [r.k for r in read_history(spark, path, schema).collect()] == ["a"]
    # the next load closes nothing and still replaces what was left under its number
    write_history(table(spark, ["a"], 2), table(spark, [], 0), path)
    assert [(r.k, r.v) for r in read_history(spark, path, schema).collect()] == [("a", 2)]
    write_history(table(spark, ["b"], 3), table(spark, ["a"], 2), path)
    assert read_history(spark, path, schema).agg(F.sum("v")).first()[0] == 5
    assert [r.k for r in read_open(spark, path, schema).collect()] == ["b"]

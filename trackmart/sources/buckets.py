"""A keyed table in hash buckets, of which a load rewrites only those that it changes.

A version is a short table that names, for every bucket, the load whose files hold it. A load
writes the buckets it changes beside the old ones and then the next version, which is what
commits it: readers see all of a load or nothing, also after a crash or on an object store, and
of two writers at once the later one fails. Files of untouched buckets stay as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.sources.files import KEPT_VERSIONS, delete, names_in, versions_of, write_version

BUCKET, LOAD = "bucket", "load"
BUCKETS = 64  # of a new table, whose keys stay in their buckets for good

LISTED = T.StructType().add(BUCKET, T.IntegerType()).add(LOAD, T.StringType())


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def buckets_of(df: DataFrame, key: str) -> list[int]:
    """The buckets that the rows of a load lie in, at most ``BUCKETS``."""
    return sorted(r[0] for r in df.select(bucket_of(key)).distinct().collect())


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
    """The newest version, or of it the named buckets only; the files of others are not opened."""
    listed = _listed(spark, path, versions_of(spark, path)[-1:])
    chosen = [pair for pair in listed if buckets is None or pair[0] in buckets]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_folder(path, *pair) for pair in chosen])


def replace_buckets(df: DataFrame, path: str, key: str, keep: int = KEPT_VERSIONS) -> int:
    """Write the next version, in which the rows of ``df`` are all rows of the buckets they lie in.

    Buckets that only versions older than the newest ``keep`` name are removed.
    """
    spark, load = df.sparkSession, uuid.uuid4().hex
    known = versions_of(spark, path)
    rows = f"{path}/rows/{LOAD}={load}"
    df.withColumn(BUCKET, bucket_of(key)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(rows)
    written = [int(name.split("=")[1]) for name in names_in(spark, rows) if name.startswith(f"{BUCKET}=")]
    before = set(_listed(spark, path, known))
    listed = dict(sorted(_listed(spark, path, known[-1:]))) | dict.fromkeys(written, load)
    version = write_version(spark.createDataFrame(sorted(listed.items()), LISTED).coalesce(1), path, keep)
    for pair in before - set(_listed(spark, path, versions_of(spark, path))):
        delete(spark, _folder(path, *pair))
    return version


def _folder(path: str, bucket: int, load: str) -> str:
    return f"{path}/rows/{LOAD}={load}/{BUCKET}={bucket}"


def _listed(spark: SparkSession, path: str, versions: list[int]) -> list[tuple[int, str]]:
    """What these versions name: at most ``BUCKETS`` folders each."""
    if not versions:
        return []
    return [tuple(r) for r in spark.read.schema(LISTED).parquet(*[f"{path}/version={v}" for v in versions]).collect()]

"""Day-partitioned Parquet, CSV exchange, versioned dimension folders, month stores.

Every path may be any Hadoop file system URI. A day's partition is replaced as a whole, so a
repeated run leaves no old part files behind.
"""

from __future__ import annotations

import hashlib
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.operators.quality import require_rows
from trackmart.operators.versions import LOAD_SEQ, MONTH, RETENTION, month_of
from trackmart.runtime import load_time
from trackmart.schemas import STATES, STATIONS

DATE = "date"
KEPT_VERSIONS = 5
LAYOUT = "_buckets-"  # begins the name of the file that tells a store's layout


def read_day(spark: SparkSession, path: str, ds: str, schema: T.StructType) -> DataFrame:
    """One day of a ``date=`` partitioned table; other days are pruned, not read."""
    stored = T.StructType([*schema.fields, T.StructField(DATE, T.StringType())])
    return spark.read.schema(stored).parquet(path).where(F.col(DATE) == ds).drop(DATE)


def read_states(spark: SparkSession, root: str, ds: str) -> DataFrame:
    return read_day(spark, f"{root}/states", ds, STATES)


def read_stations(spark: SparkSession, root: str, ds: str) -> DataFrame:
    return read_day(spark, f"{root}/stations", ds, STATIONS)


def write_day(df: DataFrame, path: str, ds: str) -> None:
    """Replace one day's partition, also by an empty one."""
    df.write.mode("overwrite").parquet(day_path(path, ds))


def day_path(path: str, ds: str) -> str:
    return f"{path}/{DATE}={ds}"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; blanks around text (padded callsigns) are kept."""
    df.write.mode("overwrite").csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header, columns taken by name, typed by ``schema`` and never by guessing.

    Whole numbers may be written as ``5`` or ``5.0`` (an export with gaps does that).
    Values that do not fit become null, and so does NaN.
    """
    text = spark.read.csv(path, header=True, inferSchema=False)
    return text.select(*[_typed(f.name, f.dataType) for f in schema])


def unfit_values(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(rule, violations): how many values of each column of a CSV do not fit its type."""
    text = spark.read.csv(path, header=True, inferSchema=False)
    lost = {f.name: F.col(f"`{f.name}`").isNotNull() & (F.lower(f"`{f.name}`") != "nan") & _typed(f.name, f.dataType).isNull() for f in schema}
    counts = text.agg(*[F.count_if(broken).alias(name) for name, broken in lost.items()])
    return counts.unpivot([], list(lost), "rule", "violations")


def _typed(name: str, kind: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, T.DoubleType):
        return F.nanvl(column.try_cast("double"), F.lit(None)).alias(name)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.coalesce(column.try_cast(kind), column.try_cast("double").try_cast(kind)).alias(name)
    return column.try_cast(kind).alias(name)


def csv_to_parquet(spark: SparkSession, csv_path: str, path: str, ds: str, schema: T.StructType) -> None:
    """Convert an extract into the day's Parquet partition, replacing it."""
    write_day(read_csv(spark, csv_path, schema), path, ds)


def publish(spark: SparkSession, source: str, target: str, ds: str) -> None:
    """Copy a day of the curated table to its published place, replacing that day there.

    Fails if the table is missing or the day holds nothing. Spark stages the rows, and its commit
    puts them in the place of the day's partition once all tasks have ended, on object stores too;
    a failed write leaves the old day as it was, and other days are never touched.
    """
    day = spark.read.parquet(source).where(F.col(DATE) == ds)
    require_rows(day, "nothing_to_publish")
    writer = day.withColumn(DATE, F.lit(ds)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DATE).parquet(target)


def append_facts(df: DataFrame, path: str, ts: str, key: list[str], load_seq: int, buckets: int | None = None) -> None:
    """Append a load to a store partitioned by month of ``ts`` and sorted by its key.

    Without ``buckets``, ranges over (month, key) give every task a slice of similar size, also
    when one month or one key holds most rows, and files whose statistics allow skipping by key.
    A store whose first load names ``buckets`` deals the rows of each month to so many buckets by
    the hash of the whole key, so that ranking its keys needs no exchange; later loads follow it.
    """
    order = [MONTH, *key]
    rows = df.withColumns({LOAD_SEQ: F.lit(load_seq).cast("long"), MONTH: month_of(F.col(ts))})
    layout = _layout(df.sparkSession, path)
    if layout is None and buckets and not exists(df.sparkSession, path):
        layout = _set_layout(df.sparkSession, path, key, buckets)
    if layout is None:
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append").partitionBy(MONTH).parquet(path)
        return
    if layout.key != key:
        raise ValueError(f"the store is bucketed by {layout.key}, not by {key}")
    fields = [f for f in rows.schema.fields if f.name not in (LOAD_SEQ, MONTH)]
    table = _bucketed_table(df.sparkSession, path, _stored(fields), layout)
    columns = [f.name for f in fields] + [LOAD_SEQ, MONTH]
    rows.select(*columns).repartition(layout.buckets, *key).write.insertInto(table)


class Layout(NamedTuple):
    buckets: int
    key: list[str]


def _stored(fields: list[T.StructField]) -> T.StructType:
    return T.StructType([*fields, T.StructField(LOAD_SEQ, T.LongType()), T.StructField(MONTH, T.StringType())])


def _layout(spark: SparkSession, path: str) -> Layout | None:
    """How a bucketed store is laid out, by the name of an empty file in it; None for others."""
    for name in names_in(spark, path):
        if name.startswith(LAYOUT):
            buckets, key = name.removeprefix(LAYOUT).split("-", 1)
            return Layout(int(buckets), key.split(","))
    return None


def _set_layout(spark: SparkSession, path: str, key: list[str], buckets: int) -> Layout:
    fs, file = _file_system(spark, f"{path}/{LAYOUT}{buckets}-{','.join(key)}")
    fs.mkdirs(file.getParent())
    fs.createNewFile(file)
    return Layout(buckets, key)


def _bucketed_table(spark: SparkSession, path: str, stored: T.StructType, layout: Layout) -> str:
    """The catalog's name for a bucketed store, under which Spark knows its buckets.

    The entry only describes the files: it is made again from the store's own layout wherever
    a catalog lacks it, and goes without them.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
    by = ", ".join(f"`{c}`" for c in layout.key)
    name = f"store_{hashlib.md5(f'{path} {columns} {layout}'.encode()).hexdigest()}"
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({MONTH}) "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {layout.buckets} BUCKETS LOCATION '{where}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")  # months come from the folders, whoever made or deleted them
    spark.catalog.refreshTable(name)
    return name


def read_store(
    spark: SparkSession, path: str, schema: T.StructType, ts: str | None = None, between: tuple[datetime, datetime] | None = None
) -> DataFrame:
    """All loads of a store, with ``load_seq`` and ``month``; none if nothing has been stored yet.

    ``between`` keeps rows whose ``ts`` lies in [first, second). It prunes whole months and
    then goes by file statistics; versions of a key share its time, so no version is lost.
    """
    stored = _stored(schema.fields)
    if not exists(spark, path):
        return spark.createDataFrame([], stored)
    layout = _layout(spark, path)
    store = spark.read.schema(stored).parquet(path) if layout is None else spark.table(_bucketed_table(spark, path, stored, layout))
    if between is None:
        return store
    first, last = between
    months = F.col(MONTH).between(f"{first:%Y%m}", f"{last:%Y%m}")
    return store.where(months & (F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(last)))


def drop_expired_months(spark: SparkSession, path: str, as_of: datetime) -> list[str]:
    """Delete the months of a store in which every row has outlived its retention.

    A month is gone for good once it lies wholly before ``as_of`` minus the retention; rows
    of the month in which the limit falls are left to ``retain``.
    """
    limit = spark.range(1).select(month_of(load_time(as_of) - F.expr(RETENTION))).first()[0]
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    months = {s.getPath().getName().removeprefix(f"{MONTH}="): s.getPath() for s in fs.listStatus(folder)}
    expired = sorted(m for m in months if m.isdigit() and m < limit)
    for month in expired:
        fs.delete(months[month], True)
    return expired


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` as one of its paths."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what stands directly below a folder; none if there is no such folder."""
    fs, folder = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def versions_of(spark: SparkSession, path: str) -> list[int]:
    """Completely written versions below ``path``, oldest first."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    entries = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("version=")]
    complete = [p for p in entries if fs.exists(_file_system(spark, f"{p.toString()}/_SUCCESS")[1])]
    return sorted(int(p.getName().split("=")[1]) for p in complete)


def read_version(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest complete version of a small table, or an empty table if there is none."""
    known = versions_of(spark, path)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={known[-1]}")


def write_version(df: DataFrame, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Write the next version beside the old ones; readers see it once it is complete.

    Batch runs and streams share one sequence. Two writers at once cannot both take a number:
    the later one fails and may try again. All but the newest ``keep`` versions are removed.
    """
    spark = df.sparkSession
    known = versions_of(spark, path)
    version = known[-1] + 1 if known else 1
    df.write.mode("overwrite" if _incomplete(spark, path, version) else "errorifexists").parquet(f"{path}/version={version}")
    fs, _ = _file_system(spark, path)
    for old in [*known, version][:-keep]:
        fs.delete(_file_system(spark, f"{path}/version={old}")[1], True)
    return version


def _incomplete(spark: SparkSession, path: str, version: int) -> bool:
    """True for what a failed writer left behind."""
    fs, folder = _file_system(spark, f"{path}/version={version}")
    return fs.exists(folder) and not fs.exists(_file_system(spark, f"{path}/version={version}/_SUCCESS")[1])

"""A dimension with history: the open versions, replaced as a whole, beside an archive of closed ones.

A version that has been closed never changes again, so a load adds those that it closes to the
archive, under its number, and writes the open ones as the next version of a small table. That
write commits the load: of the archive, readers take loads up to the newest version, and what a
failed load left there is replaced by the next one. One writer at a time is expected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.sources.files import exists, read_version, versions_of, write_version

LOAD = "load"


def read_open(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The open versions only; the archive is not opened."""
    return read_version(spark, path, schema)


def read_closed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The archive of closed versions, without what a failed load left."""
    archive, known = f"{path}/closed", versions_of(spark, path)
    if not known or not exists(spark, archive):
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(LOAD, T.LongType())])
    return spark.read.schema(stored).parquet(archive).where(F.col(LOAD) <= known[-1]).drop(LOAD)


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions, closed and open."""
    return read_closed(spark, path, schema).unionByName(read_open(spark, path, schema))


def write_history(opened: DataFrame, closed: DataFrame, path: str) -> int:
    """Store the versions that are open now, and those closed by this load.

    Both must be materialised. Files of earlier loads in the archive are not touched.
    """
    spark = opened.sparkSession
    known = versions_of(spark, path)
    load = known[-1] + 1 if known else 1
    archived = f"{path}/closed/{LOAD}={load}"
    if exists(spark, archived) or not closed.isEmpty():
        closed.write.mode("overwrite").parquet(archived)
    return write_version(opened, path)

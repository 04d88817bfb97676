"""Tables of a stream that are cut by time: ``slot=…/epoch=…`` folders.

A slot is a stretch of time of fixed length. What a batch adds to a slot stands in a folder of its
own, which a replayed batch replaces, by Spark's dynamic partition overwrite. A batch names the
slots that it reads; no other folder is listed and no other file opened, so its cost depends on
the time that it covers and not on the age of the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart.sources.files import exists

SLOT, EPOCH = "slot", "epoch"
TASK_SLOTS = 32  # files that one task writes


def slot_of(seconds: Column, length: int) -> Column:
    return F.floor(seconds / length).cast("long")


def write_slots(df: DataFrame, path: str, seconds: Column, length: int, epoch: int, slots: int = 1) -> None:
    """Put the rows of a batch into their slots, one file each; rows are few, and narrow.

    ``slots`` says how many there are, about: files, not bytes, are what their tasks are dealt by.
    """
    placed = df.withColumns({SLOT: slot_of(seconds, length), EPOCH: F.lit(epoch)})
    placed = placed.repartition(-(-slots // TASK_SLOTS), SLOT) if slots > TASK_SLOTS else placed.repartition(SLOT)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(SLOT, EPOCH).parquet(path)


def slots_in(df: DataFrame, seconds: Column, length: int) -> list[int]:
    """The slots that the rows of a batch lie in."""
    return sorted(r[0] for r in df.select(slot_of(seconds, length)).distinct().collect() if r[0] is not None)


def read_slots(spark: SparkSession, path: str, schema: T.StructType, slots: list[int]) -> DataFrame:
    """Rows of the named slots with their ``slot`` and ``epoch``; none where nothing is stored."""
    stored = T.StructType([*schema.fields, T.StructField(SLOT, T.LongType()), T.StructField(EPOCH, T.IntegerType())])
    folders = [folder for folder in (f"{path}/{SLOT}={slot}" for slot in slots) if exists(spark, folder)]
    if not folders:
        return spark.createDataFrame([], stored)
    rows = spark.read.schema(stored).option("basePath", path).parquet(*folders)
    return rows.where(F.col(SLOT).between(slots[0], slots[-1]))

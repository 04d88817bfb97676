"""Session-level helpers: shared scratch space, checkpoints, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

# A side of a join is broadcast only after it has been measured and found no larger.
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.

    A local session, which has no other machines, may go without the setting and then gets a
    folder of its own; on a cluster the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trackmart-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor never replays its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once, cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(column: Column, kind: T.DataType) -> Column:
    """Bytes a value takes, roughly: text by its length, all else by the slot."""
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [_width(column.getField(f.name), f.dataType) for f in kind], F.lit(8))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + _width(x, kind.elementType)), F.lit(0)) + 24
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """What ``df`` takes in memory, by one aggregation; maps are not measured."""
    row = reduce(lambda a, b: a + b, [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema])
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size allows, else leave the join to a
    shuffle (adaptive execution then splits hot keys)."""
    return F.broadcast(df) if measured_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes) else df


def load_time(as_of: datetime | Column | None) -> Column:
    """The run's load stamp: an injected instant, or the current time.

    A plain ``datetime`` without zone is taken as UTC.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, datetime):
        return F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc))
    return as_of

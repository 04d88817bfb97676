"""Relational sinks through Spark's JDBC writer.

The driver class comes with the caller's jars; credentials come from the caller and are
never stored here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STAGING_PREFIX = "stg_"


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batch_rows: int = 10_000,
    connections: int = 8,
) -> dict[str, str]:
    """Options of a JDBC write: rows travel in batches over a bounded number of
    connections, one per partition."""
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }
    return {k: v for k, v in options.items() if v is not None}


def stage(df: DataFrame, url: str, table: str, **options) -> None:
    """Replace the staging table ``stg_<table>``."""
    df.write.format("jdbc").options(**jdbc_options(url, f"{STAGING_PREFIX}{table}", **options)).mode("overwrite").save()


def append(df: DataFrame, url: str, table: str, **options) -> None:
    """Append to a fact or aggregate table."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()


def read(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Read a table; filters on the result are pushed into the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()

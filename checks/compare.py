"""Run registered queries against their oracles: ``python -m checks.compare [sf] [name …]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.queries import QUERIES

DATA = "/root/testdata"


def session(cpus: int | str = 8) -> SparkSession:
    """A local session with a scratch folder of its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trackmart")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="trackmart-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(sf_dir):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return db


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], list]:
    return df.columns, [tuple(r) for r in df.collect()]


def compare(name: str, spark: SparkSession, sf_dir: str, db: duckdb.DuckDBPyConnection) -> str:
    """Empty when both engines agree, else what differs."""
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    result = db.execute(oracle_sql()[name])
    expected_columns = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} <> {sorted(expected_columns)}"
    ours, theirs = multiset(columns, rows), multiset(expected_columns, expected_rows)
    if ours == theirs:
        return ""
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{len(rows)} rows against {len(expected_rows)}; {sum(extra.values())} extra, {sum(missing.values())} missing\n"
        f"  {sorted(columns)}\n  ours   {list(extra)[:2]}\n  oracle {list(missing)[:2]}"
    )


def main() -> None:
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"{DATA}/sf{sf}"
    spark, db = session(), duck(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(name, spark, sf_dir, db)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - start:7.2f}s  {problem}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")


if __name__ == "__main__":
    main()

"""The streaming job: ingest landed payload files and keep tables up to date.

``python -m trackmart.plans.live --landing s3a://bucket/landing --data-dir s3a://bucket/live
--stations s3a://bucket/flights/stations/date=2024-01-01 --interval "20 seconds" --window 1800``
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from trackmart.operators.enrich import enrich_stations
from trackmart.schemas import STATIONS
from trackmart.streaming.ingest import ingest, landed_payloads, minute_step, run_for, upsert_step


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Ingest landed payload files as they come.")
    parser.add_argument("--landing", required=True, help="folder of payload files")
    parser.add_argument("--data-dir", required=True, help="root of the tables kept, any file system URI")
    parser.add_argument("--stations", required=True, help="Parquet folder of stations")
    parser.add_argument("--interval", help="time between batches, such as '20 seconds'; without it, what is there is taken once")
    parser.add_argument("--window", type=float, help="with --interval: seconds to go on polling; then what has landed is taken and the job ends")
    parser.add_argument("--max-files", type=int, help="files per batch")
    parser.add_argument("--files-by-name", action="store_true", help="order landed files by name, not by their time")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("trackmart-live").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    root = args.data_dir
    stations = enrich_stations(spark.read.schema(STATIONS).parquet(args.stations))
    payloads = landed_payloads(spark, args.landing, args.max_files)
    steps = [upsert_step(f"{root}/dim_flight"), minute_step(f"{root}/ingested", f"{root}/time_agg", stations)]

    def start(trigger: dict) -> StreamingQuery:
        writer = ingest(payloads, f"{root}/ingested", *steps, by_name=args.files_by_name).trigger(**trigger)
        return writer.option("checkpointLocation", f"{root}/stream-state").start()

    if args.interval and args.window:
        run_for(start, args.interval, args.window)
    else:
        start({"processingTime": args.interval} if args.interval else {"availableNow": True}).awaitTermination()


if __name__ == "__main__":
    main()

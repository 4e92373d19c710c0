"""Job entry point: load new landing files and keep the tables fresh.

    spark-submit airlake/job.py --landing <dir> --lake <dir> [--framing file|lines]
                                [--every "5 minutes"] [--full] [--target <table>]

One run (default) loads every file not seen before and refreshes the days it touched;
``--every`` keeps a scheduled stream running instead; ``--full`` rebuilds all tables
after loading. Paths must be shared storage on a cluster; ``spark.checkpoint.dir`` must be
set there (the stream's checkpoint lives under ``<lake>/_checkpoints``).
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="airlake-job")
    p.add_argument("--landing", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--framing", default="file", choices=["file", "lines"])
    p.add_argument("--on-error", default="abort", choices=["abort", "skip"])
    p.add_argument("--weather", default=None, help="stored weather table to enrich the day level with")
    p.add_argument("--target", default=None, help="last table to refresh (default: all)")
    p.add_argument("--every", default=None, help='processing-time trigger, e.g. "5 minutes"')
    p.add_argument("--full", action="store_true", help="rebuild every table after loading")
    a = p.parse_args(argv)

    from airlake.plans.graph import aqi_pipeline, incremental_refresh
    from airlake.session import get_spark, read_if_there
    from airlake.streaming.ingest import ingest

    spark = spark or get_spark()
    lake = a.lake.rstrip("/")
    raw = f"{lake}/stage/raw"
    graph = aqi_pipeline(spark, lake, raw, weather_path=a.weather)
    on_batch = None if a.full else incremental_refresh(graph, a.target)
    result = ingest(spark, a.landing, raw, f"{lake}/_checkpoints/ingest", framing=a.framing,
                    on_error=a.on_error, on_batch=on_batch, every=a.every)
    if a.every:
        result.awaitTermination()
        return 0
    if a.full:
        if read_if_there(spark, raw) is None:                 # nothing was ever loaded
            print("no raw data yet; nothing to refresh")
            return 0
        graph.refresh(a.target)
    print(f"loaded {result} batch(es); refreshed {'all tables' if a.full else 'touched days'}")
    return 0


if __name__ == "__main__":
    sys.exit(main())

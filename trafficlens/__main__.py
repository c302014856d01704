"""Command line: run the whole job over an event export.

    spark-submit --py-files trafficlens.zip -m trafficlens \\
        --events s3://bucket/export --out s3://bucket/out [--signals PATH]
        [--start 2024-01-01 --end 2024-01-31] [--sessions 1000] [--labelled]
        [--shards] [--draws PATH] [--spend PATH] [--channel-map PATH]

The session's settings (master, ``spark.checkpoint.dir``, shuffle partitions)
come from spark-submit / the cluster; only unset SQL defaults are filled in.
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from . import config as C
from . import schemas
from .plans.pipeline import run
from .sources.tables import read_date_shards, read_events


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="trafficlens")
    ap.add_argument("--events", required=True, help="hit-level export (Parquet, partitioned by event_date)")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--signals", help="measured signals table (Parquet: client_id, session_id, edge_score, "
                                      "mouse_move_events)")
    ap.add_argument("--start", help="first event_date (inclusive)")
    ap.add_argument("--end", help="last event_date (inclusive)")
    ap.add_argument("--sessions", type=int, help="repeatable sample of at most N sessions")
    ap.add_argument("--labelled", action="store_true", help="hits carry raw_traffic_label, the class of their session")
    ap.add_argument("--shards", action="store_true", help="--events holds date-sharded folders events_YYYYMMDD (needs --start, --end)")
    ap.add_argument("--draws", help="posterior ROI draws (Parquet: channel, roi)")
    ap.add_argument("--spend", help="observed media spend (Parquet: geo, week, channel, spend)")
    ap.add_argument("--channel-map", help="the user's own channels (Parquet: key, name, priority)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("trafficlens").getOrCreate()
    label = [T.StructField("raw_traffic_label", T.StringType())] if a.labelled else []
    schema = T.StructType([*schemas.GA_EVENTS.fields, *label])
    if a.shards:
        if not (a.start and a.end):
            ap.error("--shards needs --start and --end")
        events = read_date_shards(spark, a.events, a.start, a.end, schema=schema)
    else:
        events = read_events(spark, a.events, schema=schema)
    signals = spark.read.schema(schemas.SIGNALS).parquet(a.signals) if a.signals else None
    cfg = dataclasses.replace(C.PipelineConfig(), date_start=a.start, date_end=a.end, n_sessions=a.sessions)
    out = run(spark, events, a.out, signals=signals, cfg=cfg, labelled=a.labelled,
              draws=spark.read.parquet(a.draws) if a.draws else None, spend=spark.read.parquet(a.spend) if a.spend else None,
              channel_map=spark.read.parquet(a.channel_map) if a.channel_map else None)
    print(json.dumps(out.paths))
    return out.paths


if __name__ == "__main__":
    main()

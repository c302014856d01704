"""Sinks: CSV exports of sessions, the JSON summary, Parquet payloads.

All writes are distributed (one file per task); nothing is collected to the
driver. Paths should live on shared storage on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an export back with its declared schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_json(doc: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A one-row summary document as a single JSON file."""
    doc.coalesce(1).write.mode(mode).json(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_by_day(events: DataFrame, path: str, day: str = "event_date", mode: str = "overwrite") -> str:
    """A copy with one folder per day, so that date ranges read only their folders.
    Rows are first brought together by day and one of four hash values, so a day has
    few files and no task writes a whole day."""
    spread = events.sparkSession.conf.get("spark.sql.shuffle.partitions")
    events.repartition(int(spread), day, F.pmod(F.hash(*[c for c, t in events.dtypes if not t.startswith(("array", "map", "struct"))]), F.lit(4))) \
        .write.mode(mode).partitionBy(day).parquet(path)
    return path

"""Readers for the input tables.

Parquet is read with an explicit path per table; Catalyst pushes filters and
column pruning into the scan. Hit-level events are expected date-partitioned
(``event_date=...``) in production so that date ranges prune whole folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared schemas of the driver tables this library reads (no inference pass).
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame. How many tasks scan it is decided by the
    file layout and ``spark.sql.files.maxPartitionBytes``."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, path: str, schema=None, fmt: str = "parquet", **options) -> DataFrame:
    """Read a hit-level event export (any Spark file source)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_date_shards(spark: SparkSession, base: str, start: str, end: str, prefix: str = "events_",
                     fmt: str = "parquet", schema=None) -> DataFrame:
    """Read date-sharded folders ``{base}/{prefix}YYYYMMDD`` whose suffix lies
    in [start, end] (both inclusive, ``YYYY-MM-DD``). One Hadoop glob over
    the calendar days of the range selects the shards, so only those folders
    are listed and read; days without a shard are simply not matched. Adds
    ``event_date`` from the shard suffix where the data has none."""
    import datetime as dt

    d0, d1 = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = [(d0 + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((d1 - d0).days + 1)]
    if not days:
        raise ValueError("empty date range")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(f"{base.rstrip('/')}/{prefix}{{{','.join(days)}}}")
    suffix = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), prefix + r"(\d{8})", 1), "yyyyMMdd")
    # a declared schema may name the column although the files do not have it
    given = [F.col("event_date")] if "event_date" in df.columns else []
    return df.withColumn("event_date", F.coalesce(*given, suffix))


def scan_date_range(events: DataFrame, start: str | None, end: str | None, col: str = "event_date") -> DataFrame:
    """Keep ``start <= col <= end`` (both inclusive). On a table partitioned by
    ``col`` both bounds become partition filters, so only those folders are read."""
    if start is not None:
        events = events.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        events = events.where(F.col(col) <= F.lit(end).cast("date"))
    return events


def scan_days(events: DataFrame, days: DataFrame, col: str = "event_date") -> DataFrame:
    """Events of the ``days`` table's days (column ``col``; repeated days count
    once). On a table partitioned by ``col`` the planner prunes folders by the days that
    the other side has at run time (dynamic partition pruning), whatever filter
    they come from."""
    return events.join(days.select(col).distinct(), col, "left_semi")


def require_rows(df: DataFrame, what: str = "query") -> DataFrame:
    """Fail fast on an empty result (job entry points only)."""
    if df.isEmpty():
        raise ValueError(f"{what} returned 0 rows")
    return df

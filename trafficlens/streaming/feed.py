"""A bidding feed that can be replayed: micro-batches are merged into a keyed table.

The table is Parquet partitioned by a column that is fixed for a key (the day of
the session). A batch is reduced to the newest row per key, merged with the
partitions it touches, and these are overwritten (dynamic partition
overwrite); other partitions are neither read nor written. A row replaces the
stored one of its key if its revision is not older. Merging is idempotent, so a
batch that failed half way is simply run again; a ledger of finished batches
also spares the work of repeating one that is done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .stream import bidding_payload_stream

LEDGER = "feed string, batch_id bigint, rows bigint"


def newest(rows: DataFrame, key: Sequence[str], revision: str) -> DataFrame:
    """One row per key: the one with the highest revision; of equal revisions
    that with the greatest values, so the result does not depend on the order
    of rows. Partial aggregation keeps one row per key and task."""
    rest = [c for c in rows.columns if c not in key]
    best = F.max(F.struct(F.col(revision).alias("_revision"), *rest)).alias("_row")
    return rows.groupBy(*key).agg(best).select(*[f"_row.{c}" if c in rest else c for c in rows.columns])


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """feed, batch_id, rows of the finished batches."""
    return _read(spark, ledger, LEDGER)


def merge(batch: DataFrame, path: str, key: Sequence[str], revision: str, partition: str) -> int:
    """Merge ``batch`` into the table at ``path``; returns its number of keys.
    ``partition`` is one of the key's columns or fixed for a key. The values of
    ``partition`` in the batch (the days it touches) come to the driver."""
    spark = batch.sparkSession
    rows = materialize(newest(batch, key, revision))
    touched = [r[0] for r in rows.select(partition).distinct().collect()]
    if not touched:
        return 0
    days = F.col(partition).isin(*[v for v in touched if v is not None])
    if None in touched:
        days = F.coalesce(days, F.lit(False)) | F.col(partition).isNull()
    old = _read(spark, path, batch.schema).where(days)
    # written out before the partitions it comes from are replaced
    merged = materialize(newest(old.select(*batch.columns).unionByName(rows), key, revision))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return rows.count()


def upsert(path: str, ledger: str, feed: str, key: Sequence[str] = ("client_id", "session_id"), revision: str = "revision",
           partition: str = "day") -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a feed. ``feed`` names the stream whose
    batch ids the ledger holds; a new checkpoint needs a new name."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not read_ledger(spark, ledger).where((F.col("feed") == feed) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        n = merge(batch, path, key, revision, partition)
        spark.createDataFrame([(feed, batch_id, n)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)

    return run


def payload_rows(rows: DataFrame) -> DataFrame:
    """Upload rows with their day and revision, from session rows that have a ``revision``."""
    out = bidding_payload_stream(rows)
    return out.withColumn("day", F.to_date(F.substring("event_timestamp", 1, 10)))


def start_upsert_feed(rows: DataFrame, path: str, ledger: str, feed: str, checkpoint: str, every: str | None = "2 seconds"):
    """Keep the keyed table at ``path`` up to date from a stream of session rows;
    ``every`` None: merge what is available and stop. Returns the StreamingQuery."""
    w = payload_rows(rows).writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert(path, ledger, feed))
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    return w.start()


def read_feed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The keyed table as it is now."""
    return _read(spark, path, schema)

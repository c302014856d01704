"""Structured Streaming forms of sessionising, classifying and the bidding
feed. The operators are the batch expressions applied to a streaming
DataFrame; state is only kept where the semantics need it (session and
tumbling windows), bounded by the watermark in append mode.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from ..operators.classify import CLASS
from ..session import scratch_path

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_event_stream(spark: SparkSession, directory: str, glob: str | None = "events.parquet",
                      max_files_per_trigger: int | None = None, schema: str = EVENTS_SCHEMA) -> DataFrame:
    """Hit stream from a folder of Parquet files. ``ts`` (UTC wall clock)
    becomes an instant (``timestamp``), which watermarks require."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory).withColumn("ts", X.utc_instant("ts"))


def stream_gap_sessions(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour",
                        key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Sessions by inactivity gap per key; closed sessions are emitted (append)
    once the watermark passes their end, and their state is dropped."""
    s = (events.withWatermark(ts, watermark)
         .groupBy(key, F.session_window(ts, gap).alias("s"))
         .agg(F.count(F.lit(1)).alias("n_events")))
    return s.select(key, F.unix_micros(F.col("s.start")).alias("session_start_us"),
                    F.unix_micros(F.col("s.end")).alias("session_end_us"), "n_events")


def stream_spans(events: DataFrame, span: str = "5 minutes", watermark: str = "1 hour", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """First half of sessions for keys with very many hits: per key and span of
    time the first and last hit and their number, emitted when the watermark
    passes the span. Tasks fold their hits before the shuffle, and the state is
    held by (key, span), so no state partition has all hits of a key."""
    s = events.withWatermark(ts, watermark).groupBy(key, F.window(ts, span).alias("w")).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return s.select(key, "first_ts", "last_ts", "n")


def stream_sessions_of_spans(spans: DataFrame, gap: str = "30 minutes", span: str = "5 minutes", key: str = "user_id") -> DataFrame:
    """Second half: spans of a key that are no further apart than ``gap``, as
    ``stream_gap_sessions`` gives them. A span lasts to its last hit plus the gap.
    Later spans begin at most ``span`` before those already seen, so this
    watermark drops none."""
    inside = F.unix_micros("last_ts") - F.unix_micros("first_ts")
    reach = F.concat(F.lit(f"{gap} "), inside.cast("string"), F.lit(" microseconds"))
    s = (spans.withWatermark("first_ts", span)
         .groupBy(key, F.session_window("first_ts", reach).alias("s"))
         .agg(F.sum("n").alias("n_events")))
    return s.select(key, F.unix_micros(F.col("s.start")).alias("session_start_us"),
                    F.unix_micros(F.col("s.end")).alias("session_end_us"), "n_events")


def drain_split_sessions(events: DataFrame, name: str, gap: str = "30 minutes", span: str = "5 minutes", watermark: str = "1 hour",
                         key: str = "user_id", ts: str = "ts", folder: str | None = None) -> DataFrame:
    """Inactivity sessions through both halves, each drained into a table under
    ``folder``; the second reads the first one's table as a stream. Hits of one
    span must be in one session, so ``span`` may not be longer than ``gap``.
    Given the folder of an earlier run both go on from there."""
    spark = events.sparkSession
    if not spark.sql(f"SELECT INTERVAL {span} <= INTERVAL {gap}").first()[0]:
        raise ValueError("span must not be longer than gap")
    folder = folder or scratch_path(spark, name)
    at = {n: f"{folder}/{n}" for n in ("spans", "spans-state", "sessions", "sessions-state")}
    halves = stream_spans(events, span, watermark, key, ts)
    drain(halves, f"{name}-spans", at["spans"], at["spans-state"])
    try:
        spans = spark.readStream.schema(halves.schema).parquet(at["spans"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # no hit has come yet
        return spark.createDataFrame([], f"{key} {halves.schema[key].dataType.simpleString()}, "
                                         "session_start_us bigint, session_end_us bigint, n_events bigint")
    return drain(stream_sessions_of_spans(spans, gap, span, key), f"{name}-sessions", at["sessions"], at["sessions-state"])


def stream_hits_per_window(events: DataFrame, size: str = "1 hour", watermark: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Hits per tumbling window, emitted when the watermark passes its end; rows
    that come later than that are dropped."""
    g = events.withWatermark(ts, watermark).groupBy(F.window(ts, size).alias("w")).agg(F.count(F.lit(1)).alias("n_events"))
    return g.select(F.unix_micros(F.col("w.start")).alias("window_start_us"), "n_events")


def classify_stream(rows: DataFrame, t: C.Thresholds = C.Thresholds()) -> DataFrame:
    """Stateless: class and bid value on each streaming session row."""
    human = F.col(CLASS) == C.HUMAN
    return (rows.withColumn(CLASS, X.classify(t=t))
            .withColumn("channel", X.channel_of("source_medium"))
            .withColumn("bid_value", F.when(human, X.conversion_value("source_medium")).otherwise(F.lit(0.0))))


def stream_tumbling_value(classified: DataFrame, size: str = "1 hour", watermark: str = "1 hour",
                          ts: str = "_ts") -> DataFrame:
    """Per tumbling window and channel: sessions, human sessions, bid value."""
    g = (classified.withWatermark(ts, watermark)
         .groupBy(F.window(ts, size).alias("w"), "channel")
         .agg(F.count(F.lit(1)).alias("sessions"),
              F.count_if(F.col(CLASS) == C.HUMAN).alias("human_sessions"),
              F.sum("bid_value").alias("_bid")))
    return g.select(F.unix_micros(F.col("w.start")).alias("window_start_us"), "channel", "sessions",
                    "human_sessions", F.round("_bid", 2).alias("bid_value"))


def drain(df: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run a streaming query over everything available in append mode, write it
    to Parquet on shared storage (file sink, exactly once through its commit
    log), and return the written table. Stateful queries have as many state
    partitions as ``spark.sql.shuffle.partitions`` says when the checkpoint
    is new. Given the ``path`` and ``checkpoint`` of an earlier run it goes
    on from there."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).queryName(f"{name}-{uuid.uuid4().hex}")
    w.outputMode("append").format("parquet").option("path", path).start().awaitTermination()
    try:
        return spark.read.schema(df.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], df.schema)  # no batch ran, so no folder was made


def bidding_payload_stream(rows: DataFrame, t: C.Thresholds = C.Thresholds()) -> DataFrame:
    """Upload rows for every streamed session: humans carry their source's
    value, bots 0.00 and ``traffic_type = 'internal'``."""
    c = classify_stream(rows, t)
    revision = ["revision"] if "revision" in rows.columns else []
    return c.select("client_id", "session_id", "event_timestamp", "source_medium", CLASS,
                    F.col("bid_value").alias("conversion_value"),
                    F.when(F.col(CLASS) != C.HUMAN, F.lit("internal")).alias("traffic_type"), *revision)


def attach_signals_stream(sessions: DataFrame, signals: DataFrame, wait: str = "1 hour", watermark: str = "1 hour",
                          ts: str = "_ts", signal_ts: str = "_signal_ts", key=("client_id", "session_id")) -> DataFrame:
    """Sessions with the signals measured on a second stream: a left outer join
    by key and time. A signal counts if its time is at most ``wait`` after the
    session's; of several for a key, the first to arrive. Both sides have a
    watermark, so the state of a session is held for ``wait`` and the watermark's
    delay at most: a session whose signal came goes out with the signal, one
    without goes out with NULLs once the watermark has passed its wait
    (``impute_signals`` then fills them)."""
    rename = {c: f"_g_{c}" for c in key}
    g = signals.withWatermark(signal_ts, watermark).dropDuplicatesWithinWatermark(list(key)).select(
        *[F.col(c).alias(n) for c, n in rename.items()], signal_ts, F.col("edge_score").alias("_m_score"),
        F.col("mouse_move_events").alias("_m_mouse"))
    s = sessions.drop("edge_score", "mouse_move_events").withWatermark(ts, watermark)
    on = F.lit(True)
    for c, n in rename.items():
        on = on & (F.col(c) == F.col(n))
    on = on & (F.col(signal_ts) >= F.col(ts)) & (F.col(signal_ts) <= F.col(ts) + F.expr(f"INTERVAL {wait}"))
    return s.join(g, on, "leftOuter").drop(*rename.values()).withColumnsRenamed({"_m_score": "edge_score", "_m_mouse": "mouse_move_events"})


def start_bidding_feed(rows: DataFrame, path: str, checkpoint: str, every: str | None = "2 seconds",
                       t: C.Thresholds = C.Thresholds()):
    """Start the live bidding feed: a micro-batch every ``every`` (None: drain
    what is available and stop), appended to Parquet through the file sink,
    which commits each batch exactly once. Returns the StreamingQuery."""
    w = (bidding_payload_stream(rows, t).writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    return w.start()

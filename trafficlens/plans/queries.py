"""Registered queries: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (``events``, ``nation``) through the
fixture views and runs over them whole. Column names match the SQL in
``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import anomaly as AN
from ..operators import channels as CH
from ..operators import classify as CL
from ..operators import clean as CN
from ..operators import model as MD
from ..operators import ordered as O
from ..operators import panel as P
from ..operators import report as R
from ..operators import sessionize as S
from ..operators import signals as SG
from ..operators import user_map as UM
from ..functions import expressions as X
from ..functions.expressions import ntz_micros
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources import sinks
from ..sources.tables import read_date_shards, read_events, require_rows, scan_date_range, scan_days, table
from ..streaming import feed as FD
from ..streaming import stream as ST

CFG = C.PipelineConfig()
DATE_START, DATE_END = "2024-01-05", "2024-01-20"
GAP_US = 30 * 60 * 1_000_000
SAMPLE_N = 1000
TRAINING_AS_OF, TRAINING_DAYS = "2024-01-28", 7
LATE_CUT = "2024-01-15 00:00:00"


# ---------------------------------------------------------------- helpers
def _ga(spark, d) -> DataFrame:
    return FX.ga_events(spark, d)


def _sessions(spark, d) -> DataFrame:
    return S.sessions_from_events(_ga(spark, d))


def _classified(spark, d, with_rule=False) -> DataFrame:
    return CL.classify_sessions(FX.session_signals(spark, d), with_rule=with_rule)


def _enriched(spark, d) -> DataFrame:
    return SG.enrich(_sessions(spark, d), FX.signals(spark, d))


def _cleaned(spark, d) -> DataFrame:
    return CN.cleaned_sessions(_classified(spark, d))


def _raw_events(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        "user_id", ntz_micros("ts").alias("us"), "event_id")


def _allowed_hits(spark, d) -> DataFrame:
    ev = S.with_param_lookups(S.event_allowlist(_ga(spark, d)))
    return ev.where(F.col("session_id").isNotNull()).select(
        F.col("user_pseudo_id").alias("client_id"), "session_id", "event_timestamp", "event_id")


# ---------------------------------------------------------------- queries
def q_scan_date_range(spark, d):
    return scan_date_range(_ga(spark, d), DATE_START, DATE_END).select(
        "event_id", "user_pseudo_id", "event_date", "event_name")


HIT_COLUMNS = ["event_id", "user_pseudo_id", "event_date", "event_name"]


def _by_day(spark, d) -> DataFrame:
    """The hits in folders by day, read back."""
    hits = _ga(spark, d)
    path = sinks.write_by_day(hits, scratch_path(spark, "hits-by-day"))
    return spark.read.schema(hits.schema).parquet(path)


def q_scan_partitioned_range(spark, d):
    return scan_date_range(_by_day(spark, d), DATE_START, DATE_END).select(*HIT_COLUMNS)


def q_scan_partitioned_days(spark, d):
    """Days on which more than the mean number of errors occurred, found at run time."""
    n = table(spark, d, "events").where("event_type = 'error'").groupBy(F.to_date("ts").alias("event_date")).agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "error-days")
    n.write.parquet(path)
    days = spark.read.schema(n.schema).parquet(path)
    return scan_days(_by_day(spark, d), days.where(F.col("n") > days.agg(F.avg("n")).scalar())).select(*HIT_COLUMNS)


def q_scan_date_shards(spark, d):
    """A date-sharded export, written as such and read for the date range."""
    hits = table(spark, d, "events").withColumn("shard", F.date_format("ts", "yyyyMMdd"))
    path = scratch_path(spark, "shards")
    hits.write.partitionBy("shard").parquet(path)
    out = read_date_shards(spark, path, DATE_START, DATE_END, prefix="shard=")
    return out.select("event_id", "user_id", "event_type", "event_date")


def q_event_allowlist(spark, d):
    return S.event_allowlist(_ga(spark, d)).select("event_id", "user_pseudo_id", "event_name")


def q_event_param_lookup(spark, d):
    return S.with_param_lookups(_ga(spark, d)).select("event_id", "session_id", "percent_scrolled", "page_location")


def q_event_param_profile(spark, d):
    return S.event_param_profile(_ga(spark, d))


def q_sessions(spark, d):
    return _sessions(spark, d)


def q_normalize_sessions(spark, d):
    return S.normalize_sessions(_sessions(spark, d))


def q_normalize_sessions_nulls(spark, d):
    """Sessions that lost counts, duration and velocity, each on rows of its own."""
    lost = {"session_duration_sec": 2, "total_events": 3, "click_events": 5, "scroll_events": 7, "page_scroll_depth_pct": 11, "event_velocity_per_sec": 13}
    s = _sessions(spark, d)
    return S.normalize_sessions(s.withColumns({c: F.when(F.col("session_id") % m != 0, F.col(c)) for c, m in lost.items()}))


def q_sample_sessions(spark, d):
    return S.sample_sessions(_sessions(spark, d), SAMPLE_N, CFG.sample_seed)


def q_sample_sessions_tenth(spark, d):
    """Every tenth session by hash: a sample too large for one task."""
    sessions = _sessions(spark, d)
    return S.sample_sessions(sessions, sessions.count() // 10, CFG.sample_seed, top_rows=0)


def q_top_sources(spark, d):
    return S.top_sources(_sessions(spark, d), CFG.top_sources)


def q_gap_sessions(spark, d):
    return O.gap_sessions(_raw_events(spark, d), ["user_id"], "us", GAP_US)


def q_time_between_events(spark, d):
    return O.gap_stats(_allowed_hits(spark, d), ["client_id", "session_id"], "event_timestamp", tie="event_id")


def q_request_cadence(spark, d):
    return S.request_cadence(S.event_allowlist(_ga(spark, d)), CFG.cadence_window)


def q_scroll_duration_ratio(spark, d):
    return S.scroll_duration_ratio(_sessions(spark, d))


def q_attach_signals(spark, d):
    return SG.attach_signals(_sessions(spark, d), FX.signals(spark, d)).select(
        "client_id", "session_id", "session_duration_sec", "edge_score", "mouse_move_events")


def q_behavior_tier(spark, d):
    return SG.with_behavior_tier(_sessions(spark, d)).select("client_id", "session_id", "behavior_tier")


def q_impute_signals(spark, d):
    return _enriched(spark, d).select(
        "client_id", "session_id", "behavior_tier", "edge_score", "mouse_move_events",
        "edge_score_source", "mouse_move_events_source")


def q_edge_score_range(spark, d):
    return SG.edge_score_range(_enriched(spark, d))


def q_classify_sessions(spark, d):
    return _classified(spark, d, with_rule=True).select(
        "client_id", "session_id", "raw_traffic_label", CL.CLASS, "rule_fired")


def q_class_distribution(spark, d):
    return CL.class_distribution(_classified(spark, d))


def q_classification_accuracy(spark, d):
    return CL.classification_accuracy(_classified(spark, d))


def q_per_class_recall(spark, d):
    return CL.per_class_recall(_classified(spark, d))


def q_confusion_matrix(spark, d):
    return CL.confusion_matrix(_classified(spark, d))


def q_cleaned_sessions(spark, d):
    return _cleaned(spark, d)


def q_bot_quarantine(spark, d):
    return CN.bot_quarantine(_classified(spark, d)).select(
        "client_id", "session_id", "source_medium", "raw_traffic_label", CL.CLASS)


def q_csv_roundtrip_clean(spark, d):
    cleaned = _cleaned(spark, d)
    path = scratch_path(spark, "cleaned-csv")
    sinks.write_csv(cleaned, path)
    return sinks.read_csv(spark, path, cleaned.schema)


def q_session_totals(spark, d):
    return CN.session_totals(_classified(spark, d))


def q_vbb_summary(spark, d):
    return CN.vbb_summary(_classified(spark, d))


def q_vbb_upload_payload(spark, d):
    return CN.vbb_upload_payload(_classified(spark, d))


def q_channel_map(spark, d):
    return CH.channel_map(FX.session_signals(spark, d))


def q_user_channel_map(spark, d):
    """A user's map: countries, and short and common keys after them."""
    own = table(spark, d, "nation").select(F.col("n_name").alias("key"), F.concat(F.lit("Region "), F.col("n_regionkey")).alias("name"),
                                           F.col("n_nationkey").alias("priority"))
    mapping = own.where(F.col("priority") % 3 != 0).unionByName(X.const_table(spark, [
        ("cpc", "Paid search", 50), ("Paid_Social", "Paid social", 40), ("7", "Seven", 70), ("x2", "Pair", 60), ("no such key", "Never", 1)],
        ["key", "name", "priority"]))
    rows = FX.session_signals(spark, d).select("client_id", "session_id", F.concat_ws(
        " / ", "source_medium", "geo_country", F.concat(F.lit("X"), F.col("client_id"))).alias("source_medium"))
    return UM.with_channel_of_table(rows, mapping)


def q_channel_stats(spark, d):
    return CH.channel_stats(_classified(spark, d)).select(
        "channel", "raw_sessions", "clean_sessions", F.round("clean_kpi", 2).alias("clean_kpi"),
        F.round("avg_conv_value", 4).alias("avg_conv_value"))


def q_observed_channels(spark, d):
    return CH.observed_channels(_classified(spark, d))


def q_channel_attribution(spark, d):
    return CH.channel_attribution(_classified(spark, d))


def q_channel_rank_shift(spark, d):
    return CH.channel_rank_shift(_classified(spark, d))


def q_channel_spend(spark, d):
    return CH.channel_spend(_classified(spark, d))


def q_roi_from_draws(spark, d):
    return P.roi_from_draws(FX.roi_draws(spark, d))


def q_roi_override(spark, d):
    return P.roi_override(_classified(spark, d), FX.roi_draws(spark, d))


def q_daily_sessions(spark, d):
    return R.daily_sessions(_classified(spark, d), CFG.daily_days)


def q_daily_sessions_ordered(spark, d):
    return R.numbered(R.daily_sessions(_classified(spark, d), CFG.daily_days))


def q_weekly_channel_panel_bounded(spark, d):
    """The panel of the weeks of January, whatever stray times the sessions have."""
    stray = F.when(F.col("session_id") % 1000 == 1, F.lit("1970-01-01T00:00:00")).otherwise(F.col("event_timestamp"))
    return P.weekly_channel_panel(_cleaned(spark, d).withColumn("event_timestamp", stray), start="2024-01-01", end="2024-01-31")


def q_daily_join(spark, d):
    return R.daily_join(_classified(spark, d))


def q_weekly_channel_panel(spark, d):
    return P.weekly_channel_panel(_cleaned(spark, d))


def q_panel_roi(spark, d):
    panel = P.weekly_channel_panel(_cleaned(spark, d), geo_col="geo_country")
    return P.panel_roi(panel, FX.media_spend(spark, d))


def q_panel_roi_joint(spark, d):
    panel = P.weekly_channel_panel(_cleaned(spark, d), geo_col="geo_country")
    return P.panel_roi_joint(panel, FX.media_spend(spark, d))


def q_feature_profile_match(spark, d):
    return CL.feature_profile_match(FX.session_signals(spark, d))


def q_bot_signature_flags(spark, d):
    return CL.bot_signature_flags(FX.session_signals(spark, d))


def q_session_outliers(spark, d):
    return CL.session_outliers(FX.session_signals(spark, d))


def q_training_slice(spark, d):
    return CL.training_slice(FX.session_signals(spark, d), TRAINING_AS_OF, TRAINING_DAYS, FX.outcomes(spark, d))


def q_summary_report(spark, d):
    return R.summary_report(_classified(spark, d), CFG.daily_days)


def q_kmeans_clusters(spark, d):
    return CL.kmeans_clusters(FX.session_signals(spark, d))


def q_kmeans_seeds(spark, d):
    return CL.kmeans_seeds(FX.session_signals(spark, d))


def q_kmeans_seeded(spark, d):
    return CL.kmeans_seeded(FX.session_signals(spark, d))


def q_model_scores(spark, d):
    """A Python model (here a linear one) over the features, batch by batch."""
    weights = [2.0, -0.05, 0.005, 0.01]

    def predict(x):
        return (x.fillna(0.0) * weights).sum(axis=1).round(6)

    out = CL.score_with_model(FX.session_signals(spark, d), predict, out_type=T.DoubleType())
    return out.select("client_id", "session_id", F.col("prediction").alias("score"))


def q_isolation_scores(spark, d):
    return AN.isolation_scores(FX.session_signals(spark, d))


def q_fitted_model_scores(spark, d):
    """A tree fitted on the training slice scores all sessions."""
    b = FX.session_signals(spark, d)
    return MD.score(b, MD.fit(CL.training_slice(b, TRAINING_AS_OF, TRAINING_DAYS, FX.outcomes(spark, d))))


def q_raw_csv(spark, d):
    raw = _classified(spark, d).drop("_ts", "_value", "referrer")
    path = scratch_path(spark, "raw-csv")
    sinks.write_csv(raw, path)
    return require_rows(read_events(spark, path, schema=raw.schema, fmt="csv", header=True))


def _nulls(spark, d):
    """Hits with missing times and labels for every seventh event."""
    gap = F.col("event_id") % 7 == 0
    return _raw_events(spark, d).withColumn("us", F.when(~gap, F.col("us")))


def q_gap_sessions_nulls(spark, d):
    return O.gap_sessions(_nulls(spark, d), ["user_id"], "us", GAP_US)


def q_time_between_events_nulls(spark, d):
    return O.gap_stats(_nulls(spark, d), ["user_id"], "us", tie="event_id")


def q_accuracy_nulls(spark, d):
    c = _classified(spark, d)
    return CL.classification_accuracy(c.withColumn(CL.LABEL, F.when(F.col("session_id") % 7 != 0, F.col(CL.LABEL))))


def q_weekly_panel_nulls(spark, d):
    c = _cleaned(spark, d)
    return P.weekly_channel_panel(c.withColumn("geo_country", F.when(F.col("client_id") % 3 != 0, F.col("geo_country"))), geo_col="geo_country")


def _stream_rows(spark, d):
    ev = ST.read_event_stream(spark, d)
    return FX.session_signals_from(ev, FX.nations(spark, d))


def q_stream_gap_sessions(spark, d):
    return ST.drain(ST.stream_gap_sessions(ST.read_event_stream(spark, d), CFG.session_gap, CFG.watermark), "stream-gap-sessions")


def q_stream_split_sessions(spark, d):
    """The same sessions in two halves, the first of which spreads a user's hits;
    the users are two, so each has half the stream."""
    hits = ST.read_event_stream(spark, d).withColumn("user_id", F.col("user_id") % 2)
    return ST.drain_split_sessions(hits, "stream-split-sessions", CFG.session_gap, CFG.session_span, CFG.watermark)


def q_stream_tumbling_value(spark, d):
    s = ST.stream_tumbling_value(ST.classify_stream(_stream_rows(spark, d)), CFG.tumbling_window, CFG.watermark)
    return ST.drain(s, "stream-tumbling-value")


def q_stream_classify(spark, d):
    s = ST.classify_stream(_stream_rows(spark, d)).select(
        "client_id", "session_id", CL.CLASS, "channel", "bid_value")
    return ST.drain(s, "stream-classify")


def q_stream_late_rows(spark, d):
    """The newer hits arrive first; a second run of the same query gets the
    older ones, all behind the watermark by then."""
    events = table(spark, d, "events")
    folder, out, state = (scratch_path(spark, n) for n in ("late-in", "late-out", "late-state"))
    stream = lambda: ST.stream_hits_per_window(ST.read_event_stream(spark, folder, glob="*.parquet"), CFG.tumbling_window, CFG.watermark)
    cut = F.lit(LATE_CUT).cast("timestamp_ntz")
    events.where(F.col("ts") >= cut).write.parquet(folder)
    ST.drain(stream(), "stream-late-rows", out, state)
    events.where(F.col("ts") < cut).write.mode("append").parquet(folder)
    return ST.drain(stream(), "stream-late-rows", out, state)


def q_stream_attach_signals(spark, d):
    """Sessions and the signals measured later, both as streams; the missing
    signals are imputed."""
    s = ST.attach_signals_stream(_stream_rows(spark, d), FX.late_signals(ST.read_event_stream(spark, d)), "1 hour", CFG.watermark)
    return ST.drain(SG.impute_signals(s).select("client_id", "session_id", "edge_score", "mouse_move_events", "edge_score_source"), "stream-attach-signals")


def q_stream_upsert_feed(spark, d):
    """The keyed bidding table after a first load, corrections for every seventh
    session, the first load once more, and a repeated batch."""
    events = table(spark, d, "events").withColumn("revision", F.lit(0).cast("bigint"))
    folder, out, ledger, state = (scratch_path(spark, n) for n in ("feed-in", "feed", "feed-ledger", "feed-state"))
    k = F.from_json("props", "k string")["k"].cast("bigint")
    corrected = events.where(F.col("event_id") % 7 == 0).withColumns(
        {"props": F.concat(F.lit('{"k": '), ((k + 50) % 100).cast("string"), F.lit("}")), "revision": F.lit(1).cast("bigint")})
    stream = lambda: FX.session_signals_from(
        ST.read_event_stream(spark, folder, glob="*.parquet", schema=ST.EVENTS_SCHEMA + ", revision bigint"), FX.nations(spark, d))
    for load in (events, corrected, events):
        load.write.mode("append").parquet(folder)
        FD.start_upsert_feed(stream(), out, ledger, "bids", state, every=None).awaitTermination()
    # Spark repeats a batch whose end it has not seen
    again = FD.payload_rows(FX.session_signals_from(events, FX.nations(spark, d)))
    FD.upsert(out, ledger, "bids")(again, 0)
    return FD.read_feed(spark, out, again.schema)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}

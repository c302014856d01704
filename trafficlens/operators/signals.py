"""Request-risk and interaction signals: attach measured values, impute the
rest from the behaviour tier, and keep provenance on every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X

SESSION_KEY = ["client_id", "session_id"]


def attach_signals(sessions: DataFrame, signals: DataFrame, key=SESSION_KEY) -> DataFrame:
    """Left join measured ``edge_score`` / ``mouse_move_events`` by session key.

    Signals are first reduced to one row per key (if several measurements
    arrive, the lowest edge score, i.e. the most bot-like one, and the
    highest mouse count are kept), so
    the join never multiplies sessions and has no skewed key. That aggregate
    is partitioned like the join needs it (no extra shuffle); the planner
    picks broadcast or sort-merge from the measured size (AQE re-checks at
    run time)."""
    sig = signals.groupBy(*key).agg(F.min("edge_score").alias("_m_score"),
                                    F.max("mouse_move_events").alias("_m_mouse"))
    base = sessions.drop(*[c for c in ("edge_score", "mouse_move_events") if c in sessions.columns])
    return base.join(sig, list(key), "left").withColumnsRenamed(
        {"_m_score": "edge_score", "_m_mouse": "mouse_move_events"})


def with_behavior_tier(sessions: DataFrame, r: C.TierRules = C.TierRules()) -> DataFrame:
    return sessions.withColumn("behavior_tier", X.behavior_tier(r=r))


def impute_signals(df: DataFrame, r: C.TierRules = C.TierRules()) -> DataFrame:
    """Fill missing signals from the tier and record where each value came from."""
    if "edge_score" not in df.columns:
        df = df.withColumn("edge_score", F.lit(None).cast("double"))
    if "mouse_move_events" not in df.columns:
        df = df.withColumn("mouse_move_events", F.lit(None).cast("bigint"))
    if "behavior_tier" not in df.columns:
        df = with_behavior_tier(df, r)
    score = X.nan_to_null("edge_score")
    return df.withColumns({
        "edge_score_source": F.when(score.isNotNull(), F.lit(C.MEASURED)).otherwise(F.lit(C.IMPUTED)),
        "mouse_move_events_source": F.when(F.col("mouse_move_events").isNotNull(), F.lit(C.MEASURED))
        .otherwise(F.lit(C.IMPUTED)),
        "edge_score": F.coalesce(score, X.tier_score("behavior_tier", r)),
        "mouse_move_events": F.coalesce(F.col("mouse_move_events").cast("bigint"), X.imputed_mouse(r=r)),
    })


def enrich(sessions: DataFrame, signals: DataFrame | None = None, r: C.TierRules = C.TierRules()) -> DataFrame:
    df = attach_signals(sessions, signals) if signals is not None else sessions
    return impute_signals(with_behavior_tier(df, r), r)


def edge_score_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("edge_score").alias("min_edge_score"), F.max("edge_score").alias("max_edge_score"),
                  F.count("edge_score").alias("n_scored"))

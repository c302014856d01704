"""Cleaning: keep human sessions, attach conversion values, totals, and the
bidding payload in which bot traffic is worth nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from .classify import CLASS

def conv_value_table(spark: SparkSession, mapping=C.CONV_VALUES) -> DataFrame:
    return X.const_table(spark, [(k, float(v)) for k, v in mapping], ["source_medium", "_conv_value"])


def with_conversion_value(df: DataFrame, values: DataFrame | None = None,
                          default: float = C.DEFAULT_CONV_VALUE) -> DataFrame:
    """Exact, case-sensitive lookup with a default. The built-in value table
    is fixed configuration (7 rows), so it is broadcast and the fact side
    never moves; a supplied table (``source_medium``, ``_conv_value``, one
    row per key) is left to the planner, which broadcasts it only if its
    measured size is below the threshold."""
    vt = F.broadcast(conv_value_table(df.sparkSession)) if values is None else values
    return (df.join(vt, "source_medium", "left")
            .withColumn("conversion_value_usd", F.coalesce(F.col("_conv_value"), F.lit(float(default))))
            .drop("_conv_value"))


def cleaned_sessions(classified: DataFrame, keep_keys: bool = True) -> DataFrame:
    human = with_conversion_value(classified.where(F.col(CLASS) == C.HUMAN))
    cols = [c for c in C.EXPORT_COLUMNS if c in human.columns]
    if keep_keys and "session_id" in human.columns:
        cols = ["session_id"] + cols
    return human.select(*cols)


def bot_quarantine(classified: DataFrame) -> DataFrame:
    """Sessions removed as bots, with their class."""
    return classified.where(F.col(CLASS) != C.HUMAN)


def session_totals(classified: DataFrame) -> DataFrame:
    """Raw, cleaned and removed counts in one pass."""
    raw = F.count(F.lit(1))
    clean = F.count_if(F.col(CLASS) == C.HUMAN)
    t = classified.agg(raw.alias("total_raw"), clean.alias("total_cleaned"))
    bots = F.col("total_raw") - F.col("total_cleaned")
    return t.select(
        "total_raw", "total_cleaned", bots.alias("bots_removed"),
        F.round(F.try_divide(bots * 100.0, F.col("total_raw")), 1).alias("bots_removed_pct"),
        F.round(F.try_divide(F.col("total_cleaned") * 100.0, F.col("total_raw")), 1).alias("human_pct"),
    )


def vbb_summary(classified: DataFrame, cpc: float = C.CPC_USD) -> DataFrame:
    """Value-based-bidding block: human value total and mean, spend saved."""
    v = with_conversion_value(classified)
    human = F.col(CLASS) == C.HUMAN
    t = v.agg(
        F.count_if(human).alias("human_sessions"),
        F.count_if(~human).alias("bot_sessions"),
        F.sum(F.when(human, F.col("conversion_value_usd"))).alias("_sum"),
        F.avg(F.when(human, F.col("conversion_value_usd"))).alias("_avg"),
    )
    return t.select(
        "human_sessions", "bot_sessions",
        F.round(F.coalesce(F.col("_sum"), F.lit(0.0)), 2).alias("total_conv_value"),
        F.round("_avg", 2).alias("avg_conv_value"),
        F.round(F.col("bot_sessions") * F.lit(cpc), 2).alias("estimated_spend_saved"),
    )


def vbb_upload_payload(classified: DataFrame) -> DataFrame:
    """One upload row per session, humans and bots: human = value of its
    source, bot = 0.00 and marked internal traffic."""
    v = with_conversion_value(classified)
    human = F.col(CLASS) == C.HUMAN
    return v.select(
        "client_id", "session_id", "event_timestamp", "source_medium", CLASS,
        F.when(human, F.col("conversion_value_usd")).otherwise(F.lit(0.0)).alias("conversion_value"),
        F.when(~human, F.lit("internal")).alias("traffic_type"),
    )

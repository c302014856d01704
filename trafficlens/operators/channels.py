"""Channel attribution before and after bot removal.

One conditional aggregate per channel replaces the separate group-bys and
outer joins of a row-at-a-time implementation (scan sharing by hand). After
it, everything works on at most one row per configured channel; the paid
dimension and ROAS tables are fixed configuration and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from .classify import CLASS
from .clean import with_conversion_value

def paid_dimension(spark: SparkSession) -> DataFrame:
    roas = dict(C.CHANNEL_ROAS)
    return X.const_table(spark, [(n, i, float(roas.get(n, C.DEFAULT_ROAS))) for i, n in enumerate(C.PAID_CHANNELS)],
                         ["name", "priority", "roas"])


def channel_map(sessions: DataFrame) -> DataFrame:
    """Channel of each observed source / medium, with its session count."""
    return sessions.groupBy("source_medium").agg(F.count(F.lit(1)).alias("sessions")).withColumn(
        "channel", X.channel_of("source_medium"))


def channel_stats(classified: DataFrame) -> DataFrame:
    """Raw and clean sessions, clean KPI and mean clean value per channel: the
    rows' own ``channel`` if they have one (a user's map), else the built-in one."""
    v = with_conversion_value(classified)
    if "channel" not in v.columns:
        v = v.withColumn("channel", X.channel_of("source_medium"))
    human = F.col(CLASS) == C.HUMAN
    return v.groupBy("channel").agg(
        F.count(F.lit(1)).alias("raw_sessions"),
        F.count_if(human).alias("clean_sessions"),
        F.coalesce(F.sum(F.when(human, F.col("conversion_value_usd"))), F.lit(0.0)).alias("clean_kpi"),
        F.coalesce(F.avg(F.when(human, F.col("conversion_value_usd"))), F.lit(C.DEFAULT_CONV_VALUE)).alias("avg_conv_value"),
    )


def observed_channels(classified: DataFrame) -> DataFrame:
    """Channels seen in raw or in cleaned sessions (set union), in one scan:
    each row contributes its raw channel and, if human, its clean channel."""
    ch = X.channel_of("source_medium")
    both = F.array(ch, F.when(F.col(CLASS) == C.HUMAN, ch))
    return classified.select(F.explode(both).alias("channel")).where(F.col("channel").isNotNull()).distinct()


def attribution_detail(classified: DataFrame) -> DataFrame:
    """All attribution columns, one row per reported paid channel."""
    return attribution_from_stats(channel_stats(classified))


def attribution_from_stats(stats: DataFrame) -> DataFrame:
    """Attribution from per-channel stats (channel, raw_sessions,
    clean_sessions, clean_kpi, avg_conv_value)."""
    paid = paid_dimension(stats.sparkSession)
    # stats has one row per configured channel name and one for others (keyed by channel_of), so broadcasting it is bounded.
    d = paid.join(F.broadcast(stats), paid["name"] == stats["channel"], "left")
    d = d.select(
        "name", "priority", "roas",
        F.coalesce("raw_sessions", F.lit(0).cast("bigint")).alias("raw_sessions"),
        F.coalesce("clean_sessions", F.lit(0).cast("bigint")).alias("clean_sessions"),
        F.coalesce("clean_kpi", F.lit(0.0)).alias("clean_kpi"),
        F.coalesce("avg_conv_value", F.lit(C.DEFAULT_CONV_VALUE)).alias("avg_conv_value"),
        F.col("channel").isNotNull().alias("observed"),
    )
    every = Window.partitionBy()  # <= 4 rows after the aggregate
    d = d.withColumn("_any_observed", F.max(F.col("observed")).over(every))
    d = d.where(F.col("observed") | ~F.col("_any_observed")).drop("_any_observed")
    d = d.withColumn("raw_kpi_estimate", F.col("raw_sessions") * F.col("avg_conv_value"))
    d = d.withColumn("total_clean", X.zero_guard(F.sum("clean_kpi").over(every)))
    d = d.withColumn("total_raw", X.zero_guard(F.sum("raw_kpi_estimate").over(every)))
    bot_pct = F.round((F.lit(1.0) - F.col("clean_sessions") / F.greatest(F.col("raw_sessions"), F.lit(1))) * 100.0, 1)
    d = d.withColumns({
        "raw_contribution_pct": F.round(F.col("raw_kpi_estimate") / F.col("total_raw") * 100.0, 1),
        "calibrated_contribution_pct": F.round(F.col("clean_kpi") / F.col("total_clean") * 100.0, 1),
        "bot_inflation_pct": bot_pct,
        "roi": F.col("roas"),
    })
    return d.withColumn("insight", X.insight("bot_inflation_pct"))


ATTRIBUTION_COLUMNS = ("name", "raw_contribution_pct", "calibrated_contribution_pct", "bot_inflation_pct", "roi", "insight")


def channel_attribution(classified: DataFrame) -> DataFrame:
    return attribution_detail(classified).orderBy("priority").select(*ATTRIBUTION_COLUMNS)


def attribution_totals(classified: DataFrame) -> DataFrame:
    """Clean value and raw estimate over the reported channels (true totals,
    0.0 when nothing was observed)."""
    d = attribution_detail(classified)
    return d.agg(F.round(F.sum("clean_kpi"), 2).alias("total_clean_value"),
                 F.round(F.sum("raw_kpi_estimate"), 2).alias("total_raw_value"),
                 F.count(F.lit(1)).alias("n_channels"))


def channel_rank_shift(classified: DataFrame) -> DataFrame:
    """How each channel's rank moves from raw to calibrated contribution."""
    d = attribution_detail(classified)
    every = Window.partitionBy()
    raw_rank = F.rank().over(every.orderBy(F.desc("raw_contribution_pct"), "priority"))
    cal_rank = F.rank().over(every.orderBy(F.desc("calibrated_contribution_pct"), "priority"))
    d = d.withColumn("raw_rank", raw_rank).withColumn("calibrated_rank", cal_rank)
    return d.select(
        "name", F.col("raw_rank").cast("int").alias("raw_rank"), F.col("calibrated_rank").cast("int").alias("calibrated_rank"),
        (F.col("raw_rank") - F.col("calibrated_rank")).cast("int").alias("rank_shift"),
        F.round(F.col("calibrated_contribution_pct") - F.col("raw_contribution_pct"), 1).alias("contribution_shift_pct"),
    )


def channel_spend(classified: DataFrame) -> DataFrame:
    """Spend per channel = total clean KPI x normalised share / ROAS."""
    d = attribution_detail(classified)
    every = Window.partitionBy()
    share = F.col("calibrated_contribution_pct") / 100.0
    d = d.withColumn("_share", share).withColumn("_ssum", X.zero_guard(F.sum(share).over(every)))
    d = d.withColumn("share", F.col("_share") / F.col("_ssum"))
    return d.select(
        "name", F.round("share", 4).alias("share"), "roas",
        F.round(F.col("total_clean") * F.col("share") / F.col("roas"), 2).alias("spend"),
    )

"""Daily series and the summary document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from ..session import materialize
from .panel import roi_from_draws
from .channels import attribution_from_stats
from .classify import CLASS
from .clean import with_conversion_value


def _daily_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy(X.iso_to_date("event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(F.col(CLASS) == C.HUMAN).alias("cleaned"))


def daily_sessions(classified: DataFrame, days: int = 7) -> DataFrame:
    """Raw and cleaned sessions for the last ``days`` observed days (days with
    no sessions are skipped), ascending. One aggregate, then a top-k."""
    d = _daily_counts(classified).orderBy(F.desc("day")).limit(days)
    return d.select("day", F.date_format("day", "EEE dd MMM").alias("label"), "raw", "cleaned").orderBy("day")


def numbered(daily: DataFrame, out: str = "position") -> DataFrame:
    """The output order as a column, for sinks that keep none: 1 for the first row.
    The days keep their ascending order; at most ``daily_days`` rows meet."""
    rows = F.array_sort(F.collect_list(F.struct(*daily.columns)))
    return daily.agg(rows.alias("_rows")).select(F.posexplode("_rows").alias("_at", "_row")).select(
        (F.col("_at") + 1).alias(out), *[F.col(f"_row.{c}").alias(c) for c in daily.columns])


def daily_join(classified: DataFrame) -> DataFrame:
    """Raw per day left-joined with cleaned per day, missing = 0 (all days)."""
    day = X.iso_to_date("event_timestamp").alias("day")
    raw = classified.groupBy(day).agg(F.count(F.lit(1)).alias("raw"))
    clean = classified.where(F.col(CLASS) == C.HUMAN).groupBy(
        X.iso_to_date("event_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("cleaned"))
    return raw.join(clean, "day", "left").select(
        "day", "raw", F.coalesce("cleaned", F.lit(0).cast("bigint")).alias("cleaned"))


def _packed(df: DataFrame, order: str, cols: list[str]) -> DataFrame:
    """Pack a small ordered result (<= 7 or <= 4 rows) into arrays of one row."""
    s = F.array_sort(F.collect_list(F.struct(order, *cols)))

    def field(c):
        return lambda x: x[c]

    return df.agg(*[F.transform(s, field(c)).alias(c) for c in cols])


def day_channel_cube(classified: DataFrame) -> DataFrame:
    """The one aggregate every summary figure derives from: per day and
    channel, raw and clean sessions and clean conversion value. Its size is
    days x channels, whatever the number of sessions."""
    v = with_conversion_value(classified)
    human = F.col(CLASS) == C.HUMAN
    return v.groupBy(X.iso_to_date("event_timestamp").alias("day"),
                     X.channel_of("source_medium").alias("channel")).agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(human).alias("cleaned"),
        F.sum(F.when(human, F.col("conversion_value_usd"))).alias("kpi"))


def summary_document(classified: DataFrame, mode: str = "batch", days: int = 7,
                     data_source: str = "hit-level event export", draws: DataFrame | None = None,
                     media_spend_source: str = "derived from ROAS") -> DataFrame:
    """The nested summary as a one-row DataFrame of structs and arrays. With
    ROI ``draws`` a channel's ROI is its posterior mean, and it says so.

    All parts come from ``day_channel_cube``, which is materialised once
    (days x channels rows, on the shared checkpoint folder): the input is
    scanned and shuffled once, the parts read the small table."""
    cube = materialize(day_channel_cube(classified))  # days x channels rows
    t = cube.agg(F.sum("raw").alias("total_raw"), F.sum("cleaned").alias("total_cleaned"),
                 F.sum("kpi").alias("_kpi"))
    bots = F.col("total_raw") - F.col("total_cleaned")
    totals = t.select(
        F.coalesce("total_raw", F.lit(0).cast("bigint")).alias("total_raw"),
        F.coalesce("total_cleaned", F.lit(0).cast("bigint")).alias("total_cleaned"),
        F.coalesce(bots, F.lit(0).cast("bigint")).alias("bots_removed"),
        F.round(F.try_divide(bots * 100.0, F.col("total_raw")), 1).alias("bots_removed_pct"),
        F.round(F.try_divide(F.col("total_cleaned") * 100.0, F.col("total_raw")), 1).alias("human_pct"),
        F.round(F.coalesce(F.col("_kpi"), F.lit(0.0)), 2).alias("total_conv_value"),
        F.round(F.try_divide(F.col("_kpi"), F.col("total_cleaned")), 2).alias("avg_conv_value"),
        F.round(F.coalesce(bots, F.lit(0)) * F.lit(C.CPC_USD), 2).alias("estimated_spend_saved"),
    )
    per_day = cube.groupBy("day").agg(F.sum("raw").alias("raw"), F.sum("cleaned").alias("cleaned"))
    last = per_day.orderBy(F.desc("day")).limit(days).select(
        "day", F.date_format("day", "EEE dd MMM").alias("label"), "raw", "cleaned")
    daily = _packed(last, "day", ["label", "raw", "cleaned"])
    stats = cube.groupBy("channel").agg(
        F.sum("raw").alias("raw_sessions"), F.sum("cleaned").alias("clean_sessions"),
        F.coalesce(F.sum("kpi"), F.lit(0.0)).alias("clean_kpi"),
        F.coalesce(F.try_divide(F.sum("kpi"), F.sum("cleaned")), F.lit(C.DEFAULT_CONV_VALUE)).alias("avg_conv_value"))
    det = attribution_from_stats(stats)
    used = F.lit(False)
    if draws is not None:
        post = roi_from_draws(draws).where(F.col("channel").isin(*C.PAID_CHANNELS))
        # one row per paid channel at most
        det = det.join(F.broadcast(post.select(F.col("channel").alias("_post_of"), "posterior_roi")), F.col("name") == F.col("_post_of"), "left")
        used = F.col("posterior_roi").isNotNull()
        det = det.withColumns({"roi": F.coalesce("posterior_roi", "roi"), "posterior_used": used})
    else:
        det = det.withColumn("posterior_used", used)
    n_weeks = cube.agg(F.count_distinct(F.date_trunc("week", "day"))).scalar()
    chan = det.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("priority", "name", "raw_contribution_pct",
                                                         "calibrated_contribution_pct", "bot_inflation_pct",
                                                         "roi", "insight", "posterior_used"))),
                    lambda x: x.dropFields("priority")).alias("channels"),
        F.round(F.sum("clean_kpi"), 2).alias("total_clean_value"),
        F.round(F.sum("raw_kpi_estimate"), 2).alias("total_raw_value"),
    )
    # Each part is a one-row aggregate; scalar subqueries place them side by
    # side in a single row without any join.
    def part(df, cols):
        return df.select(F.struct(*cols)).scalar()

    spark = classified.sparkSession
    return spark.range(1).select(
        F.current_timestamp().cast("string").alias("generated_at"),
        F.lit(mode).alias("pipeline_mode"),
        F.lit(data_source).alias("data_source"),
        part(totals, ["total_raw", "total_cleaned", "bots_removed", "bots_removed_pct", "human_pct"]).alias("sessions"),
        part(daily, [F.col("label").alias("labels"), "raw", "cleaned"]).alias("daily"),
        part(totals, [F.col("total_cleaned").alias("human_sessions"), F.col("bots_removed").alias("bot_sessions"),
                      "total_conv_value", "avg_conv_value", "estimated_spend_saved"]).alias("vbb"),
        part(chan, [F.lit("fallback" if draws is None else "posterior").alias("status"), F.lit("channel attribution (Spark)").alias("model"),
                    "channels", "total_clean_value", "total_raw_value",
                    n_weeks.alias("n_weeks_data"), F.lit(media_spend_source).alias("media_spend_source")]).alias("attribution"),
    )


def summary_report(classified: DataFrame, days: int = 7) -> DataFrame:
    """Flat one-row form of the summary (comparable by value)."""
    doc = summary_document(classified, days=days)
    return doc.select(
        "sessions.*",
        F.array_join("daily.labels", "|").alias("daily_labels"),
        F.array_join(F.transform("daily.raw", lambda x: x.cast("string")), "|").alias("daily_raw"),
        F.array_join(F.transform("daily.cleaned", lambda x: x.cast("string")), "|").alias("daily_cleaned"),
        "vbb.human_sessions", "vbb.bot_sessions", "vbb.total_conv_value", "vbb.avg_conv_value",
        "vbb.estimated_spend_saved",
        F.array_join(F.transform("attribution.channels", lambda x: x["name"]), "|").alias("channel_names"),
        "attribution.total_clean_value", "attribution.total_raw_value",
    )

"""Weekly channel panels for media-mix models, ROI from a panel or from
posterior draws, and the ROI override."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from ..session import materialize
from ..sources.tables import scan_date_range
from .channels import attribution_detail

NATIONAL = "national"


def _roas_of(channel) -> F.Column:
    pairs = []
    for k, v in C.CHANNEL_ROAS:
        pairs += [F.lit(k), F.lit(float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), X.col(channel)), F.lit(C.DEFAULT_ROAS))


def _week(ts_iso) -> F.Column:
    return F.to_date(F.date_trunc("week", F.to_timestamp(X.col(ts_iso))))


def weekly_channel_panel(cleaned: DataFrame, geo_col: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Dense geo x week x paid-channel panel of KPI (clean conversion value)
    and spend = KPI / ROAS. Weeks run from the first to the last observed
    Monday week with no gaps; missing cells are 0. With ``start`` and ``end``
    (days, inclusive) sessions outside them do not count, so one stray
    time cannot stretch the grid.

    The grid is generated, not joined: each geo row explodes a week sequence
    bounded by two scalar subqueries, then the fixed channel list. Its size is
    geos x weeks x channels, independent of the number of sessions."""
    # a session without a country belongs to the default one, not to no cell
    geo = F.coalesce(F.col(geo_col), F.lit(C.DEFAULT_COUNTRY)) if geo_col else F.lit(NATIONAL)
    paid = list(C.PAID_CHANNELS)
    c = cleaned.select(geo.alias("geo"), _week("event_timestamp").alias("week"),
                       X.channel_of("source_medium").alias("channel"), "conversion_value_usd", X.iso_to_date("event_timestamp").alias("_day"))
    c = scan_date_range(c, start, end, "_day")
    # one aggregate over all channels (geos x weeks x channels rows),
    # materialised once; week bounds, geos and cells all read it, so the
    # sessions are scanned and shuffled once
    allw = materialize(c.groupBy("geo", "week", "channel").agg(
        F.sum("conversion_value_usd").alias("_kpi"), F.count(F.lit(1)).alias("_sessions")))
    weekly = allw.where(F.col("channel").isin(*paid))
    lo = allw.agg(F.min("week")).scalar()
    hi = allw.agg(F.max("week")).scalar()
    geos = allw.select("geo").distinct()
    grid = (geos.withColumn("week", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 7 DAYS"))))
            .withColumn("channel", F.explode(F.array(*[F.lit(p) for p in paid]))))
    p = grid.join(weekly, ["geo", "week", "channel"], "left")
    kpi = F.coalesce(F.col("_kpi"), F.lit(0.0))
    return p.select(
        "geo", "week", "channel",
        F.round(kpi, 2).alias("kpi"),
        F.round(kpi / _roas_of("channel"), 2).alias("spend"),
        F.coalesce(F.col("_sessions"), F.lit(0).cast("bigint")).alias("sessions"),
    )


def panel_roi(panel: DataFrame, spend: DataFrame) -> DataFrame:
    """Least-squares slope of weekly KPI on independently supplied spend, per
    channel. Never fit on spend derived from the KPI itself: that only
    returns the ROAS table."""
    s = spend.select("geo", "week", "channel", F.col("spend").alias("_spend"))
    j = panel.select("geo", "week", "channel", "kpi").join(s, ["geo", "week", "channel"], "inner")
    return j.groupBy("channel").agg(
        F.round(F.regr_slope("kpi", "_spend"), 4).alias("roi"),
        F.round(F.regr_r2("kpi", "_spend"), 4).alias("r2"),
        F.count(F.lit(1)).alias("n_points"),
    )


def roi_from_draws(draws: DataFrame) -> DataFrame:
    """Mean ROI over chains and draws, per channel, to 2 places."""
    return draws.groupBy("channel").agg(F.round(F.avg("roi"), 2).alias("posterior_roi"),
                                        F.count(F.lit(1)).alias("n_draws"))


def roi_override(classified: DataFrame, draws: DataFrame) -> DataFrame:
    """Replace the prior ROI with the posterior mean where one exists and flag it."""
    d = attribution_detail(classified)
    post = roi_from_draws(draws).select(F.col("channel").alias("name"), "posterior_roi")
    # at most one posterior row per configured channel after the aggregate
    j = d.join(F.broadcast(post.where(F.col("name").isin(*C.PAID_CHANNELS))), "name", "left")
    return j.select(
        "name", F.col("roi").alias("prior_roi"),
        F.coalesce(F.col("posterior_roi"), F.col("roi")).alias("roi"),
        F.col("posterior_roi").isNotNull().alias("posterior_used"),
    )


def panel_roi_joint(panel: DataFrame, spend: DataFrame, channels=C.PAID_CHANNELS) -> DataFrame:
    """ROI of every paid channel from one joint least-squares fit, with intercept, of
    weekly KPI (all paid channels of a geo) on the spend of each channel.

    One aggregate over the (geo, week) rows takes the covariances of all spends
    and the KPI; the normal equations, one row, are then solved by elimination in
    column expressions. Spend is pivoted on the fixed channel list, so no
    extra pass finds the pivot values. Channels whose spend is a combination of
    those before them (or constant) have no ROI of their own: NULL for it and for all."""
    paid = list(channels)
    cols = [f"_s{i}" for i in range(len(paid))]
    kpi = panel.groupBy("geo", "week").agg(F.sum("kpi").alias("_y"))
    wide = (spend.where(F.col("channel").isin(*paid)).groupBy("geo", "week")
            .pivot("channel", paid).agg(F.sum("spend")))
    wide = wide.select("geo", "week", *[F.coalesce(F.col(f"`{p}`"), F.lit(0.0)).alias(c) for p, c in zip(paid, cols)])
    k = len(paid)
    name = lambda i, j: f"m{i}_{j}"  # noqa: E731  row i of the equations; column k is the right side
    side = [*cols, "_y"]
    eq = kpi.join(wide, ["geo", "week"]).agg(F.count(F.lit(1)).alias("n_points"), *[
        F.covar_pop(cols[i], side[j]).alias(name(i, j)) for i in range(k) for j in range(k + 1)])
    for step in range(k):
        # a pivot that is nothing beside its own variance is rounding
        if step == 0:
            eq = eq.withColumns({f"v{i}": F.col(name(i, i)) for i in range(k)})
        pivot = F.when(F.col(name(step, step)) > F.col(f"v{step}") * 1e-12, F.col(name(step, step)))
        row = {name(step, j): F.try_divide(F.col(name(step, j)), pivot) for j in range(step + 1, k + 1)}
        eq = eq.withColumns(row)
        eq = eq.withColumns({name(i, j): F.col(name(i, j)) - F.col(name(i, step)) * F.col(name(step, j))
                             for i in range(k) if i != step for j in range(step + 1, k + 1)})
    rows = F.explode(F.array(*[F.struct(F.lit(p).alias("channel"), F.round(name(i, k), 4).alias("roi")) for i, p in enumerate(paid)])).alias("r")
    return eq.select("n_points", rows).select("r.channel", "r.roi", "n_points")

"""Invariants over the fixture data."""

from conftest import SF001
from pyspark.sql import functions as F

from trafficlens import config as C
from trafficlens.operators import channels as CH
from trafficlens.operators import classify as CL
from trafficlens.operators import clean as CN
from trafficlens.operators import report as R
from trafficlens.sources import fixtures as FX


def _classified(spark):
    return CL.classify_sessions(FX.session_signals(spark, SF001))


def test_human_plus_bot_is_raw(spark):
    c = _classified(spark)
    t = CN.session_totals(c).first()
    assert t.total_cleaned + t.bots_removed == t.total_raw == c.count()
    assert CN.cleaned_sessions(c).count() + CN.bot_quarantine(c).count() == c.count()


def test_clean_le_raw_per_channel_and_day(spark):
    c = _classified(spark)
    assert CH.channel_stats(c).where(F.col("clean_sessions") > F.col("raw_sessions")).count() == 0
    assert R.daily_join(c).where(F.col("cleaned") > F.col("raw")).count() == 0


def test_contributions_sum_to_100(spark):
    a = CH.channel_attribution(_classified(spark)).agg(
        F.sum("raw_contribution_pct").alias("r"), F.sum("calibrated_contribution_pct").alias("c")).first()
    assert abs(a.r - 100) <= 0.2 and abs(a.c - 100) <= 0.2


def test_payload_value_equals_cleaned_value(spark):
    c = _classified(spark)
    p = CN.vbb_upload_payload(c).agg(F.sum("conversion_value")).first()[0]
    v = CN.cleaned_sessions(c).agg(F.sum("conversion_value_usd")).first()[0]
    assert round(p, 2) == round(v, 2)
    bots = CN.vbb_upload_payload(c).where(F.col(CL.CLASS) != C.HUMAN)
    assert bots.where((F.col("conversion_value") != 0) | (F.col("traffic_type") != "internal")).count() == 0


def test_permuting_rows_changes_nothing(spark):
    c = _classified(spark)
    shuffled = c.repartition(7, F.rand(seed=3))
    assert CH.channel_attribution(c).collect() == CH.channel_attribution(shuffled).collect()
    assert sorted(R.daily_sessions(c).collect()) == sorted(R.daily_sessions(shuffled).collect())


def test_confusion_matrix_sums_to_rows(spark):
    c = _classified(spark)
    assert CL.confusion_matrix(c).agg(F.sum("sessions")).first()[0] == c.count()
    wide = CL.confusion_matrix_wide(c)
    assert set(wide.columns) == {"true_class", *C.CLASSES}


def test_weekly_panel_is_a_dense_grid(spark):
    from trafficlens.operators import panel as P

    cleaned = CN.cleaned_sessions(_classified(spark))
    for geo_col in (None, "geo_country"):
        p = P.weekly_channel_panel(cleaned, geo_col=geo_col)
        geos = p.select("geo").distinct().count()
        weeks = p.select("week").distinct().count()
        assert p.count() == geos * weeks * len(C.PAID_CHANNELS)
        assert p.groupBy("geo", "week", "channel").count().where(F.col("count") > 1).count() == 0
        # every paid human session lands in exactly one cell
        paid = cleaned.where(F.col("source_medium").isin("google / cpc", "meta / paid_social", "bing / cpc",
                                                         "programmatic / display")).count()
        assert p.agg(F.sum("sessions")).first()[0] == paid

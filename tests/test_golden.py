"""Attribution maths against the reference's one stored run (FIXTURES.md D)."""

import pytest
from pyspark.sql import functions as F

from trafficlens import config as C
from trafficlens.operators import channels as CH
from trafficlens.operators import classify as CL
from trafficlens.operators import clean as CN
from trafficlens.operators import report as R

GOLDEN = [  # source_medium, raw rows, human rows
    ("google / cpc", 209, 108),
    ("meta / paid_social", 200, 111),
    ("bing / cpc", 190, 106),
    ("programmatic / display", 196, 106),
    ("direct / (none)", 205, 112),
]
EXPECTED = {
    "Google Ads": (37.2, 35.7, 48.3, 4.0),
    "Meta Ads": (28.5, 29.3, 44.5, 3.2),
    "Bing Ads": (20.3, 21.0, 44.2, 3.5),
    "Display": (14.0, 14.0, 45.9, 2.5),
}


@pytest.fixture(scope="module")
def golden(spark):
    base = spark.createDataFrame(GOLDEN, "source_medium string, n_raw int, n_human int")
    rows = base.select("source_medium", "n_human", F.explode(F.sequence(F.lit(1), "n_raw")).alias("i"))
    return rows.select(
        (F.monotonically_increasing_id()).alias("session_id"), F.lit("c").alias("client_id"), "source_medium",
        F.lit("2025-01-07T10:00:00").alias("event_timestamp"),
        F.when(F.col("i") <= F.col("n_human"), F.lit(C.HUMAN)).otherwise(F.lit(C.FRAUD)).alias(CL.CLASS))


def test_channel_percentages(golden):
    got = {r.name: (r.raw_contribution_pct, r.calibrated_contribution_pct, r.bot_inflation_pct, r.roi)
           for r in CH.channel_attribution(golden).collect()}
    assert got == EXPECTED
    assert [r.name for r in CH.channel_attribution(golden).collect()] == list(C.PAID_CHANNELS)
    assert all(r.insight == C.INSIGHT_HIGH for r in CH.channel_attribution(golden).collect())


def test_totals(golden):
    t = CN.session_totals(golden).first()
    assert (t.total_raw, t.total_cleaned, t.bots_removed, t.bots_removed_pct, t.human_pct) == (1000, 543, 457, 45.7, 54.3)
    v = CN.vbb_summary(golden).first()
    assert (v.total_conv_value, v.avg_conv_value, v.estimated_spend_saved) == (67820.0, 124.9, 1096.8)
    a = CH.attribution_totals(golden).first()
    assert (a.total_clean_value, a.total_raw_value) == (45420.0, 84210.0)


def test_summary_document(golden, tmp_path):
    from trafficlens.sources import sinks

    doc = R.summary_document(golden)
    row = doc.first()
    assert row.sessions.total_raw == 1000 and row.vbb.estimated_spend_saved == 1096.8
    assert [c.name for c in row.attribution.channels] == list(C.PAID_CHANNELS)
    assert row.daily.labels == ["Tue 07 Jan"]
    path = sinks.write_json(doc, str(tmp_path / "summary"))
    import glob
    import json

    files = glob.glob(path + "/*.json")
    assert len(files) == 1
    js = json.loads(open(files[0]).read().splitlines()[0])
    assert js["attribution"]["total_raw_value"] == 84210.0
    assert set(js) == {"generated_at", "pipeline_mode", "data_source", "sessions", "daily", "vbb", "attribution"}


def test_panel_roi_joint_matches_least_squares(spark):
    import numpy as np

    from conftest import SF01
    from trafficlens.operators import panel as P
    from trafficlens.plans import queries as Q
    from trafficlens.sources import fixtures as FX

    panel = P.weekly_channel_panel(Q._cleaned(spark, SF01), geo_col="geo_country")
    spend = FX.media_spend(spark, SF01)
    got = {r.channel: r.roi for r in P.panel_roi_joint(panel, spend).collect()}
    paid = list(C.PAID_CHANNELS)
    kpi = panel.groupBy("geo", "week").agg(F.sum("kpi").alias("kpi")).toPandas()
    sp = spend.toPandas().pivot_table(index=["geo", "week"], columns="channel", values="spend", aggfunc="sum").fillna(0.0)
    m = kpi.merge(sp.reset_index(), on=["geo", "week"])
    X = np.column_stack([m[p].to_numpy() for p in paid] + [np.ones(len(m))])
    beta = np.linalg.lstsq(X, m["kpi"].to_numpy(), rcond=None)[0]
    for p, b in zip(paid, beta[:4]):
        assert abs(got[p] - b) < 1e-3 * max(1.0, abs(b))

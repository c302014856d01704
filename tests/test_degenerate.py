"""Empty and degenerate inputs."""

from trafficlens import config as C
from trafficlens.operators import channels as CH
from trafficlens.operators import classify as CL
from trafficlens.operators import clean as CN
from trafficlens.operators import report as R

SCHEMA = f"session_id bigint, client_id string, source_medium string, event_timestamp string, {CL.CLASS} string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_input(spark):
    e = _df(spark, [])
    a = CH.channel_attribution(e).collect()
    # nothing observed: all four paid channels, zero contribution, 100% inflation (kept quirk)
    assert [r.name for r in a] == list(C.PAID_CHANNELS)
    assert all(r.raw_contribution_pct == 0.0 and r.bot_inflation_pct == 100.0 for r in a)
    t = CN.session_totals(e).first()
    assert t.total_raw == 0 and t.bots_removed_pct is None
    v = CN.vbb_summary(e).first()
    assert v.total_conv_value == 0.0 and v.avg_conv_value is None
    assert R.daily_sessions(e).count() == 0
    assert R.summary_report(e).count() == 1


def test_no_humans(spark):
    e = _df(spark, [(i, "c", "google / cpc", "2025-01-01T00:00:00", C.FRAUD) for i in range(5)])
    a = CH.channel_attribution(e).collect()
    assert [r.name for r in a] == ["Google Ads"]
    assert a[0].calibrated_contribution_pct == 0.0 and a[0].bot_inflation_pct == 100.0
    assert CN.cleaned_sessions(e).count() == 0


def test_no_paid_channel(spark):
    e = _df(spark, [(i, "c", "direct / (none)", "2025-01-01T00:00:00", C.HUMAN) for i in range(3)])
    a = CH.channel_attribution(e).collect()
    assert [r.name for r in a] == list(C.PAID_CHANNELS)
    assert CH.attribution_totals(e).first().total_clean_value == 0.0


def test_unknown_sources_only(spark):
    e = _df(spark, [(1, "c", "Foo / Bar", "2025-01-01T00:00:00", C.HUMAN), (2, "c", None, "2025-01-02T00:00:00", C.HUMAN)])
    assert {r.channel for r in CH.observed_channels(e).collect()} == {"Other"}
    assert CN.vbb_summary(e).first().avg_conv_value == 100.0


def test_day_with_raw_but_no_clean_and_fewer_than_7_days(spark):
    e = _df(spark, [(1, "c", "google / cpc", "2025-01-01T00:00:00", C.HUMAN),
                    (2, "c", "google / cpc", "2025-01-02T00:00:00", C.FRAUD)])
    d = [(str(r.day), r.raw, r.cleaned) for r in R.daily_sessions(e).collect()]
    assert d == [("2025-01-01", 1, 1), ("2025-01-02", 1, 0)]


def test_last_seven_present_days(spark):
    rows = [(i, "c", "x", f"2025-01-{d:02d}T00:00:00", C.HUMAN) for i, d in enumerate([1, 3, 5, 7, 9, 11, 13, 15])]
    d = [str(r.day) for r in R.daily_sessions(_df(spark, rows)).collect()]
    assert d == [f"2025-01-{x:02d}" for x in (3, 5, 7, 9, 11, 13, 15)]


def test_duplicate_signals_do_not_multiply_sessions(spark):
    from trafficlens.operators import signals as SG

    sessions = spark.createDataFrame([("a", 1, 10, 2.0, 1, 0, "x")],
                                     "client_id string, session_id bigint, session_duration_sec bigint, "
                                     "event_velocity_per_sec double, click_events bigint, scroll_events bigint, "
                                     "source_medium string")
    sig = spark.createDataFrame([("a", 1, 0.9, 5), ("a", 1, 0.3, 7)],
                                "client_id string, session_id bigint, edge_score double, mouse_move_events bigint")
    out = SG.enrich(sessions, sig).collect()
    assert len(out) == 1 and (out[0].edge_score, out[0].mouse_move_events) == (0.3, 7)
    assert out[0].edge_score_source == "MEASURED"

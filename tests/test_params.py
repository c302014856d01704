"""Nested parameter lookup: present, NULL value, absent key, empty or NULL
array, duplicate key (first occurrence wins)."""

from pyspark.sql import functions as F

from trafficlens import schemas
from trafficlens.functions.expressions import event_param
from trafficlens.operators import sessionize as S


def test_lookup_cases(spark):
    schema = "id int, event_params " + schemas.GA_EVENTS["event_params"].dataType.simpleString()
    rows = [
        (1, [("ga_session_id", (None, 7)), ("page_location", ("/a", None))]),
        (2, [("ga_session_id", (None, None))]),                      # present, NULL value
        (3, [("page_location", ("/b", None))]),                      # absent key
        (4, []),                                                      # empty array
        (5, None),                                                    # NULL array
        (6, [("ga_session_id", (None, 1)), ("ga_session_id", (None, 2))]),  # duplicate: first wins
    ]
    df = spark.createDataFrame(rows, schema)
    out = df.select("id", event_param("event_params", "ga_session_id").alias("sid"),
                    event_param("event_params", "page_location", "string_value").alias("page")).orderBy("id").collect()
    assert [(r.sid, r.page) for r in out] == [(7, "/a"), (None, None), (None, "/b"), (None, None), (None, None), (1, None)]


def test_sessions_defaults_and_null_ids(spark):
    schema = schemas.GA_EVENTS
    p = lambda sid, scroll=None, page=None: [("ga_session_id", (None, sid)), ("percent_scrolled", (None, scroll)),
                                              ("page_location", (page, None))]
    import datetime as dt

    d = dt.date(2024, 1, 1)
    rows = [
        ("u", 1, 1_000_000, "page_view", p(5, page="/x"), (None, None), (None,), (None,), d),
        ("u", 2, 3_500_000, "scroll", p(5, scroll=40), ("g", "cpc"), ("FR",), ("mobile",), d),
        ("u", 3, 4_000_000, "error", p(5), ("g", "cpc"), ("FR",), ("mobile",), d),       # not allow-listed
        ("u", 4, 9_000_000, "click", p(None), ("g", "cpc"), ("FR",), ("mobile",), d),   # NULL session id: dropped
    ]
    s = S.sessions_from_events(spark.createDataFrame(rows, schema)).collect()
    assert len(s) == 1
    r = s[0]
    # first touch: defaults from the first hit; duration truncated to whole seconds
    assert (r.source_medium, r.geo_country, r.device_category, r.landing_page) == ("(direct) / (none)", "Unknown", "desktop", "/x")
    assert (r.total_events, r.click_events, r.scroll_events, r.page_scroll_depth_pct) == (2, 0, 1, 40)
    assert (r.session_duration_sec, r.event_velocity_per_sec, r.event_timestamp) == (2, 1.0, "1970-01-01T00:00:01")
    assert F is not None

"""Property tests against brute force on random inputs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trafficlens.functions import expressions as X
from trafficlens.operators import ordered as O

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, database=None,
                    suppress_health_check=list(HealthCheck))

# (score, velocity, duration, mouse) -> class, on both sides of every limit
BOUNDARIES = [
    ((0.19, 20.01, 50, 5), "Ad_Fraud"), ((0.2, 20.01, 5, 0), "LLM_Scraper"), ((0.19, 20.0, 5, 0), "LLM_Scraper"),
    ((0.19, 20.0, 10, 0), "Ad_Fraud"), ((0.47, 8.01, 9, 0), "LLM_Scraper"), ((0.37, 8.0, 9, 0), "Ad_Fraud"),
    ((0.37, 8.01, 9, 1), "Ad_Fraud"), ((0.38, 8.01, 9, 1), "LLM_Scraper"), ((0.48, 8.01, 9, 0), "LLM_Scraper"),
    ((0.55, 5.0, 30, 1), "Human"), ((0.55, 5.01, 30, 1), "LLM_Scraper"), ((0.55, 5.0, 29, 1), "LLM_Scraper"),
    ((0.55, 5.0, 30, 0), "LLM_Scraper"), ((0.54, 5.0, 30, 1), "LLM_Scraper"), ((0.61, 6.0, 0, 0), "LLM_Scraper"),
    ((0.62, 50.0, 0, 0), "Human"), ((None, 50.0, 0, 0), "Ad_Fraud"), ((float("nan"), 1.0, 60, 9), "Ad_Fraud"),
]


def test_classifier_at_its_boundaries(spark):
    df = spark.createDataFrame([(i, *row) for i, (row, _) in enumerate(BOUNDARIES)],
                               "i int, edge_score double, event_velocity_per_sec double, "
                               "session_duration_sec bigint, mouse_move_events bigint")
    got = {r.i: r.c for r in df.select("i", X.classify().alias("c")).collect()}
    assert [got[i] for i in range(len(got))] == [c for _, c in BOUNDARIES]


GAP = 100
HITS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 2_000)), min_size=1, max_size=80)


def brute_sessions(hits, gap):
    out = []
    for key in sorted({k for k, _ in hits}):
        ts = sorted((t, i) for i, (k, t) in enumerate(hits) if k == key)
        start = prev = None
        n = 0
        for t, _ in ts:
            if prev is None or t - prev > gap:
                if start is not None:
                    out.append((key, start, prev + gap, n))
                start, n = t, 0
            n += 1
            prev = t
        out.append((key, start, prev + gap, n))
    return sorted(out)


@SETTINGS
@given(HITS, st.integers(1, 9))
def test_gap_sessions_match_brute_force(spark, hits, parts):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(hits)], "k string, us bigint, id bigint")
    got = sorted(tuple(r) for r in O.gap_sessions(df, ["k"], "us", GAP, tie="id", bucket_us=parts * 100).collect())
    assert got == brute_sessions(hits, GAP)


@SETTINGS
@given(HITS, st.integers(1, 9))
def test_gap_stats_match_brute_force(spark, hits, parts):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(hits)], "k string, us bigint, id bigint")
    got = {r.k: (r.n_gaps, r.min_gap_sec, r.max_gap_sec)
           for r in O.gap_stats(df, ["k"], "us", tie="id", bucket_us=parts * 100).collect()}
    want = {}
    for key in {k for k, _ in hits}:
        ts = sorted(t for k, t in hits if k == key)
        gaps = [b - a for a, b in zip(ts, ts[1:])]
        want[key] = (len(gaps), round(min(gaps) / 1e6, 3) if gaps else None, round(max(gaps) / 1e6, 3) if gaps else None)
    assert got == want


@SETTINGS
@given(HITS, st.integers(1, 30))
def test_gap_moments_across_buckets(spark, hits, width):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(hits)], "k string, us bigint, id bigint")
    rows = O.gap_stats(df, ["k"], "us", tie="id", bucket_us=width * 50).collect()
    for r in rows:
        ts = sorted(t for k, t in hits if k == r.k)
        gaps = [b - a for a, b in zip(ts, ts[1:])]
        assert r.avg_gap_sec == (round(sum(gaps) / len(gaps) / 1e6, 3) if gaps else None)
        if len(gaps) > 1:
            mean = sum(gaps) / len(gaps)
            exact = math.sqrt(sum((g - mean) ** 2 for g in gaps) / (len(gaps) - 1)) / 1e6
            assert abs(r.stddev_gap_sec - exact) <= 0.0006
        else:
            assert r.stddev_gap_sec is None

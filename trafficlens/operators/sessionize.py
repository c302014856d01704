"""Sessionisation of nested hit-level events (scan, allow-list, parameter
lookups, one aggregate per client and session), plus sampling and source
frequency.

Plan shape: FileScan (date partitions pruned, event names pushed) ->
Project (array lookups, no explode) -> Filter(session id not null) ->
partial aggregate -> Exchange(client, session) -> final aggregate. The
first-touch strings make Spark sort for the aggregate; they travel as one
struct with one order value.
The partial aggregate runs before the shuffle, so a client or session that
holds a large share of all hits is reduced map-side to one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import event_param, micros_to_iso
from ..sources.tables import scan_date_range


def event_allowlist(events: DataFrame, names=C.EVENT_ALLOWLIST) -> DataFrame:
    return events.where(F.col("event_name").isin(*names))


def with_param_lookups(events: DataFrame) -> DataFrame:
    """Session id, scroll percent and page of each hit, from the nested array."""
    return events.select(
        "*",
        event_param("event_params", "ga_session_id", "int_value").alias("session_id"),
        F.coalesce(event_param("event_params", "percent_scrolled", "int_value"), F.lit(0).cast("bigint")).alias("percent_scrolled"),
        F.coalesce(event_param("event_params", "page_location", "string_value"), F.lit(C.DEFAULT_PAGE)).alias("page_location"),
    )


def sessions_from_events(events: DataFrame, start: str | None = None, end: str | None = None,
                         extra_aggs=(), label: str | None = None) -> DataFrame:
    """One row per (client_id, session_id) with the session features.

    ``landing_page`` and the other descriptive fields are taken from the
    first hit of the session (ties broken by event id where the export has
    one, then by the values), so the result is repeatable. Missing values are filled before aggregating.
    ``label`` names a column of the hits that labels their session; it is kept."""
    ev = event_allowlist(scan_date_range(events, start, end))
    sm = F.concat(
        F.coalesce(F.col("traffic_source.source"), F.lit(C.DEFAULT_SOURCE)),
        F.lit(" / "),
        F.coalesce(F.col("traffic_source.medium"), F.lit(C.DEFAULT_MEDIUM)),
    )
    keyed = with_param_lookups(ev).select(
        F.col("user_pseudo_id").alias("client_id"),
        "session_id",
        F.col("event_timestamp").alias("_us"),
        F.struct(F.col("event_timestamp"), *([F.col("event_id")] if "event_id" in ev.columns else []), F.col("event_name"),
                 event_param("event_params", "page_location", "string_value"), sm).alias("_ord"),
        "event_name",
        "percent_scrolled",
        "page_location",
        sm.alias("_sm"),
        F.coalesce(F.col("geo.country"), F.lit(C.DEFAULT_COUNTRY)).alias("_country"),
        F.coalesce(F.col("device.category"), F.lit(C.DEFAULT_DEVICE)).alias("_device"),
        *[c for c in events.columns if c.startswith("_") or c == label],
    ).where(F.col("session_id").isNotNull())
    g = keyed.groupBy("client_id", "session_id").agg(
        F.min("_us").alias("_start_us"),
        F.max("_us").alias("_end_us"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_name").isin(*C.CLICK_EVENTS)).alias("click_events"),
        F.count_if(F.col("event_name").isin(*C.SCROLL_EVENTS)).alias("scroll_events"),
        F.max("percent_scrolled").alias("_max_scroll"),
        F.min_by(F.struct("_sm", "_country", "_device", "page_location"), "_ord").alias("_touch"),
        *extra_aggs,
        *([F.min_by(label, "_ord").alias(label)] if label else []),
    )
    duration = F.greatest(F.floor((F.col("_end_us") - F.col("_start_us")) / F.lit(1_000_000)).cast("bigint"), F.lit(0).cast("bigint"))
    extra = [c for c in g.columns if c.startswith("_") and c not in ("_start_us", "_end_us", "_max_scroll", "_touch")]
    extra += [label] if label else []
    return g.select(
        "client_id",
        "session_id",
        micros_to_iso("_start_us").alias("event_timestamp"),
        duration.alias("session_duration_sec"),
        "total_events",
        "click_events",
        "scroll_events",
        F.coalesce(F.col("_max_scroll"), F.lit(0).cast("bigint")).alias("page_scroll_depth_pct"),
        F.round(F.try_divide(F.col("total_events").cast("double"),
                             F.greatest(duration, F.lit(1).cast("bigint")).cast("double")), 2).alias("event_velocity_per_sec"),
        F.col("_touch._sm").alias("source_medium"),
        F.col("_touch._country").alias("geo_country"),
        F.coalesce(F.col("_touch._device"), F.lit(C.DEFAULT_DEVICE)).alias("device_category"),
        F.col("_touch.page_location").alias("landing_page"),
        *extra,
    )


def normalize_sessions(sessions: DataFrame) -> DataFrame:
    """Null fill and cast: counts to 0, velocity to 1.0."""
    out = sessions
    for c in ("session_duration_sec", "total_events", "click_events", "scroll_events", "page_scroll_depth_pct"):
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")))
    if "event_velocity_per_sec" in out.columns:
        out = out.withColumn("event_velocity_per_sec",
                             F.coalesce(F.col("event_velocity_per_sec").cast("double"), F.lit(C.DEFAULT_VELOCITY)))
    return out


def sample_sessions(sessions: DataFrame, n: int, seed: str = "42", top_rows: int = 10_000) -> DataFrame:
    """A repeatable uniform sample of ``n`` sessions (all if there are fewer):
    those with the smallest hash of seed and key.

    Up to ``top_rows`` it is a TakeOrderedAndProject: each task keeps its n
    smallest and one task merges them. Larger samples never meet in one task:
    ``nth_hash`` finds the n-th smallest hash and one filter takes the rows."""
    h = F.md5(F.concat_ws("|", F.lit(seed), F.col("client_id").cast("string"), F.col("session_id").cast("string")))
    if n <= top_rows:
        return sessions.orderBy(h, "client_id", "session_id").limit(n)
    last, ties, equal = nth_hash(sessions.select(h.alias("h")), n)
    if last is None:
        return sessions
    if ties == equal:
        return sessions.where(h <= F.lit(last))
    # rows of one hash are rows of one key; only they are ordered
    return sessions.where(h < F.lit(last)).unionByName(sessions.where(h == F.lit(last)).orderBy("client_id", "session_id").limit(ties))


def nth_hash(hashes: DataFrame, n: int, small: int = 4096, digits: int = 3) -> tuple[str | None, int, int]:
    """The n-th smallest value of the hexadecimal column ``h`` (None if there are no
    more than n), how many of the rows with that value are among the first n, and how
    many there are. Counts by the next digits, 4,096 cells a pass, narrow
    the search to one cell until that is small."""
    prefix, need = "", n
    while True:
        own = hashes.where(F.col("h").startswith(prefix)) if prefix else hashes
        cell = F.substring("h", len(prefix) + 1, digits)
        counts = sorted((r["c"], r["count"]) for r in own.groupBy(cell.alias("c")).count().collect())
        if not prefix and sum(c for _, c in counts) <= n:
            return None, 0, 0
        for c, count in counts:
            if need <= count:
                break
            need -= count
        prefix += c
        if count <= small or len(prefix) >= 32:
            break
    # at most ``small`` values, or copies of one
    values = sorted((r["h"], r["count"]) for r in hashes.where(F.col("h").startswith(prefix)).groupBy("h").count().collect())
    for h, count in values:
        if need <= count:
            return h, need, count
        need -= count
    raise AssertionError("counts changed between passes")


def top_sources(sessions: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent source / medium values; name breaks ties."""
    return (
        sessions.groupBy("source_medium").agg(F.count(F.lit(1)).alias("sessions"))
        .orderBy(F.desc("sessions"), F.asc("source_medium"))
        .limit(n)
    )


def event_param_profile(events: DataFrame) -> DataFrame:
    """Which parameters occur, how often, and with which value kind."""
    p = events.select(F.explode("event_params").alias("p"))
    return p.groupBy(F.col("p.key").alias("param_key")).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.count("p.value.int_value").alias("n_int_values"),
        F.count("p.value.string_value").alias("n_string_values"),
    )


def request_cadence(events: DataFrame, window: str = C.PipelineConfig.cadence_window) -> DataFrame:
    """Highest number of hits by one client in any one tumbling window.

    Two hash aggregates, both with map-side partial aggregation."""
    ts = F.timestamp_micros("event_timestamp")
    per_min = events.groupBy(F.col("user_pseudo_id").alias("client_id"), F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("hits"))
    return per_min.groupBy("client_id").agg(
        F.max("hits").alias("max_hits_per_window"),
        F.count(F.lit(1)).alias("active_windows"),
        F.sum("hits").alias("total_hits"),
    )


def scroll_duration_ratio(sessions: DataFrame) -> DataFrame:
    """Scroll depth per second of session (README feature)."""
    return sessions.select(
        "client_id", "session_id",
        F.round(F.try_divide(F.col("page_scroll_depth_pct").cast("double"),
                             F.greatest(F.col("session_duration_sec"), F.lit(1)).cast("double")), 4)
        .alias("scroll_depth_vs_session_duration"),
    )

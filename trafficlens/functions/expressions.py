"""Column expressions shared by batch and streaming operators.

All of these are native Catalyst expressions: they stay inside whole-stage
code generation and never call into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_param(params, key: str, kind: str = "int_value") -> Column:
    """Value of parameter ``key`` in a key/value array of structs.

    First occurrence wins; NULL when the key is absent or the array is
    NULL/empty. No explode, so no extra rows and no shuffle."""
    hit = F.filter(col(params), lambda p: p["key"] == F.lit(key))
    return F.get(hit, 0)["value"][kind]


def ntz_micros(ts) -> Column:
    """Microseconds since epoch of a wall-clock (``timestamp_ntz``) UTC time,
    whatever the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col(ts))


def utc_instant(ts) -> Column:
    """A ``timestamp_ntz`` read as UTC, as an instant (``timestamp``); event
    time for watermarks."""
    return F.timestamp_micros(ntz_micros(ts))


def micros_to_iso(us) -> Column:
    """Microseconds since epoch as UTC ``yyyy-MM-ddTHH:mm:ss``: the epoch as a
    wall-clock time plus the microseconds, so no session time zone (and no
    hour that it skips) takes part."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    text = F.timestamp_add("MICROSECOND", col(us), epoch).cast("string")  # date_format would go by the session zone
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def iso_to_date(s) -> Column:
    return F.to_date(F.to_timestamp(col(s)))


def nan_to_null(c) -> Column:
    """Spark orders NaN above every number; a missing score must compare
    false instead, so NaN becomes NULL before any rule."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def channel_of(source_medium, mapping=C.CHANNEL_NAMES, other: str = C.OTHER_CHANNEL) -> Column:
    """Channel by lower-cased literal substring, keys tried in order; NULL and
    unmatched values fall to ``other``."""
    s = F.lower(col(source_medium))
    expr = None
    for key, name in mapping:
        cond = s.contains(F.lit(key))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(other))


def conversion_value(source_medium, mapping=C.CONV_VALUES, default: float = C.DEFAULT_CONV_VALUE) -> Column:
    """Exact, case-sensitive value lookup as an expression (used on streams)."""
    pairs = []
    for k, v in mapping:
        pairs += [F.lit(k), F.lit(float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(source_medium)), F.lit(float(default)))


def _cascade(score, velocity, duration, mouse, t: C.Thresholds):
    """The classifier rules in order: (condition, class); the last is the
    fallback. A NULL or NaN score makes every comparison false."""
    s, v, d, m = nan_to_null(score), col(velocity).cast("double"), col(duration).cast("double"), col(mouse).cast("double")
    return [
        ((s < t.fraud_score) & (v > t.fraud_velocity), C.FRAUD),
        ((s < t.scraper_score) & (v > t.scraper_velocity) & (d < t.scraper_duration) & (m == 0), C.SCRAPER),
        ((s >= t.human_score) & (v <= t.human_velocity) & (d >= t.human_duration) & (m > 0), C.HUMAN),
        (s >= t.human_score_any, C.HUMAN),
        (s >= t.scraper_score_any, C.SCRAPER),
        (None, C.FRAUD),
    ]


def _first_match(rules, value) -> Column:
    expr = None
    for i, (cond, cls) in enumerate(rules):
        out = F.lit(value(i, cls))
        if cond is None:
            return expr.otherwise(out)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr


def classify(score="edge_score", velocity="event_velocity_per_sec", duration="session_duration_sec",
             mouse="mouse_move_events", t: C.Thresholds = C.Thresholds()) -> Column:
    """Ordered rule cascade; first match wins, a NULL comparison is false."""
    return _first_match(_cascade(score, velocity, duration, mouse, t), lambda i, cls: cls)


def classify_rule(score="edge_score", velocity="event_velocity_per_sec", duration="session_duration_sec",
                  mouse="mouse_move_events", t: C.Thresholds = C.Thresholds()) -> Column:
    """Number (1-6) of the cascade rule that fired."""
    return _first_match(_cascade(score, velocity, duration, mouse, t), lambda i, cls: i + 1)


def behavior_tier(duration="session_duration_sec", velocity="event_velocity_per_sec", clicks="click_events",
                  source_medium="source_medium", r: C.TierRules = C.TierRules()) -> Column:
    d, v, c = col(duration), col(velocity), col(clicks)
    src = F.lower(F.coalesce(col(source_medium).cast("string"), F.lit("")))
    display = None
    for k in r.display_keys:
        cond = src.contains(F.lit(k))
        display = cond if display is None else (display | cond)
    bursty = (d <= r.bursty_duration) | (v > r.bursty_velocity)
    return (
        F.when((d >= r.engaged_duration) & (v <= r.engaged_velocity) & (c > 0), F.lit("engaged"))
        .when(bursty & display, F.lit("bursty_display"))
        .when(bursty, F.lit("bursty"))
        .otherwise(F.lit("mixed"))
    )


def _beta_mean(ab) -> float:
    a, b = ab
    return round(a / (a + b), 3)


def tier_score(tier, r: C.TierRules = C.TierRules()) -> Column:
    """Imputed edge score: mean of the tier's Beta(a, b), rounded to 3 places."""
    t = col(tier)
    return (
        F.when(t == "engaged", F.lit(_beta_mean(r.engaged_beta)))
        .when(t == "bursty_display", F.lit(_beta_mean(r.bursty_display_beta)))
        .when(t == "bursty", F.lit(_beta_mean(r.bursty_beta)))
        .otherwise(F.lit(_beta_mean(r.mixed_beta)))
    )


def imputed_mouse(duration="session_duration_sec", clicks="click_events", scrolls="scroll_events",
                  r: C.TierRules = C.TierRules()) -> Column:
    """Midpoint (integer division) of the clamp range when the session has a
    click or a scroll, else 0."""
    d = col(duration).cast("double")
    lo = F.greatest(F.lit(r.mouse_floor).cast("long"), (d * r.mouse_low_share).cast("long"))
    hi = F.greatest(lo, F.least(F.lit(r.mouse_cap).cast("long"), (d * r.mouse_high_share).cast("long")))
    return F.when((col(clicks) > 0) | (col(scrolls) > 0), F.floor((lo + hi) / 2).cast("long")).otherwise(F.lit(0).cast("long"))


def insight(bot_pct) -> Column:
    p = col(bot_pct)
    return (
        F.when(p >= C.INSIGHT_HIGH_AT, F.lit(C.INSIGHT_HIGH))
        .when(p >= C.INSIGHT_MODERATE_AT, F.lit(C.INSIGHT_MODERATE))
        .otherwise(F.lit(C.INSIGHT_LOW))
    )


def zero_guard(x) -> Column:
    """0 (or NULL) becomes 1.0."""
    x = col(x)
    return F.when(F.coalesce(x, F.lit(0.0)) == 0, F.lit(1.0)).otherwise(x)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def const_table(spark, rows, columns):
    """A small constant table as a JVM local relation (SQL ``VALUES``): no
    Python round trip, exact size known to the planner."""
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")

"""Session classification and its evaluation.

The rule cascade is a single CASE expression (no shuffle). Evaluation
queries are small-keyed aggregates with map-side partial aggregation.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import expressions as X
from ..session import materialize

CLASS = "traffic_class"
LABEL = "raw_traffic_label"


def classify_sessions(df: DataFrame, t: C.Thresholds = C.Thresholds(), with_rule: bool = False) -> DataFrame:
    out = df.withColumn(CLASS, X.classify(t=t))
    if with_rule:
        out = out.withColumn("rule_fired", X.classify_rule(t=t))
    return out


def class_dimension(spark: SparkSession) -> DataFrame:
    """The three classes in fixed order (a 3-row constant table)."""
    return X.const_table(spark, [(c, i) for i, c in enumerate(C.CLASSES)], ["class", "class_order"])


def class_distribution(classified: DataFrame) -> DataFrame:
    return classified.groupBy(CLASS).agg(F.count(F.lit(1)).alias("sessions"))


def classification_accuracy(classified: DataFrame) -> DataFrame:
    return classified.agg(
        # a session without a label counts as a miss
        F.round(F.avg(F.coalesce(F.col(CLASS) == F.col(LABEL), F.lit(False)).cast("double")), 4).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def per_class_recall(classified: DataFrame) -> DataFrame:
    """Recall and support per true class; all three classes always listed."""
    stats = classified.where(F.col(LABEL).isin(*C.CLASSES)).groupBy(F.col(LABEL).alias("class")).agg(
        F.avg((F.col(CLASS) == F.col(LABEL)).cast("double")).alias("_recall"),
        F.count(F.lit(1)).alias("_n"),
    )
    dim = class_dimension(classified.sparkSession)  # fixed 3 rows
    # stats is keyed by the three known classes: at most 3 rows, broadcast
    return dim.join(F.broadcast(stats), "class", "left").select(
        F.col("class").alias("true_class"),
        F.round("_recall", 4).alias("recall"),
        F.coalesce(F.col("_n"), F.lit(0).cast("bigint")).alias("n"),
    )


def confusion_matrix(classified: DataFrame) -> DataFrame:
    """Long form: one row per (true, predicted) pair that occurs."""
    return classified.groupBy(F.col(LABEL).alias("true_class"), F.col(CLASS).alias("predicted_class")).agg(
        F.count(F.lit(1)).alias("sessions"))


def confusion_matrix_wide(classified: DataFrame) -> DataFrame:
    """Display form: predicted classes as columns (fixed pivot values)."""
    return classified.groupBy(F.col(LABEL).alias("true_class")).pivot(CLASS, list(C.CLASSES)).count().fillna(0)


def bot_signature_flags(df: DataFrame, r: C.SignatureRules = C.SignatureRules()) -> DataFrame:
    """The six signature flags of a scraper session, each 0/1, and their sum.
    User agent and referrer flags apply when those columns exist."""
    def flag(cond):
        return F.coalesce(cond, F.lit(False)).cast("int")

    flags = {
        "flag_low_score": flag(X.nan_to_null("edge_score") < r.low_score),
        "flag_bot_user_agent": flag(F.col("user_agent").rlike(C.BOT_UA_PATTERN)) if "user_agent" in df.columns else F.lit(0),
        "flag_zero_mouse": flag(F.col("mouse_move_events") == 0),
        "flag_high_velocity": flag(F.col("event_velocity_per_sec") > r.high_velocity),
        "flag_short_session": flag(F.col("session_duration_sec") < r.short_duration),
        "flag_empty_referrer": flag(F.coalesce(F.col("referrer"), F.lit("")) == "") if "referrer" in df.columns else F.lit(0),
    }
    total = None
    for v in flags.values():
        total = v if total is None else total + v
    return df.select("client_id", "session_id", *[v.alias(k) for k, v in flags.items()], total.alias("n_flags"))


def _in_range(c, lo, hi):
    """Inclusive range; an open end given as None makes the other bound strict
    ("> 0.65", "< 0.20")."""
    c = F.col(c).cast("double")
    if lo is None:
        return c < hi
    if hi is None:
        return c > lo
    return c.between(lo, hi)


def feature_profile_match(df: DataFrame, profiles=C.FEATURE_PROFILES) -> DataFrame:
    """Range match of each session against per-class feature ranges: count of
    features inside each class's range and the best class (first class wins a
    tie). The range table is fixed configuration, so the theta join is
    compiled into column expressions: no join, no shuffle."""
    counts = {}
    for cls in C.CLASSES:
        expr = None
        for c2, feat, lo, hi in profiles:
            if c2 != cls:
                continue
            m = F.coalesce(_in_range(feat, lo, hi), F.lit(False)).cast("int")
            expr = m if expr is None else expr + m
        counts[cls] = expr if expr is not None else F.lit(0)
    names = {C.HUMAN: "human_matches", C.SCRAPER: "scraper_matches", C.FRAUD: "fraud_matches"}
    out = df.select("client_id", "session_id", *[counts[c].alias(names[c]) for c in C.CLASSES])
    h, s, f = (F.col(names[c]) for c in C.CLASSES)
    best = F.when((h >= s) & (h >= f), F.lit(C.HUMAN)).when(s >= f, F.lit(C.SCRAPER)).otherwise(F.lit(C.FRAUD))
    return out.withColumn("profile_class", best)


CUTS, ACCURACY = 256, 10_000


def _ranks_to_bracket(cuts: list[float], rank: int, n: int) -> tuple[float, float]:
    """Two cuts that enclose the value of a rank: one cut more on either side than
    the rank's own, far more than the cuts' error of 1/ACCURACY."""
    place = rank * CUTS / n
    return cuts[max(0, math.floor(place) - 1)], cuts[min(CUTS, math.ceil(place) + 1)]


def exact_medians(df: DataFrame, values: dict, small: int = 4096) -> dict[str, float | None]:
    """Exact median of each column expression in ``values``; NULLs and NaNs are
    left out, no value gives None.

    A pass cuts the values of all features at 256 approximate quantiles in one
    aggregate. The middle lies between two cuts; the next pass counts what is
    below, at and between them. If the middle is between them, it goes on with the values
    strictly between, at most about 3/256 of them, until those are ``small`` enough to
    come back: two passes for 300,000 rows, one more for each factor of 80. No rows
    are shuffled or ordered, and equal values end the search at once."""
    cols = {n: X.nan_to_null(c.cast("double")) for n, c in values.items()}
    grid = [i / CUTS for i in range(CUTS + 1)]
    data = df.select(*[c.alias(f"v{i}") for i, c in enumerate(cols.values())])
    first = data.agg(*[e for i in range(len(cols)) for e in (
        F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", grid, ACCURACY).alias(f"c{i}"))]).first()
    found: dict[tuple[int, int], float] = {}  # (feature, rank) -> value
    open_: dict[tuple[int, int], tuple] = {}  # (feature, rank) -> (low, high, most values between)
    for i in range(len(cols)):
        n = first[f"n{i}"]
        for rank in {(n + 1) // 2, (n + 2) // 2} if n else ():
            open_[i, rank] = (*_ranks_to_bracket(first[f"c{i}"], rank, n), n * 4 // CUTS)
    while open_:
        aggs = []
        for j, ((i, _), (low, high, most)) in enumerate(open_.items()):
            v = F.col(f"v{i}")
            inside = F.when((v > F.lit(low)) & (v < F.lit(high)), v)
            aggs += [F.count_if(v < F.lit(low)).alias(f"below{j}"), F.count_if(v == F.lit(low)).alias(f"low{j}"), F.count(inside).alias(f"in{j}"),
                     (F.sort_array(F.collect_list(inside)) if most <= small else F.percentile_approx(inside, grid, ACCURACY)).alias(f"got{j}")]
        r = data.agg(*aggs).first()
        rest = {}
        for j, ((i, rank), (low, high, most)) in enumerate(open_.items()):
            at = rank - r[f"below{j}"] - r[f"low{j}"]  # place among the values between
            if at <= 0:
                found[i, rank] = low
            elif at > r[f"in{j}"]:
                found[i, rank] = high
            elif most <= small:
                found[i, rank] = r[f"got{j}"][at - 1]
            else:
                # places shift: the next pass counts from the whole column again
                rest[i, rank] = (*_ranks_to_bracket(r[f"got{j}"], at, r[f"in{j}"]), r[f"in{j}"] * 4 // CUTS)
        open_ = rest
    out = {}
    for i, name in enumerate(values):
        n = first[f"n{i}"]
        out[name] = (found[i, (n + 1) // 2] + found[i, (n + 2) // 2]) / 2 if n else None
    return out


def session_outliers(df: DataFrame, features=C.FEATURES, threshold: float = 3.5) -> DataFrame:
    """Robust z-score per feature: 0.6745 * (x - median) / MAD, with exact
    medians and deviations (one number per feature each)."""
    df = materialize(df.select("client_id", "session_id", *features))
    med = exact_medians(df, {f: F.col(f) for f in features})
    centre = {f: F.lit(med[f]).cast("double") for f in features}
    mad = exact_medians(df, {f: F.abs(F.col(f).cast("double") - centre[f]) for f in features})
    out = df.select("client_id", "session_id", *[
        F.round(F.try_divide(F.lit(0.6745) * (F.col(f).cast("double") - centre[f]), F.lit(mad[f]).cast("double")), 4).alias(f"z_{f}")
        for f in features])
    mx = F.greatest(*[F.abs(F.col(f"z_{f}")) for f in features])
    return out.withColumn("max_abs_z", mx).withColumn("is_outlier", F.coalesce(mx > threshold, F.lit(False)))


def training_slice(df: DataFrame, as_of: str, days: int = 30, outcomes: DataFrame | None = None,
                   event_date: str | None = None) -> DataFrame:
    """Labelled sessions of the ``days`` days up to ``as_of`` with features,
    label and conversion value (README retraining set). With ``event_date``,
    a partition column, the range prunes folders. ``outcomes`` (session_id,
    conversion_value_usd) gives observed values; sessions without one keep
    the value of their source."""
    end = F.lit(as_of).cast("date")
    day = F.col(event_date) if event_date else X.iso_to_date("event_timestamp")
    d = df.where((day > F.date_sub(end, days)) & (day <= end)).withColumn("day", day)
    value = X.conversion_value("source_medium")
    if outcomes is not None:
        o = outcomes.groupBy("session_id").agg(F.sum("conversion_value_usd").alias("_outcome"))
        d = d.join(o, "session_id", "left")
        value = F.coalesce("_outcome", value)
    return d.select("client_id", "session_id", "day", *C.FEATURES, F.col(LABEL).alias("label"),
                    value.alias("conversion_value_usd"))


def _nearest(columns: list[str], centres: list[list[float]]):
    """Index of the nearest centre (the first of equal ones)."""
    if len(centres) == 1:
        return F.lit(0)
    dist = [sum((F.pow(F.col(c) - F.lit(x), 2) for c, x in zip(columns, centre)), F.lit(0.0)) for centre in centres]
    least = F.least(*dist)
    out = F.lit(len(centres) - 1)
    for i in reversed(range(len(centres) - 1)):
        out = F.when(dist[i] == least, F.lit(i)).otherwise(out)
    return out


def _standardised(df: DataFrame, features) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Keys and standardised features of the sessions that have them all, written
    once, and (mean, deviation) by feature; all rounded to six places."""
    data = df.select("client_id", "session_id", *[F.col(f).cast("double").alias(f) for f in features])
    for f in features:
        data = data.where(X.nan_to_null(f).isNotNull())
    s = data.agg(*[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    scale = {f: (round(s[f"m_{f}"] or 0.0, 6), round(s[f"s_{f}"] or 0.0, 6) or 1.0) for f in features}
    z = [F.round((F.col(f) - scale[f][0]) / scale[f][1], 6).alias(f) for f in features]
    return materialize(data.select("client_id", "session_id", *z)), scale


def _lloyd(data: DataFrame, centres: list[list[float]], steps: int, features) -> DataFrame:
    for _ in range(steps):
        means = data.groupBy(_nearest(list(features), centres).alias("c")).agg(*[F.round(F.avg(f), 6).alias(f) for f in features]).collect()
        for r in means:
            centres[r["c"]] = [r[f] for f in features]
    return data.select("client_id", "session_id", _nearest(list(features), centres).cast("int").alias("cluster"))


def kmeans_clusters(df: DataFrame, start=C.KMEANS_START, steps: int = 5, features=C.FEATURES) -> DataFrame:
    """K-means over standardised features from given starting centres (in
    feature units), with ``steps`` Lloyd steps; each is one aggregate of which
    k rows come back. A session with a missing feature has no place among the
    others and is left out. Centres and features are rounded to six places."""
    data, scale = _standardised(df, features)
    return _lloyd(data, [[round((x - scale[f][0]) / scale[f][1], 6) for f, x in zip(features, c)] for c in start], steps, features)


def _square_distances(centres: list[list[float]], features) -> list:
    """Squared distance of a row to each centre."""
    return [F.expr(" + ".join(f"(`{f}` - {x!r}D) * (`{f}` - {x!r}D)" for f, x in zip(features, c))) for c in centres]


def _seeds(data: DataFrame, k: int, rounds: int, oversample: int, seed: str, features) -> list[dict]:
    """Candidates of scalable k-means++ over standardised ``data``.

    One row is drawn by its hashed key. Each round draws ``oversample`` rows without
    replacement, with weights that are the squared distances to the nearest candidate so
    far: those whose -ln(u) / weight is smallest, u being a hash of (seed, round, key).
    That is one pass a round, of which a task keeps ``oversample`` rows. A last pass
    counts the rows nearest to each candidate. The k seeds are the heaviest candidate, then
    each time the one with the greatest count times squared distance to the seeds so far."""
    features = list(features)
    key = F.concat_ws("|", F.col("client_id").cast("string"), F.col("session_id").cast("string"))
    hashed = lambda r: F.md5(F.concat_ws("|", F.lit(seed), F.lit(str(r)), key))
    first = data.orderBy(hashed(0), *features).limit(1).select(*features).collect()
    if not first:
        return []
    found = [[first[0][f] for f in features]]
    for r in range(1, rounds + 1):
        u = (F.conv(F.substring(hashed(r), 1, 8), 16, 10).cast("double") + 1) / F.lit(4294967296.0)
        far = data.withColumn("_d", F.array_min(F.array(*_square_distances(found, features)))).where(F.col("_d") > 0)
        drawn = far.orderBy(-F.ln(u) / F.col("_d"), *features).limit(oversample).select(*features).collect()
        # equal rows make one candidate
        found += sorted([list(c) for c in {tuple(row[f] for f in features) for row in drawn}])
    ds = F.array(*_square_distances(found, features))
    weight = {row["c"]: row["n"] for row in data.select(ds.alias("_ds")).groupBy(
        (F.array_position("_ds", F.array_min("_ds")) - 1).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    out = [{"candidate": i, **dict(zip(features, c)), "weight": weight.get(i, 0), "seed": None} for i, c in enumerate(found)]
    far = [1.0] * len(found)
    for s in range(min(k, len(found))):
        left = [i for i in range(len(found)) if out[i]["seed"] is None]
        best = max(left, key=lambda i: (out[i]["weight"] * far[i], -i))
        out[best]["seed"] = s
        d = [sum((a - b) ** 2 for a, b in zip(c, found[best])) for c in found]
        far = d if s == 0 else [min(a, b) for a, b in zip(far, d)]
    return out


def kmeans_seeds(df: DataFrame, k: int = 3, rounds: int = 3, oversample: int = 6, seed: str = "seeds", features=C.FEATURES) -> DataFrame:
    """The candidates of the seeding with standardised features, weight, and which
    seed they are (null: none). See ``_seeds``."""
    rows = _seeds(_standardised(df, features)[0], k, rounds, oversample, seed, features)
    schema = "candidate int, " + ", ".join(f"{f} double" for f in features) + ", weight bigint, seed int"
    return df.sparkSession.createDataFrame([tuple(r.values()) for r in rows], schema)


def kmeans_seeded(df: DataFrame, k: int = 3, steps: int = 5, rounds: int = 3, oversample: int = 6, seed: str = "seeds",
                  features=C.FEATURES) -> DataFrame:
    """As ``kmeans_clusters``, from seeds found in the data."""
    data, _ = _standardised(df, features)
    rows = [r for r in _seeds(data, k, rounds, oversample, seed, features) if r["seed"] is not None]
    if not rows:
        return data.select("client_id", "session_id", F.lit(None).cast("int").alias("cluster"))
    return _lloyd(data, [[r[f] for f in features] for r in sorted(rows, key=lambda r: r["seed"])], steps, features)


def score_with_model(df: DataFrame, predict, features=C.FEATURES, out_col: str = "prediction",
                     out_type: T.DataType = T.StringType()) -> DataFrame:
    """Apply an arbitrary Python model to the feature columns, one Arrow batch
    at a time (``mapInPandas``). ``predict`` takes a pandas DataFrame of the
    features (as float) and returns one value per row. Rows stay in their
    partitions: no shuffle, nothing through the driver."""
    fields = list(features)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, out_type, True)])

    def fn(batches):
        for pdf in batches:
            pdf[out_col] = list(predict(pdf[fields].astype("float64")))
            yield pdf

    return df.mapInPandas(fn, schema)

"""Order-dependent operators that stay balanced under key skew.

A window partitioned by client or session sends every hit of one key to one
task; one bot client can own a large share of all hits. Instead a key's hits
are cut by time into buckets (``bucket_us``), and the window runs inside (key,
bucket): one shuffle, and a heavy key is spread over as many tasks as it has
buckets. Each bucket folds to one row (gap statistics) or to its sessions, of
which only the first and last can go on in another bucket; a second window
over at most two rows per key and bucket stitches these. For sessions a key's
hits within one gap's length are one row before any shuffle, so a burst costs
no more than a single hit.

Hits with a NULL time have no place in an order: they are left out. NULL keys
form a group of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

US = "_us"
BUCKET = "_bucket"
HOUR_US = 3_600_000_000


def bucketed(df: DataFrame, keys: list[str], us: str, tie: str | None, bucket_us: int) -> DataFrame:
    """Hits with a time, as keys, time, tie-breaker and time bucket."""
    t = F.col(us).cast("bigint")
    cols = [*[F.col(k) for k in keys], t.alias(US)] + ([F.col(tie)] if tie else [])
    bucket = F.floor(t / F.lit(bucket_us)).cast("bigint").alias(BUCKET)
    return df.where(F.col(us).isNotNull()).select(*cols, bucket)


def _in_bucket(keys: list[str], tie: str | None):
    return Window.partitionBy(*keys, BUCKET).orderBy(US, *([tie] if tie else []))


def gap_stats(df: DataFrame, keys: list[str], us: str, tie: str | None = None, bucket_us: int = HOUR_US) -> DataFrame:
    """Per key: number of gaps between consecutive hits and their min, max,
    mean and sample standard deviation, in seconds (rounded to 3 places).

    A bucket folds to the moments of its own gaps; the gap to the bucket before
    comes from a window over the buckets of a key. Variances are combined by
    each part's squared distance from the common mean."""
    hits = bucketed(df, keys, us, tie, bucket_us)
    gap = F.col(US) - F.lag(US).over(_in_bucket(keys, tie))
    parts = hits.select(*keys, BUCKET, US, gap.alias("gap")).groupBy(*keys, BUCKET).agg(
        F.count("gap").alias("n"), F.sum("gap").alias("s"), F.min("gap").alias("mn"), F.max("gap").alias("mx"),
        (F.var_pop("gap") * F.count("gap")).alias("m2"), F.min(US).alias("first_us"), F.max(US).alias("last_us"))
    by_key = Window.partitionBy(*keys)
    cross = F.col("first_us") - F.lag("last_us").over(by_key.orderBy(BUCKET))
    parts = parts.withColumn("cross", cross).withColumns({
        "tot_n": F.sum(F.col("n") + F.col("cross").isNotNull().cast("int")).over(by_key),
        "tot_s": F.sum(F.coalesce("s", F.lit(0)) + F.coalesce("cross", F.lit(0))).over(by_key)})
    mean = F.col("tot_s").cast("double") / F.col("tot_n")
    spread = (F.when(F.col("n") > 0, F.col("m2") + F.col("n") * F.pow(F.col("s").cast("double") / F.col("n") - mean, 2)).otherwise(0.0)
              + F.when(F.col("cross").isNotNull(), F.pow(F.col("cross").cast("double") - mean, 2)).otherwise(0.0))
    out = parts.groupBy(*keys).agg(
        F.max("tot_n").cast("bigint").alias("n_gaps"), F.max("tot_s").alias("_sum"),
        F.least(F.min("mn"), F.min("cross")).alias("_min"), F.greatest(F.max("mx"), F.max("cross")).alias("_max"),
        F.sum(spread).alias("_m2"))
    sec = F.lit(1_000_000.0)
    return out.select(
        *keys, "n_gaps",
        F.round(F.col("_min") / sec, 3).alias("min_gap_sec"),
        F.round(F.col("_max") / sec, 3).alias("max_gap_sec"),
        F.round(F.when(F.col("n_gaps") > 0, F.col("_sum").cast("double") / F.col("n_gaps")) / sec, 3).alias("avg_gap_sec"),
        F.round(F.when(F.col("n_gaps") > 1, F.sqrt(F.col("_m2") / (F.col("n_gaps") - 1))) / sec, 3).alias("stddev_gap_sec"),
    )


def gap_sessions(df: DataFrame, keys: list[str], us: str, gap_us: int, tie: str | None = None,
                 bucket_us: int = HOUR_US) -> DataFrame:
    """Inactivity sessions per key: a hit more than ``gap_us`` after the
    previous hit of the same key starts a new session (a gap of exactly
    ``gap_us`` continues it, as Spark's ``session_window`` does).

    Hits less than ``gap_us`` apart are always in one session, so time is cut into
    spans of that length, and a span's hits are folded to their first and last
    time and their number, in the tasks that read them. Windows see spans only:
    a key has at most ``bucket_us / gap_us`` (one at least) of them in a bucket.
    Hits at equal times are in one session whatever their order, so ``tie`` (as in
    ``gap_stats``) changes nothing.

    Output: keys, session_start_us, session_end_us (last hit + gap), n_events."""
    t = F.col(us).cast("bigint")
    spans = df.where(F.col(us).isNotNull()).groupBy(*keys, F.floor(t / F.lit(max(gap_us, 1))).alias("_span")).agg(
        F.min(t).alias("first_us"), F.max(t).alias("last_us"), F.count(F.lit(1)).alias("n"))
    spans = spans.withColumn(BUCKET, F.floor(F.col("first_us") / F.lit(bucket_us)).cast("bigint"))
    w = Window.partitionBy(*keys, BUCKET).orderBy("first_us")
    starts = F.when(F.col("first_us") - F.lag("last_us").over(w) > gap_us, 1).otherwise(0)
    spans = spans.withColumn("_new", starts).withColumn("_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    local = spans.groupBy(*keys, BUCKET, "_no").agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("n").alias("n"))
    last_no = F.max("_no").over(Window.partitionBy(*keys, BUCKET))
    local = local.withColumn("_edge", (F.col("_no") == 0) | (F.col("_no") == last_no))
    # only edge sessions of a key meet; any other one has a window of its own
    apart = F.when(F.col("_edge"), F.lit(None).cast("bigint")).otherwise(F.col("first_us"))
    local = local.withColumn("_apart", apart)
    by_key = Window.partitionBy(*keys, "_apart").orderBy("first_us")
    cut = F.coalesce(F.col("first_us") - F.lag("last_us").over(by_key) > gap_us, F.lit(True)).cast("int")
    local = local.withColumn("_cut", cut).withColumn("_sid", F.sum("_cut").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    return local.groupBy(*keys, "_apart", "_sid").agg(
        F.min("first_us").alias("session_start_us"), (F.max("last_us") + F.lit(gap_us)).alias("session_end_us"),
        F.sum("n").alias("n_events")).drop("_apart", "_sid")

"""Quality rules with adaptive thresholds, in native Spark expressions only.

Each document gets counts (words, symbols, repeated lines and windows) and from
them metrics as whole numbers (per mille). The metrics of each (lang, source)
group go into a mergeable quantile sketch: a table of bins of relative width
under 1/64 with counts. Merging is adding counts, so sketches of a language
and of the whole corpus are sums of those of its groups, and results do not
depend on the order of rows. A group's threshold of a metric is its upper
quartile and ``REACH`` times the quartile range, at least ``MARGIN`` away from the
quartile. Only large values are rejected: small ones of any metric pass; groups of fewer than ``LEAST_ROWS`` documents use the sketch of
their language, small languages that of the corpus. Documents are filtered by
a join with the thresholds (null lang or source is a group like others).

All counts are of whole texts. A null or empty text has no words and fails the
base rules. Repeated rows keep one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficlens.llm.common import stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# large values are rejected
METRICS = "symbols_pm", "dup_lines_pm", "repeats_pm", "word_len_c"
LEAST_ROWS = 100
REACH = 3
MARGIN = {"symbols_pm": 100, "dup_lines_pm": 300, "repeats_pm": 300, "word_len_c": 200}
BITS = 6


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` rows as doc_id, lang, source and the counts of the text.

    Repeated windows: 64-bit hashes of the three-word windows are sorted with
    their places, so equal windows become neighbours; this runs only for texts
    where some hash repeats."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select("doc_id", "lang", "source", t.alias("t"))
    d = d.select("doc_id", "lang", "source", "t", F.array_remove(F.split("t", SPACE), "").alias("w"))
    gaps = F.char_length(F.regexp_replace("t", SPACE, ""))
    symbols = F.octet_length("t") - F.octet_length(F.regexp_replace("t", SYMBOLS, ""))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n_dup_lines = F.expr("get(transform(array(l), x -> size(x) - size(array_distinct(x))), 0)")
    d = d.select("doc_id", "lang", "source", "w", gaps.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"), lines.alias("l"))
    return d.select("doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols",
                    n_dup_lines.cast("long").alias("n_dup_lines"), F.expr(repeat_words("w")).cast("long").alias("n_repeat_words"))


def repeat_words(w: str) -> str:
    """SQL of the number of words that lie in a three-word window found twice or
    more in the array of words ``w``."""
    h = f"transform(slice({w}, 1, greatest(0, size({w}) - 2)), (x, i) -> xxhash64(x, get({w}, i + 1), get({w}, i + 2)))"
    keyed = "sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', cast(i as bigint))))"
    hits = "filter(transform(k, (s, i) -> if(s.x = get(k, i - 1).x or s.x = get(k, i + 1).x, s.i, -1L)), p -> p >= 0)"
    cover = ("get(transform(array(sort_array(p)), q -> aggregate(transform(q, (x, i) -> least(3L, coalesce(get(q, i + 1), x + 3L) - x)), 0L, (a, b) -> a + b)), 0)")
    repeated = f"get(transform(array({keyed}), k -> get(transform(array({hits}), p -> {cover}), 0)), 0)"
    return f"get(transform(array({h}), h -> if(size(array_distinct(h)) = size(h), 0L, {repeated})), 0)"


def metrics(rows: DataFrame) -> DataFrame:
    per = lambda c, m: F.expr(f"({c} * {m}) div greatest(n_words, 1)")
    return rows.select("*", per("n_symbols", 1000).alias("symbols_pm"), per("n_dup_lines", 10000).alias("dup_lines_pm"),
                       per("n_repeat_words", 1000).alias("repeats_pm"), per("word_chars", 100).alias("word_len_c"))


def bin_of(v: str) -> str:
    """SQL of a value's bin: values under 2^(BITS+1) are their own, larger ones
    keep their first BITS+1 binary digits; a bin is named by its least value."""
    shift = f"greatest(length(bin({v})) - {BITS + 1}, 0)"
    return f"shiftleft(shiftright({v}, {shift}), {shift})"


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, metric, bin, n: the sketches of all groups, mergeable by
    adding n. Only rows that pass the base rules count."""
    pairs = F.explode_outer(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in METRICS])).alias("m")
    long = rows.where(~F.col("base_failed")).select("lang", "source", pairs).select("lang", "source", "m.metric", F.col("m.v").alias("v"))
    return long.groupBy("lang", "source", "metric", F.expr(bin_of("v")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """keys..., metric, {tag}_n, {tag}_q1, {tag}_q3 of the sketches merged to ``keys``."""
    merged = sketch.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "metric")
    upto = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    run = merged.select(*keys, "metric", "bin", upto.alias("upto"), F.sum("n").over(w).alias("total"))
    first = lambda share: F.min(F.when(F.col("upto") * 4 >= F.col("total") * share, F.col("bin")))
    return run.groupBy(*keys, "metric").agg(F.max("total").alias(f"{tag}_n"), first(1).alias(f"{tag}_q1"), first(3).alias(f"{tag}_q3"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source, metric, limit."""
    g, l, c = quartiles(sketch, ["lang", "source"], "g"), quartiles(sketch, ["lang"], "l"), quartiles(sketch, [], "c")
    g, l, c = g.alias("g"), l.alias("l"), c.alias("c")
    t = g.join(l, F.col("g.lang").eqNullSafe(F.col("l.lang")) & (F.col("g.metric") == F.col("l.metric")))
    t = t.join(c, F.col("g.metric") == F.col("c.metric"))
    pick = lambda q: F.when(F.col("g_n") >= LEAST_ROWS, F.col(f"g_{q}")).when(F.col("l_n") >= LEAST_ROWS, F.col(f"l_{q}")).otherwise(F.col(f"c_{q}"))
    margin = F.lit(None)
    for m in METRICS:
        margin = F.when(F.col("g.metric") == m, F.lit(MARGIN[m])).otherwise(margin)
    limit = pick("q3") + F.greatest(F.lit(REACH) * (pick("q3") - pick("q1")), margin)
    return t.select(F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), F.col("g.metric").alias("metric"), limit.alias("limit"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, source, the counts, the
    metrics, base_failed, kept."""
    rows = stored(metrics(counted(docs, text)).withColumn("base_failed", base_failed()), "rule-counts")
    limits = thresholds(stored(sketches(rows), "sketches")).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("limit"))).alias(f"{m}_limit") for m in METRICS])
    a, b = rows.alias("a"), limits.alias("b")
    joined = a.join(b, F.col("a.lang").eqNullSafe(F.col("b.lang")) & F.col("a.source").eqNullSafe(F.col("b.source")), "left")
    within = F.lit(True)
    for m in METRICS:
        within = within & F.coalesce(F.col(m) <= F.col(f"{m}_limit"), F.lit(True))
    return joined.select(*[F.col(f"a.{c}") for c in rows.columns], (~F.col("base_failed") & within).alias("kept"))

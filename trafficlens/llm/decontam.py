"""Benchmark decontamination by winnowing, in native Spark expressions only.

A shared span of at least ``window`` words must be found. Every text is turned
into word hashes, word hashes into hashes of ``k`` words, and of each run of
``window - k + 1`` successive k-word hashes the smallest is kept as a
fingerprint. The choice depends on the run alone, so two texts that share
``window`` words keep a common fingerprint inside them (Schleimer, Wilkerson
and Aiken, 2003).

1. Fingerprints of documents meet fingerprints of benchmark items (semi join);
   what remains are the candidate documents.
2. In a candidate every place of a matching fingerprint is extended to both
   sides, word by word, against each different surrounding that the
   fingerprint has in the benchmark. Only ``window - k`` words on a side
   matter: any window around the place ends within them. Where the extension
   reaches ``window`` words, these words are hit.
3. Items of fewer than ``window`` words (but not none) count as one window of
   their own length; each such length present is winnowed with its own ``k``.

Words are compared by 64-bit xxHash: ten agreeing hashes stand for ten agreeing
words. ``explode_outer`` is used on purpose: for a plain ``explode`` Spark infers
a filter on the array's size and pushes a copy of the whole array expression
below every step that built it. Rows with the same doc_id and text give equal result rows, one each; a
null text has no words. Nothing is capped: a fingerprint in many items costs
one row per different surrounding, with the item ids as a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import ascii_lower, fresh, stored

# fixed value: what separates words, before A-Z are lower-cased
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Rows of a side that may be broadcast: of one or two numbers, and of a
# fingerprint with its surrounding (under 300 bytes). Larger sides are shuffled.
BROADCAST_NUMBERS, BROADCAST_ROWS = 1_000_000, 50_000


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null for a null text."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def _hashes(df: DataFrame, text: str, out: str) -> DataFrame:
    return df.withColumn(out, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))


def _let(value: str, name: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it in ``body`` as ``name``.
    Steps held in columns would be copied into each other wherever Spark pushes
    a filter below them, one copy per use."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _doubled(arr: str, n: int, join: str) -> str:
    """SQL that combines each ``n`` neighbours of an array by ``join`` in steps of
    doubling, so that each step looks at one neighbour. With odd rests steps
    overlap; least() allows that, and so does a hash of overlapping parts."""
    expr, have = arr, 1
    while have < n:
        add = min(have, n - have)
        name = f"s{have}"
        expr = _let(expr, name, f"transform({name}, (x, i) -> {join.format(x='x', y=f'get({name}, i + {add})')})")
        have += add
    return expr


def _grams(h: str, t: int) -> str:
    """SQL of the k-word hashes of the word hashes ``h``, for spans of ``t`` words."""
    return _doubled(h, gram_words(t), "xxhash64({x}, {y})")


def _chosen(h: str, t: int) -> str:
    """SQL of the fingerprints: the smallest k-word hash of each run."""
    return f"array_distinct({_doubled(_grams(h, t), t - gram_words(t) + 1, 'least({x}, {y})')})"


def gram_words(t: int) -> int:
    return max(1, 2 * t // 5)


def _around(h: str, at: str, k: int, reach: int) -> Column:
    """The words before a place (nearest first) and after its ``k`` words."""
    before = F.expr(f"transform(sequence(1, {reach}), j -> get({h}, {at} - j))")
    after = F.expr(f"transform(sequence(1, {reach}), j -> get({h}, {at} + {k - 1} + j))")
    return F.struct(before.alias("before"), after.alias("after"))


def _agree(a: str, b: str, reach: int) -> Column:
    """How many leading entries of two arrays agree; a null agrees with nothing."""
    total = same = None
    for j in range(reach):
        eq = F.coalesce(F.get(F.col(a), F.lit(j)) == F.get(F.col(b), F.lit(j)), F.lit(False))
        same = eq if same is None else same & eq
        total = same.cast("int") if total is None else total + same.cast("int")
    return F.lit(0) if total is None else total


def _places(df: DataFrame, t: int, fps: DataFrame, keep: list[str]) -> DataFrame:
    """One row per place of a fingerprint of ``fps``: keep..., fp, at, around."""
    k = gram_words(t)
    rows = df.select(*keep, "h", F.posexplode_outer(F.expr(_grams("h", t))).alias("at", "fp"))
    rows = rows.join(fps, "fp", "left_semi").where(F.col("at") <= F.size("h") - k)
    return rows.select(*keep, "fp", "at", _around("h", "at", k, t - k).alias("around"))


def _hinted(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Broadcast only what was counted and found small; else the planner joins
    by shuffling."""
    return F.broadcast(df) if rows <= most else df


def find_overlaps(docs: DataFrame, items: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, spans (array of struct
    (start, end) of hit words, end exclusive, each at least one window),
    items (ids, as text, of items with an occurring window)."""
    return _overlaps(docs, items, window, doc_id, text, item_id, item_text).drop("key")


def _overlaps(docs: DataFrame, items: DataFrame, window: int, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """As ``find_overlaps``, with the key of the text."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    b = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    b = stored(_hashes(b, "text", "h").where(F.size("h") > 0).select("item", "h"), "benchmark-words")
    lengths = sorted(r[0] for r in b.select(F.least(F.size("h"), F.lit(window)).alias("t")).distinct().collect())
    found = None
    for t in lengths:
        whole = F.size("h") >= window if t == window else F.size("h") == t
        hits = _find(d, b.where(whole), t)
        found = hits if found is None else found.unionByName(hits)
    counted = d.select("doc_id", "key", F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    if found is None:
        return counted.select("doc_id", "key", "n_words", none.alias("spans"), F.array().cast("array<string>").alias("items"))
    found = found.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                               F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    a, f = counted.alias("a"), found.alias("f")
    on = F.col("a.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("a.key") == F.col("f.key"))
    return a.join(f, on, "left").select(
        "a.doc_id", "a.key", "a.n_words", F.coalesce("f.spans", none).alias("spans"),
        F.coalesce("f.items", F.array().cast("array<string>")).alias("items"))


def _find(d: DataFrame, b: DataFrame, t: int) -> DataFrame:
    """Hits of windows of ``t`` words: doc_id, key, spans, items."""
    k, reach = gram_words(t), t - gram_words(t)
    fps = b.select(F.explode_outer(F.expr(_chosen("h", t))).alias("fp")).distinct()
    seeds = _places(b, t, fps, ["item"]).groupBy("fp", "around").agg(F.sort_array(F.collect_set("item")).alias("items"))
    seeds = stored(seeds, "benchmark-fingerprints")
    n_seeds = seeds.count()
    fps = _hinted(seeds.select("fp").distinct(), n_seeds, BROADCAST_NUMBERS)
    marks = _hashes(d, "text", "h").select("doc_id", "key", F.explode_outer(F.expr(_chosen("h", t))).alias("fp"))
    met = stored(marks.join(fps, "fp", "left_semi").select("doc_id", "key").distinct(), "candidates")
    c, m = d.alias("c"), _hinted(met, met.count(), BROADCAST_NUMBERS).alias("m")
    on = F.col("c.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("c.key") == F.col("m.key"))
    cand = _hashes(c.join(m, on, "left_semi").select("doc_id", "key", "text"), "text", "h")
    mine = _places(cand, t, fps, ["doc_id", "key"]).withColumnRenamed("around", "mine")
    pairs = mine.join(_hinted(seeds, n_seeds, BROADCAST_ROWS), "fp")
    pairs = pairs.withColumns({"left": _agree("mine.before", "around.before", reach),
                               "right": _agree("mine.after", "around.after", reach)})
    span = F.struct((F.col("at") - F.col("left")).cast("int").alias("start"),
                    (F.col("at") + F.col("right") + k).cast("int").alias("end"))
    return (pairs.where(F.col("left") + F.col("right") + k >= t).select("doc_id", "key", span.alias("span"), "items")
            .groupBy("doc_id", "key").agg(F.collect_set("span").alias("spans"),
                                          F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")))


def covered(spans: Column) -> Column:
    """Words covered by the spans, each counted once."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    step = F.aggregate(F.sort_array(spans), zero, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["upto"], x["start"]))).alias("n"),
        F.greatest(s["upto"], x["end"]).alias("upto")))
    return step["n"]


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per document: words, hit words, items found, digest of the items."""
    o = find_overlaps(docs, items, window).withColumn("items", F.sort_array("items"))
    n_hit = covered(F.col("spans")).cast("long")
    return o.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns kept. Rows are told
    apart by doc_id and text, so a null or reused doc_id takes no clean row along."""
    o = _overlaps(docs, items, window, doc_id, text).where(F.size("spans") > 0).select("doc_id", "key").distinct()
    leaks = stored(o, "contaminated")
    flag, key = fresh(docs, "_leak"), fresh(docs, "_key")
    a, x = docs.alias("a"), _hinted(leaks.select(F.col("doc_id").alias(flag), F.col("key").alias(key)), leaks.count(), BROADCAST_NUMBERS)
    return a.join(x, F.col(f"a.{doc_id}").eqNullSafe(F.col(flag)) & (F.xxhash64(F.col(f"a.{text}")) == F.col(key)), "left_anti")

"""A classification tree fitted on labelled sessions and compiled into column
expressions.

Fitting is level by level: one aggregate counts labels by (leaf, feature, bin), which
is at most leaves x features x bins x labels rows however many sessions there
are, and from these the driver picks the split of each leaf that lowers the Gini
impurity most. Candidate cuts are quantiles of a bounded sample (``sample`` rows with the
smallest hashed keys, all if there are fewer); the counts are of all rows. Counts
are whole numbers and ties are broken by (feature, cut), so row order and
partitions change nothing. A missing or NaN feature is never under a cut.

The fitted tree is a CASE expression: scoring needs no Python, join or shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from ..session import materialize

GAIN = 1 + 1e-9  # a split must better the leaf by more than rounding


@dataclass(frozen=True)
class Leaf:
    """A leaf: the counts of its training rows by label."""

    counts: tuple[int, ...]


@dataclass(frozen=True)
class Split:
    """Rows whose feature is at most ``cut`` go left, others right."""

    feature: str
    cut: float
    left: "Split | Leaf"
    right: "Split | Leaf"


def _value(feature: str) -> Column:
    return X.nan_to_null(F.col(feature).cast("double"))


def _under(feature: str, cut: float) -> Column:
    return F.coalesce(_value(feature) <= F.lit(float(cut)), F.lit(False))


def candidate_cuts(df: DataFrame, features, keys, bins: int, sample: int) -> dict[str, list[float]]:
    """At most ``bins - 1`` cuts a feature: the values at ranks i/bins of the sample."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    rows = df.select(*[_value(f).alias(f) for f in features], h.alias("h")).orderBy("h", *features).limit(sample)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in features])).alias("p")
    long = rows.select(pairs).select("p.f", "p.v").where(F.col("v").isNotNull())
    w = Window.partitionBy("f")
    ranked = long.select("f", "v", F.row_number().over(w.orderBy("v")).alias("at"), F.count(F.lit(1)).over(w).alias("n"))
    # the last row of each of the bins but the last
    edge = F.floor(F.col("at") * bins / F.col("n")) > F.floor((F.col("at") - 1) * bins / F.col("n"))
    got = ranked.where(edge & (F.col("at") < F.col("n"))).select("f", "v").distinct().collect()
    out: dict[str, list[float]] = {f: [] for f in features}
    for r in got:
        out[r["f"]].append(r["v"])
    return {f: sorted(v) for f, v in out.items()}


def _impurity(counts) -> float:
    """n minus this is n times the Gini impurity."""
    n = sum(counts)
    return sum(c * c for c in counts) / n if n else 0.0


def _best(hist: dict[tuple[int, int], tuple[int, ...]], total: tuple[int, ...], cuts: list[list[float]], least: int):
    """(feature, cut index) of the best split of one leaf, or None."""
    found, best = None, _impurity(total) * GAIN
    for f, own in enumerate(cuts):
        left = [0] * len(total)
        for i in range(len(own)):
            left = [a + b for a, b in zip(left, hist.get((f, i), (0,) * len(total)))]
            right = [a - b for a, b in zip(total, left)]
            if min(sum(left), sum(right)) < least:
                continue
            got = _impurity(left) + _impurity(right)
            if got > best:
                found, best = (f, i), got
    return found


def fit(df: DataFrame, label: str = "label", labels=C.CLASSES, features=C.FEATURES, keys=("client_id", "session_id"), depth: int = 4,
        bins: int = 32, sample: int = 10_000, least: int = 20) -> Split | Leaf:
    """The tree fitted on all rows of ``df`` whose label is one of ``labels``.
    Without such rows it is a leaf without counts."""
    features, labels = list(features), list(labels)
    data = materialize(df.where(F.col(label).isin(*labels)).select(*keys, *[_value(f).alias(f) for f in features], F.col(label).alias("_label")))
    by_name = candidate_cuts(data, features, keys, bins, sample)
    cuts = [by_name[f] for f in features]
    # the bin of a value: how many cuts are under it; missing values have the last one
    bin_of = [reduce(lambda a, c, f=f: a + F.when(F.col(f) <= F.lit(c), 0).otherwise(1), own, F.lit(0)) for f, own in zip(features, cuts)]
    data = data.select("_label", *features, F.array(*bin_of).alias("_bins"))
    splits: dict[int, tuple[int, float]] = {}
    counts: dict[int, tuple[int, ...]] = {}

    def leaf_of(node: int) -> Column:
        if node not in splits:
            return F.lit(node)
        f, cut = splits[node]
        return F.when(_under(features[f], cut), leaf_of(2 * node)).otherwise(leaf_of(2 * node + 1))

    open_ = {1}
    for level in range(depth + 1):
        if not open_:
            break
        own = data.withColumn("_leaf", leaf_of(1)).where(F.col("_leaf").isin(*sorted(open_)))
        cells = own.select("_leaf", "_label", F.posexplode("_bins").alias("f", "bin")).groupBy("_leaf", "f", "bin", "_label").count().collect()
        hists: dict[int, dict] = {}
        for r in cells:
            cell = hists.setdefault(r["_leaf"], {}).setdefault((r["f"], r["bin"]), [0] * len(labels))
            cell[labels.index(r["_label"])] += r["count"]
        nxt = set()
        for node in open_:
            hist = hists.get(node, {})
            total = tuple(sum(v[i] for (f, _), v in hist.items() if f == 0) for i in range(len(labels)))
            counts[node] = total
            best = _best(hist, total, cuts, least) if level < depth else None
            if best:
                splits[node] = (best[0], cuts[best[0]][best[1]])
                nxt |= {2 * node, 2 * node + 1}
        open_ = nxt

    def built(node: int) -> Split | Leaf:
        if node not in splits:
            return Leaf(counts.get(node, (0,) * len(labels)))
        f, cut = splits[node]
        return Split(features[f], cut, built(2 * node), built(2 * node + 1))

    return built(1)


def _walk(tree: Split | Leaf, at_leaf) -> Column:
    if isinstance(tree, Leaf):
        return at_leaf(tree)
    return F.when(_under(tree.feature, tree.cut), _walk(tree.left, at_leaf)).otherwise(_walk(tree.right, at_leaf))


def predicted_label(tree: Split | Leaf, labels=C.CLASSES) -> Column:
    """The most frequent label of a row's leaf, the first of equal ones; null for
    a tree fitted on nothing."""
    def name(leaf: Leaf) -> Column:
        if not any(leaf.counts):
            return F.lit(None).cast("string")
        return F.lit(labels[max(range(len(labels)), key=lambda i: (leaf.counts[i], -i))])

    return _walk(tree, name)


def probability(tree: Split | Leaf, i: int) -> Column:
    """The share of label ``i`` in a row's leaf."""
    return _walk(tree, lambda leaf: F.lit(leaf.counts[i] / sum(leaf.counts) if any(leaf.counts) else None).cast("double"))


def score(df: DataFrame, tree: Split | Leaf, labels=C.CLASSES, keys=("client_id", "session_id")) -> DataFrame:
    """keys, predicted_class and the share of each label in the row's leaf."""
    shares = [F.round(probability(tree, i), 6).alias(f"p_{name.lower()}") for i, name in enumerate(labels)]
    return df.select(*keys, predicted_label(tree, labels).alias("predicted_class"), *shares)

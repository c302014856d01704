"""Isolation Forest over session features.

Trees are grown on small subsamples, so growing is cheap at any size: a row's
key is hashed once, and tree ``t`` orders rows by ``(a_t * hash + b_t) mod PRIME``
and takes the first ``sample``. A threshold from the row count drops most rows
first, so about ``4 * sample`` rows a tree are ordered. One task grows one tree;
which feature a node splits on and where comes from a hash of (seed, tree, node)
and the least and greatest value there, so row order and partitions change nothing.

The grown nodes, at most ``trees * (2 * sample - 1)``, become a few flat arrays that
travel with the scoring tasks, which walk all trees level by level for a batch of
rows at a time: no join, no shuffle. (Native expressions over constant arrays were
measured at 50 to 250 microseconds a row, as interpreted lambdas or in methods too large to
compile; the batches take about 5.) A missing or NaN feature goes right at every split.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import expressions as X
from .classify import score_with_model

PRIME = (1 << 31) - 1
EULER = 0.5772156649015329


@dataclass(frozen=True)
class Node:
    tree: int
    node: int  # the root is 1, the children of n are 2n and 2n + 1
    feature: int  # -1: leaf
    split: float
    size: int


def _hex(*parts) -> str:
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def _sample_orders(trees: int, seed: str) -> list[tuple[int, int]]:
    """(a, b) of every tree's order."""
    return [(1 + int(_hex(seed, t, "a")[:8], 16) % (PRIME - 1), int(_hex(seed, t, "b")[:8], 16) % PRIME) for t in range(trees)]


def subsamples(df: DataFrame, trees: int, sample: int, seed: str, features=C.FEATURES, keys=("client_id", "session_id")) -> DataFrame:
    """tree and features of each tree's subsample: ``sample`` rows a tree, or all
    if there are no more."""
    total = df.count()
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    rows = df.select(*[X.nan_to_null(F.col(f).cast("double")).alias(f) for f in features], h.alias("h"))
    rows = rows.withColumn("u", F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint") % F.lit(PRIME))
    limit = PRIME if total <= 4 * sample else -(-4 * sample * PRIME // total)
    drawn = F.array(*[F.struct(F.lit(t).alias("tree"), ((F.col("u") * F.lit(a).cast("bigint") + F.lit(b)) % F.lit(PRIME)).alias("v"))
                      for t, (a, b) in enumerate(_sample_orders(trees, seed))])
    rows = rows.select(*features, "h", F.explode(F.filter(drawn, lambda d: d["v"] < F.lit(limit))).alias("d"))
    place = F.row_number().over(Window.partitionBy("d.tree").orderBy("d.v", "h", *features))
    return rows.withColumn("place", place).where(F.col("place") <= sample).select(F.col("d.tree").alias("tree"), *features)


def grow(x: np.ndarray, tree: int, seed: str, depth: int) -> list[tuple]:
    """Nodes of one tree over the rows of ``x`` (NaN: missing)."""
    out, todo = [], [(1, 0, np.arange(len(x)))]
    while todo:
        node, level, rows = todo.pop()
        own = x[rows]
        feature, split = -1, 0.0
        if level < depth and len(rows) > 1:
            lo, hi = np.fmin.reduce(own, axis=0), np.fmax.reduce(own, axis=0)
            able = np.flatnonzero(hi > lo)
            if len(able):
                h = _hex(seed, tree, node)
                feature = int(able[int(h[:8], 16) % len(able)])
                split = float(lo[feature] + (hi[feature] - lo[feature]) * (int(h[8:16], 16) / 4294967296.0))
                left = own[:, feature] < split
                todo += [(2 * node, level + 1, rows[left]), (2 * node + 1, level + 1, rows[~left])]
        out.append((tree, node, feature, split, len(rows)))
    return out


def forest(df: DataFrame, trees: int = 32, sample: int = 256, seed: str = "forest", features=C.FEATURES,
           keys=("client_id", "session_id")) -> list[Node]:
    """The nodes of all trees. Growing runs in one task a tree; at most
    ``trees * (2 * sample - 1)`` nodes come back."""
    depth = math.ceil(math.log2(max(sample, 2)))
    names = list(features)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(grow(pdf[names].to_numpy(dtype=np.float64), int(pdf["tree"].iloc[0]), seed, depth),
                            columns=["tree", "node", "feature", "split", "size"])

    nodes = subsamples(df, trees, sample, seed, features, keys).groupBy("tree").applyInPandas(
        one, "tree int, node bigint, feature int, split double, size bigint")
    return sorted((Node(*r) for r in nodes.collect()), key=lambda n: (n.tree, n.node))


def mean_path(n: int) -> float:
    """Mean length of an unsuccessful search among ``n`` values."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def _flat(nodes: list[Node]) -> tuple[list, list, list, list, list]:
    """All trees as arrays by place: feature, split, place of the left child (the
    right one follows), path length; and the places of the roots. A leaf is its
    own left child, and its split NaN."""
    trees: dict[int, dict[int, Node]] = {}
    for n in nodes:
        trees.setdefault(n.tree, {})[n.node] = n
    feature, split, left, length, roots = [], [], [], [], []
    for by in trees.values():
        roots.append(len(feature))
        order = [1]
        for node in order:  # grows while it is read: level by level
            n, at = by[node], len(feature)
            inner = n.feature >= 0
            feature.append(max(n.feature, 0))
            split.append(n.split if inner else math.nan)
            left.append(roots[-1] + len(order) if inner else at)
            length.append(0.0 if inner else node.bit_length() - 1 + mean_path(n.size))
            if inner:
                order += [2 * node, 2 * node + 1]
    return feature, split, left, length, roots


def path_lengths(nodes: list[Node]):
    """A function from rows of features (NaN: missing) to their mean path lengths."""
    feature, split, left, length = (np.array(a) for a in _flat(nodes)[:4])
    roots = _flat(nodes)[4]
    depth = max(n.node.bit_length() - 1 for n in nodes)

    def mean_length(x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for root in roots:
            at = np.full(len(x), root)
            for _ in range(depth):
                # a leaf's split is NaN: its row stays with "not less"
                right = ~(x[rows, feature[at]] < split[at]) & ~np.isnan(split[at])
                at = left[at] + right
            total += length[at]
        return total / len(roots)

    return mean_length


def isolation_scores(df: DataFrame, trees: int = 32, sample: int = 256, seed: str = "forest", threshold: float = 0.6,
                     features=C.FEATURES, keys=("client_id", "session_id")) -> DataFrame:
    """client_id, session_id, isolation_score (near 1: easily isolated, under 0.5:
    ordinary), is_anomaly. With no rows, or when no two rows differ, all scores
    are those of an empty path."""
    nodes = forest(df, trees, sample, seed, features, keys)
    if not nodes:
        return df.select(*keys, F.lit(None).cast("double").alias("isolation_score"), F.lit(False).alias("is_anomaly"))
    norm = mean_path(max(n.size for n in nodes)) or 1.0
    lengths = path_lengths(nodes)
    walked = score_with_model(df.select(*keys, *features), lambda x: lengths(x.to_numpy(dtype=np.float64)), features, "_path", T.DoubleType())
    score = F.round(F.pow(F.lit(2.0), -F.col("_path") / F.lit(norm)), 6)
    return walked.select(*keys, score.alias("isolation_score"), (score > threshold).alias("is_anomaly"))

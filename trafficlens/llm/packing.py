"""Optimal length buckets and token-budget batches.

The lengths of all documents make one histogram (a Spark aggregate). Dynamic
programming over it chooses the ``n_buckets`` upper bounds with the least
padding: a document in a bucket is padded to the bucket's bound. Inside each
bucket documents form batches of ``max(1, budget // bound)``, so that a padded batch keeps
within the token budget; a document longer than the budget is a batch alone.

Histogram cells are exact up to ``EXACT`` tokens; longer lengths share cells of
relative width 1/EXACT, each with its own largest length, so the histogram on
the driver stays under about 60,000 cells whatever the input, and bounds are
optimal among the cells' largest lengths. Nothing is cut or dropped.

A document's length is its number of words (runs without ASCII white space)
plus one end token; a null text has length one. Repeated rows keep one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import gapless_rank

EXACT = 4096
SPACE = r"[\x20\x09-\x0D]+"


def n_tokens(text: Column) -> Column:
    """Words and an end token."""
    return (F.coalesce(F.size(F.array_remove(F.split(text, SPACE), "")), F.lit(0)) + 1).cast("long")


def histogram(lengths: DataFrame, column: str) -> list[tuple[int, int, int]]:
    """(largest length, documents, tokens) of each cell, ascending."""
    x = F.col(column)
    octave = F.greatest(F.length(F.bin(x)) - EXACT.bit_length(), F.lit(0))
    width = F.pow(F.lit(2.0), octave).cast("long")
    cells = lengths.groupBy((F.floor(x / width) * width).cast("long").alias("cell")).agg(
        F.max(x).alias("top"), F.count(F.lit(1)).alias("n"), F.sum(x).alias("tokens"))
    return sorted((r["top"], r["n"], r["tokens"]) for r in cells.collect())


def best_bounds(cells: list[tuple[int, int, int]], n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets with the least padding.

    With N documents in the first j cells, best(b, j) = min over i < j of
    best(b-1, i) + top_j * (N_j - N_i) (less a constant). For a fixed b these are lines
    in top_j with slopes -N_i, and both slopes and queries are monotone, so a
    deque of the lower hull answers them in linear time. Of equal choices the
    one with fewer documents before it wins."""
    if not cells:
        return []
    tops = [c[0] for c in cells]
    count = [0]
    for c in cells:
        count.append(count[-1] + c[1])
    m = len(cells)
    best = [0] + [None] * m
    back: list[list[int]] = []
    costs = []
    for _ in range(min(n_buckets, m)):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, i
        head = 0
        now: list = [None] * (m + 1)
        came = [0] * (m + 1)
        for j in range(1, m + 1):
            i = j - 1
            if best[i] is not None:
                line = (-count[i], best[i], i)
                while len(hull) - head >= 2:
                    (s1, c1, _), (s2, c2, _) = hull[-2], hull[-1]
                    if (line[1] - c1) * (s1 - s2) < (c2 - c1) * (s1 - line[0]):
                        hull.pop()
                    else:
                        break
                hull.append(line)
            x = tops[j - 1]
            while len(hull) - head >= 2 and hull[head + 1][0] * x + hull[head + 1][1] < hull[head][0] * x + hull[head][1]:
                head += 1
            if len(hull) > head:
                s, c, i = hull[head]
                now[j] = s * x + c + x * count[j]
                came[j] = i
        best = now
        back.append(came)
        costs.append(best[m])
    b = min(range(len(costs)), key=lambda k: (costs[k], k))
    bounds, j = [], m
    while j:
        bounds.append(tops[j - 1])
        j, b = back[b][j], b - 1
    return bounds[::-1]


def packed(docs: DataFrame, n_buckets: int = 8, budget: int = 16_384, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, bucket (0 is the
    shortest), bound, place (gapless in the bucket), batch (in the bucket),
    slot (in the batch), padding."""
    lengths = docs.select(F.col(doc_id).alias("doc_id"), n_tokens(F.col(text)).alias("n_tokens"))
    bounds = best_bounds(histogram(lengths, "n_tokens"), n_buckets)
    bucket = bound = F.lit(None)
    for i in reversed(range(len(bounds))):
        inside = F.col("n_tokens") <= bounds[i]
        bucket = F.when(inside, F.lit(i)).otherwise(bucket)
        bound = F.when(inside, F.lit(bounds[i])).otherwise(bound)
    dealt = lengths.select("doc_id", "n_tokens", bucket.cast("int").alias("bucket"), bound.cast("long").alias("bound"))
    placed = gapless_rank(dealt, ["bucket"], ["doc_id", "n_tokens"], "place")
    each = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bound"))).cast("long")
    return placed.select("doc_id", "n_tokens", "bucket", "bound", "place", F.floor(F.col("place") / each).cast("long").alias("batch"),
                         (F.col("place") % each).cast("long").alias("slot"), (F.col("bound") - F.col("n_tokens")).alias("padding"))

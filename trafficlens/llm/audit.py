"""Audit of how filters interact, by min-plus removal ranks.

Each document has a mask: which of k filters it fails. Documents are counted by
(part, mask, label flags) in Spark; only these counts, at most 4 x 2^k a part, go on.
For a part, M[mask, filter] is 0 where the mask fails the filter and infinite
elsewhere, and P[order, filter] is the filter's place in the order (the inverse
permutation). Their min-plus product R[mask, order] = min over filters of
M + P is the step at which documents of the mask go. R drives weighted
scatter counts of the documents removed at each step, and a filter that fails a
mask after its step is redundant for it.

Parts are worked on in parallel, one table of counts each. All k! orders are
listed, so k is small. Every row of the input counts; null and empty texts have
no words, a null part is the empty string and counts with it. A text is a copy when
an equal text has a smaller doc_id anywhere in the table; rows with a null
doc_id neither are nor make copies, and rows of one doc_id do not make each other
copies. Repeated rows of ``labels`` count once: a flag holds if any row of
the doc_id has it. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import join_groups, ship_by_value, stored
from trafficlens.llm.exact import text_key

ship_by_value(__name__)

SPACE = r"[\x20\x09-\x0D]+"
COPY = "E"
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(text: str = "text") -> dict[str, Column]:
    """Failure conditions that look at a text alone, by filter name."""
    t = F.coalesce(F.col(text), F.lit(""))
    capitals = F.octet_length(t) - F.octet_length(F.regexp_replace(t, "[A-Z]+", ""))
    # words and distinct words of one split
    words = F.transform(F.array(F.array_remove(F.split(t, SPACE), "")),
                        lambda w: F.struct(F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("d")))
    w = F.get(words, F.lit(0))
    return {
        "A": w["n"] < 100,
        "B": 100 * w["d"] < 80 * w["n"],
        "C": 100 * capitals.cast("long") > 10 * F.char_length(t).cast("long"),
        "D": t.rlike(r"[#$%&*|]"),
    }


def bitmask(flags: list[Column]) -> Column:
    """Bit i is set where flag i holds."""
    return reduce(lambda a, b: a + b, [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(flags)])


def masked(docs: DataFrame, filters: dict[str, Column], part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, part, mask per row: bits of ``filters`` in their order, then the
    bit of a copy."""
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                              bitmask(list(filters.values())).alias("mask"), text_key(text).alias("sha")), "audit-rows")
    total = rows.count()
    groups = stored(rows.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where(F.col("n") > 1), "audit-groups")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return join_groups(rows, groups, "sha", total).select(
        "doc_id", "part", (F.col("mask") + F.when(copy, F.lit(1 << len(filters))).otherwise(F.lit(0))).alias("mask"))


def counted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic, n of the rows of ``masked``. Rows without a
    doc_id have no label and take no part in the join."""
    flags = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    known = rows.where(F.col("doc_id").isNotNull()).join(flags, "doc_id", "left").select(
        "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    unknown = rows.where(F.col("doc_id").isNull()).select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.unionByName(unknown).groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


def places(k: int) -> np.ndarray:
    """P: row per order (in lexical order of the orders), column per filter;
    the step at which the order applies the filter."""
    orders = np.array(list(itertools.permutations(range(k))), dtype=np.int64).reshape(-1, k)
    out = np.empty_like(orders)
    np.put_along_axis(out, orders, np.broadcast_to(np.arange(1, k + 1), orders.shape), axis=1)
    return out


def ranks(fails: np.ndarray, at: np.ndarray) -> np.ndarray:
    """R[mask, order]: the min-plus product of M and P; k + 1 where no filter fails."""
    k = at.shape[1]
    never = k + 1
    m = np.where(fails, 0, never)
    return np.minimum((m[:, None, :] + at[None, :, :]).min(axis=2), never)


def interactions(mask: np.ndarray, weights: np.ndarray, names: str) -> pd.DataFrame:
    """All orders and steps of one part. ``weights``: columns n, good, toxic."""
    k = len(names)
    at = places(k)
    n_orders = len(at)
    fails = (mask[:, None] >> np.arange(k)) & 1 == 1
    r = ranks(fails, at)
    order = np.broadcast_to(np.arange(n_orders), r.shape)
    removed = np.zeros((3, n_orders, k + 2), dtype=np.int64)
    for i in range(3):
        np.add.at(removed[i], (order, r), np.broadcast_to(weights[:, i, None], r.shape))
    lost = removed[:, :, 1:k + 1]
    kept = weights[:, 0].sum() - lost[0].cumsum(axis=1)
    # filters that fail a mask after it is gone
    late = fails[:, None, :] & (r[:, :, None] < at[None, :, :])
    redundant = np.einsum("m,mof->of", weights[:, 0], late.astype(np.int64))
    only = np.array([weights[mask == 1 << f, 0].sum() for f in range(k)], dtype=np.int64)
    by_filter = np.take_along_axis(lost[0], at - 1, axis=1)
    shapley = by_filter.sum(axis=0)
    applied = np.argsort(at, axis=1)  # the filter of each step
    pick = lambda x: np.take_along_axis(x, applied, axis=1).ravel()
    text = np.array(["".join(names[f] for f in row) for row in applied])
    return pd.DataFrame({
        "filter_order": np.repeat(text, k), "step": np.tile(np.arange(1, k + 1, dtype=np.int32), n_orders),
        "kept": kept.ravel(), "removed": lost[0].ravel(), "redundant": pick(redundant),
        "unique_fails": only[applied].ravel(), "good_lost": lost[1].ravel(), "toxic_lost": lost[2].ravel(),
        "shapley": shapley[applied].ravel()})


def audited(counts: DataFrame, names: str) -> DataFrame:
    """part, filter_order, step and the measures, from part, mask, good, toxic, n."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        n = pdf["n"].to_numpy(np.int64)
        weights = np.stack([n, n * pdf["good"].to_numpy(np.int64), n * pdf["toxic"].to_numpy(np.int64)], axis=1)
        out = interactions(pdf["mask"].to_numpy(np.int64), weights, names)
        out.insert(0, "part", pdf["part"].iloc[0])
        return out

    return counts.groupBy("part").applyInPandas(one, "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, part: str = "lang") -> DataFrame:
    """Audit of ``filters`` (by default those of ``failures``) and of copies."""
    filters = failures() if filters is None else filters
    return audited(counted(masked(docs, filters, part), labels), "".join(filters) + COPY)

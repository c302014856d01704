import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from trafficlens.llm import audit, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ORDERS = ["".join(p) for p in itertools.permutations("ABCDE")]


def slow(docs, labels):
    """The report by applying every order to every document."""
    flags = {}
    for i, q, t in labels:
        old = flags.get(i, (0, 0))
        flags[i] = (max(old[0], int(q == 1)), max(old[1], int(t == 1)))
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = {}
    for i, t, lang in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        good, toxic = flags.get(i, (0, 0)) if i is not None else (0, 0)
        for o in ORDERS:
            at = out.setdefault(lang or "", {}).setdefault(o, [[0] * 6 for _ in o])
            gone = False
            for s, f in enumerate(o):
                cell = at[s]
                cell[2] += fails[f] and gone
                cell[3] += fails[f] and sum(fails.values()) == 1
                if fails[f] and not gone:
                    gone = True
                    cell[1] += 1
                    cell[4] += good
                    cell[5] += toxic
                cell[0] += not gone
    rows = []
    for part, by in out.items():
        shapley = {f: sum(by[o][o.index(f)][1] for o in ORDERS) for f in "ABCDE"}
        rows += [(part, o, s + 1, *cell, shapley[o[s]]) for o, steps in by.items() for s, cell in enumerate(steps)]
    return sorted(rows)


def fast(df, labels):
    return sorted(map(tuple, audit.audit(df, labels).collect()))


def plain(df, labels):
    return slow([tuple(r) for r in df.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_against_brute_force(spark, docs, labels, edge_docs, no_docs):
    some = docs.where("doc_id % 3 = 0")
    assert fast(some, labels) == plain(some, labels)
    # repeated and contradicting labels, labels without a key or a value
    odd = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (1, None, 1), (None, 1, 1), (8, 1, None)], "doc_id long, quality int, toxic int")
    for df in (edge_docs, edge_docs.unionByName(edge_docs)):
        assert fast(df, odd) == plain(df, odd)
    assert fast(no_docs, odd) == []
    assert len(fast(edge_docs, odd.limit(0))) == 3 * 120 * 5


def test_query_columns(spark):
    out = queries.op11_filter_audit(spark, "/root/testdata/sf0.001")
    assert out.columns == ["part", "filter_order", "step", *audit.MEASURES]
    assert dict(out.dtypes)["step"] == "int" and out.count() == 120 * 5 * 4


def test_min_plus_ranks():
    at = audit.places(3)
    assert at.shape == (6, 3) and at[0].tolist() == [1, 2, 3] and at[4].tolist() == [2, 3, 1]  # order CAB
    fails = np.array([[False, False, False], [True, False, True]])
    assert audit.ranks(fails, at)[0].tolist() == [4] * 6 and audit.ranks(fails, at)[1, 4] == 1


def test_own_filters_and_a_hot_text(spark):
    """A third of all rows have one text: only the first is no copy."""
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), "id")).alias("text"),
                                    F.lit("xx").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    out = audit.audit(docs, labels, {"S": F.col("text") == "same"}).collect()
    got = {(r.filter_order, r.step): r.asDict() for r in out}
    assert got["SE", 1]["removed"] == 3000 and got["SE", 2]["removed"] == 0 and got["SE", 2]["redundant"] == 2999
    assert got["ES", 1]["removed"] == 2999 and got["ES", 2]["removed"] == 1 and got["ES", 1]["good_lost"] == 2999
    assert got["SE", 1]["unique_fails"] == 1 and got["SE", 1]["shapley"] == 3001 and got["SE", 2]["kept"] == 6000

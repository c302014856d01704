import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trafficlens.llm import exact
from trafficlens.llm.common import join_groups


def slow(rows):
    """doc_id, keep_id, group_size, kept and hash of (doc_id, text) rows; of rows equal in both one stays."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), i == keep and first, hashlib.sha256(t.encode()).hexdigest()))
            first = first and i != keep
    return sorted(out, key=str)


def fast(df, **kw):
    out = exact.duplicates(df, **kw).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")))
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("words", [exact.BROADCAST_WORDS, 0])
def test_against_brute_force(docs, edge_docs, no_docs, words):
    for df in (docs, edge_docs, edge_docs.unionByName(edge_docs), no_docs):
        want = slow([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
        assert fast(df, broadcast_words=words) == want


@pytest.mark.parametrize("words", [exact.BROADCAST_WORDS, 0])
def test_kept_rows_come_whole(spark, docs, edge_docs, words):
    df = docs.where("doc_id < 500").unionByName(docs.where("doc_id < 500").withColumn("doc_id", F.col("doc_id") + 10_000))
    got = exact.deduplicated(df, broadcast_words=words)
    assert got.columns == df.columns
    want = {i for i, _, _, kept, _ in slow([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]) if kept}
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == sorted(want) and got.exceptAll(df).count() == 0
    out = exact.deduplicated(edge_docs, broadcast_words=words)
    assert out.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(i) for i, _, _, kept, _ in slow(
        [(r.doc_id, r.text) for r in edge_docs.collect()]) if kept)


def test_single_texts_pass_and_the_filter_never_misses(spark):
    rows = exact.hashed(spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.when(F.col("id") % 20 == 0, 7).otherwise(F.col("id"))).alias("text")))
    total, words = 40_000, exact.n_words(40_000)
    marked = exact.flagged(rows, exact.bloom(rows, words).cache(), words, total, "maybe")
    got = {r["copy"]: (r["n"], r["maybe"]) for r in marked.groupBy((F.col("doc_id") % 20 == 0).alias("copy")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("maybe").cast("int")).alias("maybe")).collect()}
    assert got[True] == (2000, 2000)  # all copies
    assert got[False][0] == 38_000 and got[False][1] < 0.04 * 38_000  # few others


def test_single_rows_are_not_shuffled(spark):
    """Rows of the first branch meet the filter by broadcast only, and no text is read after the hashes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = exact.stored(exact.hashed(docs), "t-keys")
    total = rows.count()
    words = exact.n_words(total)
    marked = exact.flagged(rows, exact.stored(exact.bloom(rows, words), "t-bloom"), words, total, "maybe")
    plan = marked.where(~F.col("maybe"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    whole = exact.duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in whole and "Arrow" not in whole and "text#" not in whole


def test_hot_group_is_not_joined_by_key(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    out = join_groups(rows, groups, "k", 30_000)
    assert out.where("k = -1 and n = 10000 and top = 29997").count() == 10_000 and out.count() == 30_000
    # the hot rows stay where they are: the shuffled branch does not hold them
    shuffled = join_groups(rows, groups, "k", 30_000).where("n = 1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in shuffled) == 20_000
    assert join_groups(rows, groups.where("n > 1"), "k", 30_000).where("n is null").count() == 20_000

"""The fitted models: forest and tree against plain versions, and what must not change them."""

import math

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from trafficlens.operators import anomaly as AN
from trafficlens.operators import classify as CL
from trafficlens.operators import model as MD
from trafficlens.plans import oracle_models
from trafficlens.sources import fixtures as FX

ROWS = "client_id long, session_id long, edge_score double, event_velocity_per_sec double, session_duration_sec long, mouse_move_events long"


@pytest.fixture(scope="module")
def rows(spark):
    return FX.session_signals(spark, SF001)


def test_forest_does_not_depend_on_order_or_partitions(rows):
    want = AN.forest(rows, trees=5, sample=64)
    assert AN.forest(rows.orderBy(F.desc("session_id")).repartition(7), trees=5, sample=64) == want
    assert {n.tree for n in want} == set(range(5))
    assert all(n.size == 64 for n in want if n.node == 1) and len(want) <= 5 * 127
    assert AN.forest(rows, trees=5, sample=64, seed="other") != want


def test_path_lengths_against_a_plain_walk(rows):
    nodes = AN.forest(rows, trees=7, sample=50)
    by = {(n.tree, n.node): n for n in nodes}
    x = np.array([[0.5, 2.0, 30.0, 100.0], [math.nan, 2.0, 30.0, math.nan], [9e9, -9e9, 0.0, 0.0], [math.nan] * 4])

    def walk(row, tree):
        node = 1
        while by[tree, node].feature >= 0:
            n = by[tree, node]
            node = 2 * node + (0 if row[n.feature] < n.split else 1)
        return node.bit_length() - 1 + AN.mean_path(by[tree, node].size)

    got = AN.path_lengths(nodes)(x)
    assert np.allclose(got, [np.mean([walk(r, t) for t in range(7)]) for r in x])


def test_children_partition_their_parent(rows):
    nodes = {(n.tree, n.node): n for n in AN.forest(rows, trees=3, sample=100)}
    for (t, i), n in nodes.items():
        if n.feature >= 0:
            assert nodes[t, 2 * i].size + nodes[t, 2 * i + 1].size == n.size


def test_planted_outliers_score_highest(spark):
    plain = spark.range(3000).select(F.col("id").alias("client_id"), F.col("id").alias("session_id"), (0.5 + (F.col("id") % 10) / 100).alias("edge_score"),
                                     (2 + (F.col("id") % 7) / 10).alias("event_velocity_per_sec"), (60 + F.col("id") % 13).alias("session_duration_sec"),
                                     (80 + F.col("id") % 11).alias("mouse_move_events"))
    odd = spark.createDataFrame([(-1, -1, 0.01, 70.0, 0, 0), (-2, -2, None, float("nan"), None, None)], ROWS)
    out = AN.isolation_scores(plain.unionByName(odd)).collect()
    score = {r.session_id: r.isolation_score for r in out}
    assert len(out) == 3002 and set(sorted(score, key=score.get)[-2:]) == {-1, -2} and score[-1] > 0.6
    assert all(0 < s < 1 for s in score.values())


def test_forest_edges(spark):
    same = spark.createDataFrame([(1, i, 0.5, 1.0, 2, 3) for i in range(5)], ROWS)
    assert {r.isolation_score for r in AN.isolation_scores(same).collect()} == {0.5}
    assert AN.isolation_scores(same.limit(0)).count() == 0
    assert AN.isolation_scores(same.limit(1)).first().isolation_score == 1.0  # one row, an empty path


def slice_of(rows, label="raw_traffic_label"):
    c = CL.classify_sessions(rows)
    return CL.training_slice(c.withColumn(CL.LABEL, F.col(label)), "2024-01-28", 7)


def test_tree_of_a_harder_label_equals_its_sql(spark, rows, duck001):
    """The class of the rule cascade looks at all features."""
    tree = MD.fit(slice_of(rows, CL.CLASS))
    got = {tuple(r) for r in MD.score(rows, tree).collect()}
    assert got == set(duck001.execute(oracle_models.tree(4, 32, 10_000, 20, "traffic_class")).fetchall())
    assert isinstance(tree, MD.Split)


def test_tree_does_not_depend_on_order_and_learns(spark, rows):
    d = slice_of(rows)
    tree = MD.fit(d)
    assert MD.fit(d.orderBy(F.desc("session_id")).repartition(5)) == tree
    right = rows.withColumn("p", MD.predicted_label(tree)).where(F.col("p") == F.col(CL.LABEL)).count()
    assert right > 0.95 * rows.count()


def test_tree_edges(spark):
    schema = ROWS + ", label string"
    data = [(1, i, None if i % 5 == 0 else i / 100, float("nan"), 3, None, "Human" if i >= 50 else "Ad_Fraud") for i in range(100)]
    df = spark.createDataFrame(data + [(1, 200, 0.1, 1.0, 1, 1, "no such class"), (1, 201, 0.1, 1.0, 1, 1, None)], schema)
    tree = MD.fit(df, least=5)
    assert isinstance(tree, MD.Split) and tree.feature == "edge_score"
    out = MD.score(df, tree).collect()
    assert len(out) == 102 and all(abs(r.p_human + r.p_llm_scraper + r.p_ad_fraud - 1) < 1e-5 for r in out)
    none = MD.fit(df.limit(0))
    assert none == MD.Leaf((0, 0, 0)) and MD.score(df, none).where("predicted_class is not null").count() == 0
    one = MD.fit(df.where("label = 'Human'"))
    assert isinstance(one, MD.Leaf) and {r.predicted_class for r in MD.score(df, one).collect()} == {"Human"}


def test_scoring_with_the_tree_is_native_and_local(rows):
    plan = MD.score(rows, MD.fit(slice_of(rows)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "hashpartitioning(session_id" not in plan


# ---------------------------------------------------------------- seeding
def test_seeds_do_not_depend_on_order_and_count_all_rows(rows):
    want = [tuple(r) for r in CL.kmeans_seeds(rows).collect()]
    assert [tuple(r) for r in CL.kmeans_seeds(rows.orderBy(F.desc("session_id")).repartition(6)).collect()] == want
    assert len(want) <= 1 + 3 * 6 and sum(r[5] for r in want) == rows.count()
    assert sorted(r[6] for r in want if r[6] is not None) == [0, 1, 2]


def test_seeds_find_planted_groups(spark):
    groups = [(0.9, 1.0, 100, 200), (0.5, 20.0, 50, 100), (0.1, 60.0, 1, 0)]
    data = [(g, 1000 * g + i, s + (i % 7) / 1000, v + (i % 5) / 100, d + i % 3, m + i % 3) for g, (s, v, d, m) in enumerate(groups) for i in range(200 if g else 2000)]
    df = spark.createDataFrame(data, ROWS)
    out = CL.kmeans_seeded(df, k=3).collect()
    assert len(out) == 2400 and len({(r.client_id, r.cluster) for r in out}) == 3 == len({r.cluster for r in out})


def test_seed_edges(spark):
    same = spark.createDataFrame([(1, i, 0.5, 1.0, 2, 3) for i in range(5)] + [(1, 9, None, 1.0, 2, 3)], ROWS)
    assert [(r.candidate, r.weight, r.seed) for r in CL.kmeans_seeds(same).collect()] == [(0, 5, 0)]
    assert {r.cluster for r in CL.kmeans_seeded(same).collect()} == {0}
    assert CL.kmeans_seeds(same.limit(0)).count() == 0 and CL.kmeans_seeded(same.limit(0)).count() == 0


# ---------------------------------------------------------------- medians and samples
def test_medians_of_skewed_tied_and_odd_values(spark):
    import statistics

    n = 30_000
    cols = {
        "ties": F.when(F.col("id") < n // 2, 0.0).otherwise(1.0), "ties2": F.when(F.col("id") <= n // 2, 0.0).otherwise(1.0),
        "wide": F.pow(F.lit(10.0), (F.col("id") % 600) - 300), "minus": -F.col("id").cast("double") * 3, "one": F.when(F.col("id") == 17, 4.5),
        "nan": F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 1000), "none": F.lit(None).cast("double"),
        "gap": F.when(F.col("id") % 2 == 0, F.col("id") * 1e-9).otherwise(1e6 + F.col("id")), "inf": F.when(F.col("id") % 3 > 0, float("inf")).otherwise(1.0),
    }
    df = spark.range(n).select("id", *[c.alias(k) for k, c in cols.items()]).cache()
    pdf = df.toPandas()
    for small in (4096, 20):  # 20: several passes
        got = CL.exact_medians(df, {k: F.col(k) for k in cols}, small)
        for k in cols:
            v = [x for x in pdf[k] if x is not None and x == x]
            assert got[k] == (statistics.median(v) if v else None), (k, small)
    assert CL.exact_medians(df.limit(0), {"ties": F.col("ties")}) == {"ties": None}


def test_nth_hash_and_samples(spark):
    from trafficlens.operators import sessionize as S

    df = spark.range(20_000).select(F.col("id").cast("string").alias("client_id"), (F.col("id") % 7).alias("session_id"))
    df = df.unionByName(df.where("client_id < '2'"))  # some keys twice
    want = df.orderBy(F.md5(F.concat_ws("|", F.lit("s"), "client_id", F.col("session_id").cast("string"))), "client_id", "session_id")
    total = df.count()
    for n in (0, 1, 3000, 3001, 12_000, total - 1, total, total + 5):
        got = S.sample_sessions(df, n, "s", top_rows=-1)
        first = want.limit(n)
        assert got.count() == min(n, total) and got.exceptAll(first).count() == 0, n
    plan = S.sample_sessions(spark.range(20_000).select(F.col("id").alias("client_id"), F.col("id").alias("session_id")), 5000, top_rows=0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in text and "TakeOrdered" not in text and "Exchange" not in text  # a filter, nothing meets


# ---------------------------------------------------------------- user map
def test_user_map_against_all_pairs(spark):
    import random

    from trafficlens.operators.user_map import with_channel_of_table

    random.seed(4)
    word = lambda n: "".join(random.choice("abcAB é/") for _ in range(n))
    keys = [(word(random.randint(1, 6)), f"n{i}", random.randint(0, 5)) for i in range(60)] + [(None, "null", -1), ("zzz", "absent", -2)]
    sources = [word(random.randint(0, 14)) for _ in range(300)] + [None] * 5
    df = spark.createDataFrame([(s, i) for i, s in enumerate(sources)], "source_medium string, i int")
    for extra in ([], [("", "every", 3)]):
        table = spark.createDataFrame(keys + extra, "key string, name string, priority int")
        got = {r.i: r.channel for r in with_channel_of_table(df, table).collect()}
        for i, s in enumerate(sources):
            hits = [] if s is None else sorted((p, k.lower(), n) for k, n, p in keys + extra if k is not None and k.lower() in s.lower())
            assert got[i] == (hits[0][2] if hits else "Other"), (s, hits[:3])
    assert with_channel_of_table(df, table.limit(0)).where("channel <> 'Other'").count() == 0


def test_user_map_plan_has_no_nested_loop(spark):
    from trafficlens.operators.user_map import with_channel_of_table

    keys = spark.range(1000).select(F.concat(F.lit("key"), "id").alias("key"), F.lit("n").alias("name"), F.col("id").alias("priority"))
    df = spark.range(1000).select(F.concat(F.lit("a key"), "id").alias("source_medium"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = with_channel_of_table(df, keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan

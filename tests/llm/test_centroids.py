import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trafficlens.llm import centroids as C
from trafficlens.llm import queries

SCHEMA = "vec_id long, embedding array<float>, cluster int, v string, distance double, n int"


def slow(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centres = [v for _, v in first]
    if not centres:
        return []

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[0]].append(v)
        centres = [[sum(x) // len(x) for x in zip(*vs)] if vs else c for vs, c in zip(own, centres)]
    out = [(i, *nearest(v)) for i, v in kept]
    by = {}
    for _, c, d in out:
        by[c] = by.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, by[c], sum(by.values()), sha[c]) for i, c, d in out), key=str)


def fast(df, k, rounds, dims):
    return sorted(map(tuple, C.digest(df, k, rounds, dims).collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, NaN, infinities, other lengths, equal vectors, repeated ids, an id that is null, clashing names."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 4)]) for i in range(120)]
    rows += [(200 + i, [0.25, -0.5, 0.125, 0.0]) for i in range(40)] + [rows[5], rows[5], (7, [9.0, 9.0, -9.0, 9.0])]
    rows += [(300, None), (301, [1.0, 2.0, 3.0]), (302, [1.0, None, 2.0, 3.0]), (303, [float("nan"), 0.0, 0.0, 0.0]),
             (304, [float("inf"), 0.0, 0.0, 0.0]), (305, []), (None, [0.1, 0.2, 0.3, 0.4]), (306, [0.1, 0.2, 0.3, 0.4, 0.5])]
    return spark.createDataFrame([(i, v, 3, "x", 1.0, 2) for i, v in rows], SCHEMA).repartition(3)


def test_against_brute_force(spark, odd):
    rows = [(r.vec_id, r.embedding) for r in odd.collect()]
    for k, rounds in ((8, 5), (1, 2), (500, 1), (6, 0)):
        assert fast(odd, k, rounds, 4) == slow(rows, k, rounds, 4)
    assert fast(odd, 8, 5, 3) == slow(rows, 8, 5, 3) and fast(odd, 8, 5, 99) == []
    assert fast(odd.limit(0), 8, 5, 4) == [] and fast(odd.where("vec_id is null"), 8, 5, 4) == []


def test_partitions_and_chunks_change_nothing(spark, odd):
    want = fast(odd, 8, 5, 4)
    assert fast(odd.repartition(17), 8, 5, 4) == want
    for chunk in (1, 7, 100_000):
        rows, centres = C.clustered(odd, 8, 5, 4, chunk)
        got = rows.join(centres, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_dictionaries_lose_nothing_and_grow_where_vectors_repeat():
    rng = np.random.default_rng(1)
    for q in (rng.integers(-9, 9, (300, 8)), np.repeat(rng.integers(-9, 9, (5, 8)), 60, axis=0), rng.integers(0, 1, (9, 3))):
        blocks = C.dictionaries(q)
        assert np.array_equal(np.concatenate([e[c] for e, c in blocks], axis=1), q)
        for e, _ in blocks:
            assert len(np.unique(e, axis=0)) == len(e)  # distinct subvectors
        centres = rng.integers(-9, 9, (4, q.shape[1]))
        d = C.distances(blocks, centres)
        assert np.array_equal(d, ((q[:, None, :] - centres[None]) ** 2).sum(axis=2))
        near = d.argmin(axis=1)
        assert np.array_equal(C.sums(blocks, near, 4), np.array([q[near == j].sum(axis=0) for j in range(4)]))
    widths = [e.shape[1] for e, _ in C.dictionaries(np.repeat(rng.integers(-9, 9, (5, 8)), 60, axis=0))]
    assert widths == [8]


def test_floor_of_negative_sums_and_large_components(spark):
    df = spark.createDataFrame([(1, [-0.01, -0.5]), (2, [-0.02, -0.5]), (3, [-0.03, -0.5])], "vec_id long, embedding array<float>")
    assert fast(df, 1, 3, 2) == slow([(r.vec_id, r.embedding) for r in df.collect()], 1, 3, 2)
    big = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="after scaling"):
        C.digest(big, 1, 1, 2).collect()


def test_query_columns(spark):
    out = queries.op12_centroids(spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    ids = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where(F.size("embedding") == 64).select("vec_id")
    assert sorted(r.vec_id for r in out.collect()) == sorted(r.vec_id for r in ids.collect())

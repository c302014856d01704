import re

import numpy as np
import pytest
import xxhash

from trafficlens.llm import simhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, fps, most=4):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(range(len(ids)), key=lambda i: ids[i])
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = sorted((find(i), find(j)), key=lambda k: ids[k])
                root[b] = a
    return [ids[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("tile", [1024, 3])
def test_documents_against_brute_force(spark, docs, tile, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", tile)
    rows = simhash.near_duplicates(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(text)
    fps = [slow_fingerprint(text[r.doc_id]) for r in rows]
    assert [r.fp & (1 << 64) - 1 for r in rows] == fps
    assert [r.component_id for r in rows] == groups([r.doc_id for r in rows], fps)


def crowd():
    """A crowded group of near fingerprints, a long chain, and unlike ones."""
    rng = np.random.default_rng(3)
    base = int(rng.integers(1, 1 << 62))
    fps = {base ^ sum(1 << int(b) for b in rng.choice(64, size=rng.integers(0, 5), replace=False)) for _ in range(150)}
    at = 0x0F0F
    for i in range(60):
        at ^= 0b1111 << (i % 60)
        fps.add(at)
    return [simhash.signed(f) for f in sorted(fps | {int(x) for x in rng.integers(0, 1 << 62, 100)})]


@pytest.mark.parametrize("tile,blocks", [(1024, None), (16, 5), (16, 6), (1024, 8)])
def test_dense_cluster_and_chain(spark, tile, blocks, monkeypatch):
    """Tiles and the number of blocks change the work, not the components."""
    monkeypatch.setattr(simhash, "TILE", tile)
    fps = crowd()
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    label = {r.node: r.label for r in simhash.components(simhash.links(df, blocks=blocks)).collect()}
    assert [label.get(s, s) for s in fps] == groups(fps, fps)


def test_blocks_must_exceed_the_distance(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4, 4)


def table_of(spark, fps):
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.fp: r[1:] for r in rows.select("fp", *simhash.pivot_table(rows.fp)).collect()}
    return simhash.distances(list(np.array([got[f] for f in fps], np.int64).T)).astype(int)


def test_pivot_distances_discard_most_pairs_and_no_link(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, size=4, replace=False)) for _ in x], np.uint64)
    fps = np.concatenate([x, x ^ flips])
    table = table_of(spark, fps.view(np.int64).tolist())
    assert table.tolist() == np.bitwise_count(fps[:, None] ^ simhash.pivots()[None, :]).tolist()
    rows = np.arange(len(x))
    assert not simhash.discarded(table, rows, rows + len(x), 4).any()
    i, j = (a.ravel() for a in np.meshgrid(rows, rows + len(x)))
    apart = np.bitwise_count(fps[i] ^ fps[j]) > 4
    assert simhash.discarded(table, i, j, 4)[apart].mean() > 0.99


@pytest.mark.parametrize("blocks", [5, 6, 9])
def test_rows_within_the_distance_share_a_key(blocks):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    y = x ^ np.array([sum(1 << int(b) for b in rng.choice(64, size=4, replace=False)) for _ in x], np.uint64)
    assert np.any([(x & np.uint64(m)) == (y & np.uint64(m)) for m in simhash.key_masks(blocks, 4)], axis=0).all()


@pytest.mark.parametrize("n", [4_000, 16_000, 64_000, 200_000, 400_000, 800_000])
def test_candidates_stay_under_the_keys_of_a_row(n):
    """Pairs under equal keys, before any is discarded, of random fingerprints."""
    fps = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    masks = simhash.key_masks(simhash.blocks_for(n, 4), 4)
    pairs = 0
    for m in masks:
        size = np.unique(fps & np.uint64(m), return_counts=True)[1]
        pairs += int((size * (size - 1) // 2).sum())
    assert pairs <= n * len(masks) * 0.6
    assert simhash.blocks_for(10 * n, 4) >= simhash.blocks_for(n, 4)


def test_connected_rows_are_not_compared_again(monkeypatch):
    """A crowded unit of near fingerprints costs a few comparisons a row."""
    base = 0x0123456789ABCDEF
    fps = np.array([base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)], np.uint64)
    table = np.bitwise_count(fps[:, None] ^ simhash.pivots()[None, :]).astype(np.int8)
    order = np.lexsort((fps, table[:, 0]))
    fps, table, asked = fps[order], table[order], []
    whole = simhash.discarded
    monkeypatch.setattr(simhash, "discarded", lambda t, i, j, m: asked.append(len(i)) or whole(t, i, j, m))
    zero = np.zeros(len(fps), int)
    assert len(simhash.unit_links(zero, table, fps, zero, 4)) == len(fps) - 1
    assert sum(asked) < 4 * len(fps)


def test_edges(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    zero = {r.doc_id: r.component_id for r in rows if r.fp == 0}
    assert zero == {1: 1, 2: 1, 7: 1}
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({r.component_id for r in rows if r.component_id is not None})
    assert simhash.deduplicate(no_docs).count() == 0


def test_rows_without_or_with_reused_ids_stay_by_component(spark):
    """Unlike texts of rows with a null or reused doc_id all stay, copies go."""
    def text(tag):
        return " ".join(f"{tag}{i * 7919 % 101}" for i in range(60))

    rows = [(None, text("a")), (None, text("b")), (None, text("a")), (1, text("c")), (1, text("d")), (1, text("d")),
            (None, text("c")), (2, text("d")), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in simhash.deduplicate(df).collect()), key=str)
    assert [k for k in kept if k[1]] == sorted([(None, text("a")), (None, text("b")), (1, text("c")), (1, text("d"))], key=str)
    assert len([k for k in kept if not k[1]]) == 1

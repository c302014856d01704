import itertools
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

from pyspark.sql import functions as F

from trafficlens.llm import packing, rules, shards
from trafficlens.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_rule_counts_against_brute_force(docs, edge_docs, no_docs):
    for df in (docs.select("doc_id", "lang", "source", "text"), edge_docs):
        want = sorted((str(r.doc_id), *slow_counts(r.text)) for r in df.collect())
        got = rules.counted(df).collect()
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    out = rules.judged(edge_docs).collect()
    assert len(out) == edge_docs.count() and not any(r.kept for r in out if r.doc_id in (1, 2, 6, 7, 8))
    assert rules.judged(no_docs).count() == 0


def test_rules_keep_clean_and_drop_junk(docs, labels):
    kept = {r.doc_id: r.kept for r in rules.judged(docs).where("not base_failed").collect()}
    good = [kept[r.doc_id] for r in labels.where("quality = 1").collect() if r.doc_id in kept]
    bad = [kept[r.doc_id] for r in labels.where("quality = 0").collect() if r.doc_id in kept]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_sketches_merge_and_bound_quantiles(spark):
    random.seed(2)
    values = [random.randint(0, 50_000) for _ in range(3000)]
    df = spark.createDataFrame([("x", "y", "m", v) for v in values], "lang string, source string, metric string, v long")
    from pyspark.sql import functions as F

    sketch = df.groupBy("lang", "source", "metric", F.expr(rules.bin_of("v")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    halves = sketch.unionByName(sketch)
    q, twice = (rules.quartiles(s, ["lang"], "g").first() for s in (sketch, halves))
    exact = sorted(values)[len(values) * 3 // 4 - 1]
    assert 0 <= exact - q.g_q3 <= exact / 64 and (q.g_q1, q.g_q3) == (twice.g_q1, twice.g_q3)


def test_bounds_have_least_padding():
    random.seed(1)
    for _ in range(300):
        tops = sorted(random.sample(range(1, 40), random.randint(1, 9)))
        cells = [(t, random.randint(1, 5), 0) for t in tops]
        most = random.randint(1, 4)

        def cost(bounds, cells=cells):
            return sum(n * (min(b for b in bounds if b >= t) - t) for t, n, _ in cells)

        best = min(cost([*c, tops[-1]]) for k in range(most) for c in itertools.combinations(tops[:-1], min(k, len(tops) - 1)))
        got = packing.best_bounds(cells, most)
        assert cost(got) == best and len(got) <= most
    assert packing.best_bounds([], 3) == []


def test_packing_rows(docs, edge_docs, no_docs):
    for df, budget in ((docs, 4096), (edge_docs, 50)):
        rows = packing.packed(df, 4, budget).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted((str(r.doc_id), len(WORD.findall(r.text or "")) + 1) for r in df.collect())
        batches, places, bounds = defaultdict(list), defaultdict(list), set()
        for r in rows:
            assert r.n_tokens <= r.bound and r.padding == r.bound - r.n_tokens
            batches[r.bucket, r.batch].append(r)
            places[r.bucket].append(r.place)
            bounds.add(r.bound)
        assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(bounds) <= 4
        assert all(len(b) == 1 or len(b) * b[0].bound <= budget for b in batches.values())
    assert packing.packed(no_docs).count() == 0


def test_long_lengths_share_cells(spark):
    lengths = spark.createDataFrame([(n,) for n in [*range(1, 10_000, 7), 1_000_000, 1_000_001]], "x long")
    cells = packing.histogram(lengths, "x")
    assert sum(c[1] for c in cells) == lengths.count() and cells[-1][0] == 1_000_001 and cells[-1][1] == 2
    assert [c for c in cells if c[0] <= packing.EXACT] == [(n, 1, n) for n in range(1, packing.EXACT + 1, 7)]


def test_shards_are_even_and_gapless(spark, docs, edge_docs, no_docs):
    for df in (docs, edge_docs):
        rows = shards.sharded(df, scratch_path(spark, "map"), 16).collect()
        want = sorted((str(r.doc_id), len((r.text or "").encode()) + 1, crc32((r.text or "").encode())) for r in df.collect())
        assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
        at, held = defaultdict(list), defaultdict(int)
        for r in rows:
            at[r.shard].append(r.slot)
            held[r.shard] += r["size"]
        assert all(sorted(v) == list(range(len(v))) for v in at.values())
        if df is docs:
            assert len(held) == 16 and max(held.values()) - min(held.values()) < 0.02 * sum(held.values()) / 16
    assert shards.sharded(no_docs, scratch_path(spark, "map")).count() == 0


def test_map_versions_and_rebalancing(spark):
    random.seed(4)
    sizes = {v: random.randint(500, 1500) for v in range(1000)}
    first = shards.first_map(sizes, 8, 1000)
    grown = {v: n * (3 if first[v] == 2 else 1) for v, n in sizes.items()}
    edited = shards.rebalanced(first, grown, 8)
    load = lambda m, n: [sum(grown[v] for v in range(1000) if m[v] == s) for s in range(n)]
    assert max(load(edited, 8)) <= 1.02 * sum(grown.values()) / 8
    moved = [v for v in range(1000) if first[v] != edited[v]]
    assert moved and all(first[v] == 2 for v in moved)
    more, fewer = shards.rebalanced(first, grown, 9), shards.rebalanced(first, grown, 7)
    assert max(load(more, 9)) <= 1.05 * sum(grown.values()) / 9 and max(fewer) == 6
    path = scratch_path(spark, "versions")
    shards.save_map(spark, path, 1, first)
    shards.save_map(spark, path, 2, edited)
    read = {r.vslot: r.shard for r in shards.load_map(spark, path, 1).collect()}
    assert [read[v] for v in range(1000)] == first


def test_the_query_edits_its_map(spark, docs):
    """Version 1 deals slots evenly, version 2 evens the bytes; what comes later
    edits the last version, and moves few slots."""
    path = scratch_path(spark, "edited")
    sizes = lambda rows: [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    rows = shards.sharded(docs, path, 8).collect()
    load = lambda v: {r.vslot: r.shard for r in shards.load_map(spark, path, v).collect()}
    assert shards.last_version(spark, path) == 2
    assert set(Counter(load(1).values()).values()) == {shards.SLOTS // 8}
    assert all(load(2)[r.vslot] == r.shard for r in rows)
    assert max(sizes(rows)) - min(sizes(rows)) <= 0.01 * sum(sizes(rows)) / 8
    # nothing new: no version; a longer corpus: the next one
    again = shards.sharded(docs, path, 8).collect()
    assert shards.last_version(spark, path) == 2 and sorted(map(str, again)) == sorted(map(str, rows))
    more = docs.unionByName(docs.where("doc_id % 3 = 0"))
    grown = shards.sharded(more, path, 8).collect()
    assert shards.last_version(spark, path) == 3 and len(grown) == more.count()
    assert max(sizes(grown)) - min(sizes(grown)) <= 0.01 * sum(sizes(grown)) / 8
    used = {r.vslot for r in grown}
    assert sum(load(2)[v] != load(3)[v] for v in used) < len(used) / 4


def test_many_null_ids_and_several_cells(spark, docs, monkeypatch):
    """Rows without a doc_id are spread by their text; numbers stay gapless when a
    slot has several cells."""
    monkeypatch.setattr(shards, "CELL_ROWS", 1)
    half = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    rows = shards.sharded(half, scratch_path(spark, "half"), 4, 16).collect()
    assert len(rows) == half.count()
    assert len({r.vslot for r in rows if r.doc_id is None}) == 16
    at = defaultdict(list)
    for r in rows:
        at[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in at.values())


def test_windows_are_equal_only_by_their_whole_hash(spark):
    """Two windows whose 64-bit hashes share their first 40 bits."""
    text = "alpha beta 926757 p alpha beta 2899250 q one two three r one two three"
    df = spark.createDataFrame([(1, "en", "a", text)], "doc_id long, lang string, source string, text string")
    assert rules.counted(df).first().n_repeat_words == slow_counts(text)[4] == 6

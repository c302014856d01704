import re

from trafficlens.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(docs, items, window):
    found = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOW))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    lengths = {len(k) for k in found}
    out = []
    for doc, text in docs:
        w = WORD.findall((text or "").translate(LOW))
        hit, own = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                got = found.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    own |= got
        out.append((doc, len(w), len(hit), tuple(sorted(own))))
    return sorted(out, key=str)


def actual(docs, items, window=10):
    from pyspark.sql import functions as F

    o = decontam.find_overlaps(docs, items, window)
    rows = o.select("doc_id", "n_words", F.coalesce(decontam.covered(F.col("spans")), F.lit(0)).alias("n"), "items").collect()
    return sorted([(r.doc_id, r.n_words, r.n, tuple(sorted(r.items))) for r in rows], key=str)


def test_all_documents_against_brute_force(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()], 10)
    assert actual(docs, items) == want
    assert any(x[2] for x in want)


def test_short_items_ties_and_letters(spark):
    """Items shorter than the window, one word, none; equal items; É is not é."""
    items = spark.createDataFrame([(1, "alpha"), (2, "Beta gamma, delta"), (3, None), (4, "--"), (5, "ALPHA"),
                                   (6, "one two three four five six seven eight nine ten eleven twelve"), (7, "École du soir"),
                                   (8, "x x x x x x x x x x x x")], "item_id long, text string")
    text = "zero one two three four five six seven eight nine ten eleven nope"
    docs = spark.createDataFrame([(1, "alpha beta gamma delta alpha"), (2, text), (3, text[5:] + " " + text), (4, "école du soir"),
                                  (5, "École DU soir x"), (6, None), (7, ""), (8, "x " * 40), (8, "x " * 40), (9, "x " * 11 + "y")],
                                 "doc_id long, text string")
    want = expected([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], 10)
    assert actual(docs, items) == want
    for window in (3, 7):
        assert actual(docs, items, window) == expected([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()], window)


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "cat sat on a mat and looked at the moon while")], "item_id long, text string")
    got = decontam.contamination(edge_docs, items).collect()
    assert len(got) == edge_docs.count()
    assert {r.doc_id for r in got if r.contaminated} == {4, 5}
    assert decontam.contamination(no_docs, items).count() == 0
    none = decontam.contamination(edge_docs, items.limit(0)).collect()
    assert len(none) == edge_docs.count() and not any(r.contaminated for r in none)
    kept = decontam.clean(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "6", "7", "8", "None"]


def test_same_without_broadcast(spark, docs, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    some = docs.where("doc_id < 200")
    want = actual(some, items)
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontam, "BROADCAST_NUMBERS", 0)
    assert actual(some, items) == want


def test_native_plan(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    plan = decontam.contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow(?!ToRow)|Cartesian|NestedLoop", plan)


def test_clean_rows_stay_beside_leaks_of_the_same_id(spark):
    leak = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    rows = [(None, leak), (None, "nothing of the kind"), (1, "x " + leak), (1, "a clean text"), (None, None), (2, leak), (2, leak)]
    kept = decontam.clean(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted([tuple(r) for r in kept], key=str) == sorted([(None, "nothing of the kind"), (1, "a clean text"), (None, None)], key=str)

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from trafficlens.llm import records
from trafficlens.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(spark, df):
    path = scratch_path(spark, "records")
    index = records.written_and_indexed(df, path, PATH)
    rows = index.orderBy("start", "n_tokens").collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = {}
    for r in df.collect():
        ids.setdefault(r.doc_id, []).append(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2])
    keys = [r.doc_id for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(rows) == df.count()
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
        crcs = [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[r.doc_id]]
        assert (r.n_tokens, r.ids_crc32) in crcs
    return path, index, ids


def test_round_trip(spark, docs):
    _, index, ids = check(spark, docs.select("doc_id", "text"))
    order = [r.doc_id for r in records.shuffled(index, 7).collect()]
    assert order != sorted(order) and order == [r.doc_id for r in records.shuffled(index, 7).collect()]
    for r in records.shuffled(index, 7).limit(20).collect():
        with open(r.file.removeprefix("file:"), "rb") as f:
            data = f.read()
        doc, got, after = records.record_at(data, r.offset)
        assert doc == r.doc_id and got.tolist() in ids[doc] and after == r.offset + r.length


def test_spaces_and_edges(spark, edge_docs, no_docs):
    odd = ["  a\n\n b  c   d\x1c e ", " x", "x ", "\n", "a \nb \t c", "it's 12 o'clock  -- don't", "é è   ü", "a\x85b \x85 c", "a\nb c\n\nd e\nf. G\n", "\nx y", "a\tb c\t\nd", "one.\nTwo\u2003three four\n\u2003five",
           "a\x1c\nb c", "x\r\ny z", "\n", "\x1c", "q \x1cr s", "a, b. c", "1.5, 2.x", "it's. so, we'll.",
           "a .b ,c", "x###. y", "x., y", "a.b.c ...", "é. \u00d7. ½, ²,", ", a", ".\nA,\nB.", "a_, b", "...", "e.g., this"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    check(spark, df)
    check(spark, edge_docs.select("doc_id", "text"))
    assert records.written_and_indexed(no_docs, scratch_path(spark, "records"), PATH).count() == 0


def test_damage_is_found():
    data = bytearray(b"".join(records.frame(i, bytes([i, 0])) + b"\n" for i in range(3)))
    at, seen = 0, []
    while at < len(data):
        doc, ids, at = records.record_at(data, at)
        seen.append((doc, ids.tolist()))
    assert seen == [(0, [0]), (1, [1]), (2, [2])]
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            at = 0
            while at < len(bad):
                _, _, at = records.record_at(bytes(bad), at)


def test_full_cache_changes_nothing():
    texts = ["one two three two", "four  five six", None, "seven"]
    a, b = records.Encoder(PATH, 2), records.Encoder(PATH, 2, most=2)
    assert a.encode(texts) == b.encode(texts) == b.encode(texts)


def test_chunks_against_whole_texts():
    """Random texts of awkward pieces give the ids of the plain tokenizer."""
    import random

    random.seed(5)
    pieces = ["a", "B", "é", "1", "²", ".", ",", "'", "s", " ", " ", " ", "\n", "\t", "#", "_", "word", "Ünd", "the", "  ", "-", "×", "中", "\xa0"]
    texts = ["".join(random.choice(pieces) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    tokenizer, encoder = Tokenizer.from_file(PATH), records.Encoder(PATH, 2)
    want = [np.array(e.ids + [2], "<u2").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


def test_files_follow_the_bytes_of_the_texts(spark, docs, monkeypatch):
    df = docs.select("doc_id", "text").limit(300)
    size = sum(len((r.text or "").encode()) for r in df.collect())
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(records, "FILE_TEXT", size // (5 * usual))
    _, index, _ = check(spark, df)
    files = [r["count"] for r in index.groupBy("file").count().collect()]
    assert len(files) > 3 * usual and sum(files) == df.count()

"""Exact duplicates by two passes over a Bloom filter, in native Spark
expressions only.

A text's key is its SHA-256 (UTF-8, null as empty); equal keys are equal texts.
The filter is a table of 64-bit words, one for ``WORD_ROWS`` rows of input; a
key sets ``BITS`` bits of one word. The first pass counts how many rows set each bit
and keeps the bits set at least twice. In the second pass a row whose bits were
not all set twice is the only one with its text and passes straight through;
the others (all copies, and a few per cent of the rest by chance) are grouped by
their whole key, so chance hits cost time and no correctness.

The filter is broadcast up to ``broadcast_words`` words of 16 bytes; a larger one is joined by
word on the narrow keys. Texts are read for their hash only and never shuffled by
``duplicates``. A text that a large share of the rows has (and its filter word) is
never brought into one task, see ``join_groups``.

Of equal texts the row with the largest doc_id stays, null being smallest; of
rows equal in that too exactly one stays, any of them. Null and empty texts are the
same text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import join_groups, stored

WORD_ROWS = 4
BITS = 2
BROADCAST_WORDS = 1 << 20


def text_key(text: str = "text") -> Column:
    """The 32 bytes that stand for a text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def hashed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, sha, rid: a number per row, fixed once the result is stored."""
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("sha"), F.monotonically_increasing_id().alias("rid"))


def n_words(total: int) -> int:
    """Words of a filter for ``total`` rows."""
    return max(1, -(-total // WORD_ROWS))


def word_of(sha: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(words))


def bits_of(sha: Column) -> list[Column]:
    """The bits of its word that a key sets (two of them can coincide)."""
    h = F.xxhash64(F.lit("bits"), sha)
    return [F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]


def one_bit(bit: str) -> Column:
    return F.expr(f"shiftleft(1L, {bit})")


def bloom(rows: DataFrame, words: int) -> DataFrame:
    """First pass: word, twice (the bits that at least two rows set), n (at
    least the number of rows that set one of them)."""
    set_bits = rows.select(word_of(F.col("sha"), words).alias("word"), F.explode(F.array_distinct(F.array(*bits_of(F.col("sha"))))).alias("bit"))
    counts = set_bits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2)
    return counts.groupBy("word").agg(F.bit_or(one_bit("bit")).alias("twice"), F.sum("n").alias("n"))


def flagged(rows: DataFrame, filter_: DataFrame, words: int, total: int, maybe: str, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Second pass: ``rows``, which have ``sha``, with a boolean ``maybe``: false
    only where no other row has the key."""
    kept = rows.columns
    rows = rows.withColumn("word", word_of(F.col("sha"), words))
    if filter_.count() <= broadcast_words:
        joined = rows.join(F.broadcast(filter_.drop("n")), "word", "left")
    else:
        joined = join_groups(rows, filter_, "word", BITS * total)
    hit = F.lit(True)
    for b in bits_of(F.col("sha")):
        hit = hit & (F.getbit(F.col("twice"), b) == 1)
    return joined.select(*kept, F.coalesce(hit, F.lit(False)).alias(maybe))


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (doc_id of the row that
    stays), group_size, kept, sha."""
    rows = stored(hashed(docs, doc_id, text), "text-keys")
    total = rows.count()
    words = n_words(total)
    marked = flagged(rows, stored(bloom(rows, words), "bloom"), words, total, "maybe", broadcast_words)
    single = marked.where(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                                  F.lit(True).alias("kept"), "sha")
    maybe = stored(marked.where("maybe").drop("maybe"), "possibly-repeated")
    # a struct compares null ids as smallest; rid decides between equal ids
    top = F.max(F.struct(F.col("doc_id").alias("keep_id"), F.col("rid").alias("keep_rid"))).alias("top")
    groups = stored(maybe.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), top), "text-groups")
    repeated = join_groups(maybe, groups, "sha", total)
    return single.unionByName(repeated.select("doc_id", F.col("top.keep_id").alias("keep_id"), F.col("n").alias("group_size"),
                                              (F.col("rid") == F.col("top.keep_rid")).alias("kept"), "sha"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, whole. Only possibly repeated rows are
    shuffled, at most one per text and task (with a filter too large to
    broadcast, all rows are, by filter word). Of rows with equal text and equal doc_id any
    one stays."""
    keys = stored(docs.select(text_key(text).alias("sha")), "text-keys")
    total = keys.count()
    words = n_words(total)
    inside = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key(text).alias("sha"))
    marked = flagged(inside, stored(bloom(keys, words), "bloom"), words, total, "maybe", broadcast_words)
    one = marked.where("maybe").groupBy("sha").agg(F.max_by("row", F.struct(F.col(f"row.`{doc_id}`"))).alias("row"))
    return marked.where(~F.col("maybe")).select("row.*").unionByName(one.select("row.*"))

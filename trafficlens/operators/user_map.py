"""Channels by a user's own map of substrings, without a non-equi join.

A source belongs to the first key, by priority and then key, that it contains.
Testing every key against every source is a nested-loop join. Instead each key
is filed under one of its trigrams, the one that the fewest sources have, and each
source looks up its own trigrams: an equality join, whose pairs are then verified.
Keys of one or two letters are filed under themselves and found by the sources'
letters and letter pairs. The search runs on the distinct sources only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

GRAM = 3


def _grams(text: str, size: int) -> Column:
    """The runs of ``size`` characters of a text; none if it is shorter."""
    n = F.char_length(text) - (size - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(F.col(text), i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def filed(keys: DataFrame, source_grams: DataFrame) -> DataFrame:
    """``keys`` (key, name, priority) with ``gram``: of the grams of the key, as long as it
    allows, the one that the fewest sources have. Keys with a gram that no source has match nothing and
    go; so do empty keys, which have no gram."""
    size = F.least(F.char_length("key"), F.lit(GRAM))
    own = keys.where(F.char_length("key") > 0).select("key", "name", "priority", F.explode(F.array_distinct(
        F.when(size == 1, _grams("key", 1)).when(size == 2, _grams("key", 2)).otherwise(_grams("key", GRAM)))).alias("gram"))
    often = source_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    best = own.join(often, "gram", "left").groupBy("key", "name", "priority").agg(
        F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram")).alias("b"))
    return best.where(F.col("b.often") > 0).select("key", "name", "priority", F.col("b.gram").alias("gram"))


def channels_of_sources(sources: DataFrame, mapping: DataFrame) -> DataFrame:
    """source, channel of the distinct lower-cased ``sources`` (column ``source``) that
    contain a key of ``mapping`` (``key``, ``name``, ``priority``). Rows of the map with a
    NULL key match nothing, an empty key matches everything."""
    keys = mapping.where(F.col("key").isNotNull()).select(F.lower("key").alias("key"), "name", "priority").distinct()
    grams = sources.select("source", F.explode(F.array_distinct(F.concat(*[_grams("source", n) for n in (1, 2, GRAM)]))).alias("gram"))
    pairs = grams.join(filed(keys, grams), "gram").where(F.col("source").contains(F.col("key")))
    hits = pairs.select("source", "name", "priority", "key")
    # every source contains the empty key: one row at most
    every = keys.where(F.col("key") == "").agg(F.min(F.struct("priority", "name")).alias("e")).first()["e"]
    if every is not None:
        kind = dict(keys.dtypes)
        hits = hits.unionByName(sources.select("source", F.lit(every["name"]).cast(kind["name"]).alias("name"),
                                               F.lit(every["priority"]).cast(kind["priority"]).alias("priority"), F.lit("").alias("key")))
    return hits.groupBy("source").agg(F.min_by("name", F.struct("priority", "key", "name")).alias("channel"))


def with_channel_of_table(df: DataFrame, mapping: DataFrame, source_medium: str = "source_medium", out: str = "channel",
                          other: str = C.OTHER_CHANNEL) -> DataFrame:
    """``df`` with the channel by a user's map; sources without a key and NULL
    ones get ``other``. The result comes back by equality (a missing source as the
    empty text, so that such rows are no NULL keys)."""
    key = F.lower(F.coalesce(F.col(source_medium), F.lit("")))
    named = channels_of_sources(df.select(key.alias("source")).distinct(), mapping)
    j = df.withColumn("_source", key).join(named.select(F.col("source").alias("_source"), F.col("channel").alias("_channel")), "_source", "left")
    return j.select(*[F.col(c) for c in df.columns if c != out], F.when(F.col(source_medium).isNotNull() & F.col("_channel").isNotNull(), F.col("_channel"))
                    .otherwise(F.lit(other)).alias(out))

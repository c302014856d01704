"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
import uuid
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficlens.session import ensure_checkpoint_dir, scratch_path


def ship_by_value(module_name: str) -> None:
    """Send a module's functions to Python workers by value, so that executors
    need only the public libraries, not this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship_by_value(__name__)


def worker_state(name: str, key, make):
    """What ``make()`` returns, kept in this Python worker between tasks until
    another name or key is asked for, so a worker holds one state at a time.
    Functions shipped by value have fresh globals in every task; caches would
    start empty without this."""
    place = sys.modules.setdefault("trafficlens_worker_state", types.ModuleType("trafficlens_worker_state"))
    held = getattr(place, "held", None)
    if held is None or held[0] != (name, key):
        place.held = None
        held = place.held = ((name, key), make())
    return held[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def crc_remainder(col: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null stays null."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(modulus)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that where all characters are
    ASCII, and is much faster than ``translate``."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps
    reuse the rows, and a lost executor cannot take them away. The folder is
    left to the cluster's own clean-up of ``spark.checkpoint.dir``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hash_unit(*cols: Column) -> Column:
    """A repeatable pseudo-random number in [0, 1) of the values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, key: str, n: int, total: int | None = None) -> DataFrame:
    """At most ``n`` rows of a narrow table, the ones whose hashed key is
    smallest. A threshold drops most rows first, so the final ordering sees
    about ``2 n`` rows whatever the size of the table."""
    total = df.count() if total is None else total
    u = hash_unit(F.lit("sample"), F.col(key).cast("string"))
    if total > 2 * n:
        df = df.where(u < F.lit(min(1.0, 2.0 * n / total)))
    return df.orderBy(u, F.col(key)).limit(n)


def within_bytes(sample: DataFrame, group: list[str], order: Column, text: str, most: int) -> DataFrame:
    """The rows of a bounded sample that the driver may hold: of each group, taken
    in ``order``, texts of up to ``most`` bytes in all (of equal places in the order
    the smallest text first). Rows with null texts stay."""
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0))
    upto = fresh(sample, "upto")
    w = Window.partitionBy(*group).orderBy(order, size).rowsBetween(Window.unboundedPreceding, 0)
    # a text over the bound by itself does not use it up
    fits = size <= most
    return sample.withColumn(upto, F.sum(F.when(fits, size)).over(w)).where(fits & (F.coalesce(upto, F.lit(0)) <= most)).drop(upto)


def gapless_rank(df: DataFrame, group: list[str], order: list[str], out: str, cells: int = 256) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without bringing a group into
    one task. Rows are dealt by a hash of ``order`` into ``cells`` cells of the
    group; a row's number is the count of rows in earlier cells of its group
    plus its place in its own cell. Only the (group, cell) counts meet in one
    window. Equal rows are numbered one after the other."""
    cell, start, place = (fresh(df, n) for n in ("cell", "cell_start", "cell_place"))
    dealt = df.withColumn(cell, F.pmod(F.xxhash64(F.lit(out), *[F.col(c).cast("string") for c in order]), F.lit(cells)))
    counts = dealt.groupBy(*group, cell).agg(F.count(F.lit(1)).alias(start))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, cell, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    placed = dealt.withColumn(place, F.row_number().over(Window.partitionBy(*group, cell).orderBy(*order)) - 1)
    a, b = placed.alias("a"), starts.alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group, cell]])
    kept = [F.col(f"a.`{c}`") for c in df.columns]
    return a.join(b, same, "left").select(*kept, (F.col(f"b.{start}") + F.col(f"a.{place}")).cast("long").alias(out))


# groups with over 1/HOT_SHARE of all rows are hot: fewer than HOT_SHARE exist
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``groups`` (one row per ``key``, whose column
    ``n`` counts the key's rows among at most ``total`` in all), without bringing
    a hot key's rows into one task. Groups of over ``total / HOT_SHARE`` rows are
    fewer than HOT_SHARE, so those are broadcast and their rows stay where they
    are; the other rows are shuffled by key, at most that share to a key. Keys
    are not null. Column ``n`` is kept."""
    limit = F.lit(total // HOT_SHARE)
    hot, cold = groups.where(F.col("n") > limit), groups.where(F.col("n") <= limit)
    stay = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left")
    return stay.unionByName(rest)

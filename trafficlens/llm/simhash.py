"""SimHash near-duplicates through pivot distance tables.

Fingerprints: 64-bit SimHash over word shingles (see ``fingerprints``). Equal
fingerprints are merged first, so a group of exact copies is one row.

Pivot table: for every fingerprint the Hamming distances to ``N_PIVOTS``
reference fingerprints are computed once, a byte each (``pivot_table``). Two
fingerprints at no more than ``max_distance`` differing bits differ by no more
in any of these distances (triangle inequality), so a pair whose maximum
coordinate difference is larger is discarded; survivors are verified on the
fingerprints themselves.

Which pairs are looked at: the 64 bits are cut into blocks, and two fingerprints
within the distance agree in all but ``max_distance`` of them at least. Each
choice of that many blocks is a key, and only fingerprints with an equal key
meet. The number of blocks follows the counted fingerprints (``blocks_for``), so
that a key of unlike fingerprints holds about one; the result is the same for any
number. Under a key the fingerprints are ordered by their distance to the first
pivot, and each is compared with the following ones up to ``max_distance`` away
in it. No pair within the distance is lost, and there is no cap on candidates.

Crowded keys: a key of many near fingerprints is dealt into tiles of at most
about ``TILE`` rows by a hash, and each pair of tiles is one unit of work, so it
is spread over many tasks. Fingerprints that a unit has already connected are not
compared again, and it returns only a spanning forest of its graph, never all
pairs. Components come from min-label propagation with pointer jumping over these
links; each round is written to the shared folder, and the rows of very common
labels and fingerprints are joined without a shuffle (``join_groups``).

A null or empty text has no words: fingerprint zero, linked like any other.
Repeated rows keep one result row each.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm.common import fresh, join_groups, ship_by_value, stored

ship_by_value(__name__)

SEED = 42
N_PIVOTS = 16
TILE = 1024


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text: A-Z lower-cased, words split at ASCII white space,
    all shingles (repeats count), a bit is 1 if set in over half the hashes."""
    if not text:
        return 0
    # bytes.lower and bytes.split know ASCII only, as wanted
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[n - 1:])], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """doc_id, key (hash of the text), fp (the 64 bits as a signed long), one row
    per row of ``docs``."""
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), "<u8", b.num_rows)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fps.view("<i8"))], names=["doc_id", "key", "fp"])

    own = F.col(text).cast("string")
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(own).alias("key"), own.alias("text")).mapInArrow(run, schema)


def text_key(text: Column) -> Column:
    """Tells texts apart; a null text from an empty one, too."""
    return F.xxhash64(text, text.isNull())


def pivots() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, 7) for i in range(N_PIVOTS)], dtype=np.uint64)


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def blocks_for(n: int, max_distance: int) -> int:
    """The fewest blocks of bits for which a key of ``n`` unlike fingerprints is
    expected to hold one row at most."""
    blocks = max_distance + 1
    while n > 1 << (64 * (blocks - max_distance) // blocks):
        blocks += 1
    return blocks


def key_masks(blocks: int, max_distance: int) -> list[int]:
    """The bits of every choice of ``blocks - max_distance`` blocks."""
    cuts = np.linspace(0, 64, blocks + 1).round().astype(int).tolist()
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(masks, blocks - max_distance)]


def pivot_table(fp: Column) -> list[Column]:
    """The distances to the pivots, a byte each, eight to a long; the first pivot
    of a long is in its highest byte, so a long sorts by that one first."""
    far = [F.bit_count(fp.bitwiseXOR(F.lit(signed(int(p))))).cast("long") for p in pivots()]
    packed = [reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(d, 56 - 8 * i) for i, d in enumerate(far[k:k + 8])])
              for k in range(0, N_PIVOTS, 8)]
    return [c.alias(f"far{i}") for i, c in enumerate(packed)]


def distances(packed: list[np.ndarray]) -> np.ndarray:
    """The columns of ``pivot_table`` as (rows, pivots)."""
    return np.concatenate([c.astype(">i8").view(np.uint8).reshape(-1, 8) for c in packed], axis=1).astype(np.int8)


def discarded(table: np.ndarray, i: np.ndarray, j: np.ndarray, max_distance: int) -> np.ndarray:
    """True for pairs of rows whose maximum coordinate difference says that they
    are more than ``max_distance`` apart."""
    return np.abs(table[i] - table[j]).max(axis=1, initial=0) > max_distance


def unit_links(unit: np.ndarray, table: np.ndarray, fps: np.ndarray, side: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links (row numbers) that connect what each unit of work connects. Rows are
    ordered by unit, then by the first pivot distance; rows of side 1 are
    compared with those of side 2 only, rows of side 0 with each other."""
    root, out = np.arange(len(fps)), []

    def find(i):
        while root[i] != i:
            i = root[i]
        return int(i)

    at, k = np.arange(len(fps)), 1
    while len(at):
        at = at[at + k < len(fps)]
        # what is out of reach k rows on stays so further on
        at = at[(unit[at] == unit[at + k]) & (table[at + k, 0] - table[at, 0] <= max_distance)]
        i, j = at, at + k
        open_ = (root[i] != root[j]) & ((side[i] == 0) | (side[i] != side[j]))
        i, j = i[open_], j[open_]
        left = ~discarded(table, i, j, max_distance)
        i, j = i[left], j[left]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= max_distance
        for a, b in zip(i[near].tolist(), j[near].tolist()):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((a, b))
        while near.any() and (root[root] != root).any():
            root = root[root]
        k += 1
    return out


def links(distinct: DataFrame, max_distance: int = 4, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) at no more than
    ``max_distance`` bits: every link, up to those that others already imply
    inside one unit of work, so components are those of all links. ``blocks``
    (over ``max_distance``) changes the work, not the result."""
    blocks = blocks or blocks_for(distinct.count(), max_distance)
    if blocks <= max_distance:
        raise ValueError("blocks must exceed max_distance")
    choices = F.array(*[F.struct(F.lit(c).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                        for c, m in enumerate(key_masks(blocks, max_distance))])
    table = stored(distinct.select("fp", *pivot_table(F.col("fp"))), "pivot-table")
    far = [c for c in table.columns if c != "fp"]
    keyed = table.select("fp", *far, F.explode(choices).alias("k")).select("k.choice", "k.key", "fp", *far)
    crowded = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE)
    crowded = crowded.select("choice", "key", F.ceil(F.col("n") / F.lit(TILE)).cast("int").alias("tiles"))
    # The few rows of crowded keys are paired tile by tile; others are one tile.
    k = keyed.join(stored(crowded, "crowded"), ["choice", "key"], "left")
    tile = F.when(F.col("tiles").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("fp", F.lit("tile")), F.col("tiles")).cast("int"))
    k = k.withColumn("tile", tile)
    pair = lambda lo, hi, side: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), F.lit(side).alias("side"))
    own = F.array(pair(F.col("tile"), F.col("tile"), 0))
    with_later = F.transform(F.sequence(F.col("tile"), F.col("tiles") - 1), lambda t: pair(F.col("tile"), t, 1))
    with_earlier = F.transform(F.sequence(F.lit(0), F.col("tile")), lambda t: pair(t, F.col("tile"), 2))
    units = F.when(F.col("tiles").isNull(), own).otherwise(F.concat(
        own, F.filter(with_later, lambda u: u["lo"] != u["hi"]), F.filter(with_earlier, lambda u: u["lo"] != u["hi"])))
    unit = ["choice", "key", "lo", "hi"]
    u = k.select("choice", "key", "fp", *far, F.explode_outer(units).alias("u")).select("choice", "key", "u.lo", "u.hi", "u.side", "fp", *far)
    u = u.repartition(*unit).sortWithinPartitions(*unit, *far, "fp")

    def unit_rows(batches):
        held = None
        for b in batches:
            rows = [b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(b.num_columns)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            if not len(rows[0]):
                continue
            starts = np.concatenate(([True], np.any([r[1:] != r[:-1] for r in rows[:4]], axis=0)))
            # the last unit may go on in the next batch; a unit has about 2 TILE rows
            last = int(np.flatnonzero(starts)[-1])
            held = [r[last:] for r in rows]
            yield found([r[:last] for r in rows], starts[:last])
        if held is not None:
            yield found(held, np.zeros(len(held[0]), bool))

    def found(rows, starts):
        fps = rows[5].view(np.uint64)
        got = np.array(unit_links(np.cumsum(starts), distances(rows[6:]), fps, rows[4], max_distance), np.int64).reshape(-1, 2)
        a, b = rows[5][got[:, 0]], rows[5][got[:, 1]]
        return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return u.mapInArrow(unit_rows, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node id reachable over the edges (a, b). Each
    round every node takes the smallest label around it, then the label of its
    label, so chains shrink by halves; ends when no label changes."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    total = label.count()
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = stored(label.join(near, "node").select("node", "label", F.least("label", "near").alias("new")), "step")
        used = step.groupBy("new").agg(F.count(F.lit(1)).alias("n"))
        far = stored(used.join(label.select(F.col("node").alias("new"), F.col("label").alias("far")), "new"), "far")
        step = join_groups(step, far, "new", total).select("node", "label", F.least("new", "far").alias("new"))
        step = stored(step, "jump")
        changed = step.where(F.col("new") != F.col("label")).limit(1).count()
        label = step.select("node", F.col("new").alias("label"))
        if not changed:
            return label


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id of the component), one row per
    row of ``docs``."""
    return _labelled(docs, shingle, max_distance, doc_id, text).select("doc_id", "fp", "component_id")


def _labelled(docs: DataFrame, shingle: int, max_distance: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, key, fp, label (names the component, also where no row of it has a
    doc_id), component_id."""
    fps = stored(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")), "distinct-fingerprints")
    label = components(links(distinct, max_distance))
    named = distinct.join(label, distinct.fp == label.node, "left").select("fp", "rows", "first", F.coalesce("label", "fp").alias("label"))
    named = stored(named, "named")
    smallest = stored(named.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("component_id")), "smallest")
    named = join_groups(named.drop("first"), smallest, "label", distinct.count())
    named = stored(named.select("fp", F.col("rows").alias("n"), "label", "component_id"), "components")
    return join_groups(fps, named, "fp", fps.count()).select("doc_id", "key", "fp", "label", "component_id")


def fp_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, shingle: int = 4, max_distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component: of each component
    one, the first by doc_id (nulls last), then by a hash of the text. A doc_id
    that is null or used again does not matter. All columns are kept."""
    keep, key = fresh(docs, "_keep"), fresh(docs, "_key")
    rows = _labelled(docs, shingle, max_distance, doc_id, text)
    # min of a struct, as nulls come first in it
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    first = rows.groupBy("label").agg(first).select(F.col("first.doc_id").alias(keep), F.col("first.key").alias(key))
    a, x = docs.alias("a"), first.alias("x")
    own = text_key(F.col(f"a.`{text}`").cast("string"))
    kept = a.join(x, F.col(f"a.`{doc_id}`").eqNullSafe(F.col(f"x.{keep}")) & (own == F.col(f"x.{key}")), "left_semi")
    # equal rows by both are copies of one text; of these one stays
    kept = kept.withColumn(key, text_key(F.col(text).cast("string")))
    return kept.dropDuplicates([doc_id, key]).drop(key)

"""Centroid clustering over dictionaries of subvectors, exact in whole numbers.

A vector's components become floor(256 x). Vectors are taken in chunks of up to ``CHUNK``;
in a chunk every dimension is a block with a dictionary of its distinct values and
a code per vector, and neighbouring blocks of equal width are joined, again
and again, while the joint dictionary has at most 1/``SHARE`` of the chunk's
vectors. Nothing is lost: a vector is its codes. The chunks are written once.

In a round, a task works out the squared distance of every dictionary entry to
every centroid (once per round and chunk) and adds up each vector's distances by
its codes. Sums for the new centroids come from counts by (cluster, code) times the
entries. Only k x dimensions sums a task are shuffled and k x dimensions reach the
driver, whatever the number of vectors; a hot cluster or a common vector adds
no shuffle. New centroids are exact floors of sum / count; an empty one stays.

Kept are vectors with ``dims`` components, none null, NaN or infinite; others,
null vectors included, give no row. A vector without a vec_id is clustered, but
is no starting centroid. Repeated rows and repeated vec_ids are vectors like
others; ties go to the smaller number. With fewer vectors than ``k`` each is
a centroid at the start; where none has a vec_id there are no rows. Distances are 64-bit, so a
component beyond ``LARGEST`` after scaling is an error rather than a wrong sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm.common import ship_by_value, stored

ship_by_value(__name__)

SCALE = 256
CHUNK = 16_384
SHARE = 8
LARGEST = 1 << 27
ENCODED = "vec_ids array<bigint>, widths array<int>, entries array<binary>, codes array<binary>"
Block = tuple[np.ndarray, np.ndarray]  # entries (distinct x width), code per vector


def usable(vectors: DataFrame, dims: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v of the kept vectors."""
    v = F.col(vector).cast("array<double>")
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.where((F.size(v) == dims) & whole).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def scaled(x: np.ndarray) -> np.ndarray:
    q = np.floor(x * SCALE)
    if q.size and np.abs(q).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling")
    return q.astype(np.int64)


def joined(a: Block, b: Block, most: int) -> Block | None:
    """One block of two neighbours, if its dictionary has at most ``most`` entries."""
    both = a[1].astype(np.int64) * len(b[0]) + b[1]
    pairs, codes = np.unique(both, return_inverse=True)
    if len(pairs) > most:
        return None
    return np.concatenate([a[0][pairs // len(b[0])], b[0][pairs % len(b[0])]], axis=1), codes


def dictionaries(q: np.ndarray, share: int = SHARE) -> list[Block]:
    """Blocks of the columns of ``q``, in order."""
    blocks: list[Block] = []
    for i in range(q.shape[1]):
        values, codes = np.unique(q[:, i], return_inverse=True)
        blocks.append((values[:, None], codes))
    most = len(q) // share
    grown = True
    while grown:
        grown, out, i = False, [], 0
        while i < len(blocks):
            pair = blocks[i:i + 2]
            both = joined(*pair, most) if len(pair) == 2 and pair[0][0].shape[1] == pair[1][0].shape[1] else None
            grown |= both is not None
            out.append(pair[0] if both is None else both)
            i += 1 if both is None else 2
        blocks = out
    return blocks


def encoded(vectors: DataFrame, dims: int, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk of the rows of ``usable``: ids, and per block the width, entries, codes."""

    def row(ids: list, parts: list[np.ndarray]) -> pa.RecordBatch:
        blocks = dictionaries(scaled(np.concatenate(parts)))
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([[e.shape[1] for e, _ in blocks]], pa.list_(pa.int32())),
            pa.array([[e.astype("<i4").tobytes() for e, _ in blocks]], pa.list_(pa.binary())),
            pa.array([[c.astype("<u4").tobytes() for _, c in blocks]], pa.list_(pa.binary()))], ["vec_ids", "widths", "entries", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        parts: list[np.ndarray] = []
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            own = batch.column("vec_id").to_pylist()
            while own:
                room = chunk - len(ids)
                ids += own[:room]
                parts.append(x[:room])
                own, x = own[room:], x[room:]
                if len(ids) == chunk:
                    yield row(ids, parts)
                    ids, parts = [], []
        if ids:
            yield row(ids, parts)

    return vectors.mapInArrow(run, ENCODED)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[Block]]]:
    """The chunks of ``encoded`` rows: ids and blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            widths, entries, codes = (batch.column(n)[i] for n in ("widths", "entries", "codes"))
            blocks = [(np.frombuffer(e.as_buffer(), "<i4").reshape(-1, w).astype(np.int64), np.frombuffer(c.as_buffer(), "<u4"))
                      for w, e, c in zip(widths.as_py(), entries, codes)]
            yield batch.column("vec_ids")[i].values, blocks


def distances(blocks: list[Block], centres: np.ndarray) -> np.ndarray:
    """Squared distance of each vector (row) to each centre (column)."""
    out, at = 0, 0
    for entries, codes in blocks:
        w = entries.shape[1]
        table = np.zeros((len(entries), len(centres)), dtype=np.int64)
        for j in range(w):
            table += (entries[:, j, None] - centres[None, :, at + j]) ** 2
        out = out + table[codes]
        at += w
    return out


def sums(blocks: list[Block], nearest: np.ndarray, k: int) -> np.ndarray:
    """Component sums (column) of the vectors of each cluster (row)."""
    out = []
    for entries, codes in blocks:
        n = np.bincount(nearest * len(entries) + codes, minlength=k * len(entries)).reshape(k, -1)
        out.append(n @ entries)
    return np.concatenate(out, axis=1)


def starting(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors whose hashed vec_id is smallest, in that order. Only k rows
    a task are kept and k come back."""
    by = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    got = vectors.where(F.col("vec_id").isNotNull()).orderBy(by, "v").limit(k).select("v").collect()
    return scaled(np.array([r["v"] for r in got], dtype=np.float64))


def moved(chunked: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centres after one round."""
    k, dims = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for _, blocks in chunks(batches):
            nearest = distances(blocks, centres).argmin(axis=1)
            n += np.bincount(nearest, minlength=k)
            total += sums(blocks, nearest, k)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(has, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(has))),
            pa.array(np.repeat(n[has], dims)), pa.array(total[has].ravel())], ["cluster", "dim", "n", "total"])

    part = chunked.mapInArrow(run, "cluster int, dim int, n bigint, total bigint")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    out = centres.copy()
    for r in part.groupBy("cluster", "dim").agg(wide("n"), wide("total")).collect():
        out[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    return out


def assigned(chunked: DataFrame, centres: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks in chunks(batches):
            d = distances(blocks, centres)
            nearest = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([ids, pa.array(nearest.astype(np.int32)), pa.array(d[np.arange(len(d)), nearest])],
                                             ["vec_id", "cluster", "distance"])

    return chunked.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def centre_table(spark: SparkSession, centres: np.ndarray) -> DataFrame:
    """cluster, centroid (list of long), centroid_sha256."""
    rows = [(i, c, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centres.tolist())]
    return spark.createDataFrame(rows, "cluster int, centroid array<bigint>, centroid_sha256 string")


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(vec_id, cluster, distance per vector; cluster, centroid, centroid_sha256, cluster_inertia, inertia per non-empty cluster)."""
    spark = vectors.sparkSession
    kept = usable(vectors, dims)
    centres = starting(kept, k)
    if not len(centres):
        # nothing with a vec_id to start from
        empty = spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint")
        return empty, spark.createDataFrame([], "cluster int, centroid array<bigint>, centroid_sha256 string, cluster_inertia bigint, inertia bigint")
    chunked = stored(encoded(kept, dims, chunk), "subvectors")
    for _ in range(rounds):
        centres = moved(chunked, centres)
    out = stored(assigned(chunked, centres), "assignment")
    # one row per cluster, k at most
    by = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    inertia = spark.createDataFrame([(c, s, sum(by.values())) for c, s in sorted(by.items())], "cluster int, cluster_inertia bigint, inertia bigint")
    return out, centre_table(spark, centres).join(F.broadcast(inertia), "cluster")


def digest(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64) -> DataFrame:
    """One row per vector, with its cluster's figures; the cluster table has at
    most ``k`` rows and is broadcast."""
    rows, centres = clustered(vectors, k, rounds, dims)
    return rows.join(F.broadcast(centres), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

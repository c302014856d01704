"""Quality classifier: a linear SVM over Naive Bayes features (NB-SVM).

Features are n-gram indicators, hashed into ``N_HASH`` cells and counted once
per document: character n-grams (2 to 4 bytes), word 1- and 2-grams, and
1- to 3-grams of word shapes (first and last characters' classes, length,
whether the word repeats the one before). Each indicator is scaled by its class
log-count ratio (Wang and Manning, 2012), rows are brought to unit length, and
a hinge-loss model is fitted by dual coordinate descent (Hsieh et al., 2008) in
numpy. Margins become probabilities by a logistic fit on other sample rows.

Fitting uses a bounded sample of labelled rows (``sample_rows``, chosen by a
hash of the key): the log-count ratios come from all its rows, counted in Spark
tasks; ``svm_rows`` of them, texts of ``sample_bytes`` at most, fit the model, as many again calibrate it. Scoring covers
every document and its whole text, a long one by slices of ``SLICE`` bytes, so that
memory beside the text itself does not grow with it. Null and empty texts have no
feature: their score is that of margin zero plus the bias. With one class only,
every score is that class's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import bounded_sample, hash_unit, ship_by_value, stored, within_bytes
from trafficlens.llm.toxicity import logistic

ship_by_value(__name__)

BITS = 17
N_HASH = 1 << BITS
MULT = 0x9E3779B97F4A7C15
# classes of bytes: space, digit, upper, lower, other letter byte, full stop or comma, other
CLASS = np.full(256, 6, np.uint64)
CLASS[[9, 10, 11, 12, 13, 32]] = 0
CLASS[48:58] = 1
CLASS[65:91] = 2
CLASS[97:123] = 3
CLASS[128:] = 4
CLASS[[44, 46]] = 5
GAP = CLASS == 0
NONE = np.zeros(0, np.uint64)
# bytes of a text worked on at a time
SLICE = 1 << 18


def cells(text: str | None) -> np.ndarray:
    """The different feature cells of a text. A text over ``SLICE`` bytes is
    worked through by slices, which changes no feature."""
    if not text:
        return np.zeros(0, np.int64)
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(b) > SLICE:
        return _cells_by_slices(b)
    parts = _char_cells(b) + _word_cells(*_words(b))[0]
    if not parts:
        return np.zeros(0, np.int64)
    at = np.concatenate(parts).astype(np.int64)
    # each cell once, without sorting: the last occurrence of a cell owns it
    owner = OWNER
    n = np.arange(len(at), dtype=np.int32)
    owner[at] = n
    return at[owner[at] == n]


def _cell(h: np.ndarray, family: int) -> np.ndarray:
    return ((h + np.uint64(family)) * np.uint64(MULT)) >> np.uint64(64 - BITS)


def _char_cells(b: np.ndarray) -> list[np.ndarray]:
    """Cells of the 2- to 4-grams of bytes."""
    parts = []
    h = x = b.astype(np.uint64)
    for n in (2, 3, 4):
        if len(x) < n:
            break
        h = (h[:-1] << np.uint64(8)) | x[n - 1:]
        parts.append(_cell(h, n << 40))
    return parts


def _shape(first, second, last, size):
    odd = np.where(CLASS[last] == 6, last.astype(np.uint64), CLASS[last])
    return ((CLASS[first] * np.uint64(8) + CLASS[second]) * np.uint64(256) + odd) * np.uint64(8) + np.minimum(size // 4, 5).astype(np.uint64)


def _words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and shapes of the words of some bytes."""
    gap = np.zeros(len(b) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = CLASS[b] == 0
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return NONE, NONE
    inside = (~gap[1:-1]).astype(np.uint64)
    # a word's hash: its bytes times powers of an odd number, from the word's start
    origin = np.zeros(len(b), np.int64)
    origin[starts[0]:] = np.repeat(starts, np.diff(np.append(starts, len(b))))
    place = np.arange(len(b)) - origin
    power = POWERS[np.minimum(place, len(POWERS) - 1)]
    w = np.add.reduceat(b.astype(np.uint64) * inside * power, starts)
    return w, _shape(b[starts], b[np.minimum(starts + 1, len(b) - 1)], b[ends - 1], ends - starts)


def _word_cells(w: np.ndarray, shape: np.ndarray, before: tuple | None = None) -> tuple[list[np.ndarray], tuple]:
    """Cells of the 1- and 2-grams of words and the 1- to 3-grams of shapes, and
    what the words after these need: the last word's hash, the last two shapes."""
    last, shapes = before or (NONE, NONE)
    if not len(w):
        return [], (last, shapes)
    both = np.concatenate((last, w))
    same = np.concatenate(([0], both[1:] == both[:-1])).astype(np.uint64)[len(last):]
    shape = shape * np.uint64(2) + same
    s = np.concatenate((shapes, shape))
    step = np.uint64(1 << 20)
    parts = [_cell(w, 11 << 40), _cell(both[:-1] * np.uint64(31) + both[1:], 12 << 40), _cell(shape, 21 << 40),
             _cell(s[:-1] * step + s[1:], 22 << 40), _cell((s[:-2] * step + s[1:-1]) * step + s[2:], 23 << 40)]
    return parts, (both[-1:], s[-2:])


def _word_slices(b: np.ndarray):
    """Hashes and shapes of the words, by slices that end after white space; a
    word longer than a slice comes alone."""
    i = 0
    while i < len(b):
        gaps = np.flatnonzero(GAP[b[i:i + SLICE]])
        if i + SLICE >= len(b):
            yield _words(b[i:])
            return
        if len(gaps):
            yield _words(b[i:i + gaps[-1] + 1])
            i += gaps[-1] + 1
            continue
        end = i + SLICE
        while end < len(b) and not GAP[b[end:end + SLICE]].any():
            end += SLICE
        end = min(len(b), end + (int(GAP[b[end:end + SLICE]].argmax()) if end < len(b) else 0))
        most = len(POWERS) - 1
        word = b[i:end]
        w = (word[:most] * POWERS[:most][:len(word)]).sum(dtype=np.uint64, keepdims=True)
        w += word[most:].sum(dtype=np.uint64, keepdims=True) * POWERS[most]
        yield w, _shape(b[i:i + 1], b[i + 1:i + 2], b[end - 1:end], np.array([end - i]))
        i = end


def _cells_by_slices(b: np.ndarray) -> np.ndarray:
    found = np.zeros(N_HASH, bool)
    for i in range(0, len(b), SLICE):
        # the 4-grams that end in a slice begin up to three bytes before it
        for at in _char_cells(b[max(0, i - 3):i + SLICE]):
            found[at] = True
    before = None
    for w, shape in _word_slices(b):
        parts, before = _word_cells(w, shape, before)
        for at in parts:
            found[at] = True
    return np.flatnonzero(found)


POWERS = np.cumprod(np.concatenate(([1], np.full(255, 0x100000001B3, np.uint64))).astype(np.uint64), dtype=np.uint64)
OWNER = np.zeros(N_HASH, np.int32)


class Model:
    """weights: one per cell (ratio times SVM weight); ratio: for the row's length; line: margin to score."""

    def __init__(self, weights: np.ndarray, ratio: np.ndarray, bias: float, line: list[float], constant: float | None = None):
        self.weights, self.ratio, self.bias, self.line, self.constant = weights, ratio, bias, line, constant

    def margin(self, at: np.ndarray) -> float:
        norm = float(np.sqrt(np.square(self.ratio[at]).sum())) if len(at) else 0.0
        return (float(self.weights[at].sum()) / norm if norm else 0.0) + self.bias

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        z = self.line[0] * self.margin(cells(text)) + self.line[1]
        return round(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))), 6)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = 1.0,
                            rounds: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised hinge-loss SVM. y is +1 or -1; the
    bias is a feature of value one. Classes weigh inversely to their frequency."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(N_HASH), 0.0
    alpha = np.zeros(len(rows))
    upper = cost * np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
    square = np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), upper[i])
            d = (new - alpha[i]) * y[i]
            if d:
                w[rows[i]] += d * values[i]
                bias += d
                moved += abs(d)
                alpha[i] = new
        if moved < 1e-3 * len(rows):
            break
    return w, bias


def log_count_ratio(counts: np.ndarray, totals: tuple[float, float]) -> np.ndarray:
    """Per cell, log of (share in class one / share in class zero), smoothed."""
    one, zero = counts[0] + 1.0, counts[1] + 1.0
    return np.log((one / (totals[0] + 2.0)) / (zero / (totals[1] + 2.0)))


def class_counts(sample: DataFrame) -> tuple[np.ndarray, tuple[float, float]]:
    """Documents of each class that have a cell, and documents of each class."""

    def count(batches):
        held = np.zeros((2, N_HASH + 1), np.int64)
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held[1 - y, cells(t)] += 1
                held[1 - y, N_HASH] += 1
        at = np.flatnonzero(held.any(axis=0))
        yield pa.record_batch([pa.array(at), pa.array(held[0, at]), pa.array(held[1, at])], names=["cell", "one", "zero"])

    # N_HASH rows at most come back
    got = sample.select("text", "y").mapInArrow(count, "cell long, one long, zero long").groupBy("cell").agg(
        F.sum("one").alias("one"), F.sum("zero").alias("zero")).toPandas()
    out = np.zeros((2, N_HASH + 1))
    out[0, got["cell"]], out[1, got["cell"]] = got["one"], got["zero"]
    return out[:, :N_HASH], (out[0, N_HASH], out[1, N_HASH])


def fit(rows: list[tuple[str, int]], counts: np.ndarray, totals: tuple[float, float], svm_rows: int) -> Model:
    ratio = log_count_ratio(counts, totals).astype(np.float32)
    at = [cells(t) for t, _ in rows]
    y = np.array([1.0 if v else -1.0 for _, v in rows])
    n = min(svm_rows, -(-len(rows) // 2))
    if not len(y) or (y[:n] > 0).all() or (y[:n] < 0).all():
        return Model(np.zeros(1), ratio, 0.0, [0.0, 0.0], 0.0 if len(y) and (y < 0).all() else 1.0)
    values = []
    for a in at:
        v = ratio[a].astype(np.float64)
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm else v)
    w, bias = dual_coordinate_descent(at[:n], values[:n], y[:n])
    model = Model((w * ratio).astype(np.float32), ratio, bias, [1.0, 0.0])
    rest = range(n, len(rows)) if len(rows) - n >= 20 and len(set(y[n:])) == 2 else range(len(rows))
    margins = np.array([[model.margin(at[i])] for i in rest])
    model.line = logistic(margins, (y[list(rest)] > 0).astype(float))
    return model


def learned(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, svm_rows: int = 3000, label: str = "quality",
            sample_bytes: int = 256 << 20) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id, ``label``); keys with
    differing labels are left out."""
    one = labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("key")).agg(F.min(label).alias("y"), F.max(label).alias("high"))
    one = one.where(F.col("y") == F.col("high")).select("key", F.col("y").cast("int").alias("y"))
    keys = stored(bounded_sample(one, "key", sample_rows), "quality-keys")
    # at most sample_rows narrow rows are broadcast; texts are not shuffled
    rows = docs.select(F.col("doc_id").alias("key"), "text").join(F.broadcast(keys), "key")
    rows = stored(rows, "quality-sample")
    counts, totals = class_counts(rows)
    few = F.broadcast(bounded_sample(keys, "key", 2 * svm_rows).select("key"))
    got = rows.join(few, "key", "left_semi").dropDuplicates(["key"])
    got = within_bytes(got, [], hash_unit(F.lit("sample"), F.col("key").cast("string")), "text", sample_bytes)
    got = got.orderBy(F.xxhash64("key"), "key").select("text", "y")
    return fit([(r["text"], r["y"]) for r in got.toLocalIterator()], counts, totals, svm_rows)


def scorer(model: Model):
    """A column function text -> score."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([model.score(t) for t in s], dtype=float)

    # evaluated once per row even where the result is used twice
    return score.asNondeterministic()


def scored(docs: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    return docs.withColumn(out, scorer(model)(F.col(text).cast("string")))

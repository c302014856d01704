"""Toxicity by compression distance with zstandard dictionaries.

Two dictionaries are trained: one on windows of ordinary text, one on the
windows of toxic text that are characteristic (they hold a character 5-gram
that is far more frequent in toxic than in ordinary documents). Both
compressors share the ordinary content; the toxic one has its own content
besides. A window is ``window_words`` words, lower-cased, between spaces,
followed by ``TAIL`` bytes of shared content (zstandard does not start a match in
the last bytes of a block). A window's distance is its length under the
ordinary dictionary minus its length under the toxic one: text that only the
toxic dictionary knows gives a large one. Calibrated thresholds: from the
documents' largest distance and the sum of distances over ``NOISE`` bytes (each
different window once) a logistic regression gives the score. A text without a
positive distance scores ``UNSEEN`` at most, under 0.5. Where the fit does not tell
the toxic rows from the ordinary ones it was made on (the shares of both that reach 0.5 differ
by less than ``TELLS``), every score is the share of toxic rows, ``UNSEEN`` at most: no text
counts as toxic.

Fitting uses a bounded sample of labelled rows, ``most_toxic`` and
``most_ordinary`` documents chosen by a hash of the key, texts of ``sample_bytes`` in
all for each class, and ``most_windows`` of their ordinary windows, drawn at random,
for the ordinary dictionary; scoring covers every document and its whole text. Null and empty texts have no window: they get the
score of distance zero. With no toxic or no ordinary row in the sample every
score is 0.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.common import bounded_sample, hash_unit, ship_by_value, stored, within_bytes, worker_state

ship_by_value(__name__)

LEVEL = 9
TAIL = 16
NOISE = 3
UNSEEN, TELLS = 0.49, 0.2
GRAM = 5
ORDINARY_BYTES, TOXIC_BYTES = 8192, 4096


def windows(text: str | None, window_words: int) -> set[bytes]:
    """The different windows of a text."""
    if not text:
        return set()
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if window_words == 1:
        return set(words)
    return {b" ".join(words[i:i + window_words]) for i in range(0, len(words), window_words)}


def grams(word: bytes) -> set[bytes]:
    marked = b" " + word
    return {marked[i:i + GRAM] for i in range(len(marked) - GRAM + 1)}


def dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples (without the entropy
    tables: both compressors use the format's own). Too few samples for
    training: the samples themselves, the commonest last."""
    try:
        trained = zstandard.train_dictionary(size, samples, k=16, d=8, level=3).as_bytes()
        return trained[-max(256, size - 300):]
    except zstandard.ZstdError:
        return b"".join(s for s, _ in reversed(Counter(samples).most_common()))[-size:]


class Model:
    """Dictionary contents, window size and the calibrated logistic weights."""

    def __init__(self, ordinary: bytes, toxic: bytes, window_words: int, weights: list[float]):
        self.ordinary, self.toxic, self.window_words, self.weights = ordinary, toxic, window_words, weights

    def scores(self, features: list[tuple[float, float]]) -> np.ndarray:
        """Scores of texts by their ``Distances.features``."""
        x = np.array([(*f, 1.0) for f in features]).reshape(-1, 3)
        p = 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))
        return np.round(np.where(x[:, 0] > 0, p, np.minimum(p, UNSEEN)), 6)


class Distances:
    """Compression distances; keeps those of windows already seen by a task."""

    def __init__(self, model: Model, most: int = 400_000):
        def compressor(content):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                            write_dict_id=False)

        self.model, self.most, self.seen = model, most, {}
        self.tail = b" " + model.ordinary[-TAIL:]
        self.plain, self.toxic = compressor(model.ordinary), compressor(model.ordinary + model.toxic)

    def features(self, text: str | None) -> tuple[float, float]:
        """The largest distance, and the logarithm of the sum of those over NOISE."""
        seen, plain, toxic, tail = self.seen, self.plain.compress, self.toxic.compress, self.tail
        most = total = 0
        for w in windows(text, self.model.window_words):
            d = seen.get(w)
            if d is None:
                whole = b" " + w + tail
                d = len(plain(whole)) - len(toxic(whole))
                if len(seen) >= self.most:
                    seen.clear()
                if len(w) < 100:
                    seen[w] = d
            if d > most:
                most = d
            if d > NOISE:
                total += d
        return float(most), math.log1p(total)


def fit(toxic: list[str], ordinary: list[str], window_words: int = 1, seed: int = 1, most_windows: int = 80_000) -> Model:
    if not toxic or not ordinary:
        return Model(b"", b"", window_words, [])
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    random.seed(seed)
    bad, good = Counter(), Counter()
    for counter, texts in ((bad, toxic), (good, ordinary)):
        for t in texts:
            counter.update({g for w in windows(t, 1) for g in grams(w)})
    least = max(2, 0.02 * len(toxic))
    strange = {g for g, n in bad.items() if n >= least and n / len(toxic) > 60 * (good[g] + 0.5) / len(ordinary)}
    if not strange:
        # few rows: the most one-sided n-grams there are
        strange = {g for g, n in bad.items() if n >= 2 and not good[g]} or {g for g in bad if not good[g]}
    plain = sorted({b" " + w + b" " for t in ordinary for w in windows(t, 4)})
    random.shuffle(plain)
    char = []
    for t in toxic:
        own = sorted(w for w in windows(t, 1) if not strange.isdisjoint(grams(w)))
        random.shuffle(own)
        char += [b" " + b" ".join(own[i:i + 4]) + b" " for i in range(0, len(own), 4)]
    model = Model(dictionary(plain[:most_windows], ORDINARY_BYTES), dictionary(char, TOXIC_BYTES), window_words, [])
    at = Distances(model)
    x = np.array([at.features(t) for t in toxic + ordinary])
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    model.weights = logistic(x, y)
    hit = model.scores(x) >= 0.5
    if hit[y > 0].mean() - hit[y == 0].mean() < TELLS:
        share = min(float(y.mean()), UNSEEN)
        model.weights = [0.0, 0.0, math.log(share / (1 - share))]
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> list[float]:
    """Logistic regression by Newton steps; both classes weigh the same."""
    z = np.column_stack([x, np.ones(len(x))])
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (share * (y - p)) - penalty @ w
        w = w + np.clip(np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + penalty, grad), -2, 2)
    return w.tolist()


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bounds: dict[int, int], key: str = "doc_id",
                    text: str = "text", sample_bytes: int = 128 << 20) -> dict[int, list[str]]:
    """At most ``bounds[v]`` texts, of ``sample_bytes`` at most, per label value ``v``. Keys with differing
    labels are left out. The keys are bounded, so they are broadcast and the
    texts are not shuffled."""
    one = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(label).alias("low"), F.max(label).alias("high"))
    one = one.where(F.col("low") == F.col("high")).select("key", F.col("low").cast("int").alias("y"))
    keys = None
    for v, n in sorted(bounds.items()):
        part = bounded_sample(one.where(F.col("y") == v), "key", n)
        keys = part if keys is None else keys.unionByName(part)
    keys = stored(keys, "label-sample")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(keys), "key").dropDuplicates(["key"])
    rows = within_bytes(stored(rows, "label-texts"), ["y"], hash_unit(F.lit("sample"), F.col("key").cast("string")), "text", sample_bytes)
    out: dict[int, list[str]] = {v: [] for v in bounds}
    for r in rows.orderBy("key").collect():
        if r["text"]:
            out[r["y"]].append(r["text"])
    return out


def learned(docs: DataFrame, labels: DataFrame, window_words: int = 1, most_toxic: int = 1500, most_ordinary: int = 3000,
            sample_bytes: int = 128 << 20, most_windows: int = 80_000) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id, toxic)."""
    got = labelled_sample(docs, labels, "toxic", {1: most_toxic, 0: most_ordinary}, sample_bytes=sample_bytes)
    return fit(got[1], got[0], window_words, most_windows=most_windows)


def scorer(model: Model):
    """A column function text -> score."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = model.ordinary, model.toxic, model.window_words
        at = worker_state("toxicity", key, lambda: Distances(model)) if model.weights else None
        for s in parts:
            if at is None:
                yield pd.Series(np.zeros(len(s)))
                continue
            yield pd.Series(model.scores([at.features(t) for t in s]))

    # evaluated once per row even where the result is used twice
    return score.asNondeterministic()


def scored(docs: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    return docs.withColumn(out, scorer(model)(F.col(text).cast("string")))

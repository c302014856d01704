"""Language of code-switched text by a linear-chain conditional random field.

Every word (run of letters) gets a label; the chain has features per word -
affixes and character n-grams (1 to 4 letters, with word-boundary marks, so
the marked ones are prefixes and suffixes; hashed into ``N_HASH`` cells) and
membership in a learned lexicon of each language - and learned transitions.
Forward-backward gives the posterior of every word's language; the document's
language is the one with the largest posterior mass, its score that share.

Fitting uses a bounded sample: at most ``sample_per_language`` documents per
language, chosen by a hash of the key, ``sample_rows`` of all languages, and texts of
``sample_bytes`` in all, an equal part for each language; all their words make the
lexicon, ``max_words`` of them, in segments drawn at random, the chains. Segments of sample documents are joined into
code-switched chains, so that transitions are learned; the weights follow the
gradient of the chain's log-likelihood (AdaGrad, numpy on the driver, whose
memory is bounded by the sample). Scoring covers every document and whole
texts; potentials of about ``SCORED_WORDS`` words, or of one longer text, are in
memory at a time.

Null texts and texts without a letter get ``und`` and score 0. Languages are
those seen in the sample; with no labelled row every document is ``und``.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.llm.common import hash_unit, ship_by_value, stored, within_bytes, worker_state

ship_by_value(__name__)

N_HASH = 1 << 17
MAX_ORDER = 4
BLOCK = 32
SEGMENT = 24
CHAIN = 96
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
SCORED_WORDS = 1 << 17


def words_of(text: str | None) -> list[str]:
    # the pattern also takes numerals that are no decimal digits, such as a superscript
    return [w for w in LETTERS.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))] if text else []


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of each word, flat, and where each word's ids begin."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    ids, owners = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, MAX_ORDER + 1):
        m = len(code) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + code[n - 1:]
        inside = owner[:m] == owner[n - 1:]
        cell = ((h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 17)
        ids.append(cell[inside].astype(np.int64))
        owners.append(owner[:m][inside])
    ids.append(np.array([N_HASH + lexicon.get(w, -1) + 1 for w in words], np.int64))
    owners.append(np.arange(len(words)))
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    starts = np.searchsorted(owners[order], np.arange(len(words)))
    return np.concatenate(ids)[order], starts


class Model:
    """Languages, word weights (features x languages), transitions, start scores."""

    def __init__(self, langs: list[str], lexicon: dict[str, int], weights: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.langs, self.lexicon, self.weights, self.trans, self.start = langs, lexicon, weights, trans, start

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.langs)), np.float32)
        ids, starts = word_features(words, self.lexicon)
        sums = np.add.reduceat(self.weights[ids], starts, axis=0)
        return sums / np.diff(np.append(starts, len(ids)))[:, None]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.max(axis=-1, keepdims=True)


def posteriors(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray,
               pairs: np.ndarray | None = None) -> np.ndarray:
    """Label posteriors of all words of several chains laid end to end; the
    expected counts of label pairs are added to ``pairs``. Chains are cut into blocks; products of the blocks' transfer matrices carry the
    forward and backward messages across blocks, then all blocks run side by
    side, so cost follows the number of words and not the longest chain."""
    n_lang = emit.shape[1]
    if not len(emit):
        return emit
    blocks = -(-lengths // BLOCK)
    total = int(blocks.sum())
    first = np.cumsum(blocks) - blocks
    word0 = np.cumsum(lengths) - lengths
    within = np.arange(len(emit)) - np.repeat(word0, lengths)
    at = (np.repeat(first, lengths) + within // BLOCK, within % BLOCK)
    pot = np.zeros((total, BLOCK, n_lang))
    pot[at] = np.exp(emit - emit.max(axis=1, keepdims=True))
    live = np.zeros((total, BLOCK), bool)
    live[at] = True
    step = np.exp(trans - trans.max())
    head = np.zeros(total, bool)
    head[first[blocks > 0]] = True
    # a chain's first word has no transition into it: start scores instead
    prod = np.broadcast_to(np.eye(n_lang), (total, n_lang, n_lang)).copy()
    for j in range(BLOCK):
        on = live[:, j]
        use = on & ~(head & (j == 0))
        prod[use] = (prod[use] @ step) * pot[use, j][:, None, :]
        prod[use] /= prod[use].max(axis=(1, 2), keepdims=True)
    alpha_in = np.ones((total, n_lang))
    beta_out = np.ones((total, n_lang))
    s0 = np.exp(start - start.max())
    alpha_in[first[blocks > 0]] = s0 / s0.max()
    many = np.flatnonzero(blocks > 1)
    depth = int(blocks.max(initial=0))
    lead = head[:, None, None]
    first_pot = np.where(lead, pot[:, 0][:, None, :], 1.0)
    for d in range(1, depth):
        on = many[blocks[many] > d]
        b = first[on] + d
        a = alpha_in[b - 1] * first_pot[b - 1, 0]
        alpha_in[b] = _normal(np.einsum("bi,bij->bj", a, prod[b - 1]))
    for d in range(depth - 1, 0, -1):
        on = many[blocks[many] > d]
        b = first[on] + d
        beta_out[b - 1] = _normal(np.einsum("bij,bj->bi", prod[b], beta_out[b]))
    alpha = np.zeros((total, BLOCK, n_lang))
    a = alpha_in
    for j in range(BLOCK):
        moved = a @ step
        if j == 0:
            moved = np.where(head[:, None], a, moved)
        a = np.where(live[:, j][:, None], _normal(np.maximum(moved * pot[:, j], 1e-300)), a)
        alpha[:, j] = a
    beta = beta_out
    post = np.zeros((total, BLOCK, n_lang))
    for j in range(BLOCK - 1, -1, -1):
        post[:, j] = alpha[:, j] * beta
        if pairs is not None:
            on = live[:, j] & ~(head & (j == 0))
            before = alpha[on, j - 1] if j else alpha_in[on]
            both = before[:, :, None] * step[None] * (pot[on, j] * beta[on])[:, None, :]
            pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta = np.where(live[:, j][:, None], _normal(np.maximum((beta * pot[:, j]) @ step.T, 1e-300)), beta)
    out = post[at]
    return out / out.sum(axis=1, keepdims=True)


def fit(sample: list[tuple[str, str]], epochs: int = 4, rate: float = 0.3, max_words: int = 400_000, seed: int = 1) -> Model:
    """Fit on (text, language) pairs."""
    langs = sorted({lang for _, lang in sample})
    if not langs:
        return Model([], {}, np.zeros((N_HASH + 1, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    segments: list[tuple[int, list[str]]] = []
    in_docs = Counter()
    for text, lang in sample:
        words = words_of(text)
        y = langs.index(lang)
        in_docs.update((w, y) for w in set(words))
        segments += [(y, words[i:i + SEGMENT]) for i in range(0, len(words) - SEGMENT + 1, SEGMENT)]
        if len(words) < SEGMENT and words:
            segments.append((y, (words * SEGMENT)[:SEGMENT]))
    by_word: dict[str, list[int]] = {}
    for (w, y), n in in_docs.items():
        by_word.setdefault(w, [0] * len(langs))[y] += n
    lexicon = {w: int(np.argmax(n)) for w, n in by_word.items() if sum(n) >= 5 and max(n) >= 0.9 * sum(n)}
    keep = rng.permutation(len(segments))[: max_words // SEGMENT]
    segments = [segments[i] for i in keep]
    n_lang = len(langs)
    model = Model(langs, lexicon, np.zeros((N_HASH + n_lang + 1, n_lang), np.float32), np.zeros((n_lang, n_lang)), np.zeros(n_lang))
    if not segments:
        return model
    vocab = {w: i for i, w in enumerate(sorted({w for _, s in segments for w in s}))}
    ids, starts = word_features(list(vocab), lexicon)
    ends = np.append(starts[1:], len(ids))
    per_chain = CHAIN // SEGMENT
    g_w, g_t, g_s = (np.full(x.shape, 1e-6) for x in (model.weights, model.trans, model.start))
    for _ in range(epochs):
        order = rng.permutation(len(segments))
        chains = [order[i:i + per_chain] for i in range(0, len(order), per_chain)]
        for i in range(0, len(chains), 32):
            group = chains[i:i + 32]
            words = np.array([vocab[w] for c in group for s in c for w in segments[s][1]])
            label = np.array([segments[s][0] for c in group for s in c for _ in range(SEGMENT)])
            lengths = np.array([len(c) * SEGMENT for c in group])
            used, back = np.unique(words, return_inverse=True)
            flat = np.concatenate([ids[starts[u]:ends[u]] for u in used])
            sizes = ends[used] - starts[used]
            emit_used = np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            expected = np.zeros((n_lang, n_lang))
            post = posteriors(emit_used[back], lengths, model.trans, model.start, expected)
            truth = np.eye(n_lang)[label]
            err = np.zeros((len(used), n_lang))
            np.add.at(err, back, truth - post)
            err_feat = np.repeat(err / sizes[:, None], sizes, axis=0)
            grad = np.stack([np.bincount(flat, err_feat[:, y], minlength=len(model.weights)) for y in range(n_lang)], axis=1)
            grad -= 1e-4 * model.weights
            inner = np.ones(len(words), bool)
            inner[np.cumsum(lengths) - lengths] = False
            j = np.flatnonzero(inner)
            g_trans = truth[j - 1].T @ truth[j] - expected
            g_start = (truth - post)[~inner].sum(axis=0)
            for x, g, acc in ((model.weights, grad, g_w), (model.trans, g_trans - 0.01 * model.trans, g_t), (model.start, g_start - 0.01 * model.start, g_s)):
                acc += g * g
                x += rate * g / np.sqrt(acc)
    return model


def learned(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_per_language: int = 600,
            sample_rows: int = 30_000, sample_bytes: int = 128 << 20, max_words: int = 400_000) -> Model:
    """Fit on a bounded sample of the labelled rows of ``docs``, drawn in one pass
    whatever the number of languages; with over ``sample_rows /
    sample_per_language`` of them each has fewer rows, one at least."""
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang")).where(F.col("lang").isNotNull())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "langid-counts")
    n_langs = counts.count()
    if not n_langs:
        return fit([])
    each = max(1, min(sample_per_language, sample_rows // n_langs))
    u = hash_unit(F.lit("sample"), F.col("key").cast("string"))
    # a threshold leaves about twice the rows wanted of a language
    few = rows.join(counts, "lang").where((F.col("n") <= 2 * each) | (u < 2.0 * each / F.col("n")))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(u, "key"))
    keys = few.withColumn("place", first).where(F.col("place") <= each).select("key").distinct()
    keys = stored(keys, "langid-sample")
    # at most sample_rows keys, or one for each language
    got = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("lang").isNotNull())
    got = stored(got.join(F.broadcast(keys), "key", "left_semi").dropDuplicates(["key"]), "langid-texts")
    got = within_bytes(got, ["lang"], u, "text", sample_bytes // n_langs).orderBy("key").collect()
    return fit([(r["text"], r["lang"]) for r in got], max_words=max_words)


class _Words:
    """Emission scores of the words seen by this task, refilled when large."""

    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most = model, most
        self.clear()

    def clear(self):
        self.at, self.rows, self.n = {}, np.zeros((1024, len(self.model.langs)), np.float32), 0

    def scores(self, words: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self.at))
        if self.n + len(new) > self.most:
            self.clear()
            new = list(dict.fromkeys(words))
        for i in range(0, len(new), 20_000):
            part = new[i:i + 20_000]
            emit = self.model.emissions(part)
            if self.n + len(part) > len(self.rows):
                grown = np.zeros((2 * (self.n + len(part)), emit.shape[1]), np.float32)
                grown[: self.n] = self.rows[: self.n]
                self.rows = grown
            self.rows[self.n:self.n + len(part)] = emit
            self.at.update(zip(part, range(self.n, self.n + len(part))))
            self.n += len(part)
        at = self.at
        return self.rows[np.array([at[w] for w in words], np.int64)]


def _groups(texts: list[str | None]) -> Iterator[list[list[str]]]:
    """The words of at most 256 texts at a time, fewer where texts are long."""
    held, n = [], 0
    for t in texts:
        held.append(words_of(t))
        n += len(held[-1])
        if len(held) == 256 or n >= SCORED_WORDS:
            yield held
            held, n = [], 0
    if held:
        yield held


def predictor(model: Model):
    """A column function text -> struct(lang, score)."""
    mark = uuid.uuid4().hex

    @F.pandas_udf("lang string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = worker_state("langid", mark, lambda: _Words(model))
        for s in parts:
            langs, scores = [], []
            texts = s.tolist()
            for part in _groups(texts):
                lengths = np.array([len(p) for p in part], np.int64)
                flat = [w for p in part for w in p]
                if not flat or not model.langs:
                    langs += [UNKNOWN] * len(part)
                    scores += [0.0] * len(part)
                    continue
                post = posteriors(table.scores(flat), lengths, model.trans, model.start)
                cum = np.vstack([np.zeros(post.shape[1]), np.cumsum(post, axis=0)])
                ends = np.cumsum(lengths)
                mass = (cum[ends] - cum[ends - lengths]) / np.maximum(lengths, 1)[:, None]
                best = mass.argmax(axis=1)
                for n, b, m in zip(lengths.tolist(), best.tolist(), mass):
                    langs.append(model.langs[b] if n else UNKNOWN)
                    scores.append(min(1.0, max(0.0, float(round(m[b], 6)))) if n else 0.0)
            yield pd.DataFrame({"lang": langs, "score": scores})

    # evaluated once per row even where the result is used twice
    return predict.asNondeterministic()


def predicted(docs: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``out``: struct(lang, score)."""
    return docs.withColumn(out, predictor(model)(F.col(text).cast("string")))


def accepted(pred: Column, least_score: float = 0.5) -> Column:
    """A document with letters, most of whose words are of one language."""
    return (pred["lang"] != UNKNOWN) & (pred["score"] >= least_score)

"""Document scores by masked pseudo-likelihood.

A bidirectional window network predicts every token from the ``REACH`` tokens
on each side of it: hidden = tanh(b + sum of one table row per neighbour and
place), then a two-level softmax (class of the token, token within its class),
so each probability is normalised over all ids. A document's score is the sum of
its tokens' conditional log-probabilities.

Tokens are words (A-Z lower-cased, split at ASCII white space). The ids are those
of the ``TOP`` most frequent words of the whole corpus, counted in Spark, and
``RARE`` shared ids for all others by a hash of their last three bytes. A word
with a shared id has the probability of that id times its own share of it, from
the counts of all words (smoothed by ``UNSEEN``, which also leaves a share to words
not counted). So each different word has its own probability, however many there are.
The network sees the shared id only; a word's share of it does not depend on the
neighbours.

The counts meet the documents in a join: a task numbers the different
shared-id words of each chunk of documents and names each once by its hash; logarithms
of the shares come back by chunk and are summed over the documents' words.

Training runs where the data is: in each round every task starts from the
shared weights, trains by AdaGrad in numpy on its own documents, and returns its weights;
their average, weighted by positions, starts the next round (parameter
averaging). Every position of every document is a target in just one of the
rounds: with two rounds the even places in the first, the odd ones in the second.
Counts, training and what the
tasks send grow with the corpus, the model does not. Averages are summed in
the order of task numbers, so results repeat on the same partitions.

A null or empty text has no tokens: sum 0, mean null. Repeated rows keep one
result row each.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.llm.common import ship_by_value, stored

ship_by_value(__name__)

TOP, RARE = 1536, 512
PER_CLASS = 64
CLASSES = (TOP + RARE) // PER_CLASS
VOCAB = TOP + RARE
PAD = VOCAB
REACH = 2
HIDDEN = 24
CHUNK = 16_384
STEP = 4096
SCORED = 8192
PART = 8192
# seed of Spark's xxhash64; shared-id words of a chunk of documents, about, bytes of
# text to each of them, and bytes that a row counts besides its text; smoothing
SEED = 42
CHUNK_RARE = 1 << 19
PER_RARE = 16
ROW = 16
UNSEEN = 0.5
# the cells of each row of a table of neighbours
CELLS = np.arange((VOCAB + 1) * HIDDEN).reshape(VOCAB + 1, HIDDEN)


def pieces(batches, most: int):
    """Tables with the rows of the batches in order, each with texts (the last
    column) of at most ``most`` bytes in all, ``ROW`` added to each; a longer text
    is alone."""
    held, room = [], most
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(b.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(size.astype(np.int64) + ROW), 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            upto = int(np.searchsorted(ends, before + room, side="right"))
            if upto == at and not held:
                upto += 1
            if upto > at:
                held.append(b.slice(at, upto - at))
                room, at = room - (ends[upto - 1] - before), upto
            if at < b.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, room = [], most
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and where each text's words start
    (with the end of the last)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words, starts = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    # white space at the ends of a text makes empty words
    full = pc.greater(pc.binary_length(words), 0)
    upto = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))
    return words.filter(full), upto[starts - starts[0]]


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """w, n: all different words of all texts and their counts. A task counts
    the words of its texts up to ``CHUNK_RARE`` different ones or so at a time; only
    these counts are shuffled."""

    def merged(held):
        return pa.concat_tables(held).group_by("w").aggregate([("n", "sum")]).rename_columns(["w", "n"])

    def run(batches):
        held = []
        for piece in pieces(batches, CHUNK_RARE * PER_RARE):
            words, _ = split_words(piece.column(0).combine_chunks())
            held.append(pa.table(pc.value_counts(words).flatten(), names=["w", "n"]))
            if sum(map(len, held)) >= CHUNK_RARE:
                held = [merged(held)]
                if 2 * len(held[0]) >= CHUNK_RARE:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from merged(held).to_batches()

    part = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "w string, n bigint")
    return stored(part.groupBy("w").agg(F.sum("n").alias("n")), "word-counts")


def vocabulary(docs: DataFrame, text: str = "text") -> list[tuple[str, int]]:
    """The TOP most frequent words of all texts and their counts."""
    return most_frequent(word_counts(docs, text))


def most_frequent(counts: DataFrame) -> list[tuple[str, int]]:
    """The TOP most frequent words. A histogram of the counts' sizes tells which
    words can be among them, so only about as many are ordered, whatever the
    number of words and tasks."""
    digits = F.length(F.bin("n"))
    have, least = 0, 0
    for r in sorted(counts.groupBy(digits.alias("d")).agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["d"]):
        have, least = have + r["words"], r["d"]
        if have >= TOP:
            break
    top = counts.where(digits >= least).orderBy(F.desc("n"), "w").limit(TOP)
    return [(r["w"], r["n"]) for r in top.collect()]


def by_row(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of the values from each start to the next."""
    offsets = pa.array(starts * values.itemsize, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, offsets.buffers()[1], pa.py_buffer(values)])


def token_ids(docs: DataFrame, words: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (two bytes each) of all rows; chunk and at, which name the row;
    rare (four bytes each): the places of its shared-id words in the chunk's list of
    them; new: the hashes of the words that it adds to the list, from place start."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("ids", T.BinaryType()),
                           T.StructField("chunk", T.LongType()), T.StructField("at", T.IntegerType()),
                           T.StructField("rare", T.BinaryType()), T.StructField("start", T.IntegerType()),
                           T.StructField("new", T.ArrayType(T.LongType()))])
    frequent = pa.array(words, pa.string())

    def run(batches):
        for k, piece in enumerate(pieces(batches, CHUNK_RARE * PER_RARE)):
            found, starts = split_words(piece.column(1).combine_chunks())
            coded = found.dictionary_encode()
            kinds, code = coded.dictionary, coded.indices.to_numpy()
            # of each different word its id and, if that is a shared one, its place
            ids = pc.fill_null(pc.index_in(kinds, frequent), -1).to_numpy().astype(np.int64)
            listed = np.flatnonzero(ids < 0)
            place = np.full(len(ids), -1, np.int64)
            place[listed] = np.arange(len(listed))
            kinds = kinds.take(pa.array(listed)).cast(pa.binary())
            tails = pc.binary_slice(kinds, -3).dictionary_encode()
            shared = np.array([TOP + zlib.crc32(x) % RARE for x in tails.dictionary.to_pylist()], np.int64)
            ids[listed] = shared[tails.indices.to_numpy()]
            hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in kinds.to_numpy(zero_copy_only=False)], np.uint64).view(np.int64)
            rare = place[code]
            is_rare = rare >= 0
            rare = rare[is_rare]
            rare_starts = np.concatenate(([0], np.cumsum(is_rare)))[starts]
            # places are numbered as the words come, so a row adds those over all before
            new_starts = np.concatenate(([0], np.maximum.accumulate(rare) + 1))[rare_starts]
            n = len(piece)
            columns = [piece.column(0).combine_chunks(), by_row(ids[code].astype("<u2"), starts),
                       pa.array(np.full(n, (TaskContext.get().partitionId() << 32) + k), pa.int64()), pa.array(np.arange(n), pa.int32()),
                       by_row(rare.astype("<u4"), rare_starts), pa.array(new_starts[:-1], pa.int32()),
                       pa.ListArray.from_arrays(pa.array(new_starts, pa.int32()), pa.array(hashes, pa.int64()))]
            yield pa.record_batch(columns, names=schema.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def shares(counts: DataFrame, words: list[tuple[str, int]]) -> DataFrame:
    """word (hash), share: of each word that is not among ``words`` (the most
    frequent ones, in order), the logarithm of its smoothed share of its id."""
    rest = counts.where(F.lit(False))
    if words:
        last, least = words[-1]
        rest = counts.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("w") > last)))
    bucket = F.crc32(F.substring(F.col("w").cast("binary"), -3, 3)) % RARE
    rest = rest.select(F.xxhash64("w").alias("word"), "n", bucket.alias("bucket"))
    # RARE rows at most
    whole = rest.groupBy("bucket").agg((F.sum("n") + UNSEEN * (F.count(F.lit(1)) + 1)).alias("whole"))
    return rest.join(F.broadcast(whole), "bucket").select("word", F.log((F.col("n") + UNSEEN) / F.col("whole")).cast("float").alias("share"))


def inside(tokens: DataFrame, share: DataFrame) -> DataFrame:
    """chunk, at, inside: of each row with shared-id words, the sum of their
    logarithmic shares. ``share`` must hold all words of ``tokens``."""
    listed = tokens.where(F.size("new") > 0).select(F.col("chunk").alias("list"), "start", F.posexplode("new").alias("i", "word"))
    priced = listed.join(share, "word").select("list", (F.col("start") + F.col("i")).alias("place"), "share")

    def sums(rows, priced):
        own = np.full(len(priced), np.nan)
        own[priced.column("place").to_numpy()] = priced.column("share").to_numpy()
        total = [own[np.frombuffer(x.as_buffer(), "<u4")].sum() for x in rows.column("rare")]
        return pa.table([rows.column("chunk"), rows.column("at"), pa.array(total, pa.float64())], names=["chunk", "at", "inside"])

    rows = tokens.where(F.length("rare") > 0).select("chunk", "at", "rare")
    return rows.groupBy("chunk").cogroup(priced.groupBy("list")).applyInArrow(sums, "chunk long, at int, inside double")


class Net:
    """Weights as one vector, with views into it."""

    SHAPES = {"near": (2 * REACH, VOCAB + 1, HIDDEN), "b": (HIDDEN,), "to_class": (HIDDEN, CLASSES), "class_bias": (CLASSES,),
              "to_word": (CLASSES, HIDDEN, PER_CLASS), "word_bias": (CLASSES, PER_CLASS)}
    SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat, self.held, at = flat, {}, 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, flat[at:at + n].reshape(shape))
            at += n

    @classmethod
    def first(cls, counts: list[int], total: int, seed: int = 1) -> Net:
        """Small random weights; biases from the words' frequencies."""
        net = cls((np.random.default_rng(seed).normal(size=cls.SIZE) * 0.05).astype(np.float32))
        freq = np.full(VOCAB, 0.5)
        freq[:len(counts)] += counts
        freq[TOP:] += max(0, total - sum(counts)) / RARE
        by_class = freq.reshape(CLASSES, PER_CLASS)
        net.b[:] = 0
        net.class_bias[:] = np.log(by_class.sum(axis=1) / freq.sum())
        net.word_bias[:] = np.log(by_class / by_class.sum(axis=1, keepdims=True))
        return net

    def room(self, name: str, *shape: int, kind: type = np.float32) -> np.ndarray:
        """An array for intermediate values, in memory that is kept from one batch
        of positions to the next: fresh memory costs about as much as the sums."""
        n = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < n:
            self.held[name] = np.empty(n, kind)
        return self.held[name][:n].reshape(shape)

    def hidden(self, around: np.ndarray) -> np.ndarray:
        """Of neighbours by place and position; held until the next batch."""
        h, row = (self.room(x, around.shape[1], HIDDEN) for x in ("h", "row"))
        h[:] = self.b
        for table, ids in zip(self.near, around):
            # all ids are in the table; "clip" lets take write into row directly
            h += np.take(table, ids, axis=0, out=row, mode="clip")
        return np.tanh(h, out=h)

    def class_logits(self, h: np.ndarray) -> np.ndarray:
        z = np.matmul(h, self.to_class, out=self.room("class", len(h), CLASSES))
        z += self.class_bias
        return z

    def word_logits(self, h: np.ndarray, cuts: list[int]) -> np.ndarray:
        """Logits of the words of each row's class; rows are ordered by class."""
        z = self.room("word", len(h), PER_CLASS)
        for c in range(CLASSES):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                np.matmul(h[a:b], self.to_word[c], out=z[a:b])
                z[a:b] += self.word_bias[c]
        return z

    def log_probs(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        order, cuts = by_class(target)
        h, target = self.hidden(ordered(around, order)), target[order]
        found = log_softmax(self.class_logits(h), target // PER_CLASS, self.room("exps", len(h), CLASSES))
        found += log_softmax(self.word_logits(h, cuts), target % PER_CLASS, self.room("exps", len(h), PER_CLASS))
        out = np.empty_like(found)
        out[order] = found
        return out

    def step(self, grad2: Net, around: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One AdaGrad step on a batch of positions."""
        n = len(target)
        order, cuts = by_class(target)
        around, target = ordered(around, order), target[order]
        h, grad, every = self.hidden(around), Net(self.room("grad", self.SIZE)), np.arange(n)
        err = softmax(self.class_logits(h), self.room("exps", n, CLASSES))
        err.reshape(-1)[every * CLASSES + target // PER_CLASS] -= 1
        dh, part = np.matmul(err, self.to_class.T, out=self.room("dh", n, HIDDEN)), self.room("row", n, HIDDEN)
        ones = np.ones(n, np.float32)
        np.matmul(h.T, err, out=grad.to_class)
        np.matmul(ones, err, out=grad.class_bias)
        # one softmax for all classes: each row has the words of its own
        err = softmax(self.word_logits(h, cuts), self.room("exps", n, PER_CLASS))
        err.reshape(-1)[every * PER_CLASS + target % PER_CLASS] -= 1
        for c in range(CLASSES):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                np.matmul(err[a:b], self.to_word[c].T, out=part[a:b])
                np.matmul(h[a:b].T, err[a:b], out=grad.to_word[c])
                np.matmul(ones[a:b], err[a:b], out=grad.word_bias[c])
            else:
                grad.to_word[c], grad.word_bias[c] = 0, 0
        dh += part
        h *= h
        dh *= np.subtract(1, h, out=h)
        np.matmul(ones, dh, out=grad.b)
        # sums by table cell: a histogram of the cells, weighted by the slopes
        slopes, cells = self.room("slopes", n, HIDDEN, kind=np.float64), self.room("cells", n, HIDDEN, kind=np.intp)
        slopes[:] = dh
        for total, ids in zip(grad.near, around):
            np.take(CELLS, ids, axis=0, out=cells, mode="clip")
            total[:] = np.bincount(cells.ravel(), slopes.ravel(), total.size).reshape(total.shape)
        g, acc, square = grad.flat, grad2.flat, self.room("square", self.SIZE)
        g /= n
        acc += np.multiply(g, g, out=square)
        g *= rate
        g /= np.sqrt(acc, out=square)
        self.flat -= g


def ordered(around: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The neighbours of the positions in ``order``, one row of them for each place."""
    return np.stack([column[order] for column in around.T], dtype=np.intp)


def by_class(target: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order of positions by class and where each class starts."""
    cls = (target // PER_CLASS).astype(np.uint8)
    return np.argsort(cls, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(cls, minlength=CLASSES)))).tolist()


def exps(z: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Writes exp(z - high) to ``e`` and returns its sums by row, and high. One number is
    taken off all rows, which is faster than the largest of each; where a row lies far
    below it, its own."""
    high = z.max()
    np.exp(np.subtract(z, high, out=e), out=e)
    total = e @ np.ones(z.shape[1], z.dtype)
    if total.min() < 1e-20:
        high = z.max(axis=1)
        np.exp(np.subtract(z, high[:, None], out=e), out=e)
        total = e.sum(axis=1)
    return total, high


def softmax(z: np.ndarray, e: np.ndarray) -> np.ndarray:
    """In ``e``."""
    total, _ = exps(z, e)
    e /= total[:, None]
    return e


def log_softmax(z: np.ndarray, at: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Of each row, the logarithmic probability of the entry ``at``; ``e`` is overwritten."""
    total, high = exps(z, e)
    return z[np.arange(len(z)), at] - high - np.log(total)


def contexts(docs_ids: list[np.ndarray], turn: int = 0, rounds: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours and targets of the positions of several documents that are
    targets in round ``turn`` of ``rounds``; by default of all positions."""
    gap = np.full(REACH, PAD, np.uint16)
    flat = np.concatenate([x for d in docs_ids for x in (gap, d)] + [gap])
    at = np.flatnonzero(flat != PAD)
    if rounds > 1:
        at = at[targets(docs_ids, turn, rounds)]
    # by place: a place's ids lie side by side
    return np.stack([flat[at + o] for o in range(-REACH, REACH + 1) if o]).T, flat[at]


def _batches(batches, most: int):
    """Lists of id arrays of about ``most`` tokens; a longer document is alone."""
    held, n = [], 0
    for b in batches:
        for x in b.column(b.num_columns - 1):
            ids = np.frombuffer(x.as_buffer(), "<u2") if x.is_valid else np.zeros(0, np.uint16)
            held.append(ids)
            n += len(ids)
            if n >= most:
                yield held
                held, n = [], 0
    if held:
        yield held


def targets(docs_ids: list[np.ndarray], turn: int, rounds: int) -> np.ndarray:
    """Which positions of several documents are targets in round ``turn``."""
    return np.concatenate([np.arange(len(d)) for d in docs_ids]) % rounds == turn


def trained(tokens: DataFrame, net: Net, rounds: int = 2, rate: float = 0.1) -> Net:
    for turn in range(rounds):
        start = net.flat

        def learn(own, acc, parts):
            a, t = (np.concatenate(x) for x in zip(*parts))
            # steps of like size, of STEP positions or somewhat more
            for a, t in zip(*(np.array_split(x, max(1, len(t) // STEP)) for x in (a, t))):
                own.step(acc, a, t, rate)

        def train(batches, start=start, turn=turn):
            own, acc, seen = Net(start.copy()), Net(np.full(Net.SIZE, 1e-4, np.float32)), 0
            # targets of many documents make a batch, so that steps are of like size
            parts, n = [], 0
            for docs in _batches(batches, CHUNK):
                parts.append(contexts(docs, turn, rounds))
                n += len(parts[-1][1])
                if n >= STEP:
                    learn(own, acc, parts)
                    seen, parts, n = seen + n, [], 0
            if n:
                learn(own, acc, parts)
                seen += n
            if seen:
                cut = range(0, Net.SIZE, PART)
                yield pa.record_batch([pa.array([seen] * len(cut), pa.int64()), pa.array(range(len(cut)), pa.int32()),
                                       pa.array([own.flat[i:i + PART].tobytes() for i in cut], pa.binary())], names=["n", "part", "flat"])

        def average(batches):
            sums: dict[int, list] = {}
            for b in batches:
                for n, part, flat in zip(*(b.column(i).to_pylist() for i in range(3))):
                    s = sums.setdefault(part, [0, 0.0])
                    s[0] += n
                    s[1] = s[1] + n * np.frombuffer(flat, "<f4").astype(np.float64)
            done = sorted(sums.items())
            yield pa.record_batch([pa.array([p for p, _ in done], pa.int32()),
                                   pa.array([(s / n).astype("<f4").tobytes() for _, (n, s) in done], pa.binary())], names=["part", "flat"])

        sent = tokens.select("ids").mapInArrow(train, "n long, part int, flat binary").withColumn("task", F.spark_partition_id())
        # a partition holds few parts; their rows are summed as they come, in task order
        sent = sent.repartition("part").sortWithinPartitions("part", "task").select("n", "part", "flat")
        got = {r["part"]: r["flat"] for r in sent.mapInArrow(average, "part int, flat binary").collect()}
        if got:
            net = Net(np.concatenate([np.frombuffer(got[i], "<f4") for i in sorted(got)]).copy())
    return net


def scores(tokens: DataFrame, net: Net, within: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, log_prob (sum over tokens), mean_log_prob; of the ids
    alone, or with what ``within`` (see ``inside``) adds for the words."""
    schema = T.StructType([tokens.schema["doc_id"], T.StructField("chunk", T.LongType()), T.StructField("at", T.IntegerType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType())])
    flat = net.flat

    def run(batches):
        own = Net(flat)
        for b in batches:
            sums, sizes = [], []
            for docs in _batches([b], CHUNK):
                around, target = contexts(docs)
                lp = np.concatenate([own.log_probs(around[i:i + SCORED], target[i:i + SCORED]) for i in range(0, len(target), SCORED)] or [np.zeros(0)])
                size = np.array([len(d) for d in docs])
                upto = np.concatenate(([0.0], np.cumsum(lp, dtype=np.float64)))
                ends = np.cumsum(size)
                sums.append(upto[ends] - upto[ends - size])
                sizes.append(size)
            n = np.concatenate(sizes or [np.zeros(0, np.int64)])
            s = np.concatenate(sums or [np.zeros(0)])
            yield pa.record_batch([*b.columns[:3], pa.array(n, pa.int64()), pa.array(s, pa.float64())], names=schema.names)

    out = tokens.select("doc_id", "chunk", "at", "ids").mapInArrow(run, schema)
    total = F.col("log_prob")
    if within is not None:
        out = out.join(within, ["chunk", "at"], "left")
        total = total + F.coalesce("inside", F.lit(0.0))
    out = out.select("doc_id", "n_tokens", F.round(total, 4).alias("log_prob"))
    mean = F.when(F.col("n_tokens") > 0, F.round(F.col("log_prob") / F.col("n_tokens"), 4))
    return out.select("*", mean.alias("mean_log_prob"))


def scored(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """Train on all rows of ``docs`` and score all of them."""
    counts = word_counts(docs)
    words = most_frequent(counts)
    tokens = stored(token_ids(docs, [w for w, _ in words]), "tokens")
    total = tokens.agg(F.sum(F.length("ids") / 2).cast("long")).first()[0] or 0
    net = trained(tokens, Net.first([n for _, n in words], total), rounds)
    return scores(tokens, net, inside(tokens, shares(counts, words)))

"""A gated recurrent language model with a class-factored output, scoring whole documents.

A token's probability is P(class | state) P(token | class). The most frequent words and
the document's end are classes of their own; every other word falls into a class by its
last letters, where its probability is its smoothed share of the class's training tokens.
The recurrent network sees and predicts classes, so its size does not depend on the
vocabulary, and the shares are exact counts over all training documents.

The network is trained in numpy by back-propagation through windows of fixed length; the
state is carried from window to window of a document, in training without a gradient
across the border, in scoring exactly. Training starts on a bounded sample; then every
task trains on its own part of all training documents and the weights are averaged,
weighted by tokens.

Counts of frequent words are known to every task (a bounded table); those of the rest come
by a join of each document's distinct rare words with the count table.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import SAMPLE_TEXT_BYTES, remainder
from .support import LETTERS_LOWER, LETTERS_UPPER, stored

#: Classes: frequent words, the end, and words by their last letters.
FREQUENT, SHAPES, SUFFIX = 79, 48, 3
END, CLASSES = FREQUENT, FREQUENT + 1 + SHAPES
START = CLASSES
HIDDEN, WINDOW = 24, 16
TRAIN_LANES, SCORE_LANES = 128, 512
#: Documents of the sample that training starts on, and passes over it.
SAMPLE_DOCS, SAMPLE_PASSES = 600, 4
FIRST_RATE, TASK_RATE = 0.01, 0.002
#: Words whose counts every task knows; words that a task counts before it hands them on.
HEAD_WORDS, COUNTED_WORDS = 100_000, 200_000
#: Tokens that a task lays out at once.
BLOCK_TOKENS = 1_000_000
_LOWER = bytes.maketrans(LETTERS_UPPER.encode(), LETTERS_LOWER.encode())
_LN10 = float(np.log(10))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_LOWER).split() if text else []


def shape_of(word: bytes) -> int:
    """The class of a word that is none of its own."""
    return END + 1 + zlib.crc32(word[-SUFFIX:]) % SHAPES


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class GatedNetwork:
    """One gated recurrent layer between class inputs and a softmax over classes."""

    SHAPES = {"inputs": (CLASSES + 1, 3 * HIDDEN), "state": (HIDDEN, 3 * HIDDEN), "output": (HIDDEN, CLASSES), "bias": (CLASSES,)}

    def __init__(self, weights: np.ndarray | None = None):
        sizes = [int(np.prod(s)) for s in self.SHAPES.values()]
        if weights is None:
            weights = np.random.default_rng(1).normal(0, 0.1, sum(sizes))
        self.weights = np.array(weights, np.float32)
        parts = np.split(self.weights, np.cumsum(sizes)[:-1])
        self.inputs, self.state, self.output, self.bias = (p.reshape(s) for p, s in zip(parts, self.SHAPES.values()))
        self.first = np.zeros_like(self.weights)
        self.second = np.zeros_like(self.weights)
        self.steps = 0

    def _step(self, a: np.ndarray, h: np.ndarray) -> tuple:
        g = h @ self.state
        gates = _sigmoid(a[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(a[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
        return n + z * (h - n), z, r, n, g[:, 2 * HIDDEN :]

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray, keep: np.ndarray, h: np.ndarray) -> tuple:
        """Mean negative log-likelihood of a window, its gradient, and the state after it.

        ``x``, ``y``, ``keep`` are (time, lane): inputs, targets (negative where a lane has
        ended) and 0 where a document begins.
        """
        steps, lanes = x.shape
        saved, states = [], np.empty((steps, lanes, HIDDEN), np.float32)
        for t in range(steps):
            before = h * keep[t][:, None]
            h, z, r, n, u = self._step(self.inputs[x[t]], before)
            saved.append((before, z, r, n, u))
            states[t] = h
        flat, target = states.reshape(-1, HIDDEN), y.reshape(-1)
        valid = target >= 0
        count = max(1, int(valid.sum()))
        logits = flat @ self.output + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        total = p.sum(axis=1, keepdims=True)
        rows = np.arange(len(target))
        loss = float((np.log(total[:, 0]) - logits[rows, np.maximum(target, 0)])[valid].sum()) / count
        p /= total
        p[rows, np.maximum(target, 0)] -= 1
        p[~valid] = 0
        p /= count
        gradient = np.zeros_like(self.weights)
        d = GatedNetwork._views(gradient)
        d["output"] += flat.T @ p
        d["bias"] += p.sum(axis=0)
        into = (p @ self.output.T).reshape(steps, lanes, HIDDEN)
        dh = np.zeros((lanes, HIDDEN), np.float32)
        da_all = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            before, z, r, n, u = saved[t]
            dh = dh + into[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * u * r * (1 - r)
            da = da_all[t]
            da[:, :HIDDEN], da[:, HIDDEN : 2 * HIDDEN], da[:, 2 * HIDDEN :] = dz, dr, dn
            dg = np.concatenate([dz, dr, dn * r], axis=1)
            d["state"] += before.T @ dg
            dh = (dh * z + dg @ self.state.T) * keep[t][:, None]
        order = np.argsort(x.reshape(-1), kind="stable")
        used, begins = np.unique(x.reshape(-1)[order], return_index=True)
        d["inputs"][used] = np.add.reduceat(da_all.reshape(-1, 3 * HIDDEN)[order], begins, axis=0)
        return loss, gradient, h

    @classmethod
    def _views(cls, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in cls.SHAPES.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def update(self, gradient: np.ndarray, rate: float) -> None:
        norm = float(np.sqrt((gradient * gradient).sum()))
        gradient = gradient * min(1.0, 5.0 / (norm + 1e-9))
        self.steps += 1
        self.first += 0.1 * (gradient - self.first)
        self.second += 0.001 * (gradient * gradient - self.second)
        size = rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        self.weights -= size * self.first / (np.sqrt(self.second) + 1e-8)

    def train(self, documents: list[np.ndarray], rate: float) -> int:
        """One pass over documents (arrays of classes that end with END); tokens seen."""
        if not documents:
            return 0
        y = np.concatenate(documents)
        begins = np.zeros(len(y), bool)
        begins[np.cumsum([0, *map(len, documents[:-1])])] = True
        x = np.where(begins, START, np.roll(y, 1))
        lanes = min(TRAIN_LANES, len(y))
        length = -(-len(y) // lanes)
        pad = lanes * length - len(y)
        x, begins = np.append(x, np.full(pad, START)), np.append(begins, np.ones(pad, bool))
        targets = np.append(y, np.full(pad, -1))
        x, targets, keep = (v.reshape(lanes, length).T for v in (x, targets, (~begins).astype(np.float32)))
        h = np.zeros((lanes, HIDDEN), np.float32)
        for at in range(0, length, WINDOW):
            part = slice(at, at + WINDOW)
            _, gradient, h = self.loss_and_gradient(x[part], targets[part], keep[part], h)
            self.update(gradient, rate)
        return len(y)

    def log_likelihoods(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each document's classes, from the empty state on.

        Documents are dealt to lanes, longest first to the lane that is shortest; lanes run
        side by side, a lane that has ended drops out. The state is reset where a document
        begins and carried through all windows of it.
        """
        order = sorted(range(len(documents)), key=lambda k: -len(documents[k]))
        heap = [(0, lane) for lane in range(min(SCORE_LANES, len(documents)))]
        dealt: list[list[int]] = [[] for _ in heap]
        for k in order:
            used, lane = heapq.heappop(heap)
            dealt[lane].append(k)
            heapq.heappush(heap, (used + len(documents[k]), lane))
        dealt.sort(key=lambda ks: -sum(len(documents[k]) for k in ks))
        if not documents:
            return np.zeros(0)
        lengths = np.array([sum(len(documents[k]) for k in ks) for ks in dealt])
        laid = [k for ks in dealt for k in ks]
        y_all = np.concatenate([documents[k] for k in laid])
        sizes = np.array([len(documents[k]) for k in laid])
        x_all = np.append(START, y_all[:-1])
        x_all[np.cumsum(sizes) - sizes] = START
        offsets = np.cumsum(lengths) - lengths
        log_p = np.zeros(len(y_all))
        h = np.zeros((len(dealt), HIDDEN), np.float32)
        for at in range(0, int(lengths.max()), WINDOW):
            lanes = int((lengths > at).sum())
            n = np.minimum(lengths[:lanes] - at, WINDOW)
            times = np.arange(int(n.max()))[:, None]
            valid = times < n
            place = np.where(valid, offsets[:lanes] + at + times, 0)
            x, y = x_all[place], y_all[place]
            h = h[:lanes]
            states = np.empty((*x.shape, HIDDEN), np.float32)
            for t in range(len(x)):
                h = self._step(self.inputs[x[t]], h * (x[t] != START)[:, None])[0]
                states[t] = h
            logits = states.reshape(-1, HIDDEN) @ self.output + self.bias
            chosen = logits[np.arange(y.size), y.reshape(-1)]
            highest = logits.max()
            if highest - logits.min() > 80:
                highest = logits.max(axis=1)
                total = np.log(np.exp(logits - highest[:, None]).sum(axis=1))
            else:
                logits -= highest
                total = np.log(np.exp(logits, out=logits).sum(axis=1))
            log_p[place[valid]] = (chosen - highest - total).reshape(x.shape)[valid]
        return np.bincount(np.repeat(laid, sizes), log_p, len(documents))


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """``(word, c)`` over all rows of ``docs``; the end of a document is the empty word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])

        for batch in batches:
            for t in batch.column(0):
                counts.update(words_of(t.as_py()))
                counts[b""] += 1
                if len(counts) >= COUNTED_WORDS:
                    yield rows()
                    counts.clear()
        if counts:
            yield rows()

    return docs.select(F.col(text).alias("text")).mapInArrow(counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, most: int = HEAD_WORDS) -> list[tuple[str, int]]:
    """At most ``most`` of the most frequent words, by count and then by word.

    A histogram of the logarithms of the counts says from which step on the words fit; only
    those are fetched, so no task sends its own list of candidates to the driver.
    """
    step = F.floor(F.log2("c") * 32)
    by_step = sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"])
    total, least = 0, None
    for r in by_step:
        total += r["count"]
        if total > most:
            break
        least = r["step"]
    if least is None:
        return []
    rows = counts.filter(step >= F.lit(least)).collect()
    return sorted(((r.word, r.c) for r in rows), key=lambda x: (-x[1], x[0]))


class Vocabulary:
    """What every task knows: counts and classes of the most frequent words."""

    def __init__(self, head: list[tuple[str, int]]):
        words = [(w.encode(), c) for w, c in head]
        self.place = {w: k for k, (w, _) in enumerate(words)}
        frequent = [w for w, _ in words if w][:FREQUENT]
        own = {w: k for k, w in enumerate(frequent)} | {b"": END}
        self.count = np.array([c for _, c in words] or [0], np.int64)
        self.kind = np.array([own[w] if w in own else shape_of(w) for w, _ in words] or [0], np.int64)
        self.frequent = set(own)

    def classes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, Counter]:
        """Classes of a document's tokens with its end, places in the head, rare words."""
        places = np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))
        kinds = self.kind[places]
        rare = np.flatnonzero(places < 0)
        unknown = [words[k] for k in rare]
        kinds[rare] = [shape_of(w) for w in unknown]
        return np.append(kinds, END), places[places >= 0], Counter(unknown)


def _sample(docs: DataFrame, key: str, text: str) -> list[str]:
    """About ``SAMPLE_DOCS`` texts, those with the least hashes of key and text."""
    short = docs.filter(F.octet_length(text) <= SAMPLE_TEXT_BYTES)
    n = short.count()
    if not n:
        return []
    least = F.pmod(F.xxhash64(key, text), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE_DOCS / n)))
    return [r[0] for r in short.filter(least).select(text).orderBy(F.xxhash64(text), text).limit(2 * SAMPLE_DOCS).collect()]


def train_network(training: DataFrame, vocabulary, key: str, text: str) -> np.ndarray:
    """Weights after the sample and one averaged pass of all tasks over all training documents."""
    network = GatedNetwork()
    sample = [vocabulary.value.classes(words_of(t))[0] for t in _sample(training, key, text)]
    for _ in range(SAMPLE_PASSES):
        network.train(sample, FIRST_RATE)
    begin = network.weights.copy()

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tokens, block, size = GatedNetwork(begin), 0, [], 0
        for batch in batches:
            for t in batch.column(0):
                block.append(vocabulary.value.classes(words_of(t.as_py()))[0])
                size += len(block[-1])
                if size >= BLOCK_TOKENS:
                    tokens += own.train(block, TASK_RATE)
                    block, size = [], 0
        tokens += own.train(block, TASK_RATE)
        if tokens:
            weights = pa.array([own.weights.astype(np.float64)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([weights, pa.array([tokens], pa.int64())], ["weights", "tokens"])

    parts = training.select(text).mapInArrow(trained, "weights array<double>, tokens long")
    cells = parts.select("tokens", F.posexplode("weights").alias("place", "weight"))
    mean = (F.sum(F.col("weight") * F.col("tokens")) / F.sum("tokens")).alias("weight")
    rows = cells.groupBy("place").agg(mean).toArrow()
    if not rows.num_rows:
        return begin
    weights = np.empty(len(begin))
    weights[rows.column("place").to_numpy()] = rows.column("weight").to_numpy()
    return weights.astype(np.float32)


def score_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", modulus: int = 7, held: int = 2) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Scores are log10 probabilities of whole texts with their end. A null or empty text is
    the end alone. A null key is not held out. Repeated rows are scored row by row; an
    empty table gives no rows. Without any training document nothing is known: the base
    gives every token probability one and the network is untrained.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (remainder(key, modulus) == held).alias("held_out"))
    training = rows.filter(~F.col("held_out"))
    counts = stored(count_words(training, "text"), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head = frequent_words(counts)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(head))
    shape_n, shape_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for kind, tokens, words in _shape_totals(counts, vocabulary):
        shape_n[kind], shape_v[kind] = tokens, words
    weights = train_network(training, vocabulary, "key", "text")
    base_total = n + v + 1

    def inside(kind, c):
        """log10 of a token's share of its class."""
        share = np.log10((c + 1) / (shape_n[kind] + shape_v[kind] + 1))
        return np.where(kind <= END, 0.0, share)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, network = vocabulary.value, GatedNetwork(weights)
        head_base = np.log10((known.count + 1) / base_total)
        head_inside = inside(known.kind, known.count)
        end = known.place.get(b"")
        end_base = float(head_base[end]) if end is not None else float(np.log10(1 / base_total))
        names = ["row", "key", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "rare_n"]

        def settle(block: list) -> pa.RecordBatch:
            likelihoods = network.log_likelihoods([b[3] for b in block]) / _LN10
            columns = [list(c) for c in zip(*((*b[:3], len(b[3]), b[4], b[5], b[6] + s, list(b[7]), list(b[7].values())) for b, s in zip(block, likelihoods)))]
            kinds = [pa.int64(), keys, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            columns[7] = [[w.decode() for w in ws] for ws in columns[7]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        block, size = [], 0
        for batch in batches:
            keys = batch.column(1).type
            for row, k, t, h in zip(*(c for c in batch.columns)):
                kinds, places, rare = known.classes(words_of(t.as_py()))
                base = float(head_base[places].sum()) + end_base
                block.append((row.as_py(), k.as_py(), h.as_py(), kinds, len(places) + (end is not None), base, float(head_inside[places].sum()), rare))
                size += len(kinds)
                if size >= BLOCK_TOKENS:
                    yield settle(block)
                    block, size = [], 0
        if block:
            yield settle(block)

    key_type = docs.schema[key].dataType.simpleString()
    schema = f"row long, key {key_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<string>, rare_n array<long>"
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "key", "text", "held_out")
    partial = stored(numbered.mapInArrow(scored, schema), "document-scores")
    rare = partial.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("n"))
    met = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    totals = F.array(*[F.lit(float(a + b + 1)) for a, b in zip(shape_n, shape_v)])
    total = F.get(totals, _shape_column())
    added = met.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(base_total)))).alias("more_base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / total)).alias("more_score"),
    )
    zero = F.lit(0)
    return partial.join(added, F.col("row") == F.col("of"), "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def _shape_column() -> Column:
    """``shape_of`` of the column ``word``."""
    last = F.unhex(F.expr(f"right(hex(encode(word, 'UTF-8')), {2 * SUFFIX})"))
    return (F.lit(END + 1) + F.crc32(last) % SHAPES).cast("int")


def _shape_totals(counts: DataFrame, vocabulary) -> list:
    """Training tokens and distinct words of each class by last letters."""
    frequent = [w.decode() for w in vocabulary.value.frequent]
    rest = counts.filter(~F.col("word").isin(frequent)).select(_shape_column().alias("kind"), "c")
    return [tuple(r) for r in rest.groupBy("kind").agg(F.sum("c"), F.count(F.lit(1))).collect()]

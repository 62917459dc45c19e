"""Language-model scoring: masked pseudo-likelihood from a bidirectional window network trained in numpy.

The network predicts a word from the words on both sides: the vectors of the neighbours, one table for each place,
are summed, bent by tanh, and a softmax in two steps (a class of words, then an entry of the class) gives a conditional
probability. The ``words`` most frequent words have entries of their own; all others share ``rare`` entries by their
hash, and the probability of such a word is that of its entry times the word's share of the entry's occurrences. So
every word of the corpus has a probability, whatever its size. A document's score sums the conditional
log-probabilities of all its words, each hidden in its turn.

* Words are counted over all documents, pre-aggregated in each task, in a shuffle that grows with the corpus; the counts
  of rare words stay in a table and are joined to the words of the documents.
* Training is distributed: all documents are dealt by hash to copies of the network, as many as the corpus has times
  ``copy_words`` words; a task trains each, and the copies are averaged by the words they saw, block of parameters by
  block. This is repeated ``rounds`` times. Gradients of a batch are summed by row, and each row has a step of its own
  (by its squares so far). A copy sees its documents in order of a hash, so the result depends on the table alone, not
  on how Spark had split it.
* Scoring is a narrow Arrow map over all documents with the averaged network, a few MB whatever the corpus, and one join
  of rare words.

Defined results: a null or empty text has no words and scores 0 with a mean of 0; equal texts have equal scores (but
for rounding); a word that the fitted corpus lacks counts as if it had occurred once; a corpus without words gives an untrained network.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import filterfalse, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Tables, slices, texts_of


@dataclass(frozen=True)
class Settings:
    """``words`` and ``rare``: entries of the network; ``copy_words``: words that a copy of it is trained on, about."""

    words: int = 3_584
    rare: int = 508
    classes: int = 64
    window: int = 2
    dim: int = 16
    copy_words: int = 4_000_000
    rounds: int = 1
    batch: int = 16_384
    rate: float = 0.1
    seed: int = 7

    @property
    def entries(self) -> int:
        return self.words + self.rare + 4  # and an edge of the text; a multiple of ``classes``


def words_of(text: str) -> list[str]:
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                counts.update(words_of(text))
            if len(counts) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return texts_of(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def utf8(words: list[str]) -> Iterator[bytes]:
    return map(str.encode, words, repeat("utf-8"), repeat("surrogatepass"))


class Numbers(dict):
    """Word -> entry. Entry 0 is the edge of a text; rare words share entries by hash."""

    def __init__(self, words: list[str], s: Settings) -> None:
        super().__init__((w, i + 1) for i, w in enumerate(words))
        self.s = s

    def get_all(self, text: str) -> np.ndarray:
        found = words_of(text)
        get, first, rare = self.get, self.s.words + 1, self.s.rare
        return np.fromiter((i if (i := get(w)) is not None else first + zlib.crc32(w.encode("utf-8", "surrogatepass")) % rare for w in found), np.int64, len(found))

    def sequence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries of all texts with ``window`` edges before, between and after them; the words' places; words of each text."""
        w, lists = self.s.window, [self.get_all(t) for t in texts]
        n = np.array([len(x) for x in lists], np.int64)
        edge = np.zeros(w, np.int64)
        seq = np.concatenate([edge, *(y for x in lists for y in (x, edge))])
        return seq, np.arange(n.sum()) + np.repeat(w * np.arange(1, len(n) + 1), n), n


#: Rows of a batch that meet all classes at once: what is worked out of them stays in a core's cache.
ROWS = 2_048


def exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.float32]:
    """In its place, ``exp`` of a matrix less its largest value, the sum of each row, and that value (0 where it lies in 0 to 20,
    which changes no row for the worse). Rows of one batch lie far closer together than float32 reaches."""
    top = x.max()
    if 0 <= top < 20:
        top = np.float32(0)
    else:
        x -= top
    np.exp(x, out=x)
    return x, np.maximum(x @ np.ones(x.shape[1], x.dtype), np.float32(1e-30)), top


class Network:
    """Parameters: ``around`` (place, entry, dim), ``bias`` (dim), ``top`` (dim + 1, classes), ``low`` (classes, dim + 1, entries of a class)."""

    def __init__(self, s: Settings, flat: np.ndarray | None = None) -> None:
        self.s = s
        per = -(-s.entries // s.classes)
        shapes = {"around": (2 * s.window, per * s.classes, s.dim), "bias": (s.dim,), "top": (s.dim + 1, s.classes), "low": (s.classes, s.dim + 1, per)}
        if flat is None:
            rng = np.random.default_rng(s.seed)
            flat = np.concatenate([(rng.normal(0, 0.1, np.prod(x)) if k != "bias" else np.zeros(x)).ravel() for k, x in shapes.items()]).astype(np.float32)
        self.flat, at = flat.astype(np.float32).copy(), 0
        for name, shape in shapes.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size
        self.squares = {k: np.full(x[:2] if k == "around" else x, 1e-2, np.float32) for k, x in shapes.items()}
        self.space = np.empty(s.batch * max(per, s.classes), np.float32)
        self.offsets = [k for k in range(-s.window, s.window + 1) if k]

    def start_at(self, counts: np.ndarray) -> Network:
        """Sets the biases of both softmaxes so that the network first gives each entry its frequency."""
        logs = np.log(counts + 1.0).reshape(-1, self.s.classes)  # row: place in a class; column: class
        self.low[:, -1, :] = logs.T
        self.low[:, :-1, :] *= 0.1
        self.top[-1] = np.log(np.exp(logs).sum(0))
        self.top[:-1] *= 0.1
        return self

    def neighbours(self, seq: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
        """The entries beside each place, offset by offset."""
        return [seq.take(places + k) for k in self.offsets]

    def hidden(self, near: list[np.ndarray]) -> np.ndarray:
        """A row for each place, with a last 1, from its :meth:`neighbours`."""
        h = np.ones((len(near[0]), self.s.dim + 1), np.float32)
        for a in range(0, len(h), ROWS):
            total = self.bias + self.around[0].take(near[0][a : a + ROWS], 0)
            for table, entries in zip(self.around[1:], near[1:], strict=True):
                total += table.take(entries[a : a + ROWS], 0)
            np.tanh(total, out=h[a : a + ROWS, :-1])
        return h

    def logits(self, h: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Their product, in a place that the next one takes over."""
        return np.matmul(h, weights, out=self.space[: len(h) * weights.shape[1]].reshape(len(h), -1))

    def by_class(self, entries: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """An order that puts entries of one class together, and (class, begin, end) of those that occur."""
        classes = (entries % self.s.classes).astype(np.uint16)
        order = np.argsort(classes, kind="stable")
        edges = [0, *np.cumsum(np.bincount(classes, minlength=self.s.classes)).tolist()]
        return order, [(g, a, b) for g, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]

    def log_probabilities(self, seq: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Log-probability of the entry at each place given its neighbours."""
        out = np.empty(len(places), np.float64)
        for a in range(0, len(places), self.s.batch):
            part = places[a : a + self.s.batch]
            entries = seq.take(part)
            order, groups = self.by_class(entries)
            part, entries = part[order], entries[order]
            h, word = self.hidden(self.neighbours(seq, part)), entries // self.s.classes
            p, rows, classes = np.empty(len(part), np.float32), np.arange(len(part)), entries % self.s.classes
            for i in range(0, len(part), ROWS):
                x = self.logits(h[i : i + ROWS], self.top)
                own = x[rows[: len(x)], classes[i : i + ROWS]]
                _, total, top = exponentials(x)
                p[i : i + ROWS] = own - top - np.log(total)
            for g, i, j in groups:
                x = self.logits(h[i:j], self.low[g])
                own = x[rows[: j - i], word[i:j]]
                _, total, top = exponentials(x)
                p[i:j] += own - top - np.log(total)
            out[a + order] = p
        return out

    def move(self, name: str, index: object, gradient: np.ndarray) -> None:
        """A step against a gradient; ``around`` has one step size for each row, the others one for each number."""
        squares = self.squares[name]
        squares[index] += (gradient**2).mean(-1) if name == "around" else gradient**2
        root = np.sqrt(squares[index])
        getattr(self, name)[index] -= self.s.rate * gradient / (root[:, None] if name == "around" else root)

    def train(self, seq: np.ndarray, places: np.ndarray) -> None:
        """One pass of batches; gradients of all parameters at once."""
        s = self.s
        for a in range(0, len(places), s.batch):
            part = places[a : a + s.batch]
            entries = seq.take(part)
            order, groups = self.by_class(entries)
            part, entries = part[order], entries[order]
            near = self.neighbours(seq, part)
            h, word, rows = self.hidden(near), entries // s.classes, np.arange(len(part))
            classes, back, gradient = entries % s.classes, np.empty((len(part), s.dim), np.float32), np.zeros_like(self.top)
            for i in range(0, len(part), ROWS):
                error, total, _ = exponentials(self.logits(h[i : i + ROWS], self.top))
                error[rows[: len(error)], classes[i : i + ROWS]] -= total
                total = 1 / total[:, None]
                np.multiply(error @ self.top[:-1].T, total, out=back[i : i + ROWS])
                gradient += (h[i : i + ROWS] * total).T @ error
            self.move("top", slice(None), gradient)
            gradient = np.zeros_like(self.low)
            for g, i, j in groups:
                e, total, _ = exponentials(self.logits(h[i:j], self.low[g]))
                e[rows[: j - i], word[i:j]] -= total
                total = 1 / total[:, None]
                back[i:j] += (e @ self.low[g, :-1].T) * total
                gradient[g] = (h[i:j] * total).T @ e
            self.move("low", slice(None), gradient)
            back *= 1 - h[:, :-1] ** 2
            self.move("bias", slice(None), back.sum(0))
            columns, size = np.ascontiguousarray(back.T, np.float64), self.around.shape[1]
            for place, beside in enumerate(near):
                met = np.flatnonzero(np.bincount(beside, minlength=size))
                sums = np.array([np.bincount(beside, column, size) for column in columns])
                self.move("around", (place, met), sums[:, met].T.astype(np.float32))


@dataclass(frozen=True)
class Model:
    """``occurrences``: of all words of each rare entry; ``counts``: ``hash, n`` of the rare words that occur twice."""

    vocabulary: list[str]
    flat: np.ndarray
    settings: Settings
    occurrences: np.ndarray
    counts: DataFrame


BLOCK = 16_384


def train_round(dealt: DataFrame, vocabulary: list[str], flat: np.ndarray, s: Settings) -> np.ndarray:
    """The average of the copies that the tasks trained, weighted by the words they saw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, net, seen = Numbers(vocabulary, s), Network(s, flat), 0
        for batch in slices(batches):
            seq, places, n = numbers.sequence(batch.column("text").to_pylist())
            net.train(seq, np.random.default_rng(s.seed).permutation(places))
            seen += int(n.sum())
        if seen:
            blocks = range(0, len(net.flat), BLOCK)
            values = [net.flat[a : a + BLOCK].astype(np.float64) * seen for a in blocks]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([seen] * len(blocks), pa.int64()), pa.array([v.astype(np.float32).tobytes() for v in values], pa.binary())], ["block", "seen", "weighted"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row comes from each task, each of a fixed size, and they are added as they come."""
        total, seen = None, 0
        for batch in batches:
            for n, blob in zip(batch.column("seen").to_pylist(), batch.column("weighted").to_pylist(), strict=True):
                values = np.frombuffer(blob, np.float32).astype(np.float64)
                total, seen = values if total is None else total + values, seen + n
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())], ["block", "mean"])

    copies = dealt.mapInArrow(run, "block int, seen long, weighted binary")
    rows = copies.groupBy("block").applyInArrow(add, "block int, mean binary").collect()  # the network once
    if not rows:
        return flat
    return np.concatenate([np.frombuffer(r["mean"], np.float32) for r in sorted(rows, key=lambda r: r["block"])])


def fit(docs: DataFrame, s: Settings | None = None) -> Model:
    s, t = s or Settings(), Tables(docs.sparkSession, "language-model")
    counts = t.write(word_counts(docs), "words")
    frequent = np.zeros(s.entries)
    common = []
    for i, r in enumerate(counts.orderBy(F.desc("n"), "word").limit(s.words).collect()):
        common.append(r["word"])
        frequent[i + 1] = r["n"]
    rare = counts.where(~F.col("word").isin(common)) if common else counts
    occurrences = np.zeros(s.rare)
    for r in rare.groupBy(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(s.rare)).alias("entry")).agg(F.sum("n").alias("n")).collect():  # a row for each entry
        occurrences[r["entry"]] = r["n"]
    frequent[s.words + 1 : s.words + 1 + s.rare] = occurrences
    flat, copies = Network(s).start_at(frequent).flat, int(frequent.sum()) // s.copy_words + 1
    key = F.xxhash64("text", "doc_id")  # copies of a text have ids of their own and spread
    dealt = texts_of(docs).withColumn("key", key).repartitionById(copies, F.pmod("key", F.lit(copies)).cast("int")).sortWithinPartitions("key").select("text")
    for _ in range(s.rounds):
        flat = train_round(dealt, common, flat, s)
    again = t.write(rare.where("n > 1").select(F.xxhash64("word").alias("hash"), "n"), "rare")
    t.drop(counts)
    return Model(common, flat, s, occurrences, again)


def rare_words(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``hash, text_key, times`` of the rare words of each text (rows that repeat a text repeat its words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(vocabulary)
        for batch in slices(batches):
            found, times, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                counts = Counter(filterfalse(known.__contains__, words_of(text)))
                found += counts
                times += counts.values()
                sizes.append(len(counts))
            keys = np.repeat(batch.column("text_key").to_numpy(), sizes)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, utf8(found), repeat(42)), np.uint64, len(found)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(keys), pa.array(times, pa.int32())], ["hash", "text_key", "times"])

    return texts.mapInArrow(run, "hash long, text_key long, times int")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_words, score, mean_score``: the sum of conditional log-probabilities and their mean."""
    s, t = model.settings, Tables(docs.sparkSession, "scores")
    vocabulary, flat, occurrences = model.vocabulary, model.flat, model.occurrences

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, net = Numbers(vocabulary, s), Network(s, flat)
        share = np.zeros(s.entries)  # of one occurrence in its entry
        share[s.words + 1 : s.words + 1 + s.rare] = -np.log(np.maximum(occurrences, 1))
        for batch in slices(batches):
            seq, places, n = numbers.sequence(batch.column("text").to_pylist())
            p = np.concatenate([[0.0], np.cumsum(net.log_probabilities(seq, places) + share[seq[places]])])
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(p[ends] - p[ends - n])], ["doc_id", "text_key", "n_words", "score"])

    texts = texts_of(docs).withColumn("text_key", F.xxhash64("text"))
    told = t.write(texts.mapInArrow(run, "doc_id long, text_key long, n_words long, score double"), "told")
    # Rare words that occur more often have as many times the share of one occurrence.
    # Their counts, at most a row for each word that a partition meets, are looked up by hash: the far more rows of texts need no sort.
    more = rare_words(texts, vocabulary).join(model.counts.hint("shuffle_hash"), "hash").groupBy("text_key").agg(F.sum(F.col("times") * F.log("n")).alias("more"))
    copies = told.groupBy("text_key").agg(F.count("*").alias("copies"))
    more = t.write(more.join(copies, "text_key").select("text_key", (F.col("more") / F.col("copies")).alias("more")), "more")
    total = F.col("score") + F.coalesce("more", F.lit(0.0))
    mean = F.when(F.col("n_words") > 0, total / F.col("n_words")).otherwise(F.lit(0.0))
    return told.join(more, "text_key", "left").select("doc_id", "n_words", F.when(F.col("n_words") > 0, total).otherwise(F.lit(0.0)).alias("score"), mean.alias("mean_score"))

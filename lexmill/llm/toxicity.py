"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (hashed, with word-end marks), a run of ``window`` words is the
mean of its words (a shorter text is one run), and a two-class softmax over that mean gives the run's probability. Runs begin at
every word, so a word put before a text changes no other run. A document's score pools its runs smoothly (log-mean-exp while training, maximum while scoring), so a few
abusive words in a long text still count and a long clean text does not drift. Misspelt words share n-gram vectors with
the words they bend.

The model is fitted on a bounded sample of labelled documents (``Settings.sample``); scoring is a narrow Arrow map
over all documents, whole texts, with a table of one float per n-gram bucket (``Settings.buckets``) sent along.

Defined results: a null or empty text, or one of white space, gets the score of a run without words (the prior of
the sample, below 0.5); repeated rows get equal scores; labels with null ids or values are ignored.
"""

from __future__ import annotations

import itertools
import string
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType

from lexmill.llm.common import BATCH_BYTES, slices, texts_of


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled documents per class that are fitted at most (a fixed bound; ids are drawn by hash).
    ``sample_words``: words of these documents that are fitted at most, half of them for each class and what the other
    leaves; whole documents in order of the hash, and those that do not fit are passed over."""

    sample: int = 2_000
    sample_words: int = 1_200_000
    buckets: int = 1 << 17
    dim: int = 16
    shortest: int = 3
    longest: int = 5
    window: int = 2
    min_docs: int = 8
    epochs: int = 60
    rate: float = 0.05
    decay: float = 0.1
    floor: float = 1e-5
    sharp: float = 6.0
    seed: int = 13


class Words:
    """Word -> mean over its n-grams of the softmax's preference for the toxic class.

    Words that were not met before are worked out together. When ``most`` are held they become the old generation and the older
    one goes, so what is asked for often stays and memory is bounded."""

    def __init__(self, table: np.ndarray, s: Settings, most: int) -> None:
        self.table, self.s, self.most = table, s, most
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def __getitem__(self, word: str) -> float:
        return float(self.values([word])[0])

    def values(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for a in range(0, len(words), WORDS):
            part = words[a : a + WORDS]
            self._learn(set(part))
            out[a : a + len(part)] = np.fromiter(map(self.young.__getitem__, part), np.float64, len(part))
        return out

    def _learn(self, words: set[str]) -> None:
        if len(self.young) + len(words) > self.most:
            self.young, self.old = {}, self.young
        fresh = words.difference(self.young)
        known = {w: value for w in fresh if (value := self.old.get(w)) is not None}
        self.young |= known
        fresh = list(fresh.difference(known))
        self.young |= zip(fresh, means(fresh, self.table, self.s).tolist(), strict=True)


#: Words that are looked up together.
WORDS = 100_000


def word_scores(table: np.ndarray, s: Settings, most: int = 120_000) -> Words:
    return Words(table, s, most)


def crc_steps() -> np.ndarray:
    """What a byte does to zlib's checksum, by the byte and the checksum's last one."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = steps >> 1 ^ np.uint32(0xEDB88320) * (steps & 1)
    return steps


STEPS = crc_steps()


def utf8(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four bytes (of which the first ``n`` count) of each code point, and ``n``."""
    n = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)[n]
    out = np.zeros((4, len(codes)), np.uint32)
    for k in range(int(n.max(initial=1))):
        bits = codes >> (6 * np.maximum(n - 1 - k, 0)).astype(np.uint32)
        out[k] = bits | lead if k == 0 else bits & 0x3F | 0x80
    return out, n


def means(words: list[str], table: np.ndarray, s: Settings) -> np.ndarray:
    """Of each word the mean of ``table`` over its pieces, for all words at once. Checksums of n-grams go on from those of shorter ones;
    words with a repeated n-gram, and very long ones, are cut into pieces one by one."""
    marked = [marks(w) for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    out = table[np.fromiter((bucket(w, s.buckets) for w in marked), np.int64, len(marked))].astype(np.float64)
    apart = size > 1_000
    some = np.flatnonzero(~apart)
    codes = np.frombuffer("".join([marked[i] for i in some] if apart.any() else marked).encode("utf-32-le", "surrogatepass"), "<u4")
    word = np.repeat(some, size[some])
    left = np.repeat(np.cumsum(size[some]), size[some]) - np.arange(len(codes))  # characters from here to the word's end
    data, n_bytes = utf8(codes)
    crc = np.full(len(codes), 0xFFFFFFFF, np.uint32)
    for n in range(1, s.longest + 1):
        crc = crc[: max(0, len(codes) - n + 1)].copy()
        for k in range(int(n_bytes.max(initial=1))):
            step = STEPS[(crc ^ data[k, n - 1 :]) & 0xFF] ^ crc >> 8
            crc = step if k == 0 else np.where(n_bytes[n - 1 :] > k, step, crc)
        if n < s.shortest:
            continue
        at = np.flatnonzero(left[: len(crc)] >= n)
        if n == s.shortest:  # whoever repeats a longer one repeats this one
            keys = np.sort(word[at] << 32 | crc[at])
            apart[keys[1:][keys[1:] == keys[:-1]] >> 32] = True
        at = at[size[word[at]] > n]  # the word itself is there already
        out += np.bincount(word[at], table[(~crc[at]) % s.buckets], len(out))
    out /= 1 + sum(np.where(size > n, size - n + 1, 0) for n in range(s.shortest, s.longest + 1))
    for i in np.flatnonzero(apart):
        found = grams(words[i], s)
        out[i] = table[found].sum(dtype=np.float64) / len(found)
    return out


def bucket(gram: str, buckets: int) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % buckets


def marks(word: str) -> str:
    return f"<{word.strip(string.punctuation)}>"


def pieces(word: str, s: Settings) -> list[str]:
    """A word's n-grams and the word itself, once each, in an order that depends on the word alone."""
    w = marks(word)
    return list(dict.fromkeys([w, *(w[i : i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(w) - n + 1))]))


def grams(word: str, s: Settings) -> list[int]:
    """Buckets of a word's pieces."""
    return [bucket(g, s.buckets) for g in pieces(word, s)]


@dataclass(frozen=True)
class Model:
    """What scoring needs: per bucket the product of its vector and the softmax's class difference, and the bias."""

    table: np.ndarray
    bias: float
    settings: Settings

    def scores(self, texts: list[str], memo: Words) -> np.ndarray:
        """Probability of the toxic class of each text."""
        return 1 / (1 + np.exp(-self.logits(texts, memo)))

    def logits(self, texts: list[str], memo: Words) -> np.ndarray:
        lists = [t.lower().split() for t in texts]
        lens = np.fromiter(map(len, lists), np.int64, len(lists))
        values = memo.values(list(itertools.chain.from_iterable(lists)))
        out = np.full(len(texts), self.bias)
        begin, size, runs = runs_of(lens, self.settings.window)
        total = np.zeros(len(begin))
        for k in range(int(size.max(initial=0))):
            more = size > k
            total[more] += values[begin[more] + k]
        if len(begin):
            out[lens > 0] += np.maximum.reduceat(total / size, (np.cumsum(runs) - runs)[lens > 0])
        return out


def runs_of(lens: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the runs of texts of ``lens`` words begin among all words, their sizes, and how many a text has."""
    runs = np.where(lens > 0, np.maximum(lens - window, 0) + 1, 0)
    size = np.repeat(np.minimum(lens, window), runs)
    return np.repeat(np.cumsum(lens) - lens, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs), size, runs


def fit(texts: list[str], labels: np.ndarray, s: Settings | None = None) -> Model:
    """The model of all texts, with a bias that was found on texts it had not seen.

    A model tells the texts that it learned from apart without an error, so these say nothing about where to cut. Two models, each
    of every other text, score the texts of the other one; the cut with the fewest errors (a clean text counts twice) is the bias."""
    s = s or Settings()
    model = fit_table(texts, labels, s)
    half = np.zeros(len(texts), np.int64)
    for value in (0, 1):
        half[labels == value] = np.arange((labels == value).sum()) % 2
    if not len(texts) or min((half[labels == value] == k).sum() for value in (0, 1) for k in (0, 1)) < LEAST_TO_CUT:
        return model
    seen = np.zeros(len(texts))
    for k in (0, 1):
        own, other = np.flatnonzero(half == k), np.flatnonzero(half != k)
        part = fit_table([texts[i] for i in other], labels[other], s)
        seen[own] = part.logits([texts[i] for i in own], word_scores(part.table, s)) - part.bias
    return Model(model.table, min(-cut(seen, labels), -1e-3), s)


#: Texts of a class in each half from which on the bias is found on unseen texts.
LEAST_TO_CUT = 30


def cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """Where to part the classes: the middle of the cuts with the fewest errors, an error of class 0 counting twice."""
    good, bad = np.sort(scores[labels == 0]), np.sort(scores[labels == 1])
    cuts = np.unique(scores)
    if len(cuts) < 2:
        return float(cuts[0]) if len(cuts) else 3.0
    mids = (cuts[:-1] + cuts[1:]) / 2
    wrong = 2 * (len(good) - np.searchsorted(good, mids)) / max(1, len(good)) + np.searchsorted(bad, mids) / max(1, len(bad))
    best = np.flatnonzero(wrong == wrong.min())
    return float(mids[best[len(best) // 2]])


def fit_table(texts: list[str], labels: np.ndarray, s: Settings) -> Model:
    """Embeddings and softmax, jointly, by full-batch Adam.

    With two classes the gradient of an n-gram's vector is a multiple of the softmax's difference vector, so an
    epoch moves one number for each word and n-gram and stays cheap. Words and rows of vectors are gone through in blocks
    (``BLOCK``), and only n-grams that count have vectors: the driver holds little more than these, their moments and the buckets of all pieces.
    """
    if not len(texts) or labels.min(initial=1) == labels.max(initial=0):
        return Model(np.zeros(s.buckets, np.float32), -3.0, s)
    ids: dict[str, int] = {}
    packed_words, lens = array("i"), np.zeros(len(texts), np.int64)
    for d, text in enumerate(texts):
        before = len(packed_words)
        packed_words.extend(ids.setdefault(w, len(ids)) for w in text.lower().split())
        lens[d] = len(packed_words) - before
    flat = np.frombuffer(packed_words, np.int32)
    begin, size, runs = runs_of(lens, s.window)
    end = begin + size
    n_words = len(ids)
    packed, sizes = array("i"), array("i")
    for w in ids:
        found = grams(w, s)
        packed.extend(found)
        sizes.append(len(found))
    del ids
    gram, gram_n = np.frombuffer(packed, np.int32), np.frombuffer(sizes, np.int32)
    first_gram = np.cumsum(gram_n, dtype=np.int64) - gram_n
    # n-grams of very few documents only let the model learn its sample by heart.
    kept = documents_of_buckets(flat, lens, gram, gram_n, s.buckets) >= s.min_docs
    touched = np.zeros(s.buckets, bool)
    touched[gram] = True
    touched = np.flatnonzero(touched & kept)

    share_of = (1 / gram_n).astype(np.float32)  # of a piece in its word
    edges = np.append(first_gram, len(gram))[np.append(np.arange(0, n_words, BLOCK), n_words)]
    blocks = [(slice(k * BLOCK, min(n_words, (k + 1) * BLOCK)), gram[a:b]) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]

    rng = np.random.default_rng(s.seed)
    vectors = rng.normal(0, 0.1, (s.buckets, s.dim))[touched]
    diff = rng.normal(0, 1, s.dim)
    bias = -1.0
    y = labels.astype(float)
    rows = np.flatnonzero(lens)  # documents with words
    weight = np.where(y == 1, 0.5 / max(1, (y[rows] == 1).sum()), 0.5 / max(1, (y[rows] == 0).sum()))
    count = runs[rows]
    starts = np.cumsum(count) - count

    def run_logits() -> tuple[np.ndarray, np.ndarray]:
        one, word = np.zeros(s.buckets), np.empty(n_words)
        one[touched] = vectors @ diff
        for some, part in blocks:
            n = gram_n[some]
            word[some] = np.bincount(np.repeat(np.arange(len(n)), n), np.repeat(share_of[some], n) * one[part], len(n))
        total = np.concatenate([[0.0], np.cumsum(word[flat])])
        out = total[end]
        out -= total[begin]
        out /= size
        return one, out

    def pooled(logits: np.ndarray, sharp: float) -> tuple[np.ndarray, np.ndarray]:
        top = np.maximum.reduceat(logits, starts)
        e = logits - np.repeat(top, count)
        e *= sharp
        np.exp(e, out=e)
        total = np.add.reduceat(e, starts)
        e /= np.repeat(total, count)
        return top + np.log(total / count) / sharp, e

    moments = [[np.zeros((len(touched), s.dim)), np.zeros((len(touched), s.dim))], [np.zeros(s.dim), np.zeros(s.dim)]]
    for epoch in range(1, s.epochs + 1):
        sharp = s.sharp * min(1.0, epoch / (s.epochs / 2))
        _, logits = run_logits()
        whole, share = pooled(logits, sharp)
        p = 1 / (1 + np.exp(-(whole + bias)))
        error = (p - y[rows]) * weight[rows]
        share *= np.repeat(error, count)
        share /= size
        by_place = np.bincount(begin, share, len(flat) + 1)
        by_place -= np.bincount(end, share, len(flat) + 1)
        by_word = np.bincount(flat, np.cumsum(by_place, out=by_place)[:-1], n_words)
        del logits, share, by_place
        by_gram = np.zeros(s.buckets)
        for some, part in blocks:
            np.add.at(by_gram, part, np.repeat(share_of[some] * by_word[some], gram_n[some]))
        by_gram = by_gram[touched]

        def move(m: np.ndarray, v: np.ndarray, g: np.ndarray) -> np.ndarray:
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            return s.rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + s.floor)

        of_diff = vectors.T @ by_gram
        for a in range(0, len(touched), BLOCK):
            rows_of = slice(a, a + BLOCK)
            vectors[rows_of] -= move(*(x[rows_of] for x in moments[0]), by_gram[rows_of, None] * diff) + s.rate * s.decay * vectors[rows_of]
        diff -= move(*moments[1], of_diff)
        bias -= 2.0 * float(error.sum())
    one, logits = run_logits()
    # The score takes the largest run, so the bias is set again for it.
    bias = -cut(np.maximum.reduceat(logits, starts), y[rows])
    table = np.zeros(s.buckets, np.float32)
    table[touched] = one[touched]
    return Model(table, min(bias, -1e-3), s)


#: Words, or rows of vectors, that are worked on together.
BLOCK = 8_192


def documents_of_buckets(flat: np.ndarray, lens: np.ndarray, gram: np.ndarray, gram_n: np.ndarray, buckets: int) -> np.ndarray:
    """Of each bucket the documents with a word that has a piece in it. ``flat``: the documents' words, one document after the other."""
    n_words, first_gram = len(gram_n), np.cumsum(gram_n, dtype=np.int64) - gram_n
    pairs = np.unique(np.repeat(np.arange(len(lens)), lens) * n_words + flat)
    out = np.zeros(buckets)
    for chunk in np.array_split(pairs, max(1, len(pairs) // 50_000)):
        doc, word = np.divmod(chunk, n_words)
        n = gram_n[word]
        where = np.repeat(first_gram[word], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out += np.bincount(np.unique(np.repeat(doc, n) * buckets + gram[where]) % buckets, minlength=buckets)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings, learn_from: F.Column | None = None) -> tuple[list[str], np.ndarray]:
    """The bounded sample: of each class the ``s.sample`` labelled ids whose hash is smallest, with their texts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("draw", F.xxhash64("doc_id", F.lit(s.seed)))
    drawn = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy("draw", "doc_id").limit(s.sample)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most 2 * s.sample rows of three numbers: safe to send to every task.
    rows = texts_of(docs).join(F.broadcast(drawn), "doc_id").withColumn("text_key", F.xxhash64("text"))
    words = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    words = F.greatest(words, (F.length("text") / 8).cast("int"))  # so that texts with few blanks are bounded too
    sizes = rows.groupBy("toxic", "draw", "doc_id", "text_key").agg(F.sum(words.cast("long")).alias("words"))
    taken = within_budget(sorted(tuple(r) for r in sizes.collect()), s.sample_words)
    if not taken:
        return [], np.zeros(0, np.int64)
    # Only texts within the budget reach the driver.
    chosen = docs.sparkSession.createDataFrame(taken, "toxic int, draw long, doc_id long, text_key long")
    got = rows.join(F.broadcast(chosen.select("doc_id", "text_key")), ["doc_id", "text_key"]).select("draw", "doc_id", "toxic", "text").toArrow()
    found = sorted(zip(*(got[c].to_pylist() for c in ("draw", "doc_id", "toxic", "text")), strict=True))
    return [r[3] for r in found], np.asarray([r[2] for r in found], dtype=np.int64)


def within_budget(sizes: list[tuple[int, int, int, int, int]], budget: int) -> list[tuple[int, int, int, int]]:
    """Of rows ``(toxic, draw, doc_id, text_key, words)``, in order, those that fit. Each class has half of the budget and
    what the other leaves of its half; a document that does not fit is passed over, and a class keeps one at least."""
    parts = [[r for r in sizes if r[0] == value] for value in (0, 1)]

    def fill(part: list[tuple[int, int, int, int, int]], left: int) -> tuple[list[tuple[int, int, int, int]], int]:
        out, used = [], 0
        for r in part:
            if used + r[4] <= left:
                used += r[4]
                out.append(r[:4])
        return out, used

    clean, used = fill(parts[0], budget - budget // 2)
    toxic, used = fill(parts[1], budget - used)
    clean, _ = fill(parts[0], budget - used)
    return [r for got, part in zip((clean, toxic), parts, strict=True) for r in got or [r[:4] for r in sorted(part, key=lambda r: r[4])[:1]]]


def fit_documents(docs: DataFrame, labels: DataFrame, s: Settings | None = None, learn_from: F.Column | None = None) -> Model:
    s = s or Settings()
    texts, ys = training_rows(docs, labels, s, learn_from)
    return fit(texts, ys, s)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_scores(model.table, model.settings)
        for batch in slices(batches):
            scores = model.scores(batch.column("text").to_pylist(), memo)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is below one half, with all their columns, whatever these are: only texts are passed on."""

    @arrow_udf(DoubleType())
    def score(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = word_scores(model.table, model.settings, 40_000)  # the workers go on to other steps with what they hold
        for texts in arrays:
            yield pa.array(np.concatenate([model.scores([t.as_py() or "" for t in texts[a : a + 500]], memo) for a in range(0, len(texts), 500)] or [np.zeros(0)]))

    docs.sparkSession.conf.set(*BATCH_BYTES)
    return docs.where(score(F.col("text")) < 0.5)

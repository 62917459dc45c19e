"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores what they meet.

A document is contaminated by an item if the alignment's score reaches ``share`` of the item's words (matching words
count 1, others and gaps cost a half), so edited, paraphrased and partly copied items are found.

Seeds. An alignment with ``E`` edits that scores ``S`` has ``S + E / 2`` matches, in ``E + 1`` runs at most, so it matches
``S - E / 2 - 1`` pairs of words side by side. Alignments of few edits so show in pairs of words; those of more edits have
so many more matches that they show in single words. Of each kind, if ``k`` of ``n`` must match, any ``n - k + r`` hold ``r``
that do: the rarest ones, by how many items have them, are the seeds, and a passage meets an item if it has ``r`` of its seeds.
No pair is lost, whatever an edit replaced. Longer n-grams would promise less. The join of passages with seeds is worked
out in the tasks, over a table of seeds that the block's size bounds: each rare n-gram leads to few items however many there are.

Passages. An alignment covers at most ``m + 2 * (1 - share) * m`` words, so documents go passage by passage, each twice as
long as that and starting in the middle of the one before, with items of about one size together; long texts do not gather seeds from far apart.

Bounds for what has met, each proved: every word of the passage adds 1 to a score at most if the item has it and costs a
half otherwise, so the running sum of these, never below 0, must reach the share (where it is 0, the stretches between are
aligned each by itself); and enough of the item's words, as often as the item has them, must occur in the stretch.

Items go in blocks of bounded size; documents are never shuffled.

Defined results: null and empty texts and items match nothing; items shorter than ``gram`` words match as a whole;
repeated rows each give their own pairs; words are runs of bytes other than white space and ASCII punctuation.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Tables, slices, texts_of

_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
for _c in string.punctuation.encode():
    _TABLE[_c] = 32
_TABLE = bytes(_TABLE)


@dataclass(frozen=True)
class Settings:
    """``few_edits``: up to so many edits, as a part of the matches wanted, pairs of words are the seeds; ``seeds``: seeds that a passage must have at least (``r``); ``passage``: words from the start of a passage to the next, at least;
    ``block_words``: words of the items that are held in memory together; more items mean more passes."""

    gram: int = 3
    share: float = 0.5
    few_edits: float = 0.8
    seeds: int = 6
    passage: int = 100
    block_words: int = 1_000_000


#: Seeds' items that are looked at together.
MET_ROWS = 1 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Seeds:
    """For some items the rarest of their tokens, and for each of these the items whose seed it is. An alignment matches at least
    ``least`` tokens of an item, so of any ``tokens - least + r`` at least ``r``."""

    def __init__(self, items: np.ndarray, tokens: list[np.ndarray], least: np.ndarray, r: int) -> None:
        self.items, self.wanted = items, np.minimum(least, r)
        counted = [np.unique(x, return_counts=True) for x in tokens]
        token, times = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*counted, strict=True) if counted else ([], [])))
        owner = np.repeat(np.arange(len(items)), [len(x) for x, _ in counted])
        every, name, held = np.unique(token, return_inverse=True, return_counts=True)
        size = np.array([len(x) for x in tokens], np.int64)
        order = np.lexsort((name, held[name], owner))
        name, owner, times = name[order], owner[order], times[order]
        rarer = np.cumsum(times) - times - (np.cumsum(size) - size)[owner]  # places of rarer tokens of the item
        seed = rarer < (size - least + self.wanted)[owner]
        name, owner, times = name[seed], owner[seed], times[seed]
        # Rows (seed, item, times) by seed; those of seed i are at first[i] .. first[i + 1].
        order = np.argsort(name, kind="stable")
        name, self.owner, self.times = name[order], owner[order], times[order]
        seeds, self.first = np.unique(name, return_index=True)
        self.seeds, self.first = every[seeds], np.append(self.first, len(name))

    def among(self, tokens: np.ndarray) -> np.ndarray:
        """Where seeds are among ``tokens``."""
        if not len(self.seeds):
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.seeds[np.minimum(np.searchsorted(self.seeds, tokens), len(self.seeds) - 1)] == tokens)

    def met(self, passages: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Passages and items of which enough seeds are among the passages' ``tokens`` (all of them seeds), each as often as both
        have it."""
        key, there = np.unique(passages * max(1, len(self.seeds)) + np.searchsorted(self.seeds, tokens), return_counts=True)
        passage, at = np.divmod(key, max(1, len(self.seeds)))
        a, n = self.first[at], self.first[at + 1] - self.first[at]
        # some passages at a time, each as a whole, so that what they meet stays small
        ends = np.flatnonzero(np.diff(passage, append=-1)) + 1
        begin, upto = 0, np.cumsum(n)
        for end in ends.tolist():
            if end < len(key) and upto[end - 1] - (upto[begin - 1] if begin else 0) < MET_ROWS:
                continue
            some = slice(begin, end)
            m = n[some]
            rows = np.repeat(a[some] - np.cumsum(m) + m, m) + np.arange(m.sum())
            pair, which = np.unique(np.repeat(passage[some], m) * len(self.items) + self.owner[rows], return_inverse=True)
            found = np.bincount(which, np.minimum(self.times[rows], np.repeat(there[some], m)), len(pair))
            p, i = np.divmod(pair, len(self.items))
            enough = found >= self.wanted[i]
            yield p[enough], self.items[i[enough]]
            begin = end


def pairs_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every two words side by side that items have (number above 0) as one number, and where they are."""
    at = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
    return (words[at] << 32) | words[at + 1], at


class Sized:
    """Items of about one size, with their seeds."""

    def __init__(self, items: list[tuple[int, np.ndarray]], s: Settings) -> None:
        numbers, size = np.array([k for k, _ in items]), np.array([len(ws) for _, ws in items])
        reached = s.share * size
        #: A passage starts so many words after the one before: an alignment covers as many at most.
        self.step = max(int((size + np.floor(2 * (size - reached))).max()), s.passage)
        few = np.floor(np.minimum(2 * (size - reached), s.few_edits * reached))
        pairs = np.ceil(reached - few / 2 - 1 - 1e-9).astype(np.int64)
        few = np.where(pairs > 0, few, -1)  # without a promise for pairs all alignments have to show in words
        words = np.ceil(reached + (few + 1) / 2 - 1e-9).astype(np.int64)
        by_words, by_pairs = np.flatnonzero(words <= size), np.flatnonzero(pairs > 0)
        self.words = Seeds(numbers[by_words], [items[i][1] for i in by_words], words[by_words], s.seeds)
        self.pairs = Seeds(numbers[by_pairs], [pairs_of(items[i][1])[0] for i in by_pairs], pairs[by_pairs], s.seeds)

    def met(self, flat: np.ndarray, offset: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(place, first word, end, item) of passages that meet an item. ``flat``: words of documents, with a 0 after each;
        ``offset``: of each word in its document; ``size``: of its document. The place is the passage's first word in ``flat``.

        Passages are twice ``step`` long, and the last one reaches the end, so each alignment lies within one."""
        last = np.maximum(0, -(-(size - self.step) // self.step) - 1)  # of the document's passages
        own = offset // self.step
        begins = np.arange(len(flat)) - offset
        known = np.flatnonzero(flat > 0)
        for seeds, (tokens, at) in ((self.words, (flat[known], known)), (self.pairs, pairs_of(flat))):
            seed = seeds.among(tokens)
            tokens, at = tokens[seed], at[seed]
            numbers = np.concatenate([own[at], own[at] - 1])  # a word is in two passages
            within = (numbers >= 0) & (numbers <= np.tile(last[at], 2))
            places = (np.tile(begins[at], 2) + numbers * self.step)[within]
            for places, items in seeds.met(places, np.tile(tokens, 2)[within]):
                for place, k in zip(places.tolist(), items.tolist(), strict=True):
                    a = int(offset[place])
                    yield place, a, min(a + 2 * self.step, int(size[place])), k


class Block:
    """Some items: their words as numbers, and their seeds by classes of size."""

    def __init__(self, items: list[tuple[int, list[bytes]]], s: Settings) -> None:
        self.s = s
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [i for i, _ in items]
        self.words = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws], np.int64) for _, ws in items]
        self.different = [np.unique(ws, return_counts=True) for ws in self.words]
        self.short: dict[int, list[int]] = {}
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k, ws in enumerate(self.words):
            if len(ws) >= s.gram:
                by_size.setdefault(len(ws).bit_length(), []).append((k, ws))
            elif len(ws):
                self.short.setdefault(len(ws), []).append(k)
        self.sized = [Sized(of, s) for of in by_size.values()]
        self.mark = np.full(len(self.vocabulary) + 1, -0.5)

    def numbers(self, text: str) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, itertools.repeat(0)), np.int64, len(words))

    def stretches(self, k: int, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """First word and end of the stretches of a passage where an alignment with item ``k`` may reach the share."""
        (own, times), least = self.different[k], self.s.share * len(self.words[k])
        self.mark[own] = 1.0
        total = np.cumsum(self.mark[words])
        self.mark[own] = -0.5
        bound = total - np.minimum(np.minimum.accumulate(total), 0)
        high = np.flatnonzero(bound >= least)
        if not len(high):
            return
        zero = np.concatenate([[-1], np.flatnonzero(bound == 0)])
        stretch = np.searchsorted(zero, high)  # of each high place the number of zeros before it
        for i in np.flatnonzero(np.diff(stretch, append=-1)).tolist():
            a, b = int(zero[stretch[i] - 1]) + 1, int(high[i]) + 1
            there = np.sort(words[a:b])
            n = np.searchsorted(there, own, "right") - np.searchsorted(there, own, "left")
            if np.minimum(n, times).sum() >= least:
                yield a, b

    def candidates(self, documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, first word, end) of the stretches where an alignment may reach the share."""
        sizes = np.array([len(x) for x in documents], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        flat = np.zeros(int((sizes + 1).sum()), np.int64)
        for at, words in zip(starts.tolist(), documents, strict=True):
            flat[at : at + len(words)] = words
        owner = np.repeat(np.arange(len(documents)), sizes + 1)
        offset, size = np.arange(len(flat)) - starts[owner], sizes[owner]
        for sized in self.sized:
            told = set()  # pairs of words and words may both tell
            for place, a, b, k in sized.met(flat, offset, size):
                if (place, k) not in told:
                    told.add((place, k))
                    for x, y in self.stretches(k, flat[place : place + b - a]):
                        yield int(owner[place]), k, a + x, a + y
        for length, items in self.short.items():
            for d, words in enumerate(documents):
                for k in items if len(words) >= length else ():
                    same = np.all(np.lib.stride_tricks.sliding_window_view(words, length) == self.words[k], axis=1)
                    for p in np.flatnonzero(same)[:1].tolist():
                        yield d, k, p, p + length


def smith_waterman(item: np.ndarray, words: np.ndarray) -> tuple[float, int]:
    """Best local alignment's score (match 1, mismatch and gap -1/2) and where it ends in ``words``.

    Rows are worked out at once: gaps along a row are a running maximum.
    """
    n = len(words)
    tilt = 0.5 * np.arange(1, n + 1)
    last, best, end = np.zeros(n + 1), 0.0, 0
    for w in item:
        row = np.maximum(last[:-1] + np.where(words == w, 1.0, -0.5), last[1:] - 0.5)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + tilt) - tilt
        last[1:] = row
        k = int(row.argmax())
        if row[k] > best:
            best, end = float(row[k]), k + 1
    return best, end


def blocks(items: DataFrame, s: Settings) -> Iterator[Block]:
    """The items in order of their ids, ``block_words`` words at a time, so the driver holds one block at most."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").orderBy("item_id", "text")
    part: list[tuple[int, list[bytes]]] = []
    size = 0
    for r in rows.toLocalIterator():
        words = words_of(r["text"])
        if size and size + len(words) > s.block_words:
            yield Block(part, s)
            part, size = [], 0
        part.append((r["item_id"], words))
        size += len(words)
    if part:
        yield Block(part, s)


def contaminated_pairs(docs: DataFrame, items: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id, item_id, score, share, end_word`` of every document and item whose alignment reaches the share."""
    s = s or Settings()
    schema = "doc_id long, item_id long, score double, share double, end_word long"
    walk = blocks(items, s)
    first = next(walk, None)
    if first is None:
        return docs.sparkSession.createDataFrame([], schema)
    second, t, done = next(walk, None), None, []
    for block in itertools.chain([first], [second] if second else [], walk):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                rows, best, ids = [], {}, batch.column("doc_id").to_pylist()
                documents = [block.numbers(text) for text in batch.column("text").to_pylist()]
                for d, k, a, b in block.candidates(documents):
                    score, end = smith_waterman(block.words[k], documents[d][a:b])
                    if score > best.get((d, k), (0.0, 0))[0]:
                        best[d, k] = score, a + end
                for (d, k), (score, end) in best.items():
                    if score >= s.share * len(block.words[k]):
                        rows.append((ids[d], block.ids[k], score, score / len(block.words[k]), end))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "score", "share", "end_word"])

        found = texts_of(docs).mapInArrow(run, schema)
        if second is None:
            return found
        t = t or Tables(docs.sparkSession, "contaminated")  # written, so that no plan holds more than one block
        done.append(t.write(found, "pairs").written_to)
    return docs.sparkSession.read.schema(schema).parquet(*done)


def keep_uncontaminated(docs: DataFrame, items: DataFrame, s: Settings | None = None) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    gone = contaminated_pairs(docs, items, s).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")

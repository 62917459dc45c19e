"""Spelling variant grouping by a symmetric-delete join.

Words are counted where the texts are read and shuffled as counts. Every word then emits itself and each of its distinct
single deletions as a key, together with a name of the word; words with equal keys meet in an equi-join, and a pair
stays if its edit distance is exactly one. A pair at distance one shares exactly one distinct key (the shorter word
itself, or what both leave when the replaced place goes), so no pair comes twice. A key has at most one word for each
place and letter around it, and rejected pairs are never more than words with the same two deletions, so no key
outgrows its length; there is no hot key to salt. Both directions of the pairs are aggregated by word, and forms are
followed to their roots by joins that double the distance each time: a form is ten times as frequent as its word, so
four joins reach the root of any chain of fifteen forms.

Keys are 64-bit hashes of a deletion, worked out for all places of a word at once from prefix sums: a word of a million letters emits
a million numbers, not a million texts. Equal hashes only propose a pair. Words beyond ``LONG`` code points travel
under a digest and are looked up again for the test of their distance.

Defined results: a null text has no runs; an id that is null counts as an empty one in the hash that garbles runs; rows that
repeat count again; without words the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Tables

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of a run, both ends of the second range included.
LETTERS = r"A-Za-zÀ-ÿ"
#: Code points of a text that are searched together, and of a word beyond which its digest stands for it.
PIECE, LONG = 1 << 16, 64


@dataclass(frozen=True)
class Settings:
    """A run is garbled where ``every`` divides its hash (0: never); words have ``least_length`` code points and
    ``least_count`` occurrences; a near word is a form if it is ``ratio`` times as frequent."""

    every: int = 31
    least_length: int = 7
    least_count: int = 2
    ratio: int = 10


def lowered(run: Column) -> Column:
    """Only A to Z in lower case."""
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def garbled(doc_id: Column, run: Column, every: int) -> Column:
    """``run`` without the code point that its and its document's hash names, where ``every`` divides the hash."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run) if every else run


def word_counts(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all words. A long text is cut at ends of runs first."""
    text = F.col(text_col)
    pieces = F.when(F.length(text) <= PIECE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}[{LETTERS}]*+"), F.lit(0)))
    runs = docs.select(F.col(id_col).alias("id"), F.explode(pieces).alias("piece")).select("id", F.explode(F.regexp_extract_all("piece", F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("run"))
    # A garbled run is at most one shorter, so shorter runs need no hash.
    words = runs.where(F.length("run") >= s.least_length).select("id", lowered(F.col("run")).alias("run")).select(garbled(F.col("id"), F.col("run"), s.every).alias("word"))
    counted = words.where(F.length("word") >= s.least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= s.least_count)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(n: int, first: np.uint64) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = first
    return np.multiply.accumulate(out)


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def deletion_keys(word: str) -> Iterator[np.ndarray]:
    """Hashes of the word and, in blocks of places, of its distinct single deletions.

    The hash of letters c_0 c_1 ... is the sum of c_j B^j, so a deletion's is the sum before its place plus the sum
    behind it divided by B. Of equal letters side by side only the last is deleted: the others leave the same.
    """
    with np.errstate(over="ignore"):
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        n, total, power = len(codes), np.uint64(0), np.uint64(1)
        starts: list[tuple[np.uint64, np.uint64]] = []
        for a in range(0, n, PIECE):
            starts.append((total, power))
            part, powers = codes[a : a + PIECE].astype(np.uint64), _powers(min(PIECE, n - a), power)
            total, power = total + (part * powers).sum(dtype=np.uint64), powers[-1] * _BASE
        size = np.uint64(n) * np.uint64(0xD6E8FEB86659FD93)
        yield _scrambled(np.array([total + size], np.uint64))
        for a, (before, power) in zip(range(0, n, PIECE), starts, strict=True):
            part = codes[a : a + PIECE]
            upto = before + np.cumsum(part.astype(np.uint64) * _powers(len(part), power), dtype=np.uint64)
            left = np.concatenate([np.array([before], np.uint64), upto[:-1]]) + (total - upto) * _BACK
            distinct = np.append(part[1:] != part[:-1], a + len(part) == n or part[-1] != codes[a + len(part)])
            yield _scrambled(left[distinct] + size - np.uint64(0xD6E8FEB86659FD93))


def keys(words: DataFrame) -> DataFrame:
    """``key, name, n`` of ``words(word, name, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple[np.ndarray, str, int]]) -> pa.RecordBatch:
            sizes = [len(k) for k, _, _ in rows]
            where = pa.array(np.repeat(np.arange(len(rows)), sizes))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([k for k, _, _ in rows]).view(np.int64)), pa.array([x for _, x, _ in rows]).take(where), pa.array([c for _, _, c in rows], pa.int64()).take(where)], ["key", "name", "n"])

        held: list[tuple[np.ndarray, str, int]] = []
        size = 0
        for batch in batches:
            for word, name, n in zip(*(batch.column(c).to_pylist() for c in ("word", "name", "n")), strict=True):
                for found in deletion_keys(word):
                    held.append((found, name, n))
                    size += len(found)
                    if size >= PIECE:
                        yield batch_of(held)
                        held, size = [], 0
        if held:
            yield batch_of(held)

    return words.select("word", "name", "n").mapInArrow(run, "key long, name string, n long")


def near_words(words: DataFrame, t: Tables) -> DataFrame:
    """``a, na, b, nb``: each unordered pair of ``words(word, n)`` at edit distance one, once."""
    is_long = F.length("word") > LONG
    named = words.withColumn("name", F.when(is_long, F.sha2(F.col("word").cast("binary"), 256)).otherwise(F.col("word")))
    emitted = t.write(keys(named), "keys")
    left, right = (emitted.select("key", F.col("name").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    met = t.write(left.join(right, "key").where("a < b").select("a", "na", "b", "nb"), "met")
    digest = lambda x: F.col(x).rlike("^[0-9a-f]{64}$") & F.col(x).rlike("[0-9]")  # noqa: E731  words have no digits
    one_apart = F.levenshtein("a", "b", 1) == 1
    plain = met.where(~digest("a") & ~digest("b")).where(one_apart)
    texts = named.where(is_long).select("name", "word")
    rare = met.where(digest("a") | digest("b"))
    for x in "ab":
        rare = rare.join(texts.select(F.col("name").alias(x), F.col("word").alias(f"text_{x}")), x, "left").withColumn(x, F.coalesce(f"text_{x}", x)).drop(f"text_{x}")
    return plain.unionByName(rare.select("a", "na", "b", "nb").where(one_apart))


def roots(forms: DataFrame, t: Tables) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: the last form, by joins that double the steps each root stands for."""
    state = t.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = t.write(state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        t.drop(state)
        state = moved.select("word", "root")
        state.written_to = moved.written_to
        if moved.where("moved").isEmpty():
            return state


def variants(docs: DataFrame, s: Settings | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    s, t = s or Settings(), Tables(docs.sparkSession, "spelling")
    words = t.write(word_counts(docs, s, id_col, text_col), "words")
    pairs = t.write(near_words(words, t), "pairs")
    directed = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m"))
    directed = directed.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("other")))
    near = directed.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.m") >= s.ratio * F.col("n")
    told = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n"))
    told = t.write(told, "told")
    found = told.join(roots(told.where("form IS NOT NULL"), t), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

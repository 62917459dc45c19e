"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Every line is an id. Positions get ranks by their first line, then by two, four, ... lines, each round from the pair
of ranks at a position and half the depth further on. Positions whose ranks agree form an interval of the suffix
array, and the depth is a common prefix of all its suffixes: a repeated run. A run counts if it has ``min_lines`` lines
and ``min_chars`` characters together, one long line as well as many short ones. Of each interval the first copy, in
order of ``doc_id`` and position, stays; all lines of the later copies of maximal repeated runs are deleted.

A line belongs to a later copy of a run that counts if and only if it belongs to one of two kinds of runs within it:
the shortest that counts from some line on, or the shortest that counts up to some line. So doubling goes on while
ranks repeat where these are not yet told apart; a run of ``n`` lines is two overlapping windows of the largest power
of two in ``n``. Only lines that occur twice take part after the first step, and only lines beside short ones after
the second.

Ranks come from a sort by ranges with per-range offsets; no step collects a group: firsts are pre-aggregated minima.

Defined results: a null or empty text is one empty line; runs do not cross documents; lines compare exactly; rows that
repeat ``doc_id`` and text are one document and get equal results; rows that share a ``doc_id`` but not the text are
ordered by a hash of the text; null ids come last; other columns, whatever their names and types, stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from lexmill.llm.common import Tables, shuffle_partitions, slices


@dataclass(frozen=True)
class Settings:
    min_lines: int = 1
    min_chars: int = 60


LAST = (1 << 63) - 1
KEY = ["doc", "text_key"]


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(11))


def doc_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def dense_ranks(keys: DataFrame, columns: list[str], t: Tables) -> DataFrame:
    """Distinct ``keys`` with ``rank``: 1, 2, ... in their order, by ranges and offsets of ranges."""
    spark = keys.sparkSession
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.select(*columns).schema) + ", part int, place long"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())], [*columns, "part", "place"])
            at += n

    ordered = keys.select(*columns).repartitionByRange(shuffle_partitions(spark), *columns).sortWithinPartitions(*columns)
    placed = t.write(ordered.mapInArrow(number, schema), "placed")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").select(*columns, (F.col("offset") + F.col("place") + 1).alias("rank"))


def shortest_runs(sizes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """For each line of a text, by the lines' sizes, how many lines the shortest run that counts from it on has (0: none
    does), and where the shortest run that counts up to it begins (-1: none does)."""
    n = len(sizes)
    chars = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(n)
    end = np.maximum(np.searchsorted(chars, chars[:-1] + s.min_chars, "left"), at + s.min_lines)
    begin = np.minimum(np.searchsorted(chars, chars[1:] - s.min_chars, "right") - 1, at + 1 - s.min_lines)
    return np.where(end <= n, end - at, 0), np.maximum(begin, -1)


def line_rows(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc, text_key, pos, a, b, beside, ahead, since``: of every line its digest, whether it or a neighbour is too short
    to count alone, and its two shortest runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests, counts, runs, beside = [], [], [], []
            for text in batch.column("text").to_pylist():
                lines = text.split("\n")
                sizes = np.fromiter(map(len, lines), np.int64, len(lines))
                counts.append(len(lines))
                digests += [hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16).digest() for x in lines]
                runs.append(shortest_runs(sizes, s))
                short = np.pad((sizes < s.min_chars) | (s.min_lines > 1), 1)
                beside.append(short[:-2] | short[1:-1] | short[2:])
            n = np.array(counts)
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            keys = (pa.array(np.repeat(batch.column(c).to_numpy(), n)) for c in KEY)
            rest = (pa.array(np.concatenate([r[k] for r in runs]).astype(np.int32)) for k in range(2))
            columns = [*keys, pa.array(pos.astype(np.int32)), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()), pa.array(np.concatenate(beside)), *rest]
            yield pa.RecordBatch.from_arrays(columns, [*KEY, "pos", "a", "b", "beside", "ahead", "since"])

    rows = docs.select(doc_key(F.col("doc_id")).alias("doc"), text_key(F.col("text")).alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc long, text_key long, pos int, a long, b long, beside boolean, ahead int, since int")


def later_copies(docs: DataFrame, s: Settings, t: Tables) -> DataFrame:
    """``doc, text_key, start, n``: shortest runs that count and that also start earlier."""
    lines = t.write(line_rows(docs, s), "lines")
    often = t.write(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"), "often")
    ranks = t.write(dense_ranks(often, ["a", "b"], t), "ranks")
    first = t.write(lines.join(ranks, ["a", "b"]).select(*KEY, "pos", "rank", "beside", "ahead", "since").distinct(), "repeated")
    t.drop(lines, often, ranks)
    from_here, up_to_here = F.struct(F.col("pos").alias("start"), F.col("ahead").alias("n")), F.struct(F.col("since").alias("start"), (F.col("pos") - F.col("since") + 1).alias("n"))
    windows = first.select(*KEY, F.explode(F.array(F.when(F.col("ahead") > 1, from_here), F.when((F.col("since") >= 0) & (F.col("since") < F.col("pos")), up_to_here))).alias("w")).where("w IS NOT NULL")
    windows = t.write(windows.select(*KEY, "w.start", "w.n").distinct(), "windows")
    state = t.write(first.where("beside").select(*KEY, "pos", "rank"), "state")
    out = _later(first.where("ahead = 1").select(*KEY, F.col("pos").alias("start"), F.lit(1).alias("n"), F.col("rank").alias("r1"), F.col("rank").alias("r2")), t)
    size = 1
    while True:
        # Windows of size + 1 to 2 * size lines repeat only where those of ``size`` lines do; unique positions drop out.
        windows = t.write(windows.join(state.select(*KEY, F.col("pos").alias("start")), [*KEY, "start"], "left_semi"), "windows")
        if windows.isEmpty():
            return out
        if size > 1:
            ends = state.select(*KEY, F.col("pos").alias("last"), F.col("rank").alias("r2"))
            begins = state.select(*KEY, F.col("pos").alias("start"), F.col("rank").alias("r1"))
            here = windows.where(F.col("n") < 2 * size).join(begins, [*KEY, "start"]).withColumn("last", F.col("start") + F.col("n") - size).join(ends, [*KEY, "last"])
            out = out.unionByName(_later(here.select(*KEY, "start", "n", "r1", "r2"), t))
            windows = windows.where(F.col("n") >= 2 * size)
        state = _doubled(state, size, t)
        size *= 2


def _later(windows: DataFrame, t: Tables) -> DataFrame:
    """All but the first of equal windows ``doc, text_key, start, n, r1, r2``."""
    windows = t.write(windows, "told")
    place = F.struct(*KEY, "start")
    first = windows.groupBy("n", "r1", "r2").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    first = t.write(first.select("n", "r1", "r2", "first"), "first")  # so that the join can split windows that very many have
    later = t.write(windows.join(first, ["n", "r1", "r2"]).where(place > F.col("first")).select(*KEY, "start", "n"), "later")
    t.drop(windows, first)
    return later


def _doubled(state: DataFrame, size: int, t: Tables) -> DataFrame:
    """Ranks of windows of twice the size, where these repeat."""
    ahead = state.select(*KEY, (F.col("pos") - size).alias("pos"), F.col("rank").alias("next"))
    pairs = t.write(state.join(ahead, [*KEY, "pos"]).select(*KEY, "pos", F.col("rank").alias("here"), "next"), "pairs")
    keys = t.write(pairs.groupBy("here", "next").agg(F.count("*").alias("n")).where("n > 1").select("here", "next"), "keys")
    ranks = t.write(dense_ranks(keys, ["here", "next"], t), "ranks")
    out = t.write(pairs.join(ranks, ["here", "next"]).select(*KEY, "pos", "rank"), "state")
    t.drop(pairs, keys, ranks)
    return out


@arrow_udf(StructType([StructField("text", StringType()), *(StructField(n, LongType()) for n in ("n_lines", "n_removed", "n_runs"))]))
def _cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
    """The texts without the lines of their runs, and counts of lines, removed lines and removed runs."""
    rows = []
    for text, runs in zip(texts, lists, strict=True):
        text, runs = text.as_py(), runs.as_py()
        lines = (text or "").split("\n")
        step = np.zeros(len(lines) + 1, np.int64)
        if runs:
            np.add.at(step, [r["start"] for r in runs], 1)
            np.add.at(step, [r["start"] + r["n"] for r in runs], -1)
        gone = np.cumsum(step[:-1]) > 0
        kept = "\n".join(x for x, g in zip(lines, gone.tolist(), strict=True) if not g) if runs else text
        rows.append((kept, len(lines), int(gone.sum()), int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))))
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["text", "n_lines", "n_removed", "n_runs"])


def dedup_lines(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``row, cut``: every row of ``docs`` as a struct, and its ``text`` without later copies of repeated line runs with
    ``n_lines, n_removed, n_runs``."""
    s, t = s or Settings(), Tables(docs.sparkSession, "lines")
    runs = later_copies(docs.select("doc_id", "text"), s, t).groupBy(*KEY).agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    rows = docs.select(F.struct("*").alias("row"), doc_key(F.col("doc_id")).alias("doc"), text_key(F.col("text")).alias("text_key"), F.col("text"))
    return rows.join(runs, KEY, "left").select("row", _cut("text", "runs").alias("cut"))


def report(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id, n_lines, n_removed, n_runs, kept_sha256`` of every document."""
    out = dedup_lines(docs.select("doc_id", "text"), s)
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "cut.n_lines", "cut.n_removed", "cut.n_runs", F.sha2(F.coalesce("cut.text", F.lit("")), 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """The documents with their columns only; ``n_chars``, where there is one, follows the text."""
    fresh = {"text": F.col("cut.text"), "n_chars": F.length(F.coalesce("cut.text", F.lit("")))}
    columns = [fresh[f.name].cast(f.dataType) if f.name in fresh else F.col("row").getItem(f.name) for f in docs.schema]
    return dedup_lines(docs, s).select(*(c.alias(f.name) for c, f in zip(columns, docs.schema, strict=True)))

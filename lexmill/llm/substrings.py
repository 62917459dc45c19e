"""Suffix-array dedup: intervals of a Burrows-Wheeler transform, expanded up to a length.

All bytes are removed that a string of ``length`` bytes covers which also starts in a document with a smaller id.

1. *Anchors.* Of every ``length`` consecutive bytes the byte run (``gram`` bytes) with the smallest hash is the
   anchor, so equal strings have equal anchors at equal offsets, and the strings of a document fall into runs of
   consecutive starts with the same anchor. A string reaches half of the remaining bytes beyond the anchor on the left
   or on the right, so runs carry the hashes of the anchor widened to either side. Runs are dealt by hash, many packed in
   a row, to tasks that get a bounded number of them, and sorted by hash; of each the strings stay whose wider anchor
   another text has too; a hash shared by very many documents is spread over
   all tasks, and all its strings stay. Equal texts (by 96 bits of digests) count as one text here, that of their
   smallest id; larger copies go whole.
2. *Contexts.* A run's bytes (at most ``2 * length``) go, once for each different content with its smallest id, to the
   block of its anchor's hash.
3. *Crowded anchors.* Where an anchor has more contents than a block holds, its strings go on under the wider anchors
   on the left or on the right, and so on, with half of the remaining bytes each time: at ``length`` bytes an anchor has
   one content. So no block and no task holds more than a fixed number of contents of one anchor.
4. *Intervals.* A block's contexts, joined, are sorted to a Burrows-Wheeler transform. Breadth-first backward extension
   starts from the empty string and visits intervals in order of length; the right end of an interval met first at
   length l + 1 has a common prefix of l with its neighbour. It stops at ``length``: ends not met by then lie inside
   a group of equal strings. Each group knows its smallest id.
5. Starts whose group has a smaller id than their own text's mark bytes; texts join their marks once.

Defined results: a null text is an empty text and has nothing to remove; texts shorter than ``length`` bytes stay;
rows that share a ``doc_id`` are one document to each other, so they do not shorten each other; rows with a null id come
after all others and not before each other; matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Tables, shuffle_partitions, slices, texts_of

LAST = (1 << 63) - 1
SHAPE = 1 << 12
#: One in so many texts is looked at to find anchors that very many texts have.
SHARE = 64
#: Runs that are dealt to one task at most, about.
RUNS = 1_500_000
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


@dataclass(frozen=True)
class Settings:
    """``block``: bytes of contexts that are sorted together at most; ``many``: contents of one anchor in a block at
    most, beyond which the anchor is widened; ``remembered``: texts whose copies a task passes over; ``held``: runs that
    a task deals out or compares together."""

    length: int = 50
    gram: int = 16
    block: int = 250_000
    many: int = 2_000
    remembered: int = 500_000
    held: int = 400_000

    @property
    def side(self) -> int:
        """Bytes beyond the anchor that every string has on the left or on the right."""
        return half(self.length, self.gram)


def half(length: int, gram: int) -> int:
    return (length - gram + 1) // 2


def gram_hashes(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """64-bit hashes of all runs of so many bytes, for each of the ascending sizes, by doubling."""
    out = []
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(1)) * _M[0]
        h ^= h >> np.uint64(29)
        size = 1
        for n in sizes:
            while size < n:
                step = min(size, n - size)
                h = h[:-step] * _M[1] + h[step:] if step == size else h[: len(h) - step] * _M[2] + h[step:]
                h ^= h >> np.uint64(32)
                h *= _M[0]
                size += step
            out.append(h ^ (h >> np.uint64(29)))
    return out


#: Runs as they are dealt: ``place`` holds the first start (high half) and the shape, ``sides`` the left and right hashes.
RUN = ["hash", "text_key", "tag", "place", "sides"]
RUN_SQL = "hash long, text_key long, tag int, place long, sides long"
RUN_BYTES = [8, 8, 4, 8, 8]
KEPT_SQL = "hash long, text_key long, tag int, first int, shape int"


def packed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Two 32-bit numbers in one."""
    return (high.astype(np.int64) << 32) | low.astype(np.uint32)


def halves(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (both >> 32).astype(np.int32), both.astype(np.int32)


def packs(columns: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The different places, and the runs of each in one piece of bytes, column by column."""
    by = np.argsort(place, kind="stable")  # runs of a text stay together: its keys compress
    place, columns = place[by], [c[by] for c in columns]
    starts = np.flatnonzero(_starts_of(place))
    ends = np.append(starts[1:], len(place))
    return place[starts], [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def unpacked(pieces: list[bytes]) -> list[np.ndarray]:
    out, at = [], [0] * len(pieces)
    for size in RUN_BYTES:
        n = [len(x) // sum(RUN_BYTES) for x in pieces]
        out.append(np.concatenate([np.frombuffer(x, f"i{size}", k, a) for x, k, a in zip(pieces, n, at, strict=True)]))
        at = [a + k * size for a, k in zip(at, n, strict=True)]
    return out


def anchors(data: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Of each run of string starts with one anchor: the anchor's hash, the first start, in one number how many
    starts there are and how far the anchor is from the first (``SHAPE * starts + distance``), and the hashes of the
    anchor widened by ``side`` bytes to the left and to the right (0 where no string of the run reaches so far)."""
    starts = len(data) - s.length + 1
    if starts <= 0:
        return [np.zeros(0, np.int64), *(np.zeros(0, np.int32) for _ in range(4))]
    h, wide = gram_hashes(data, s.gram, s.gram + s.side)
    span = s.length - s.gram + 1  # grams of a string
    # Order by 40 bits of the hash, then by place; places are counted anew every 2**23 bytes, which no string straddles unseen.
    best = np.empty(starts, np.int64)
    piece = 1 << 23
    for a in range(0, starts, piece):
        b = min(starts, a + piece)
        part = h[a : b + span - 1]
        v = (part & ~np.uint64(0xFFFFFF)) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while size * 2 <= span:
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        if size < span:
            v = np.minimum(v[: len(v) - (span - size)], v[span - size :])
        best[a:b] = (v & np.uint64(0xFFFFFF)).astype(np.int64) + a
    first = np.flatnonzero(np.diff(best, prepend=-1))
    anchor = best[first]
    count, distance = np.append(first[1:], starts) - first, anchor - first
    left = np.where(distance >= s.side, wide[np.maximum(anchor - s.side, 0)], np.uint64(0))
    right = np.where(distance - count + 1 < s.side, wide[np.minimum(anchor, len(wide) - 1)], np.uint64(0))
    low = lambda x: (x & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
    return [h[anchor].view(np.int64), first.astype(np.int32), (count * SHAPE + distance).astype(np.int32), low(left), low(right)]


def _bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]


def _starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the row before, in any column; the first row always does."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
    return new


def shared_runs(columns: list[np.ndarray], open_hashes: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Of runs (``hash, text_key, tag, first, shape, left, right``), in order of their hash, those that have strings whose wider anchor another text has
    too, cut to these strings. Runs of ``open_hashes``, which may go on elsewhere, stay as they are."""
    h = columns[0]
    n = np.diff(np.append(np.flatnonzero(_starts_of(h)), len(h)))
    is_open = np.isin(h, open_hashes)
    columns = [c[(np.repeat(n, n) > 1) | is_open] for c in columns]
    order = np.lexsort(tuple(columns[k] for k in (3, 2, 1, 0)))
    columns = [c[order] for c in columns]
    if not len(order):
        return columns
    columns = [c[_starts_of(*columns[:4])] for c in columns]  # copies of a text
    h, key, tag, first, shape, left, right = columns
    group, text = np.cumsum(_starts_of(h)), np.cumsum(_starts_of(h, key, tag))

    def common(x: np.ndarray) -> np.ndarray:
        both = (group << 32) | (x.astype(np.int64) & 0xFFFFFFFF)
        by = np.argsort(both)
        starts = np.flatnonzero(_starts_of(both[by]))
        n = np.diff(np.append(starts, len(by)))
        out = np.empty(len(by), bool)
        out[by] = np.repeat(np.minimum.reduceat(text[by], starts) != np.maximum.reduceat(text[by], starts), n)
        return out

    is_open = np.isin(h, open_hashes)
    count, distance = shape.astype(np.int64) // SHAPE, shape.astype(np.int64) % SHAPE
    on_left = (common(left) | is_open) & (distance >= s.side)
    on_right = (common(right) | is_open) & (distance - count + 1 < s.side)
    # Strings that start at most distance - side on reach far enough to the left, the others to the right.
    skip = np.where(on_left, 0, np.maximum(0, distance - s.side + 1))
    end = np.where(on_right, count, np.minimum(count, distance - s.side + 1))
    good = (on_left | on_right) & (end > skip)
    shape = (end - skip) * SHAPE + distance - skip
    return [c[good] for c in (h, key, tag, (first + skip).astype(np.int32), shape.astype(np.int32), left, right)]


def shared_anchors(texts: DataFrame, s: Settings, t: Tables) -> DataFrame:
    """``hash, text_key, tag, first, shape`` of the runs that another text may share strings of."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches):
            keys = list(zip(batch.column("text_key").to_pylist(), batch.column("tag").to_pylist(), strict=True))
            fresh = []
            for i, k in enumerate(keys):
                if k not in seen:
                    fresh.append(i)
                    if len(seen) < s.remembered:
                        seen.add(k)
            if not fresh:
                continue
            batch = batch.take(pa.array(fresh))
            found = [anchors(np.frombuffer(t, np.uint8), s) for t in _bytes_of(batch)]
            n = [len(x[0]) for x in found]
            h, first, shape, left, right = (np.concatenate([x[k] for x in found]) for k in range(5))
            key, tag = (np.repeat(batch.column(c).to_numpy(), n) for c in ("text_key", "tag"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, key, tag, packed(first, shape), packed(left, right))], RUN)

    # Hashes are even over their range, save some that very many texts have: these are told from a part of the texts, for
    # where rows go only, and spread by text.
    some = texts.where(F.pmod("text_key", F.lit(SHARE)) == 0).mapInArrow(find, RUN_SQL)
    some = t.write(some.groupBy("hash").agg(F.count("*").alias("n")), "often")
    total = some.agg(F.sum("n")).first()[0] or 0
    parts = max(shuffle_partitions(texts.sparkSession), total * SHARE // RUNS)
    least = max(8, total // (4 * parts))
    hot = np.array([r["hash"] for r in some.where(F.col("n") >= least).collect()], np.int64)  # at most four for each partition
    t.drop(some)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs go to their tasks many in a row: Spark has little to do for each run."""

        def out(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            columns = [np.concatenate([b.column(c).to_numpy() for b in rows]) for c in RUN]
            place = columns[0] % parts  # low bits: anchors have small hashes
            if len(hot):
                place = np.where(np.isin(columns[0], hot), columns[1] % parts, place)
            places, pieces = packs(columns, place.astype(np.uint16 if parts < 1 << 16 else np.int32))
            return pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(pieces, pa.binary())], ["place", "runs"])

        held, size = [], 0
        for batch in find(batches):
            held.append(batch)
            size += batch.num_rows
            if size > s.held:
                yield out(held)
                held, size = [], 0
        if size:
            yield out(held)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of a hash that other tasks have too all stay."""
        pieces = [x for b in batches for x in b.column("runs").to_pylist()]
        if not pieces:
            return
        columns, spread = unpacked(pieces), hot
        pieces.clear()
        by = np.argsort(columns[0])
        h = columns[0][by]
        n = np.diff(np.append(np.flatnonzero(_starts_of(h)), len(h)))
        stay = np.repeat(n > 1, n) | np.isin(h, hot)
        by, h = by[stay], h[stay]
        at = 0
        while at < len(h):
            end = len(h)
            if end - at > s.held:
                end = int(np.searchsorted(h, h[at + s.held], "left"))
                if end <= at:  # one hash, too often to be compared together
                    end = at + s.held
                    spread = np.append(spread, h[at])
            hash_, key, tag, place, sides = (c[by[at:end]] for c in columns)
            done = shared_runs([hash_, key, tag, *halves(place), *halves(sides)], spread, s)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in done[:5]], [c.split()[0] for c in KEPT_SQL.split(", ")])
            at = end

    ordered = texts.mapInArrow(deal, "place int, runs binary").repartitionById(parts, "place")
    return ordered.mapInArrow(keep, KEPT_SQL)


def contexts(texts: DataFrame, firsts: DataFrame, runs: DataFrame, s: Settings, t: Tables) -> DataFrame:
    """``hash, content, doc, text_key, tag, first, distance, context``: the bytes of each run's strings and a digest of
    them; of equal texts one stands for all, with the smallest id (``firsts``). Of equal contents that a task meets again
    only the first keeps its bytes."""
    lists = t.write(runs.groupBy("text_key", "tag").agg(F.collect_list(F.struct("hash", "first", "shape")).alias("at")).join(firsts, ["text_key", "tag"]), "lists")
    t.drop(runs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches):
            lists_ = batch.column("at")
            offsets, at = lists_.offsets.to_numpy(), lists_.values
            inside = slice(offsets[0], offsets[-1])
            hashes, firsts, shapes = (at.field(c).to_numpy()[inside] for c in ("hash", "first", "shape"))
            ends = firsts + shapes // SHAPE + s.length - 1
            offsets = offsets - offsets[0]
            keep, parts = np.zeros(len(hashes), bool), []
            for text, a, b in zip(_bytes_of(batch), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                fits = keep[a:b] = ends[a:b] <= len(text)
                parts += [text[x:y] for x, y in zip(firsts[a:b][fits].tolist(), ends[a:b][fits].tolist(), strict=True)]
            content = [digest(x) for x in parts]
            for i, k in enumerate(zip(hashes[keep].tolist(), content, strict=True)):
                if k in seen:
                    parts[i] = None
                elif len(seen) < s.remembered:
                    seen.add(k)
            n = np.diff(offsets)
            own = (pa.array(np.repeat(batch.column(c).to_numpy(), n)[keep]) for c in ("doc", "text_key", "tag"))
            columns = [pa.array(hashes[keep]), pa.array(content, pa.int64()), *own, pa.array(firsts[keep]), pa.array((shapes % SHAPE)[keep].astype(np.int32)), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["hash", "content", "doc", "text_key", "tag", "first", "distance", "context"])

    schema = "hash long, content long, doc long, text_key long, tag int, first int, distance int, context binary"
    found = t.write(texts.join(lists, ["text_key", "tag", "doc"]).select("doc", "text_key", "tag", "text", "at").mapInArrow(cut, schema), "found")
    t.drop(lists)
    return found


def digest(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)


def _ranked(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``key`` (below ``2**bits``) and its sorted values; sorts keys with their places in one number if these fit."""
    low = int(len(key)).bit_length()
    if bits + low > 63:
        order = np.argsort(key)
        return order, key[order]
    packed = np.sort((key << low) | np.arange(len(key)))
    return packed & ((1 << low) - 1), packed >> low


def bounded_sort(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols (below 512) at least: by seven symbols, then by doubling."""
    n, bits = len(text), int(len(text)).bit_length()
    ahead = np.zeros(n + 6, np.int64)
    ahead[:n] = text
    key = ahead[:n].copy()
    for j in range(1, 7):
        key = (key << 9) | ahead[j : j + n]
    order = np.argsort(key)
    key = key[order]
    rank, have = np.empty(n, np.int64), 7
    rank[order] = np.cumsum(np.diff(key, prepend=key[0]) != 0)
    while have < depth and rank[order[-1]] < n - 1:
        ahead = np.zeros(n, np.int64)
        ahead[: n - have] = rank[have:] + 1
        order, key = _ranked((rank << bits) | ahead, 2 * bits)
        rank[order] = np.cumsum(np.diff(key, prepend=key[0]) != 0)
        have *= 2
    return order


def interval_groups(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a text of symbols, and for each row whether it starts a group of suffixes that share their
    first ``depth`` symbols: backward extension of intervals, by increasing length, on the transform."""
    n = len(text)
    order = bounded_sort(text, depth + 1)
    bwt = text[order - 1]  # the symbol before; the text is taken as a circle
    by_symbol = np.argsort(bwt.astype(np.uint16), kind="stable")
    to = np.empty(n, np.int64)  # last-to-first mapping
    to[by_symbol] = np.arange(n)
    edges = np.append(np.flatnonzero(_starts_of(bwt))[1:], n)
    run_end = np.repeat(edges, np.diff(edges, prepend=0))  # of each row where its symbol's run of rows ends
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(depth):
        # Rows of the frontier, by interval and symbol before them: each pair is an interval one symbol longer.
        size = high - low
        plain = run_end[low] >= high  # one symbol before all rows: one interval of the same size
        straight, width = to[low[plain]], size[plain]
        low, size = low[~plain], size[~plain]
        row = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        owner = np.repeat(np.arange(len(size)), size)
        by, key = _ranked((owner << 9) | bwt[row], 9 + int(len(size)).bit_length())
        row = row[by]
        starts = np.flatnonzero(_starts_of(key)) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(starts, len(key)))
        begin = to[np.minimum.reduceat(row, starts)] if len(key) else starts  # rows keep their order under the mapping
        begin, end = np.concatenate([straight, begin]), np.concatenate([straight + width, begin + count])
        new = ~known[end]
        known[end[new]] = True
        low, high = begin[new], end[new]
        if not len(low):
            break
    return order, known[:n]


def resolve(contexts_: list[bytes], least: np.ndarray, s: Settings) -> list[np.ndarray]:
    """For each context the smallest id that has each of its strings, in this block."""
    sizes = np.array([len(c) for c in contexts_])
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join(contexts_) + b"\0", np.uint8).astype(np.int64) + 1
    text[begin + sizes] = 0  # ends of contexts
    order, first = interval_groups(text, s.length)
    strings = sizes - s.length + 1
    owner = np.full(len(text), -1)
    places = np.repeat(begin - np.cumsum(strings) + strings, strings) + np.arange(strings.sum())
    owner[places] = np.repeat(np.arange(len(sizes)), strings)
    ids = np.append(least, np.iinfo(np.int64).max)[owner[order]]
    starts = np.flatnonzero(first)
    low = np.minimum.reduceat(ids, starts)
    out = np.empty(len(text), np.int64)
    out[order] = np.repeat(low, np.diff(np.append(starts, len(ids))))
    return [out[a : a + n] for a, n in zip(begin.tolist(), strings.tolist(), strict=True)]


LOWS = pa.list_(pa.struct([("at", pa.int32()), ("low", pa.int64()), ("n", pa.int32())]))
LOWS_SQL = "array<struct<at:int,low:long,n:int>>"
#: Hashes of crowded anchors that are sent to every task at most; more are joined.
SENT = 100_000


def _flat(low: np.ndarray, most: int) -> list[dict]:
    """Equal neighbours as one (first string, value, count), where a text that has the content comes after the value."""
    edge = np.flatnonzero(np.diff(low, prepend=low[0] - 1))
    n = np.diff(np.append(edge, len(low)))
    return [{"at": a, "low": v, "n": k} for a, v, k in zip(edge.tolist(), low[edge].tolist(), n.tolist(), strict=True) if v < most]


def solved_blocks(contents: DataFrame, s: Settings) -> DataFrame:
    """``hash, content, lows`` of contents whose anchors have ``many`` of them at most: whole anchors at a time, about
    ``block`` bytes together. Contents without a string that could go from any text are left out."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        group: list[tuple] = []
        done: list[tuple] = []
        size = 0

        def close() -> None:
            nonlocal size
            if len(group) == 1:
                h, content, least, most, context = group[0]
                if least < most:
                    done.append((h, content, [{"at": 0, "low": least, "n": len(context) - s.length + 1}]))
            else:
                part.extend(group)
                size += sum(len(x[4]) + 1 for x in group)
            group.clear()

        def solve() -> None:
            nonlocal size
            if part:
                lows = resolve([x[4] for x in part], np.array([x[2] for x in part], np.int64), s)
                done.extend((x[0], x[1], f) for x, low in zip(part, lows, strict=True) if (f := _flat(low, x[3])))
            part.clear()
            size = 0

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], kind) for k, kind in enumerate((pa.int64(), pa.int64(), LOWS))], ["hash", "content", "lows"])
            done.clear()
            return out

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("hash", "content", "least", "most", "context")), strict=True):
                if group and row[0] != group[-1][0]:
                    close()
                    if size > s.block:
                        solve()
                    if len(done) > 5_000:
                        yield batch_of()
                group.append(row)
        if group:
            close()
        solve()
        yield batch_of()

    dealt = contents.select("hash", "content", "least", "most", "context").repartition(shuffle_partitions(contents.sparkSession), "hash").sortWithinPartitions("hash")
    return dealt.mapInArrow(blocks, f"hash long, content long, lows {LOWS_SQL}")


def widened(contents: DataFrame, gram: int, s: Settings) -> DataFrame:
    """``hash, content, at, key, sub, least, most, context, distance``: the strings of each content that reach half of
    the bytes beyond its anchor on the left, and those that do on the right, under the anchor widened by these bytes."""
    h = half(s.length, gram)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for hash_, content, least, most, context, distance in zip(*(batch.column(c).to_pylist() for c in ("hash", "content", "least", "most", "context", "distance")), strict=True):
                n = len(context) - s.length + 1
                to_left = min(n, max(0, distance - h + 1))  # strings before reach far enough to the left
                for a, b, anchor in ((0, to_left, distance - h), (to_left, n, distance)):
                    if a < b:
                        part = context[a : b + s.length - 1]
                        key = digest(context[anchor : anchor + gram + h])
                        rows.append((hash_, content, a, key, digest(part), least, most, part, anchor - a))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["hash", "content", "at", "key", "sub", "least", "most", "context", "distance"])

    return contents.mapInArrow(cut, "hash long, content long, at int, key long, sub long, least long, most long, context binary, distance int")


def _distinct(rows: DataFrame, least: str, most: str) -> DataFrame:
    return rows.groupBy("hash", "content").agg(F.min(least).alias("least"), F.max(most).alias("most"), F.first("context", ignorenulls=True).alias("context"), F.first("distance").alias("distance"))


def least_ids(found: DataFrame, s: Settings, t: Tables) -> DataFrame:
    """``hash, content, lows``: for different contexts, runs of their strings with the smallest id that has them, where
    that is smaller than the id of any text with the content; a content may have several rows."""
    level, gram, places, out = t.write(_distinct(found, "doc", "doc"), "contents"), s.gram, None, None
    while True:
        hot, calm = None, level
        if gram < s.length:
            crowded = t.write(level.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > s.many).select("hash"), "crowded")
            if n := crowded.count():
                hashes = F.broadcast(crowded) if n <= SENT else crowded
                hot, calm = level.join(hashes, "hash", "left_semi"), level.join(hashes, "hash", "left_anti")
        lows = t.write(solved_blocks(calm, s), "solved")
        if places is not None:
            lows = places.join(lows.select(F.col("hash").alias("key"), F.col("content").alias("sub"), "lows"), ["key", "sub"])
            lows = lows.select("hash", "content", F.transform("lows", lambda x: F.struct((x["at"] + F.col("at")).alias("at"), x["low"].alias("low"), x["n"].alias("n"))).alias("lows"))
        out = lows if out is None else out.unionByName(lows)
        if hot is None:
            return out
        parts = t.write(widened(hot, gram, s), "widened")
        gram += half(s.length, gram)
        if places is None:
            places = parts.select("hash", "content", "at", "key", "sub")
        else:
            deeper = parts.select(F.col("hash").alias("key"), F.col("content").alias("sub"), F.col("at").alias("more"), F.col("key").alias("key2"), F.col("sub").alias("sub2"))
            places = places.join(deeper, ["key", "sub"]).select("hash", "content", (F.col("at") + F.col("more")).alias("at"), F.col("key2").alias("key"), F.col("sub2").alias("sub"))
        places = t.write(places, "places")
        level = t.write(_distinct(parts.select(F.col("key").alias("hash"), F.col("sub").alias("content"), "least", "most", "context", "distance"), "least", "most"), "contents")


def removed_spans(texts: DataFrame, s: Settings, t: Tables) -> DataFrame:
    """``text_key, tag, least, spans``: of each different text its smallest id, and the byte spans (start, end) that are
    to go from it there, overlapping as they come. Larger copies go whole."""
    firsts = t.write(texts.groupBy("text_key", "tag").agg(F.min("doc").alias("doc")), "firsts")
    found = contexts(texts, firsts, t.write(shared_anchors(texts, s, t), "runs"), s, t)
    lows = least_ids(found, s, t)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("lows")
            offsets = lists.offsets.to_numpy()
            at, low, n = (lists.values.field(c).to_numpy()[offsets[0] : offsets[-1]] for c in ("at", "low", "n"))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            doc, key, tag, begin = (batch.column(c).to_numpy()[rows] for c in ("doc", "text_key", "tag", "first"))
            gone = low < doc
            start = (begin + at)[gone]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[gone], tag[gone], start, start + n[gone] - 1 + s.length)], ["text_key", "tag", "start", "end"])

    marked = found.select("hash", "content", "doc", "text_key", "tag", "first").join(lows, ["hash", "content"]).select("doc", "text_key", "tag", "first", "lows")
    marked = t.write(marked.mapInArrow(marks, "text_key long, tag int, start int, end int"), "marks")
    t.drop(found)
    spans = marked.groupBy("text_key", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return t.write(firsts.withColumnRenamed("doc", "least").join(spans, ["text_key", "tag"], "left"), "spans")


def dedup_substrings(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256``; ``kept`` holds the remaining bytes."""
    s = s or Settings()
    texts = texts_of(docs).select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text", F.xxhash64("text").alias("text_key"), F.hash("text").alias("tag"))
    spans = removed_spans(texts.select("doc", "text", "text_key", "tag"), s, Tables(docs.sparkSession, "substrings"))
    joined = texts.join(spans, ["text_key", "tag"]).select("doc_id", "text", (F.col("doc") > F.col("least")).alias("copy"), F.when(F.col("doc") == F.col("least"), F.col("spans")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, lists = [], batch.column("spans")
            offsets = lists.offsets.to_numpy()
            begins, ends = (lists.values.field(c).to_numpy() for c in ("start", "end"))
            for text, copy, a, b in zip(_bytes_of(batch), batch.column("copy").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if copy and len(text) >= s.length:
                    rows.append((len(text), len(text), 1, b"", hashlib.sha256(b"").hexdigest()))
                    continue
                if a == b:
                    rows.append((len(text), 0, 0, text, hashlib.sha256(text).hexdigest()))
                    continue
                step = np.bincount(begins[a:b], minlength=len(text) + 1) - np.bincount(ends[a:b], minlength=len(text) + 1)
                gone = np.cumsum(step[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                rows.append((len(text), int(gone.sum()), int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0]), kept, hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")

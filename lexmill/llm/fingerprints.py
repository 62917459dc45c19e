"""Document fingerprints: prefix polynomial hashes.

For a text of code points ``c_0 .. c_(n-1)`` the prefix array ``P[i] = sum of (c_j + 1) * B**j for j < i`` modulo a
prime answers equality of any two spans in constant time, and a binary search over it gives longest common
extensions. A fingerprint is read off two such arrays:

* the length and the hash of the whole text;
* the hashes of the prefixes at the points of a fixed grid (1, 2, ... 8, 10, 12, 14, 16, 20, ...), among which a binary
  search finds, to a quarter of itself, how far two texts agree from their start;
* the ``kept`` smallest hashes of all spans of ``span`` code points.

The likeness of two fingerprints is 1 for equal texts, else the larger of two shares: of the longer text that the common
prefix covers, and of the spans that both have, as estimated from the smallest hashes of their union. It is the same for
texts of any length.

Defined results: a null text is an empty text; empty texts have equal fingerprints and likeness 1; a text shorter
than a span is one span; texts are never cut, however long; equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import boundaries_of, shuffle_partitions, texts_of

P1, P2 = (1 << 31) - 1, (1 << 31) - 19
B1, B2 = 911_382_323, 972_663_749
BACK1, BACK2 = pow(B1, -1, P1), pow(B2, -1, P2)
BLOCK = 1 << 14


@dataclass(frozen=True)
class Settings:
    """``span``: code points of a compared span; ``kept``: smallest span hashes that a fingerprint keeps."""

    span: int = 8
    kept: int = 64


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=8)
def _table(base: int, prime: int) -> np.ndarray:
    """``base**0 .. base**(BLOCK - 1)`` modulo ``prime``; longer ones are this table times one number for each block."""
    out = np.ones(1, np.int64)
    while len(out) < BLOCK:  # doubling: base**(n + i) = base**n * base**i
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out


def powers(base: int, prime: int, start: int, size: int) -> np.ndarray:
    """``base**start .. base**(start + size - 1)`` modulo ``prime``, for at most ``BLOCK`` of them."""
    return _table(base, prime)[:size] * pow(base, start, prime) % prime


class PrefixHash:
    """The prefix arrays of one text, modulo two primes; worked out block by block, eight bytes for each code point."""

    def __init__(self, text: str, head: PrefixHash | None = None, keep: int = 0) -> None:
        """``head``, ``keep``: arrays of a text that begins with the same ``keep`` code points, to go on from."""
        c = code_points(text[keep:])
        self.n, self.keep, self.head = keep + len(c), keep, head
        self.hashes: dict[int, np.ndarray] = {}
        self.prefix = []
        for k, (b, p) in enumerate(((B1, P1), (B2, P2))):
            out = np.zeros(self.n + 1, np.uint32)
            if head:
                out[: keep + 1] = head.prefix[k][: keep + 1]
            last = int(out[keep])
            for a in range(0, len(c), BLOCK):
                part = c[a : a + BLOCK].astype(np.int64) + 1
                sums = np.cumsum(part * powers(b, p, keep + a, len(part)) % p) + last  # below 2**15 terms of 31 bits
                out[keep + a + 1 : keep + a + 1 + len(part)] = sums % p
                last = int(sums[-1] % p)
            self.prefix.append(out)

    def span(self, start: int, length: int) -> int:
        """62-bit hash of the span of ``length`` at ``start``, the same wherever it stands."""
        one, two = ((int(x[start + length]) - int(x[start])) * pow(back, start, p) % p for x, back, p in zip(self.prefix, (BACK1, BACK2), (P1, P2), strict=True))
        return one << 31 | two

    def all_spans(self, length: int) -> np.ndarray:
        """Mixed 32-bit hashes, modulo one prime, of the spans at every place; those of ``head`` are taken over."""
        if length not in self.hashes:
            places = self.n - length + 1
            out, first = np.empty(places, np.uint32), 0
            if self.head and self.head.n >= length:
                first = max(0, self.keep - length + 1)
                out[:first] = self.head.all_spans(length)[:first]
            prefix = self.prefix[0]
            for a in range(first, places, BLOCK):
                b = min(places, a + BLOCK)
                h = prefix[a + length : b + length].astype(np.int64) - prefix[a:b]
                out[a:b] = _mix((h % P1 * powers(BACK1, P1, a, b - a) % P1).astype(np.uint64))
            self.hashes[length] = out
        return self.hashes[length]

    def equal(self, i: int, j: int, length: int, other: PrefixHash | None = None) -> bool:
        """Whether the spans of ``length`` at ``i`` here and at ``j`` in ``other`` (or here) are equal."""
        return self.span(i, length) == (other or self).span(j, length)

    def common_extension(self, i: int, j: int, other: PrefixHash | None = None) -> int:
        """Length of the longest common extension from ``i`` here and ``j`` in ``other`` (or here)."""
        other = other or self
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.equal(i, j, mid, other) else (low, mid - 1)
        return low


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32)


def _smallest(h: np.ndarray, kept: int) -> np.ndarray:
    if len(h) > 8 * kept:
        most = kept * 4  # equal spans repeat: look at more than are kept, at all if that does not do
        few = np.unique(np.partition(h, most)[:most])
        if len(few) >= kept:
            return few[:kept]
    return np.unique(h)[:kept]


def grid(n: int) -> list[int]:
    """The points of the grid below ``n``: four between a power of two and the next."""
    out, step = [], 1
    while True:
        for g in range(4 * step if step > 1 else 1, 8 * step, step):
            if g >= n:
                return out
            out.append(g)
        step *= 2


@dataclass(frozen=True)
class Fingerprint:
    n: int
    whole: int
    prefixes: tuple[int, ...]
    spans: tuple[int, ...]

    @staticmethod
    def of(prefix: PrefixHash, s: Settings = Settings()) -> Fingerprint:  # noqa: B008
        n = prefix.n
        if not n:
            return Fingerprint(0, 0, (), ())
        at = grid(n)
        ends = (prefix.prefix[0][at].astype(np.uint64) << np.uint64(31)) | prefix.prefix[1][at]
        return Fingerprint(n, prefix.span(0, n), tuple(_mix(ends).tolist()), tuple(_smallest(prefix.all_spans(min(n, s.span)), s.kept).tolist()))

    def __str__(self) -> str:
        return f"{self.n}:{self.whole:016x}:{''.join(f'{x:08x}' for x in self.prefixes)}:{''.join(f'{x:08x}' for x in self.spans)}"

    @staticmethod
    def parse(text: str) -> Fingerprint:
        n, whole, *lists = text.split(":")
        return Fingerprint(int(n), int(whole, 16), *(tuple(int(x[i : i + 8], 16) for i in range(0, len(x), 8)) for x in lists))

    def common_prefix(self, other: Fingerprint) -> int:
        """The last point of the grid up to which both texts agree."""
        low, high = 0, min(len(self.prefixes), len(other.prefixes))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.prefixes[mid - 1] == other.prefixes[mid - 1] else (low, mid - 1)
        return grid(min(self.n, other.n))[low - 1] if low else 0

    def likeness(self, other: Fingerprint, s: Settings = Settings()) -> float:  # noqa: B008
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        union = sorted({*self.spans, *other.spans})[: s.kept]
        shared = len({*self.spans} & {*other.spans} & {*union}) / len(union)
        return max(shared, self.common_prefix(other) / max(self.n, other.n))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_prefix long"


def _range_of(key: Column, cuts: list[int]) -> Column:
    """The number of ``cuts`` (ascending) that are not below ``key``: by steps of the square root of their number, then
    one by one within a step."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    longs = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # noqa: E731  folded to one literal
    steps = F.size(F.filter(longs(cuts[step - 1 :: step]), lambda c: c < key)) * step
    return F.lit(len(cuts)) - steps - F.size(F.filter(F.slice(longs(cuts), steps + 1, F.lit(step)), lambda c: c < key))


def fingerprint_edits(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """Fingerprints of every text and of its edit: the last third replaced by the head of the next document.

    "Next" follows descending ``doc_id`` (nulls last, by a hash of the text; equal ids by text), and the first follows the last. Documents go
    once through a shuffle, by ranges of ids; the head of a range also goes, as a guest, to the range that comes
    before it, so each task finds every neighbour at hand. ``kept_prefix`` is the longest common extension of a text and its edit.
    """
    import hashlib

    s = s or Settings()
    spark = docs.sparkSession
    texts = texts_of(docs)
    # Rows without an id come last, in order of a hash of the text, so that they too spread over ranges.
    last = F.shiftrightunsigned(F.xxhash64("text"), 2) - F.lit(1 << 62) - F.lit(1 << 62)
    keyed = texts.select("doc_id", "text", F.coalesce(F.col("doc_id"), last).alias("key"))
    parts = shuffle_partitions(spark)
    cuts = boundaries_of(keyed.select("key"), "key", 8 * parts)
    # Ranges are numbered in the order of the walk: 0 holds the largest ids.
    placed = keyed.withColumn("at", _range_of(F.col("key"), cuts))
    heads = {r["at"]: r["head"] for r in placed.groupBy("at").agg(F.max("key").alias("head")).collect()}  # a row for each range, at most 8 * parts
    order = sorted(heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first range's head follows the last range
    if order:
        ranges = spark.createDataFrame([(b, heads[b], before[b]) for b in order], "at int, head long, host int")
        placed = placed.join(F.broadcast(ranges), "at")
        own = F.struct(F.col("at").alias("range"), F.lit(False).alias("guest"))
        guest = F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))
        placed = placed.withColumn("place", F.explode(F.when(F.col("key") == F.col("head"), F.array(own, guest)).otherwise(F.array(own)))).select("doc_id", "text", "key", "place.range", "place.guest")
    else:
        placed = placed.select("doc_id", "text", "key", F.col("at").alias("range"), F.lit(False).alias("guest"))
    sorted_ = placed.repartition(parts, "range").sortWithinPartitions("range", "guest", F.desc("key"), F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(now: tuple, after: tuple) -> tuple:
            text, following = now[1], after[1]
            n = len(text)
            k = n // 3
            edited = text[: n - k] + following[:k] if k else text
            here = now[4] or PrefixHash(text)
            there = here if edited == text else PrefixHash(edited, here, n - k)
            after[4] = here if following == text else PrefixHash(following)
            a, b, c = (Fingerprint.of(x, s) for x in (here, there, after[4]))
            return (now[0], n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), str(a), str(b), a.likeness(b, s), a.likeness(c, s), here.common_extension(0, 0, there))

        def rows() -> Iterator[tuple]:
            last = None  # waits for what follows it
            for batch in batches:
                for doc_id, text, range_, guest in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "text", "range", "guest")), strict=True):
                    row = [doc_id, text, range_, guest, None]
                    if last is not None and last[2] == range_ and not last[3]:
                        yield one(last, row)
                    last = row

        found, size = [], 0
        for row in rows():
            found.append(row)
            size += 1
            if size == 500:
                yield _batch(found)
                found, size = [], 0
        if found:
            yield _batch(found)

    return sorted_.select("doc_id", "text", "range", "guest").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[x.split()[1]]) for c, x in zip(zip(*rows, strict=True), SCHEMA.split(", "), strict=True)], names)

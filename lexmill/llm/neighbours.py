"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Equal vectors are one vector with the few smallest ids that an answer can need, so copies cost nothing beyond a count. Vectors are scaled by
the largest norm and given one more component that makes their length one; for a query of length one the largest inner
product is then the smallest distance. A table's hash functions project on normal (2-stable) directions and cut the
line into slots; the slots of all its functions name a bucket.

A query looks for vectors at a likeness ``c``: what its wanted neighbours have at least, by exact search for a bounded sample of
queries. Ranks by inner product do not change when a query is made longer, so it is put at ``1 / c`` of its direction,
where the vectors it wants are nearest against all others; their projections are then normal around its own. That orders
the buckets by estimated success; they are visited until the chance that a wanted neighbour's bucket is
among them reaches the table's share of ``success``. Buckets for very near vectors (``near``) are added. Nothing is
capped, and no list of buckets is made: an estimate of success is a sum over the functions, so how far down the order a query
goes follows from their distributions, and a bucket at hand is visited if its own sum lies within that.

Vectors travel once, packed into blocks, and so do queries; every block meets every query in a Cartesian product of packed rows,
where the vectors of a block are grouped by bucket in each table and a bucket's vectors are multiplied with the queries that visit it. So a bucket with
a third of all rows is in as many tasks as others are. Single precision with a proved margin decides what is looked at; the scores
that count are inner products of the original vectors in double precision. A task keeps the best of each query over all its blocks.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without an id, take no
part; components that a shorter vector lacks count as zero; a row that repeats an id and vector counts once, one that repeats
an id with another vector is a row of its own, and no query is answered by its own id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import erf, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import Tables, shuffle_partitions


@dataclass(frozen=True)
class Settings:
    """``bucket_rows``: vectors in a bucket on average, which sets the number of functions of a table; ``sample``: queries
    searched exactly to learn what likeness to look for; ``block``: rows of a bucket that meet at once."""

    tables: int = 3
    width: float = 2.5
    bucket_rows: int = 512
    success: float = 0.95
    near: float = 0.95
    sample: int = 64
    block: int = 4096
    seed: int = 12


@dataclass(frozen=True)
class Index:
    """Directions and offsets of all tables' functions, and what the vectors are scaled by."""

    directions: np.ndarray  # (tables, functions, dimension + 1)
    offsets: np.ndarray  # (tables, functions)
    width: float
    largest: float

    @property
    def dim(self) -> int:
        return self.directions.shape[2] - 1

    def projections(self, x: np.ndarray, query: bool) -> np.ndarray:
        """(tables, rows, functions) of vectors scaled by the largest norm, or of queries of length one."""
        scaled = x / (np.linalg.norm(x, axis=1, keepdims=True) if query else self.largest)
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
        return np.stack([scaled @ d[:, :-1].T + rest[:, None] * d[:, -1] for d in self.directions])

    def slots(self, x: np.ndarray) -> np.ndarray:
        """(tables, rows, functions): the slots of vectors, the first one being 0."""
        first, n = slot_range(self.width)
        slots = np.floor((self.projections(x, False) + self.offsets[:, None, :]) / self.width)
        return np.clip(slots, first, first + n - 1).astype(np.int64) - first


def slot_range(width: float) -> tuple[int, int]:
    """The first slot and the number of slots; what lies beyond counts to the outermost ones."""
    first = int(np.floor(-FAR / width))
    return first, int(np.floor((FAR + width) / width)) - first + 1


def bucket_names(table: int, slots: np.ndarray) -> np.ndarray:
    """64-bit names of (rows, functions) slots. Two buckets of a block with one name, by a chance of 2 ** -64, would be visited together."""
    h = np.full(len(slots), table + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(slots.shape[1]):
            h = (h ^ (slots[:, j].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
    return h.view(np.int64)


_below = np.vectorize(lambda x: 0.5 * (1.0 + erf(x / 2**0.5)), otypes=[float])
#: Deviations from the origin up to which slots have a place of their own; further ones count to the outermost.
FAR = 4.5
#: The chance that a very near vector is found.
NEAR_SUCCESS = 0.97


def slot_chances(at: np.ndarray, spread: float, offsets: np.ndarray, first: int, n: int, width: float) -> np.ndarray:
    """(rows, functions, n): the chance that a normal around ``at`` falls into each of the slots from ``first`` on; the
    outermost ones take what lies beyond."""
    edges = (np.arange(1, n) + first) * width
    under = _below((edges[None, None, :] - offsets[None, :, None] - at[:, :, None]) / spread)
    return np.diff(under, axis=2, prepend=0.0, append=1.0)


def best_buckets(order: np.ndarray, chance: np.ndarray, wanted: float) -> tuple[np.ndarray, np.ndarray]:
    """``row, slots``: for each row the buckets in descending product of ``order`` until their products of ``chance`` sum
    to ``wanted``.

    The best buckets of the first functions hold the beginnings of all best buckets, so a list of a fixed length is
    exact as far as it goes; it is doubled until no row wants more. This is the plain form, by which ``depths`` is tested: lists
    of many functions at a faint likeness do not fit into memory."""
    rows, functions, n = order.shape
    keep = 64
    while True:
        score, chances, slots = np.ones((rows, 1)), np.ones((rows, 1)), np.zeros((rows, 1, 0), np.int16)
        for j in range(functions):
            score = (score[:, :, None] * order[:, j, None, :]).reshape(rows, -1)
            chances = (chances[:, :, None] * chance[:, j, None, :]).reshape(rows, -1)
            top = np.argpartition(-score, keep - 1, axis=1)[:, :keep] if score.shape[1] > keep else np.tile(np.arange(score.shape[1]), (rows, 1))
            score, chances = np.take_along_axis(score, top, 1), np.take_along_axis(chances, top, 1)
            slots = np.concatenate([np.take_along_axis(slots, (top // n)[:, :, None], 1), (top % n).astype(np.int16)[:, :, None]], axis=2)
        by = np.argsort(-score, axis=1, kind="stable")
        upto = np.cumsum(np.take_along_axis(chances, by, 1), axis=1)
        if keep >= n**functions or (upto[:, -1] >= wanted).all():
            break
        keep *= 2
    row, place = np.nonzero(np.concatenate([np.ones((rows, 1), bool), upto[:, :-1] < wanted], axis=1))
    return row, slots[row, by[row, place]]


#: Steps of an estimate's logarithm, and how many of them below the best bucket are told apart; queries that go further visit all buckets.
STEPS, DEEP = 16, 320
EVERY = np.iinfo(np.int32).max


def depths(order: np.ndarray, chance: np.ndarray, wanted: float) -> tuple[np.ndarray, np.ndarray]:
    """``costs, depth``: what each slot of each function (rows, functions, n) takes from the product of ``order``, in steps of its
    logarithm, and for each row the sum of costs up to which the buckets' products of ``chance`` sum to ``wanted``.

    These are the buckets of ``best_buckets`` but for rounding to steps, without a list of them: the sum's distribution is that of
    independent functions, added one by one."""
    rows, functions, n = order.shape
    costs = -np.log(np.maximum(order, 1e-300))
    costs = np.minimum(np.rint((costs - costs.min(axis=2, keepdims=True)) * STEPS), DEEP).astype(np.int64)
    upto = np.zeros((rows, 2 * DEEP))  # the left half stays empty
    upto[:, DEEP] = 1.0
    at = np.arange(rows)[:, None] * (2 * DEEP) + np.arange(DEEP, 2 * DEEP)[None, :]
    for j in range(functions):
        upto[:, DEEP:] = sum(np.take(upto, at - costs[:, j, slot, None]) * chance[:, j, slot, None] for slot in range(n))
    enough = np.cumsum(upto[:, DEEP:], axis=1) >= wanted - 1e-12
    return costs, np.where(enough.any(axis=1), enough.argmax(axis=1), EVERY)


def ways(index: Index, q: np.ndarray, like: float, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """``costs, depth`` of (rows, tables, 2) for queries ``q``: for vectors at ``like`` and for very near ones."""
    first, n = slot_range(s.width)
    costs, depth = [], []
    for t, at in enumerate(index.projections(q, True)):
        for c, share in ((like, s.success), (max(like, s.near), NEAR_SUCCESS)):
            spread = (1.0 - c * c) ** 0.5
            chance = slot_chances(c * at, spread, index.offsets[t], first, n, s.width)
            order = slot_chances(at / c, spread / c, index.offsets[t], first, n, s.width)
            for told, x in zip((costs, depth), depths(order, chance, 1.0 - (1.0 - share) ** (1.0 / s.tables)), strict=True):
                told.append(x)
    shape = (len(q), len(index.directions), 2)
    return np.stack(costs, axis=1).astype(np.int16).reshape(*shape, -1, n), np.stack(depth, axis=1).astype(np.int32).reshape(shape)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a list column as rows of ``dim`` doubles, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """``v, ids`` of ``rows(id, v)``: each different vector with the ``most`` smallest of its ids."""
    few = rows.withColumn("h", F.xxhash64("v"))  # sorts by a number, vectors only where it is equal
    few = few.withColumn("r", F.dense_rank().over(Window.partitionBy("h", "v").orderBy("id"))).where(F.col("r") <= most)
    return few.groupBy("h", "v").agg(F.sort_array(F.collect_set("id")).alias("ids")).select("v", "ids")


def _exact(vectors: DataFrame, asked: np.ndarray, k: int) -> DataFrame:
    """``q, score``: of each batch the ``k`` largest inner products of each of a few queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = asked @ _matrix(batch.column("v"), asked.shape[1]).T
                best = -np.partition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(asked)), best.shape[1])), pa.array(best.ravel())], ["q", "score"])

    return vectors.select("v").mapInArrow(run, "q long, score double")


def fit(vectors: DataFrame, asked: DataFrame, k: int, s: Settings) -> tuple[Index, float, int] | None:
    """The index's functions, the likeness that queries look for and the number of vectors. The likeness is exceeded by the ``k``-th neighbour of three quarters of
    a sample of ``asked``, found exactly over all ``vectors``."""
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    known = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(size).alias("largest")).first()
    some = [r["v"] for r in asked.orderBy(F.xxhash64("v"), "v").select("v").limit(s.sample).collect()]
    if not known["n"] or not some:
        return None
    q = np.zeros((len(some), known["dim"]))
    for row, v in zip(q, some, strict=True):
        row[: len(v)] = v
    by = Window.partitionBy("q").orderBy(F.desc("score"))
    ranked = _exact(vectors, q, k + 1).withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1).groupBy("q").agg(F.min("score").alias("least"))
    least = {r["q"]: r["least"] for r in ranked.collect()}  # a row for each of the sample
    likes = [least[i] / (known["largest"] * np.linalg.norm(q[i])) for i in range(len(q))]
    functions = round(log(max(1.0, known["n"] / s.bucket_rows)) / log(2.8))  # a function makes nearly three buckets of each
    tables = s.tables if functions else 1  # a small table is one bucket, and its answers exact
    rng = np.random.default_rng(s.seed)
    index = Index(rng.standard_normal((tables, functions, known["dim"] + 1)), rng.uniform(0, s.width, (tables, functions)), s.width, known["largest"])
    return index, float(np.clip(np.quantile(likes, 0.25), 0.05, 0.99)), known["n"]


#: Bytes of vectors in a packed row, and queries in one.
BLOCK_BYTES, QUERIES = 16 << 20, 8192


def _packed(rows: DataFrame, columns: dict[str, str], full: Callable[[int], int], unpack: Callable[[pa.RecordBatch], list[np.ndarray]]) -> DataFrame:
    """Rows whose binary ``columns`` hold up to ``full(bytes of one)`` rows each, as ``unpack`` gives them, in the given kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        have = 0

        def told() -> pa.RecordBatch:
            parts = [np.ascontiguousarray(np.concatenate(c), kind) for c, kind in zip(zip(*held, strict=True), columns.values(), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in parts], list(columns))

        for batch in batches:
            parts = unpack(batch) if batch.num_rows else []
            most = full(parts[-1][0].nbytes) if parts else 1
            a = 0
            while a < batch.num_rows:
                b = min(batch.num_rows, a + most - have)
                held.append([c[a:b] for c in parts])
                have, a = have + b - a, b
                if have >= most:
                    yield told()
                    held, have = [], 0
        if have:
            yield told()

    return rows.mapInArrow(run, ", ".join(f"{c} binary" for c in columns))


def blocks(vectors: DataFrame, index: Index, kind: str) -> DataFrame:
    """``ids, least, v``: the vectors, packed."""
    real = "f4" if kind == "array<float>" else "f8"
    unpack = lambda batch: [batch.column("id").to_numpy(), batch.column("least").to_numpy(), _matrix(batch.column("v"), index.dim).astype(real)]
    return _packed(vectors.select("id", "least", "v"), {"ids": "i8", "least": "i8", "v": real}, lambda size: max(1, BLOCK_BYTES // size), unpack)


def probing(asked: DataFrame, index: Index, like: float, s: Settings, parts: int) -> DataFrame:
    """``asked, costs, depth, x``: the queries and the ways that they go, packed, in ``parts`` partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                told = ways(index, _matrix(part.column("v"), index.dim), like, s)
                bits = [pa.array([row.tobytes() for row in x], pa.binary()) for x in told]
                yield pa.RecordBatch.from_arrays([part.column("id"), *bits, part.column("v")], ["id", "costs", "depth", "v"])

    def unpack(batch: pa.RecordBatch) -> list[np.ndarray]:
        costs, depth = (np.frombuffer(b"".join(batch.column(c).to_pylist()), d).reshape(batch.num_rows, -1) for c, d in (("costs", "i2"), ("depth", "i4")))
        return [batch.column("id").to_numpy(), costs, depth, _matrix(batch.column("v"), index.dim)]

    kind = asked.schema["v"].dataType.simpleString()
    dealt = asked.select("id", "v").mapInArrow(run, f"id long, costs binary, depth binary, v {kind}").repartition(parts)
    return _packed(dealt, {"asked": "i8", "costs": "i2", "depth": "i4", "x": "f8"}, lambda _: QUERIES, unpack)


def places(flags: np.ndarray) -> np.ndarray:
    """Where few of many flags hold, found by eight at once."""
    whole = len(flags) // 8 * 8
    at = (np.flatnonzero(flags[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flags[at]], np.flatnonzero(flags[whole:]) + whole])


class Held:
    """The vectors of a block, and their buckets in each table."""

    def __init__(self, index: Index, ids: np.ndarray, least: np.ndarray, v: np.ndarray) -> None:
        self.ids, self.least, self.v = ids, least, v
        x = v.astype(np.float64)
        self.scaled = (x / index.largest).astype(np.float32)
        self.norms = np.linalg.norm(self.scaled, axis=1)
        self.tables = []
        for t, slots in enumerate(index.slots(x)):
            _, some, which, sizes = np.unique(bucket_names(t, slots), return_index=True, return_inverse=True, return_counts=True)
            self.tables.append((slots, slots[some], np.argsort(which, kind="stable"), np.cumsum(sizes) - sizes, sizes))


class Best:
    """The ``k`` best candidates of each of a block of queries, kept in flat columns."""

    #: Candidates held before they are cut back to ``k`` for each query; scores worked out together; rows of a bucket that meets its own queries only.
    HELD, CELLS, LARGE = 1 << 19, 1 << 21, 32

    def __init__(self, index: Index, k: int, block: int, asked: np.ndarray, costs: np.ndarray, depth: np.ndarray, x: np.ndarray) -> None:
        self.k, self.block, self.asked, self.costs, self.depth, self.x = k, block, asked, costs, depth, x
        norms = np.linalg.norm(x, axis=1)
        self.unit, self.scale = (x / norms[:, None]).astype(np.float32), index.largest * norms
        self.error = (x.shape[1] + 16) * 2.0**-24  # of an inner product in single precision, for lengths of one
        #: What the k-th best score found is at least, scaled.
        self.floor = np.full(len(asked), -np.inf)
        self.parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0)]]
        self.held = 0
        cells = max(self.CELLS, block)
        self.scores, self.high = np.empty(cells, np.float32), np.empty(cells, bool)

    def visit(self, held: Held) -> None:
        """Meets the vectors of a block in the buckets that each query visits."""
        queries, n = np.arange(len(self.asked)), self.costs.shape[-1]
        for t, (slots, names, rows, starts, sizes) in enumerate(held.tables):
            large = np.flatnonzero(sizes >= self.LARGE)
            large = large[np.argsort(-sizes[large], kind="stable")]
            if len(large):
                taken = (names[large][:, :, None] == np.arange(n)).reshape(len(large), -1).astype(np.float32)
                visits = np.zeros((len(large), len(queries)), bool)
                for way in (0, 1):  # sums of whole numbers, exact in single precision
                    visits |= taken @ self.costs[:, t, way].reshape(len(queries), -1).T.astype(np.float32) <= self.depth[:, t, way].astype(np.float64)
                for b, visited in zip(large, visits, strict=True):
                    self.meet(held, np.flatnonzero(visited), rows[starts[b] : starts[b] + sizes[b]])
            rest = rows[np.repeat(sizes < self.LARGE, sizes)]
            if len(rest):
                self.meet(held, queries, rest, (t, slots))

    def meet(self, held: Held, queries: np.ndarray, rows: np.ndarray, within: tuple[int, np.ndarray] | None = None) -> None:
        """Scores ``queries`` against ``rows``; ``within`` a table and its slots, only where the query visits the row's bucket."""
        for a in range(0, len(rows), self.block):
            some = rows[a : a + self.block]
            x, error = held.scaled[some].T, self.error * float(held.norms[some].max()) + 1e-30
            step = max(1, self.CELLS // len(some))
            for i in range(0, len(queries), step):
                q = queries[i : i + step]
                size = len(q) * len(some)
                scores = np.matmul(self.unit[q], x, out=self.scores[:size].reshape(len(q), len(some)))
                if within is None and len(some) >= self.k:
                    new = np.flatnonzero(np.isneginf(self.floor[q]))
                    if len(new):
                        self.floor[q[new]] = np.partition(scores[new], len(some) - self.k, axis=1)[:, len(some) - self.k] - error
                # all that tie with the k-th stay: the smallest id decides among them later
                high = np.greater_equal(scores, (self.floor[q] - error).astype(np.float32)[:, None], out=self.high[:size].reshape(scores.shape))
                row, col = np.divmod(places(high.ravel()), len(some))
                if within is not None and len(row):
                    kept = self.visited(q[row], within[0], within[1][some[col]])
                    row, col = row[kept], col[kept]
                if len(row):
                    self.add(held, q[row], some[col])

    def visited(self, q: np.ndarray, t: int, slots: np.ndarray) -> np.ndarray:
        which = np.arange(slots.shape[1])
        sums = (self.costs[q[:, None], t, way, which, slots].sum(axis=1, dtype=np.int64) for way in (0, 1))
        return np.logical_or(*(total <= self.depth[q, t, way] for way, total in enumerate(sums)))

    def add(self, held: Held, q: np.ndarray, rows: np.ndarray) -> None:
        for a in range(0, len(q), 1 << 15):
            some, at = q[a : a + (1 << 15)], rows[a : a + (1 << 15)]
            self.parts.append([some, held.ids[at], held.least[at], np.einsum("ij,ij->i", self.x[some], held.v[at].astype(np.float64))])
        self.held += len(q)
        if self.held > self.HELD:
            self.cut()

    def cut(self) -> list[np.ndarray]:
        q, ids, small, scores = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        by = np.lexsort((ids, small, -scores, q))
        q, ids, small, scores = q[by], ids[by], small[by], scores[by]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])  # a pair's scores agree, so what several tables found is side by side
        q, ids, small, scores = q[new], ids[new], small[new], scores[new]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        kept = rank < self.k
        last = kept & (rank == self.k - 1)
        self.floor[q[last]] = scores[last] / self.scale[q[last]] - self.error * 2.0**-8
        self.parts = [[q[kept], ids[kept], small[kept], scores[kept]]]
        self.held = int(kept.sum())
        return self.parts[0]

    def told(self) -> pa.RecordBatch:
        """``q, found``: a row for each query that has candidates."""
        q, ids, small, scores = self.cut()
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
        each = pa.StructArray.from_arrays([pa.array(-scores), pa.array(small), pa.array(ids)], ["far", "least", "id"])
        return pa.RecordBatch.from_arrays([pa.array(self.asked[q[first]]), pa.ListArray.from_arrays(pa.array(np.r_[first, len(q)].astype(np.int32)), each)], ["q", "found"])


def meet(packed: DataFrame, probed: DataFrame, index: Index, k: int, s: Settings, kind: str) -> DataFrame:
    """``q, found``: the ``k`` best of each query from the blocks of each task."""
    real = "f4" if kind == "array<float>" else "f8"
    _, n = slot_range(s.width)
    tables, functions, _ = index.directions.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        now = None
        for batch in batches:
            for i in range(batch.num_rows):
                of = lambda c, d, *shape: np.frombuffer(batch.column(c)[i].as_buffer(), d).reshape(-1, *shape)  # noqa: B023, E731
                ids, asked = of("ids", "i8"), of("asked", "i8")
                if now is None or now.ids[0] != ids[0]:
                    now = Held(index, ids, of("least", "i8"), of("v", real, index.dim))
                if int(asked[0]) not in best:
                    own = (of("costs", "i2", tables, 2, functions, n) if functions else np.zeros((len(asked), tables, 2, 0, n), np.int16)), of("depth", "i4", tables, 2), of("x", "f8", index.dim)
                    best[int(asked[0])] = Best(index, k, s.block, asked.copy(), *(x.copy() for x in own))
                best[int(asked[0])].visit(now)
        for one in best.values():
            yield one.told()
        pa.default_memory_pool().release_unused()

    pairs = packed.hint("shuffle_replicate_nl").crossJoin(probed)
    return pairs.mapInArrow(run, "q long, found array<struct<far: double, least: long, id: long>>")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, s: Settings | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` that ``queries`` holds for."""
    s, t = s or Settings(), Tables(vectors.sparkSession, "neighbours")
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.where(_usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"), queries.alias("asked"))
    found = distinct_vectors(rows.select("id", "v"), k + 1).select(F.monotonically_increasing_id().alias("id"), "ids", F.get("ids", F.lit(0)).alias("least"), "v")
    found = t.write(found, "vectors")
    hashed = lambda df, c: df.select(F.col("id").alias(c), F.xxhash64("v").alias("h"), "v")
    named = t.write(hashed(rows.where("asked"), "query_id").join(hashed(found, "q"), ["h", "v"]).select("query_id", "q").distinct(), "named")
    asked = t.write(found.join(named.select(F.col("q").alias("id")).distinct(), "id", "left_semi").select("id", "v"), "asked")
    fitted = fit(found, asked, k, s)
    empty = "query_id long, rank int, vec_id long, score double"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], empty)
    index, like, rows_of = fitted
    # blocks of vectors by blocks of queries: a query has few lists of candidates, however many tasks there are
    many = asked.count()
    sides = min(8, -(-rows_of * index.dim * (4 if kind == "array<float>" else 8) // BLOCK_BYTES))
    parts = max(-(-many // (2 * QUERIES)), min(-(-shuffle_partitions(vectors.sparkSession) // sides), -(-many // 128)))
    packed = blocks(found.coalesce(max(4, sides)), index, kind).repartition(sides)  # few files to a task fill its blocks
    probed = probing(asked, index, like, s, parts)
    met = meet(packed, probed, index, k + 1, s, kind)
    ranked = met.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))  # at most ``sides`` lists of k + 1
    best = ranked.select("q", F.explode("found").alias("f")).select("q", "f.id", (-F.col("f.far")).alias("score"))
    ids = best.join(found.select("id", "ids"), "id").select("q", F.explode("ids").alias("vec_id"), "score")
    answers = ids.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("answers"))  # at most (k + 1) ** 2
    own = named.join(answers, "q").select("query_id", F.slice(F.filter("answers", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("answers"))
    told = own.select("query_id", F.posexplode("answers").alias("place", "answer"))
    return told.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("answer.vec_id").alias("vec_id"), (-F.col("answer.far")).alias("score"))

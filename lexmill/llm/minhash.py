"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets and union-find grouping.

SuperMinHash gives each element a random permutation of the signature's slots together with increasing ranks: slot
``k`` of the signature is the least ``j + r_j`` over the elements whose ``j``-th slot is ``k``. Ranks of one element
are correlated across slots, which lowers the variance against independent minima, and once every slot holds a value
below ``j`` no later round can change it, so long documents stop after a round or two.

Steps: a narrow Arrow map makes signatures; documents with equal sets collapse to their smallest id; bands of four
slots bucket the rest; each bucket is compared with its smallest id only; components grow from confirmed links;
buckets that still hold several components are compared across them, save pairs that an exact bound rules out: set
sizes with the elements that only one of the documents has, classes of elements that one set holds and the other does
not, or the triangle inequality of the Jaccard distance. So copies never expand into all pairs and no tested candidate
is left out. Every link is confirmed on the full shingle sets. With 32 bands of 4 slots a pair at similarity 0.8 misses all
buckets with probability 5e-8.

Defined results: a null or empty text, or one without words, has an empty set, links with nothing and is kept; fewer
words than a shingle make one shingle; rows that repeat a ``doc_id`` are one document and share a component; rows with
a null ``doc_id`` take the component of the documents with the same set (null if there is none) and are not kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Tables, slices, texts_of

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


@dataclass(frozen=True)
class Settings:
    """Documents are linked if ``parts * intersection >= share * union`` for ``share / parts`` = similarity."""

    words: int = 5
    share: int = 80
    parts: int = 100
    bands: int = 32
    rows: int = 4


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C[1]
    h = (h ^ (h >> np.uint64(27))) * _C[2]
    return h ^ (h >> np.uint64(31))


#: Bytes of text whose words are hashed together, and of a word beyond which its digest stands for it.
PIECE, LONG = 1 << 18, 64
GAP = re.compile(rb"[\x20\x09-\x0d]")
_R = mix(np.arange(1, LONG + 1, dtype=np.uint64) * _C[0]) | np.uint64(1)


def in_pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``PIECE`` bytes, cut at white space."""
    at = 0
    while len(text) - at > PIECE and (gap := GAP.search(text, at + PIECE)):
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words: sums of their bytes, each times a fixed odd number of its place, mixed with the length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(words), np.uint8)
    place = (np.arange(len(flat)) - np.repeat(starts, sizes)) & (LONG - 1)
    out = mix(np.add.reduceat((flat.astype(np.uint64) + np.uint64(1)) * _R[place], starts) + sizes.astype(np.uint64) * _C[3])
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(words[i], digest_size=8).digest(), "little")
    return out


def text_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, in order, and the number of words of each text; words are hashed about
    ``PIECE`` bytes at a time, however long a text is."""
    counts, hashes, held, size = [], [], [], 0
    for text in texts:
        n = 0
        for piece in in_pieces(text):
            words = piece.translate(LOWER).split()
            n += len(words)
            held += words
            size += len(piece)
            if size >= PIECE and held:
                hashes.append(word_hashes(held))
                held, size = [], 0
        counts.append(n)
    if held:
        hashes.append(word_hashes(held))
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.array(counts, np.int64)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``k`` of the word hashes ``h``, worked out in blocks."""
    parts = []
    for a in range(0, len(h) - k + 1, PIECE):
        n = min(PIECE, len(h) - k + 1 - a)
        run = np.zeros(n, np.uint64)
        for j in range(k):
            run += mix(h[a + j : a + j + n] + np.uint64(j + 1) * _C[0])
        parts.append(np.unique(mix(run)))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``k`` are one shingle."""
    out, at = [], 0
    with np.errstate(over="ignore"):
        h, counts = text_hashes(texts)
        for n in counts.tolist():
            words = h[at : at + n]
            if n >= k:
                out.append(shingles(words, k))
            elif n:
                out.append(mix(shingles(words, n) ^ _C[3]))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
    return out


def signature(elements: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash of a set of 64-bit hashes: ``m`` values, round number in the high and rank in the low 32 bits.

    The signature of a union is the least of its parts' ones, so large sets go part by part."""
    if len(elements) > PIECE:
        return np.minimum.reduce([signature(elements[a : a + PIECE], m) for a in range(0, len(elements), PIECE)])
    sig = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    n = len(elements)
    slots = rows = None
    with np.errstate(over="ignore"):
        for j in range(m):
            draw = mix(elements + np.uint64(j + 1) * _C[0])
            rank = (draw >> np.uint64(32)) | np.uint64(j << 32)
            k = j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
            if j == 0:
                place, first = k, k
            else:
                if slots is None:  # the permutations so far: only slot 0 and the slot it was swapped with differ
                    slots, rows = np.tile(np.arange(m, dtype=np.int32), (n, 1)), np.arange(n)
                    slots[rows, first] = 0
                    slots[:, 0] = first
                place = slots[rows, k]
                slots[rows, k] = slots[:, j]
                slots[:, j] = place
            np.minimum.at(sig, place, rank)
            if sig.max() < np.uint64((j + 1) << 32):
                break
    return sig


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        groups = sig.reshape(-1, rows)
        h = np.arange(len(groups), dtype=np.uint64) * _C[3]
        for j in range(rows):
            h = mix(h + groups[:, j] * _C[j % 4] + np.uint64(j))
    return h.view(np.int64)


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_id, bands``; ``set_id`` is a digest of the whole set, ``bands`` is empty for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets([x.encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist()], s.words)
            bands = [band_hashes(signature(x, s.bands * s.rows), s.rows) if len(x) else np.zeros(0, np.int64) for x in sets]
            ids = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_id", "bands"],
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, n_shingles long, set_id binary, bands array<long>")


#: Classes of elements, in words of 64 bits, that tell what one set has and another lacks.
CLASS_WORDS = 16


def classes(elements: np.ndarray) -> np.ndarray:
    """A bit for each class that the set has elements of."""
    bits = np.zeros(64 * CLASS_WORDS, np.uint8)
    bits[elements % np.uint64(len(bits))] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _sets(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, elements, classes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets([x.encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist()], s.words)
            held = pa.array([classes(x) for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.tobytes() for x in sets], pa.binary()), held], ["doc_id", "elements", "classes"])

    return docs.mapInArrow(run, "doc_id long, elements binary, classes array<long>")


def _common(pairs: DataFrame) -> DataFrame:
    """Sizes of both sets of a pair and of what they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("ea", "eb"))
            rows = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                rows.append((len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
            na, nb, both = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True)) if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), na, nb, both], ["a", "b", "na", "nb", "both"])

    return pairs.select("a", "b", "ea", "eb").mapInArrow(run, "a long, b long, na long, nb long, both long")


def _verify(docs: DataFrame, pairs: DataFrame, s: Settings, t: Tables) -> tuple[DataFrame, DataFrame]:
    """Of distinct pairs ``a, b`` the Jaccard distance, on full sets, and whether they are linked; and the sets."""
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = texts_of(docs).join(wanted, "doc_id", "left_semi")
    sets = t.write(_sets(texts, s), "sets")
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("ea")), "a")
    both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("eb")), "b")
    union = F.col("na") + F.col("nb") - F.col("both")
    return sets, _common(both).select("a", "b", (1 - F.col("both") / union).alias("distance"), (F.col("both") * s.parts >= s.share * union).alias("linked"))


def _own_elements(sets: DataFrame, members: DataFrame) -> DataFrame:
    """``a, own``: for each of ``members(a)`` how many elements no other member has. Counts are pre-aggregated."""

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("elements").to_pylist()
            flat = np.frombuffer(b"".join(blobs), np.int64)
            owner = np.repeat(batch.column("doc_id").to_numpy(), [len(x) // 8 for x in blobs])
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(owner)], ["element", "a"])

    wanted = sets.join(members.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_semi")
    counted = wanted.select("doc_id", "elements").mapInArrow(elements, "element long, a long").groupBy("element").agg(F.min("a").alias("a"), F.max("a").alias("z"))
    return counted.where("a = z").groupBy("a").agg(F.count("*").alias("own"))


def _unlike(a: str, b: str) -> Column:
    """The number of classes that one of the two has and the other has not."""
    return reduce(lambda x, y: x + y, (F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(CLASS_WORDS)))


def components(links: DataFrame, t: Tables | None = None) -> DataFrame:
    """Connected components: ``node, component`` (the smallest node reachable) of the nodes of ``links(a, b)``.

    Tasks first replace their links by a spanning forest (union-find); then rounds of star operations hang every
    node on the smallest node it sees, until nothing moves. Each round is pre-aggregated by node.
    """

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def flush() -> pa.RecordBatch:
            found = [(x, find(x)) for x in list(root)]
            found = [(x, r) for x, r in found if x != r]
            root.clear()
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
            if len(root) > 500_000:
                yield flush()
        yield flush()

    t = t or Tables(links.sparkSession, "components")
    edges = t.write(links.select("a", "b").mapInArrow(forest, "a long, b long").distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == state or not now["n"]:
            break
        state = (now["n"], now["h"])
        # Large star: neighbours above a node hang on the smallest node in its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = t.write(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = t.write(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        t.drop(edges, least)
        # Small star: a node and its neighbours below hang on the smallest of these.
        least = t.write(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = t.write(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        t.drop(large, least)
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def near_duplicates(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    s = s or Settings()
    t = Tables(docs.sparkSession, "minhash")
    sigs = t.write(signatures(docs, s), "signatures")
    filled = sigs.where("n_shingles > 0")
    reps = filled.groupBy("set_id").agg(F.min("doc_id").alias("a"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    reps = t.write(reps.where("a IS NOT NULL"), "representatives")
    banded = reps.select("a", "n", F.explode("bands").alias("band"))
    hubs = t.write(banded.groupBy("band").agg(F.min("a").alias("b"), F.max("a").alias("last")).where("b <> last").select("band", "b"), "hubs")
    near = t.write(banded.join(hubs, "band"), "near")
    sets, verified = _verify(docs, near.where("a <> b").select("a", "b").distinct(), s, t)
    tested = t.write(verified, "tested")
    t.drop(hubs)
    links = tested.where("linked").select("a", "b")
    grouped = t.write(components(links, t), "components")
    # Buckets with several components: compare across these, pairs that the bucket's hub does not rule out.
    told = near.join(tested.select("a", "b", "distance"), ["a", "b"], "left").withColumn("distance", F.coalesce("distance", F.lit(0.0)))
    told = told.join(grouped.select(F.col("node").alias("a"), "component"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    mixed = t.write(told.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("band"), "mixed")
    left = t.write(told.where("a <> b").join(mixed, "band"), "left")
    t.drop(near, mixed)
    # Elements that only one of these documents has are in its unions and in no intersection: that bounds a pair.
    own = t.write(_own_elements(sets, left.select("a")), "own")
    left = left.join(own, "a", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    left = left.where(F.col("own") * s.parts <= (s.parts - s.share) * F.col("n"))
    left = t.write(left.join(sets.select(F.col("doc_id").alias("a"), "classes").distinct(), "a"), "left")
    t.drop(sets, own)
    other = left.select("band", *(F.col(c).alias(f"{c}2") for c in ("a", "n", "own", "distance", "component", "classes")))
    far = 1 - s.share / s.parts + 1e-9
    ratio = F.least(F.col("n") - F.col("own"), F.col("n2") - F.col("own2")) * s.parts >= s.share * F.greatest(F.col("n") + F.col("own2"), F.col("n2") + F.col("own"))
    # Each class that one set has and the other has not is an element of the union outside the intersection.
    classes_agree = _unlike("classes", "classes2") * (s.parts + s.share) <= (F.col("n") + F.col("n2")) * (s.parts - s.share)
    across = left.join(other, "band").where((F.col("a") < F.col("a2")) & (F.col("component") != F.col("component2")) & ratio & (F.abs(F.col("distance") - F.col("distance2")) <= far) & classes_agree)
    extra = t.write(across.select("a", F.col("a2").alias("b")).distinct(), "across")
    if not extra.isEmpty():
        more = t.write(_verify(docs, extra, s, t)[1].where("linked").select("a", "b"), "more")
        grouped = t.write(components(links.unionByName(more), t), "components")
    named = reps.join(grouped.select(F.col("node").alias("a"), "component"), "a", "left").where("copies > 1 OR component IS NOT NULL").select("set_id", F.coalesce("component", "a").alias("component"))
    named = t.write(named, "named")
    t.drop(reps, tested, grouped, left, extra)
    found = sigs.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    return found.select("doc_id", "n_shingles", component, F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """Documents without the near duplicates of a document with a smaller id; all columns stay."""
    gone = near_duplicates(docs, s).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")

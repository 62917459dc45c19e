"""Merkle dataset manifest: Pregel-style RDD supersteps over the trees of all groups at once.

A vertex is an aligned run of ``2 ** height`` nodes of one level with the levels above them. In a superstep each vertex
takes the digests that its children sent, hashes its levels and sends its top to its parent; a group whose top is alone
halts. The tops of the groups are the leaves of one more tree. Reverse supersteps go back down: a vertex gets the
sibling path of its top from its parent, puts the siblings of its own levels before it and sends the longer paths to its
children, until the leaves fold theirs. With eight levels to a vertex a tree of 10 ** 9 leaves takes four supersteps each
way, and no vertex has more than 256 messages.

Places of leaves come from sorted ranges whose counts are carried, so one group may hold all rows and no task sees more
than its range. What a superstep sends is a table in the shared folder: a lost executor repeats its tasks from there.

Defined results: null values hash as ``-``, texts are hashed whole; leaves ascend by ``doc_id`` (null first), rows that repeat an
id by their digests; equal rows are leaves of their own; a null id is not tampered with; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import groupby

from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import Tables, shuffle_partitions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one vertex hashes.
HEIGHT = 8
#: ``n``: nodes of the whole level.
NODE = "tree string, n long, place long, digest string"
#: A step of a path: ``<`` or ``>`` and the sibling on that side, or nothing where a node is alone in its run.
PATH = "tree string, place long, top string, path array<string>"


def digest_of(values: Iterable[Column]) -> Column:
    """Hexadecimal SHA-256 of values, each ``-`` if null, else its bytes' count, a colon and itself."""
    texts = [v.cast("string") for v in values]
    told = (F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts)
    return F.sha2(F.concat(*told).cast("binary"), 256)


def hashed(digests: Iterable[str]) -> str:
    return sha256("".join(digests).encode("ascii")).hexdigest()


def placed(nodes: DataFrame, order: list[str], t: Tables) -> DataFrame:
    """``nodes`` with ``place`` (from 0, in order within ``tree``) and ``n`` (the tree's leaves).

    Rows are sorted by ranges and written; counts, a row for each range and tree that meet, tell what lies before."""
    ranges = nodes.repartitionByRange(shuffle_partitions(t.spark), "tree", *order).sortWithinPartitions("tree", *order)
    ranged = t.write(ranges.withColumn("at", F.monotonically_increasing_id()), "ranged")
    ranged_of = ranged.withColumn("range", F.shiftrightunsigned("at", 33))
    counts = ranged_of.groupBy("tree", "range").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    whole, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("tree", "range", "first", F.sum("here").over(whole).alias("n"), F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    met = ranged_of.join(carried, ["tree", "range"]).withColumn("place", F.col("before") + F.col("at") - F.col("first"))
    out = t.write(met.drop("at", "range", "first", "before"), "placed")
    t.drop(ranged)
    return out


def runs_of(digests: list[str]) -> list[str]:
    """The next level: every two consecutive nodes, a last one alone."""
    return [hashed(digests[i : i + 2]) for i in range(0, len(digests), 2)]


def _vertices(messages: DataFrame) -> RDD:
    """``((tree, vertex), rows)``: the messages of each vertex by their place, at most ``2 ** height`` and its parent's."""

    def gathered(rows: Iterator) -> Iterator[tuple]:
        for key, got in groupby(rows, key=lambda r: (r[0], r[1])):
            yield key, list(got)

    keys = ["tree", "vertex"]
    return messages.repartition(shuffle_partitions(messages.sparkSession), *keys).sortWithinPartitions(*keys, "place").rdd.mapPartitions(gathered)


def _to_parents(nodes: DataFrame, height: int, *more: str) -> DataFrame:
    """``tree, vertex, place, n, digest, ...``: what nodes send to the vertex that they belong to."""
    return nodes.select("tree", F.shiftright("place", height).alias("vertex"), "place", "n", "digest", *more)


def grow(leaves: DataFrame, t: Tables, height: int = HEIGHT) -> list[DataFrame]:
    """Supersteps upward: the leaves, then the tops of each superstep; a tree is done where its node's ``n`` is 1."""

    def completed(vertex: tuple) -> tuple:
        (tree, at), got = vertex
        digests, n = [x[4] for x in got], got[0][3]
        for _ in range(height):
            if n == 1:
                break
            digests, n = runs_of(digests), (n + 1) // 2
        return tree, n, at, digests[0]

    supersteps = [leaves]
    while not (going_on := supersteps[-1].where("n > 1")).isEmpty():
        tops = _vertices(_to_parents(going_on, height)).map(completed)
        supersteps.append(t.write(t.spark.createDataFrame(tops, NODE, verifySchema=False), "tops"))
    return supersteps


def paths_within(digests: list[str], n: int, height: int) -> list[list[str]]:
    """The steps that each of a vertex's nodes takes to its top."""
    paths: list[list[str]] = [[] for _ in digests]
    for level in range(height):
        if n == 1:
            break
        for i, path in enumerate(paths):
            at = i >> level
            path.append("" if at ^ 1 >= len(digests) else f"{'<' if at % 2 else '>'}{digests[at ^ 1]}")
        digests, n = runs_of(digests), (n + 1) // 2
    return paths


def sent_down(nodes: DataFrame, paths: DataFrame, height: int = HEIGHT, *more: str) -> RDD:
    """A reverse superstep: ``(tree, place, top, path, digest, ...)`` of nodes, from the paths of their vertices' tops."""

    def passed(vertex: tuple) -> Iterator[tuple]:
        (tree, _), got = vertex
        parent, own = got[0], got[1:]  # the parent's message has the place -1
        steps = paths_within([x[4] for x in own], own[0][3], height) if own else []
        for node, path in zip(own, steps, strict=True):
            yield tree, node[2], parent[-2], path + parent[-1], node[4], *node[5:-2]

    sent = paths.select("tree", F.col("place").alias("vertex"), F.lit(-1).cast("long").alias("place"), "top", "path")
    return _vertices(_to_parents(nodes, height, *more).unionByName(sent, allowMissingColumns=True)).flatMap(passed)


def descend(supersteps: list[DataFrame], tops: DataFrame, t: Tables, height: int = HEIGHT, *more: str) -> RDD:
    """Reverse supersteps: ``(tree, place, top, path, digest, ...)`` of the leaves; ``tops`` (``PATH`` and ``step``, the superstep
    after which a tree halted) has the paths of the trees' own tops."""
    paths = tops.where(F.col("step") == len(supersteps) - 1).drop("step")
    for step in range(len(supersteps) - 1, 0, -1):
        sent = sent_down(supersteps[step], paths, height).map(lambda x: x[:4])
        paths = t.write(t.spark.createDataFrame(sent, PATH, verifySchema=False), "paths")
        paths = paths.unionByName(tops.where(F.col("step") == step - 1).drop("step"))
    return sent_down(supersteps[0], paths, height, *more)


def folded(digest: str, path: list[str]) -> str:
    for step in path:
        digest = hashed((step[1:], digest) if step[:1] == "<" else (digest, step[1:]))
    return digest


def manifest(docs: DataFrame, height: int = HEIGHT, every: int = 7) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: a tree for each ``lang`` and one of their
    roots; rows whose id's hash ``every`` divides are folded from a leaf with one character more than was hashed."""
    spark = docs.sparkSession
    t = Tables(spark, "merkle")
    forged = dict.fromkeys(FIELDS) | {c: F.col(c) for c in FIELDS}
    forged["n_chars"] = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"),  # null sorts first
        F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col(c) for c in FIELDS).alias("digest"),
        F.when(tampered & F.col("n_chars").isNotNull(), digest_of(forged.values())).alias("forged"),
        F.monotonically_increasing_id().alias("salt"),
    )
    hashed_once = t.write(leaves, "leaves")  # the salt spreads rows that are all alike, and stays when a task is repeated
    trees = grow(placed(hashed_once, ["doc_id", "digest", "salt"], t), t, height)
    t.drop(hashed_once)
    steps = (x.where("n = 1").select("tree", "digest", F.lit(i).alias("step")) for i, x in enumerate(trees))
    subroots = None
    for x in steps:
        subroots = x if subroots is None else subroots.unionByName(x)
    subroots = t.write(subroots, "subroots")
    above = grow(placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest", "step"), ["of"], t), t, height)
    found = above[-1].select("digest").first()
    root = found["digest"] if found else ""
    top = spark.createDataFrame([("", 0, root, [], len(above) - 1)], f"{PATH}, step int")
    down = descend(above, top, t, height, "of", "step").map(lambda x: (x[5], 0, x[4], x[3], x[6]))
    tops = t.write(spark.createDataFrame(down, f"{PATH}, step int", verifySchema=False), "tops")

    def verified(leaf: tuple) -> tuple:
        _, _, subroot, path, digest, doc_id, other = leaf
        end = folded(other or digest, path)
        return doc_id, digest, subroot, root, hashed(step[1:] for step in path), end, end == root

    rows = descend(trees, tops, t, height, "doc_id", "forged").map(verified)
    return spark.createDataFrame(rows, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", verifySchema=False)

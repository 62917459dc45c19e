"""Spelling variants, nearest neighbours and the Merkle manifest against brute force and their SQL."""

import hashlib
import os
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import merkle, neighbours, queries, spelling

SF = "/root/testdata/sf0.001"


def against_sql(spark, name, sf=SF):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    got, want = queries.CATALOG.queries[name](spark, sf).toArrow(), c.execute(queries.CATALOG.sql[name]).to_arrow_table()
    names = sorted(want.schema.names)
    assert sorted(got.schema.names) == names and got.num_rows
    assert sorted(map(repr, got.select(names).to_pylist())) == sorted(map(repr, want.select(names).to_pylist()))


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_merkle_manifest"])
def test_queries_against_sql(spark, name):
    against_sql(spark, name)


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, s):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if s.every and h % s.every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= s.least_length and n >= s.least_count}
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= s.ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def told(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_variants_of_words_of_few_letters_and_odd_rows(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abÀÿ×") for _ in range(rng.randint(1, 5))) for _ in range(150)] + ["Abba", "aBBa", "abbaa"]
    weights = [1000 // (i + 1) + 1 for i in range(len(words))]
    rows = [(i if i % 9 else None, " ,9-\n"[i % 5].join(rng.choices(words, weights, k=rng.randint(0, 300)))) for i in range(60)] + [(7, None), (8, ""), (9, "12 3"), (1, "abab abab"), (1, "abab abab")]
    docs = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], "doc_id long, text string, n int, `a.word` string, key string")
    for s in (spelling.Settings(least_length=2), spelling.Settings(every=3, least_length=3, least_count=1, ratio=2), spelling.Settings(every=0, least_length=1, least_count=3, ratio=3)):
        assert told(spelling.variants(docs, s)) == brute_variants(rows, s)
    assert spelling.variants(docs.limit(0)).count() == 0 and spelling.variants(docs.where("text IS NULL OR text = ''")).count() == 0


def test_variants_of_very_long_words(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdé") for _ in range(n)) for n in (63, 64, 65, 3000)] + ["a" * 70, "a" * 71, "ab" * 40, "ba" * 40]
    edited = []
    for w in base:
        at = rng.randrange(len(w))
        edited += [w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + "z" + w[at + 1 :], w[:at] + "y" + w[at + 1 :], w[1:] + "q"]
    rows = [(1, " ".join(base * 30 + edited * 2)), (2, "x" * 70_000 + " " + "y" * 200_001 + "!" + " ab" * 40_000), (3, "x" * 70_000 + " " + "x" * 70_001)]
    s = spelling.Settings(every=0, least_count=1)
    got = told(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), s))
    assert got == brute_variants(rows, s)
    assert sum(r[1] is not None for r in got) >= 20


def test_deletion_keys_are_those_of_the_deletions():
    rng = random.Random(5)
    for _ in range(300):
        w = "".join(rng.choice("ab") for _ in range(rng.randint(2, 12)))
        keys = [int(k) for part in spelling.deletion_keys(w) for k in part]
        deletions = {w[:i] + w[i + 1 :] for i in range(len(w))}
        assert keys[0] == int(next(spelling.deletion_keys(w))[0]) and len(keys) == 1 + len(deletions)
        assert set(keys[1:]) == {int(next(spelling.deletion_keys(x))[0]) for x in deletions}


def brute_nearest(rows, k):
    rows = [(i, v) for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v))]
    dim = max(len(v) for _, v in rows)
    x, ids = np.array([(*v, *[0.0] * (dim - len(v))) for _, v in rows]), np.array([i for i, _ in rows])
    out = {}
    for j in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[j]
        by = np.lexsort((ids, -scores))
        out.setdefault(int(ids[j]), []).append([(int(ids[i]), float(scores[i])) for i in by if ids[i] != ids[j]][:k])
    return out


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, None) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, `a.id` string")


def test_nearest_of_small_tables_is_exact(spark):
    rng = np.random.default_rng(6)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(200)]
    rows += [(20 * i, [1.0, 2.0, 0.0, 1.0]) for i in range(100, 140)] + [(5000 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(30)]  # copies
    rows += [(300, None), (320, []), (340, [0.0] * 4), (360, [1.0, nan, 0.0, 0.0]), (380, [inf, 0.0, 0.0, 0.0]), (400, [None, 1.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    rows += [(420, [2.0, 1.0]), (421, [3.0]), (5000, [1.0, 2.0, 0.0, 1.0]), (-20, [9.0, 0.0, 0.0, 0.0]), (-7, [0.0, 0.0, 0.0, -9.0])]
    for kind in ("float", "double"):
        got = neighbours.nearest(vectors(spark, rows, kind), F.col("vec_id") % 20 == 0).collect()
        by = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        want = {q: [(n + 1, i, s) for n, (i, s) in enumerate(found[0])] for q, found in brute_nearest(rows, 20).items()}
        assert by == want
    few = neighbours.nearest(vectors(spark, [(20, [1.0, 0.0]), (21, [2.0, 0.0]), (22, [-1.0, 5.0])]), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, few)) == [(20, 1, 21, 2.0), (20, 2, 22, -1.0)]
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(vectors(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_recall_on_clusters_norms_and_split_buckets(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((30, 24))
    x = np.concatenate([centres[rng.integers(0, 30, 6000)] + 0.15 * rng.standard_normal((6000, 24)), rng.standard_normal((2000, 24))]) * rng.uniform(0.2, 3.0, (8000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute_nearest(rows, 20)
    for s in (neighbours.Settings(), neighbours.Settings(block=50)):
        got = {}
        for r in neighbours.nearest(vectors(spark, rows, "double"), F.col("vec_id") % 20 == 0, s=s).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        hits = sum(len(got[q] & {i for i, _ in found[0]}) for q, found in want.items())
        assert hits >= 0.9 * sum(len(found[0]) for found in want.values())


def test_op12_recall(spark):
    got = {}
    for r in queries.op12_nearest_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_nearest([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()], 20)
    assert set(got) == set(want) and all([r for r, _, _ in sorted(v)] == list(range(1, 21)) for v in got.values())
    assert sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q][0]}) for q in want) >= 0.9 * 20 * len(want)


def test_best_buckets_come_in_order_and_reach_their_chance():
    rng = np.random.default_rng(8)
    order, chance = (rng.dirichlet(np.ones(4), (5, 6)) for _ in range(2))
    row, slots = neighbours.best_buckets(order, chance, 0.7)
    for i in range(5):
        every = np.array(np.unravel_index(np.arange(4**6), (4,) * 6)).T
        score = np.prod(order[i, np.arange(6), every], axis=1)
        by = np.argsort(-score)
        upto = np.cumsum(np.prod(chance[i, np.arange(6), every], axis=1)[by])
        n = 1 + int((upto < 0.7).sum())
        assert {tuple(x) for x in slots[row == i]} == {tuple(x) for x in every[by[:n]]}


def test_depths_reach_the_buckets_of_the_list():
    rng = np.random.default_rng(9)
    order, chance = (rng.dirichlet(np.ones(4), (6, 6)) for _ in range(2))
    costs, depth = neighbours.depths(order, chance, 0.7)
    every = np.array(np.unravel_index(np.arange(4**6), (4,) * 6)).T
    row, slots = neighbours.best_buckets(order, chance, 0.7)
    for i in range(6):
        total, chances = (of[i, np.arange(6), every] for of in (costs, chance))
        total, chances = total.sum(axis=1), np.prod(chances, axis=1)
        assert chances[total <= depth[i]].sum() >= 0.7 - 1e-9 > chances[total < depth[i]].sum()
        listed, reached = {tuple(x) for x in slots[row == i]}, {tuple(x) for x in every[total <= depth[i]]}
        assert len(listed ^ reached) < 0.1 * len(listed)  # costs are rounded
    certain = np.zeros((1, 3, 4))
    certain[..., 0] = 1.0
    assert neighbours.depths(certain, certain, 0.9)[1].tolist() == [0]
    assert neighbours.depths(np.ones((2, 0, 5)), np.ones((2, 0, 5)), 0.9)[1].tolist() == [0, 0]


def test_many_functions_and_faint_likeness_need_no_lists_of_buckets(spark):
    """With eight functions a query at a likeness of 0.45 visits up to hundreds of thousands of buckets of 5 ** 8."""
    rng = np.random.default_rng(10)
    x = rng.standard_normal((3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = neighbours.Index(rng.standard_normal((3, 8, 25)), rng.uniform(0, 2.5, (3, 8)), 2.5, 1.0)
    tracemalloc.start()
    neighbours.ways(index, x[:128], 0.45, neighbours.Settings())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want, got = brute_nearest(rows, 20), {}
    for r in neighbours.nearest(vectors(spark, rows, "double"), F.col("vec_id") % 20 == 0, s=neighbours.Settings(bucket_rows=1)).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert all(len(found) == 20 for found in got.values())
    assert sum(len(set(got[q]) & {i for i, _ in found[0]}) for q, found in want.items()) >= 0.9 * 20 * len(want)
    scores = {(q, i): x[q] @ x[i] for q, found in got.items() for i in found}
    assert all(abs(got[q][i] - score) < 1e-12 for (q, i), score in scores.items())


def test_nearest_of_signed_zeros_and_far_apart_norms_is_exact(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(100)]
    rows += [(100 + i, [0.0 if i % 2 else -0.0, 2.0, -0.0, 1.0]) for i in range(45)] + [(200 + i, [2.0**60 * float(x) for x in rng.integers(-2, 3, 4)]) for i in range(41)]
    rows += [(300 + i, [2.0**-60 * float(x) for x in rng.integers(-2, 3, 4)]) for i in range(41)]
    by = {}
    for r in neighbours.nearest(vectors(spark, rows, "double"), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by == {q: found[0] for q, found in brute_nearest(rows, 20).items()}


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, every=7):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: H(field(v) for v in (r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4]))

    def tree(level):
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for i, p in enumerate(at):
                paths[i].append((p % 2, level[p ^ 1] if p ^ 1 < len(level) else ""))
                at[i] = p // 2
            level = [H(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0], paths

    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    groups = [sorted(by_lang[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for k in sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))]
    trees = [tree([leaf(r) for r in g]) for g in groups]
    root, above = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), more in zip(groups, trees, above, strict=True):
        for r, path in zip(g, paths, strict=True):
            end = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0))
            for left, sibling in path + more:
                end = H([sibling, end] if left else [end, sibling])
            out.append((r[0], leaf(r), subroot, root, H(x for _, x in path + more), end, end == root))
    return sorted(map(str, out))


def test_manifest_of_odd_rows_and_heights(spark):
    langs = [None, "", "en", "de", "é", "zz"]
    rows = [(i % 50 if i % 3 else None, "s" * (i % 3) if i % 4 else None, langs[i * i % 6], i if i % 5 else None, None if i % 7 == 0 else "té" * (i % 9)) for i in range(600)]
    rows += [(1000, "a", "alone", 3, "x"), (77, "a", "en", 3, "a" * 300_000)] + [(77, "a", "en", 3, "x")] * 20
    for some, height in ((rows, 2), (rows, 8), (rows[:1], 1), (rows[:2], 8), (rows[:3], 1), ([], 8)):
        docs = spark.createDataFrame([(*r, 1, "x") for r in some], "doc_id long, source string, lang string, n_chars int, text string, digest int, `meta.tree` string")
        got = merkle.manifest(docs, height).collect()
        assert sorted(str(tuple(r)) for r in got) == (brute_manifest(some) if some else [])

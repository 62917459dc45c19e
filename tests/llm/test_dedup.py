"""Near duplicates and line runs against brute force and their SQL."""

import os
import random
import re

import duckdb
import pytest

from lexmill.llm import lines, minhash, queries

SF = "/root/testdata/sf0.001"


def clashing(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", None) for d, t in rows], "doc_id long, text string, component int, set_id string, n_chars long")


def brute_sets(texts, k):
    out = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute_components(rows, s):
    sets = brute_sets([t for _, t in rows], s.words)
    ids = [d for d, _ in rows]
    least = {d: d for d in ids}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and s.parts * len(a & b) >= s.share * len(a | b):
                x, y = find(ids[i]), find(ids[j])
                least[max(x, y)] = min(x, y)
    return sorted((d, len(a), find(d) if a else d) for d, a in zip(ids, sets, strict=True))


def test_components_of_near_copies_and_odd_rows(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "oNE "), (5, "one two three"), (6, "one  two\tthree"), (7, "w " * 3000), (8, "w " * 3001)]
    for family in range(4):
        base = [word() for _ in range(rng.choice([30, 120]))]
        for i in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((100 * (family + 1) + i, " ".join(copy)))
    rows += [(10_000 + i, " ".join(word() for _ in range(50))) for i in range(20)]
    rows.append((rows[-1][0], rows[-1][1]))  # a repeated row
    rng.shuffle(rows)
    for s in (minhash.Settings(words=4), minhash.Settings()):
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(clashing(spark, rows), s).collect())
        assert got == brute_components(rows, s)
    kept = minhash.keep_one(clashing(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(d for d, _, c in brute_components(rows, minhash.Settings()) if c == d)
    assert minhash.near_duplicates(clashing(spark, rows).limit(0)).count() == 0
    none = minhash.near_duplicates(clashing(spark, [(None, "one two"), (4, "one two"), (None, "a b")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in none) == [("4", "4", True), ("None", "4", False), ("None", "None", False)]


def test_signature_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        both = rng.integers(0, 1 << 62, 400, dtype=np.uint64)
        a, b = np.unique(both[:300]), np.unique(both[100:])
        x, y = minhash.signature(a, 128), minhash.signature(b, 128)
        errors.append((x == y).mean() - 0.5)
        assert (minhash.signature(a[::-1], 128) == x).all()
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    tiny = minhash.signature(np.array([7], np.uint64), 16)  # one element: a permutation of the rounds
    assert sorted((tiny >> np.uint64(32)).tolist()) == list(range(16))


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (300, 299)]
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 150: 100, 300: 299, 299: 299}


def brute_lines(rows, s):
    """All lines of the longest run from any line on that also starts earlier, in order of id and place, if it counts."""
    order = sorted(range(len(rows)), key=lambda i: ((1 << 63) - 1 if rows[i][0] is None else rows[i][0], i))
    seen, gone = set(), {}
    for i in order:
        found = tuple((rows[i][1] or "").split("\n"))
        gone[i] = set()
        for p in range(len(found)):
            end = p
            while end < len(found) and found[p : end + 1] in seen:
                end += 1
            if end - p >= s.min_lines and sum(map(len, found[p:end])) >= s.min_chars:
                gone[i] |= set(range(p, end))
            seen |= {found[p:e] for e in range(p + 1, len(found) + 1)}
    return sorted((str(rows[i][0]), "\n".join(x for p, x in enumerate((rows[i][1] or "").split("\n")) if p not in gone[i])) for i in order)


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_line_runs(spark, min_lines):
    rng = random.Random(min_lines)
    pool = ["", "ab", "a longer line of text", "another line, longer still", "x" * 70, "y" * 40]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.8 else str(rng.random()) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    rows += [(70, None), (71, ""), (None, "\n".join(pool * 2)), (72, "\n".join(["x" * 70] * 50)), (73, "\n".join("short" for _ in range(40))), (74, "\n".join(["", "b"] * 30)), (75, "\n".join(["y" * 40, *["ab"] * 12, "y" * 40] * 2))]
    s = lines.Settings(min_lines=min_lines, min_chars=60)
    got = lines.deduplicated(clashing(spark, rows), s)
    assert got.columns == ["doc_id", "text", "component", "set_id", "n_chars"]
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == brute_lines(rows, s)
    assert lines.deduplicated(clashing(spark, rows).limit(0), s).count() == 0


def test_other_columns_stay_whatever_their_names(spark):
    from pyspark.sql import Row

    text = "a line that is long enough to count on its own, sixty characters\n"
    rows = [(i, f"{text}tail {i}", "en", i, [1], "k", Row(**{"x y": i}), {"a": 1}) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, `meta.lang` string, __starts long, runs array<int>, `a``b` string, row struct<`x y`: long>, cut map<string, long>")
    got = sorted(lines.deduplicated(frame).collect())
    assert [tuple(r) for r in got] == [(i, f"tail {i}" if i else f"{text}tail 0", "en", i, [1], "k", Row(**{"x y": i}), {"a": 1}) for i in range(3)]
    assert lines.deduplicated(frame).schema == frame.schema


def test_repeated_rows_are_one_document(spark):
    text = "first long line of a text that repeats\nsecond long line of a text that repeats"
    got = lines.report(clashing(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 2)]


@pytest.mark.parametrize("name", ["op1_minhash", "op3_line_dedup"])
def test_queries_match_their_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got, want = queries.CATALOG.queries[name](spark, SF).toArrow(), c.execute(queries.CATALOG.sql[name]).to_arrow_table()
    names = sorted(got.schema.names)
    assert sorted(map(repr, got.select(names).to_pylist())) == sorted(map(repr, want.select(names).to_pylist()))


def test_long_texts_are_hashed_in_bounded_memory():
    """What a text of 6 MB takes beside itself: 16 times its size for its signature, 30 times for its prefix arrays."""
    import tracemalloc

    from lexmill.llm import fingerprints

    rng = random.Random(2)
    words = [f"{rng.getrandbits(40):x}" for _ in range(2_000)]
    text = " ".join(rng.choice(words) + str(i % 977) for i in range(440_000))[:6_000_000]
    data = text.encode()
    assert len(data) > 5_000_000

    def peak(f):
        tracemalloc.start()
        f()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most / len(data)

    assert peak(lambda: minhash.signature(minhash.shingle_sets([data], 5)[0], 128)) < 16
    assert peak(lambda: fingerprints.Fingerprint.of(fingerprints.PrefixHash(text))) < 30
    one = b"x" * 3_000_000 + b" y"
    assert len(minhash.shingle_sets([one], 5)[0]) == 1 and minhash.shingle_sets([one], 1)[0].tolist() == minhash.shingle_sets([b"Y  " + one[:-2].upper()], 1)[0].tolist()

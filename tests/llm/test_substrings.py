"""Substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from lexmill.llm import queries, substrings

LAST = (1 << 63) - 1


def brute(rows, length):
    texts = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in texts:
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            least[w] = min(least.get(w, LAST), d)
    out = []
    for (d, b), (doc_id, _) in zip(texts, rows, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < d:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((str(doc_id), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_interval_groups_are_those_of_all_strings():
    rng = random.Random(1)
    for t in range(150):
        length = rng.choice([2, 3, 5, 8])
        contexts = ["".join(rng.choice("ab" + "c" * (t % 2)) for _ in range(rng.randint(length, 12))).encode() for _ in range(rng.randint(1, 12))]
        ids = np.array([rng.randrange(20) for _ in contexts])
        least = {}
        for c, d in zip(contexts, ids, strict=True):
            for i in range(len(c) - length + 1):
                least[c[i : i + length]] = min(least.get(c[i : i + length], 99), d)
        want = [[least[c[i : i + length]] for i in range(len(c) - length + 1)] for c in contexts]
        assert [x.tolist() for x in substrings.resolve(contexts, ids, substrings.Settings(length=length, gram=1))] == want


@pytest.mark.parametrize("many", [2_000, 3])
def test_small_alphabets_nulls_ties_and_repeats(spark, many):
    rng = random.Random(many)
    base = "".join(rng.choice("abcdefgh \n") for _ in range(400))
    rows = [(1, base), (5, base[:200] + "é" * 40 + base[100:]), (3, None), (4, ""), (None, base), (None, base[50:300]), (7, base[:49]), (8, base[:50]), (5, "x" * 300), (5, base), (2, "x" * 120 + base[10:200])]
    rows += [(20 + i, f"{rng.random()}" + base[30:120] + f"{rng.random()}{rng.random()}{rng.random()}") for i in range(12)]
    frame = spark.createDataFrame([(d, t, 1, "clash") for d, t in rows], "doc_id long, text string, hash int, doc string")
    assert result(substrings.dedup_substrings(frame, substrings.Settings(many=many))) == brute(rows, 50)
    assert substrings.dedup_substrings(frame.limit(0)).count() == 0


def test_runs_are_dealt_many_in_a_row():
    rng = np.random.default_rng(1)
    kinds = [f"i{n}" for n in substrings.RUN_BYTES]
    runs = [rng.integers(-1 << 31, 1 << 31, 1000).astype(k) for k in kinds]
    places, pieces = substrings.packs(runs, np.arange(1000) % 7)
    assert places.tolist() == list(range(7)) and len(pieces) == 7
    for place, piece in zip(places, pieces, strict=True):
        assert all((a == b[place::7]).all() for a, b in zip(substrings.unpacked([piece]), runs, strict=True))
    both = substrings.unpacked(pieces[:2])
    assert [len(x) for x in both] == [286] * len(kinds) and all((a[143:] == b[1::7]).all() for a, b in zip(both, runs, strict=True))


def test_few_runs_at_a_time_and_hashes_with_more(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh \n") for _ in range(300))
    rows = [(i, f"{rng.random()}" + base[i : 120 + 5 * i] + f"{rng.random()}{rng.random()}") for i in range(40)]
    rows += [(60 + i, f"{i}" * 3 + "0123456789abcdefghijklmnopqrstuvwxyz" * 20 + f"{rng.random()}") for i in range(5)] + [(None, base), (3, base[100:])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(substrings.dedup_substrings(frame, substrings.Settings(held=5))) == brute(rows, 50)


def test_query_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert result(queries.op9_substring_dedup(spark, "/root/testdata/sf0.001")) == brute(rows, 50)

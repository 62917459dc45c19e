"""Masked pseudo-likelihood against a word-by-word computation, and against word frequencies."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lexmill.llm import language_model as lm
from lexmill.llm import queries

SF = "/root/testdata/sf0.001"
SMALL = lm.Settings(words=184, rare=68, classes=16, dim=8, rounds=2, batch=512)


def by_hand(model, counts, text):
    """The sum of log-probabilities, one word at a time."""
    s, net = model.settings, lm.Network(model.settings, model.flat)
    places = {w: i + 1 for i, w in enumerate(model.vocabulary)}
    entry = lambda w: places.get(w) or s.words + 1 + zlib.crc32(w.encode()) % s.rare
    together = Counter()
    for w, n in counts.items():
        together[entry(w)] += n
    words = text.lower().split()
    ids = [entry(w) for w in words]
    total = 0.0
    for i, x in enumerate(ids):
        h = net.bias.astype(float).copy()
        for k, d in enumerate([-2, -1, 1, 2]):
            h += net.around[k][ids[i + d] if 0 <= i + d < len(ids) else 0]
        h = np.append(np.tanh(h), 1.0)
        for logits, at in ((h @ net.top, x % s.classes), (h @ net.low[x % s.classes], x // s.classes)):
            total += logits[at] - math.log(np.exp(logits - logits.max()).sum()) - logits.max()
        if words[i] not in places:
            total += math.log(max(1, counts[words[i]]) / together[x])
    return total


@pytest.mark.parametrize("s", [SMALL, lm.Settings()])
def test_scores_and_odd_rows(spark, s):
    """Small settings, and those of the query, over every document of the table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = lm.fit(docs, s)
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts = Counter(w for t in texts.values() for w in t.lower().split())
    scores = {r.doc_id: r for r in lm.score(docs, model).collect()}
    assert scores.keys() == texts.keys()
    for doc_id in sorted(texts, key=lambda d: len(texts[d]))[:: 8 if s is SMALL else 20]:
        assert abs(scores[doc_id].score - by_hand(model, counts, texts[doc_id])) < 1e-3 * (1 + scores[doc_id].n_words)
        assert scores[doc_id].n_words == len(texts[doc_id].split())
    odd = spark.createDataFrame([(1, None, 3.0), (2, "", 1.0), (None, "the of", 2.0), (4, " \n ", 0.0), (4, "the of", 0.0), (5, "x " * 50_000, 0.0), (6, "neverseenword", 0.0)], "doc_id long, text string, score double")
    got = lm.score(odd, model).collect()
    assert [r.n_words for r in sorted(got, key=lambda r: r.n_words)] == [0, 0, 0, 1, 2, 2, 50_000]
    assert all(r.score == 0 == r.mean_score for r in got if not r.n_words) and len({r.score for r in got if r.n_words == 2}) == 1
    assert lm.score(odd.limit(0), model).count() == 0
    assert lm.fit(odd.limit(0), SMALL).vocabulary == []


def test_both_sides_help(spark):
    """In 'a b a b ...' texts the neighbours give a word away; frequencies do not."""
    rows = [(i, " ".join("red green blue white".split()[(i + j) % 4] for j in range(60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    s = lm.Settings(words=12, rare=16, classes=4, dim=8, rounds=4, batch=64, rate=0.3)
    model = lm.fit(docs, s)
    right = lm.score(docs, model).first().mean_score
    mixed = lm.score(spark.createDataFrame([(0, "red blue red white white green red red green blue blue white")], "doc_id long, text string"), model).first().mean_score
    assert right > -0.7 > math.log(1 / 4) > mixed


def test_texts_that_occur_twice_are_told_apart_whatever_the_partitions(spark):
    """All words of all documents count: words of a text that occurs again have twice the share. The query's settings."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    common = [word() for _ in range(4_500)]
    once = [" ".join(rng.choice(common) if rng.random() < 0.7 else word() for _ in range(80)) for _ in range(700)]
    rows = list(enumerate(once + once[:60]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")
    scores = {r.doc_id: r.mean_score for r in lm.score(docs, lm.fit(docs)).collect()}
    twice, single = [scores[i] for i in [*range(60), *range(700, 760)]], [scores[i] for i in range(60, 700)]
    cut = (np.mean(twice) + np.mean(single)) / 2
    assert np.mean(np.array(twice) > cut) > 0.9 and np.mean(np.array(single) < cut) > 0.8
    assert all(abs(scores[i] - scores[700 + i]) < 1e-4 for i in range(60))
    other = {r.doc_id: r.mean_score for r in lm.score(docs, lm.fit(docs.repartition(1))).collect()}
    assert all(abs(scores[i] - other[i]) < 1e-3 for i in scores)
    many = {r.doc_id: r.mean_score for r in lm.score(docs, lm.fit(docs, lm.Settings(copy_words=15_000))).collect()}  # five copies
    assert np.corrcoef([scores[i] for i in scores], [many[i] for i in scores])[0, 1] > 0.9


def test_training_step_against_plain_loops():
    """One batch that is cut into blocks of rows, against gradients of single words; products share one place."""
    s = lm.Settings(words=40, rare=20, classes=8, dim=4, batch=5_000)
    rng = np.random.default_rng(5)
    net = lm.Network(s).start_at(rng.integers(1, 50, s.entries))
    assert len(net.space) == s.batch * 8 and 2 * lm.ROWS < s.batch - 500
    seq = np.concatenate([[0, 0], rng.integers(1, s.entries, s.batch), [0, 0]])
    places = rng.permutation(np.arange(2, s.batch + 2))
    old = lm.Network(s, net.flat)
    low, top, around, bias = (np.zeros(x.shape) for x in (old.low, old.top, old.around, old.bias))
    for i in places:
        h = np.append(np.tanh(sum(old.around[k][seq[i + d]].astype(float) for k, d in enumerate(old.offsets)) + old.bias), 1.0)
        g, back = seq[i] % s.classes, 0.0
        for weights, gradient, at in ((old.top, top, g), (old.low[g], low[g], seq[i] // s.classes)):
            x = h @ weights
            e = np.exp(x - x.max())
            e /= e.sum()
            e[at] -= 1
            back = back + e @ weights[:-1].T
            gradient += np.outer(h, e)
        back = back * (1 - h[:-1] ** 2)
        bias += back
        for k, d in enumerate(old.offsets):
            around[k][seq[i + d]] += back
    net.train(seq, places)
    for name, gradient in (("top", top), ("low", low), ("bias", bias), ("around", around)):
        root = np.sqrt(1e-2 + ((gradient**2).mean(-1, keepdims=True) if name == "around" else gradient**2))
        assert np.allclose(getattr(net, name), getattr(old, name) - s.rate * gradient / root, atol=2e-4), name


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op2_language_model(spark, SF).collect()
    assert {r.doc_id: r.n_words for r in got} == {d: len(t.split()) for d, t in texts.items()} and all(r.score < 0 for r in got)


def test_rare_words_are_joined_without_a_sort(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c w{i % 7} w{i % 5} x{i}") for i in range(60)], "doc_id long, text string")
    s, plans, write = lm.Settings(words=3, rare=5, classes=4, dim=4), {}, lm.Tables.write
    monkeypatch.setattr(lm.Tables, "write", lambda t, df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or write(t, df, name))
    assert lm.score(docs, lm.fit(docs, s)).count() == 60
    rare = [x for x in plans["more"].splitlines() if "hash#" in x and "Join" in x]
    assert rare and all("ShuffledHashJoin" in x for x in rare)

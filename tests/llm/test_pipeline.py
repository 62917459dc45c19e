"""The pipeline against brute-force versions of its stages, and its stages on odd tables."""

import hashlib
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline
from lexmill.llm import decontaminate, lines, minhash, toxicity
from test_dedup import brute_components, brute_lines
from test_texts import reference

SF = "/root/testdata/sf0.001"


def test_run_is_what_its_stages_say(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = toxicity.fit_documents(docs, labels)
    scores = model.scores([t for _, t in rows], toxicity.word_scores(model.table, model.settings))
    rows = [r for r, s in zip(rows, scores, strict=True) if s < 0.5]
    rows = [(int(d), t) for d, t in brute_lines(rows, lines.Settings())]
    kept = {d for d, _, c in brute_components(rows, minhash.Settings()) if c == d}
    rows = [r for r in rows if r[0] in kept]
    items = [decontaminate.words_of(r.text) for r in bench.collect()]

    def clean(text):
        ws = decontaminate.words_of(text)
        have = set(ws)
        for iw in items:
            if sum(w in have for w in set(iw)) * 4 >= len(set(iw)):
                code = {w: i for i, w in enumerate({*iw, *ws})}
                if decontaminate.smith_waterman(np.array([code[w] for w in iw]), np.array([code[w] for w in ws]))[0] >= 0.5 * len(iw):
                    return False
        return True

    ref = reference()
    want = []
    for d, t in rows:
        if clean(t):
            ids = ref.encode_ordinary(t)
            want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), True))
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.lossless) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted(want) and len(got) > 50


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_tables(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words without an id", "en", None, 24), (3, "same text twice here and there", None, "s", 30), (3, "same text twice here and there", None, "s", 30), (4, "word " * 30_000, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wide = docs.selectExpr("*", "1 AS score", "'x' AS component", "2 AS item_id", "'y' AS ids")
    odd = docs.selectExpr("*", "1 AS `meta.lang`", "array(1) AS __starts", "'k' AS `a``b`", "named_struct('x y', 1) AS __doc", "map('a', 1) AS __key", "2.5 AS __gone", "'r' AS row", "3 AS __lines", "true AS __removed", "'c' AS cut")
    for frame in (docs, wide, odd, docs.limit(0)):
        got = stage(spark, frame, SF)
        if k < 4:
            assert got.columns == frame.columns
            assert got.schema.simpleString() == frame.schema.simpleString()
        found = got.collect()
        assert len(found) == frame.count() if k != 2 else len(found) <= frame.count()
        assert {r.doc_id for r in found} == {r.doc_id for r in frame.collect()}

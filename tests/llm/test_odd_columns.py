"""Columns that no operator names, whatever their names and types, change nothing in what it returns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lexmill.llm import bpe, decontaminate, fingerprints, language_model, lines, merkle, minhash, neighbours, pii, spelling, substrings, token_files

SF = "/root/testdata/sf0.001"
ODD = {"meta.lang": "'x'", "a`b": "1", "word": "named_struct('x y', 1)", "hash": "array('h')", "tree": "map('k', 2)", "key": "CAST(NULL AS STRING)", "id": "-1.5D", "name": "X'00'"}


def clashing(frame, **more):
    return frame.select(*(F.expr(e).alias(n) for n, e in (ODD | more).items()), "*")


def tokens(docs, tmp_path):
    path = f"{tmp_path}/{len(docs.columns)}"
    token_files.write_tokens(docs, path, open(public_tokenizers.path("byte_bpe_50k.json")).read())
    return token_files.checksums(token_files.read_tokens(docs.sparkSession, path))


def benchmark(docs, _):
    return decontaminate.contaminated_pairs(docs, docs.sparkSession.read.parquet(f"{SF}/benchmark.parquet").select("*", F.lit(1).alias("doc_id"), F.lit(2).alias("a.b")))


OPERATORS = {
    "minhash": lambda d, _: minhash.near_duplicates(d),
    "language model": lambda d, _: language_model.score(d, language_model.fit(d)).select("doc_id", "n_words", F.round("score", 2)),
    "lines": lambda d, _: lines.report(d),
    "token files": tokens,
    "personal data": lambda d, _: pii.report(d),
    "decontamination": benchmark,
    "fingerprints": lambda d, _: fingerprints.fingerprint_edits(d),
    "substrings": lambda d, _: substrings.dedup_substrings(d).drop("kept"),
    "byte BPE": lambda d, _: bpe.round_trip(d, bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN),
    "spelling": lambda d, _: spelling.variants(d),
    "manifest": lambda d, _: merkle.manifest(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, tmp_path, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    told = lambda frame: sorted(map(str, OPERATORS[name](frame, tmp_path).collect()))
    want = told(docs)
    assert want and told(clashing(docs)) == want


def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    told = lambda frame: sorted(map(str, neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()))
    assert told(clashing(rows, v="1", asked="'no'", q="3")) == told(rows)

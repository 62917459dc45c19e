"""The corpus pipeline: raw documents in, clean and tokenised documents out.

Stages, in order: toxic documents go; later copies of repeated line runs go; of near duplicates the smallest id stays;
documents that a benchmark item contaminates go; what is left is encoded to ids and decoded again.

Each stage takes all that its predecessor kept, with null texts as empty ones, works on whole texts and, but for the
last, returns the columns of ``documents``. Rows with a null ``doc_id`` pass the filters unless their own text fails
the toxicity stage; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexmill.catalog import table
from lexmill.llm import bpe, common, decontaminate, lines, minhash, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.deduplicated(docs)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near duplicates", minhash_stage),
    ("decontamination", decontamination_stage),
    ("byte BPE", encoding_stage),
]
#: No SQL states a fitted classifier, so ``run`` is tested against brute-force versions of its stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept = table(spark, sf_dir, "documents"), common.Tables(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = kept.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

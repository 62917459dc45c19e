"""Vectors: text to vector, length one, checks, printed form and similarity."""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexmill.functions.text import embed_text
from lexmill.sources import scratch_path

#: A backend turns a list of texts into a list of vectors. It is built once for each Python worker batch stream.
Backend = Callable[[list[str]], list[list[float]]]
VECTOR = T.ArrayType(T.DoubleType())


@dataclass(frozen=True)
class EmbedConfig:
    """``dim``: wanted dimension; ``batch``: texts given to the backend at once; ``attempts .. most``: retries with growing waits."""

    dim: int = 768
    batch: int = 64
    normalize: bool = True
    attempts: int = 6
    wait: float = 1.5
    most: float = 30.0


def stub_backend(dim: int) -> Backend:
    """Pseudo-random vectors of length one that depend on the text alone; for tests and dry runs."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            draw = random.Random(int(hashlib.sha256(text.encode()).hexdigest()[:16], 16))
            v = [draw.uniform(-1.0, 1.0) for _ in range(dim)]
            norm = sum(x * x for x in v) ** 0.5
            out.append([x / norm for x in v] if norm else v)
        return out

    return embed


def waits(config: EmbedConfig) -> Iterator[float]:
    """Seconds before each further attempt: doubled each time up to ``most``, with up to a second of chance."""
    for n in range(config.attempts - 1):
        yield min(config.wait * 2**n, config.most) + random.random()


def with_retry(embed: Backend, config: EmbedConfig, sleep: Callable[[float], None] = time.sleep) -> Backend:
    """``embed``, tried again after each of the :func:`waits`; the last failure is raised."""

    def tried(texts: list[str]) -> list[list[float]]:
        left = waits(config)
        while True:
            try:
                return embed(texts)
            except Exception:
                pause = next(left, None)
                if pause is None:
                    raise
            sleep(pause)

    return tried


def probed_dim(make: Callable[[], Backend], wanted: int) -> int:
    """The dimension that a backend really gives, from one short text; fails if it is not the wanted one (0: any)."""
    found = len(make()(["dimension"])[0])
    if wanted and found != wanted:
        raise ValueError(f"the backend gives vectors of {found} dimensions, not {wanted}")
    return found


def embed_column(make: Callable[[], Backend], config: EmbedConfig, keep_errors: bool = False):
    """A function of a text column: an iterator of Arrow batches, one backend for all batches of a task. With
    ``keep_errors`` it gives ``vector, error``, and a batch that fails to the last has its message; else it raises."""

    @F.pandas_udf(T.StructType([T.StructField("vector", VECTOR), T.StructField("error", T.StringType())]))
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        backend = with_retry(make(), config)
        for part in parts:
            texts = list(part)
            vectors: list[list[float] | None] = []
            errors: list[str | None] = []
            for i in range(0, len(texts), config.batch):
                some = texts[i : i + config.batch]
                try:
                    vectors += backend(some)
                    errors += [None] * len(some)
                except Exception as e:
                    if not keep_errors:
                        raise
                    vectors += [None] * len(some)
                    errors += [str(e) or type(e).__name__] * len(some)
            yield pd.DataFrame({"vector": pd.Series(vectors, dtype=object), "error": pd.Series(errors, dtype=object)})

    return (lambda c: embed(embed_text(c))) if keep_errors else (lambda c: embed(embed_text(c))["vector"])


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """Length one; a zero vector stays."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v)


def checked(v: Column, dim: int) -> Column:
    """The vector; fails the job where the dimension differs."""
    return F.when(F.size(v) == dim, v).otherwise(F.raise_error(F.format_string("a vector of %d dimensions, not %d", F.size(v), F.lit(dim))))


@F.pandas_udf(T.StringType())
def literal(v: pd.Series) -> pd.Series:
    """``[0.10000000,..]``: eight digits, rounded from the exact binary value."""
    return v.map(lambda xs: None if xs is None else "[" + ",".join(f"{x:.8f}" for x in xs) + "]")


def top_similar(queries: DataFrame, vectors: DataFrame, k: int, query_rows: int = 10_000) -> DataFrame:
    """The ``k`` most similar of ``vectors(id, v)`` for each of ``queries(query_id, q)``, by cosine; ties by id.

    Queries are walked in ranges of ``query_id`` of about ``query_rows`` rows. Each range goes to all tasks as one matrix;
    where there are several, a range's result is written before the next one is read. A task keeps its best ``k`` of a
    query from each batch before anything is shuffled. Rows without a vector have no rank.
    """
    spark = queries.sparkSession
    asked = queries.where("q IS NOT NULL AND query_id IS NOT NULL").select(F.col("query_id").cast("long").alias("query_id"), "q")
    blocks = -(-asked.count() // query_rows)
    if blocks < 2:
        return _ranked(_best_of_block(asked.collect(), vectors, k), k)
    cuts = asked.agg(F.percentile_approx("query_id", [i / blocks for i in range(1, blocks)], max(10_000, 20 * blocks))).first()[0]
    cuts = sorted(set(cuts))
    path = scratch_path(spark, "topk")
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        block = asked if low is None else asked.where(F.col("query_id") > low)
        block = block if high is None else block.where(F.col("query_id") <= high)
        best = _ranked(_best_of_block(block.collect(), vectors, k), k)
        best.write.mode("append").parquet(path)  # so that the next plan does not hold this block
    return spark.read.schema(best.schema).parquet(path)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def _best_of_block(asked: list, vectors: DataFrame, k: int) -> DataFrame:
    """``query_id, id, score``: of each batch of ``vectors`` the best ``k`` of each query."""
    names = np.array([r["query_id"] for r in asked], np.int64)
    wanted = _unit_rows([r["q"] for r in asked])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(names):
                continue
            ids = batch.column("id").to_numpy()
            scores = wanted @ _unit_rows(batch.column("v").to_pylist()).T
            rows = []
            for q, row in enumerate(scores):
                near = np.flatnonzero(row >= np.partition(row, -min(k, len(row)))[-min(k, len(row))])
                near = near[np.lexsort((ids[near], -row[near]))][:k]
                rows.append((np.full(len(near), names[q]), ids[near], row[near]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], ["query_id", "id", "score"])

    return vectors.where("v IS NOT NULL").select(F.col("id").cast("long").alias("id"), "v").mapInArrow(best, "query_id long, id long, score double")


def _unit_rows(rows: list) -> np.ndarray:
    m = np.array(rows, np.float64).reshape(len(rows), -1 if rows else 0)
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, size, out=m, where=size > 0)

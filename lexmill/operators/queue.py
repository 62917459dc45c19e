"""A work queue and a vector store on plain tables: claims, marks, upserts, cascades and audits, as joins.

Tables are immutable files, so every operation returns the new table. Status changes touch only the rows they name; the
ids of a batch are few and bounded by its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.sources import numbered

PENDING, WORKING, DONE, ERROR = "pending", "working", "done", "error"


def enqueue(chunks: DataFrame, now: Column | None = None, after: int = 0) -> DataFrame:
    """Rows ``source_url, title, subtitle1, chunk_no, chunk`` as pending work, with ids from ``after + 1`` on in order of
    ``source_url, chunk_no``."""
    at = F.current_timestamp() if now is None else now
    rows = numbered(chunks.select("source_url", "title", "subtitle1", F.col("chunk_no").cast("int").alias("chunk_no"), "chunk"), ["source_url", "chunk_no", "chunk"], after=after)
    return rows.select("id", "source_url", "title", "subtitle1", "chunk_no", "chunk", F.lit(PENDING).alias("status"), F.lit(None).cast("string").alias("error"), at.alias("created_at"), at.alias("updated_at"))


def claimable(queue: DataFrame, limit: int, worker: int = 0, workers: int = 1) -> DataFrame:
    """The ``limit`` oldest pending rows (a top-k: nothing is sorted whole). Of several ``workers`` each sees the rows of
    its share of the ids, so no two can claim the same row; workers that come and go claim by leases
    (:mod:`lexmill.streaming.leases`)."""
    mine = queue.where(F.col("status") == PENDING)
    if workers > 1:
        mine = mine.where(F.pmod("id", F.lit(workers)) == worker)
    return mine.orderBy("id").limit(limit)


def with_status(queue: DataFrame, ids: DataFrame, status: str, error: Column | None = None, only: str | None = None) -> DataFrame:
    """The queue with the rows of ``ids(id)`` moved to ``status`` (only from status ``only``, if given)."""
    named = ids.select(F.col("id").alias("__id")).distinct()
    joined = queue.join(named, queue["id"] == F.col("__id"), "left")
    hit = F.col("__id").isNotNull()
    if only is not None:
        hit = hit & (F.col("status") == only)
    columns = {"status": F.when(hit, F.lit(status)).otherwise(F.col("status"))}
    if "updated_at" in queue.columns:
        columns["updated_at"] = F.when(hit, F.current_timestamp()).otherwise(F.col("updated_at"))
    if error is not None and "error" in queue.columns:
        columns["error"] = F.when(hit, error).otherwise(F.col("error"))
    return joined.withColumns(columns).select(*queue.columns)


def claim(queue: DataFrame, limit: int, worker: int = 0, workers: int = 1) -> tuple[DataFrame, DataFrame]:
    """The claimed rows, and the queue with them at work. Their ids, ``limit`` at most, are fixed here, so both results
    speak of the same rows however often they are computed."""
    ids = [r["id"] for r in claimable(queue, limit, worker, workers).select("id").collect()]
    taken = F.col("id").isin(ids) & (F.col("status") == PENDING)
    columns = {"status": F.when(taken, F.lit(WORKING)).otherwise(F.col("status"))}
    if "updated_at" in queue.columns:
        columns["updated_at"] = F.when(taken, F.current_timestamp()).otherwise(F.col("updated_at"))
    return queue.where(taken), queue.withColumns(columns)


def marked(queue: DataFrame, marks: DataFrame) -> DataFrame:
    """The queue with the newest mark of each row (``id, status, error, updated_at``); repeated marks are pre-aggregated."""
    newest = marks.groupBy("id").agg(F.max(F.struct("updated_at", "status", "error")).alias("__mark"))
    joined = queue.join(newest, "id", "left")
    new = {c: F.when(F.col("__mark").isNotNull(), F.col("__mark")[c]).otherwise(F.col(c)).alias(c) for c in ("status", "error", "updated_at")}
    return joined.select(*(new.get(c, F.col(c)) for c in queue.columns))


def upsert_vectors(store: DataFrame, rows: DataFrame, key: str = "queue_id", now: Column | None = None) -> DataFrame:
    """New vectors replace old ones of the same key. An old row's chunk number, id and creation time stay; of repeated new
    keys the row with the largest ``id`` wins (without ids, the largest chunk number and vector)."""
    at = F.current_timestamp() if now is None else now
    order = F.struct(*(["id"] if "id" in rows.columns else []), "chunk_no", "vector")
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c != key)), order).alias("__new"))
    old, new = store.alias("a"), newest.alias("b")
    joined = old.join(new, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    columns = [F.coalesce(f"a.{key}", f"b.{key}").alias(key)]
    for c in (c for c in store.columns if c != key):
        fresh = F.col("b.__new")[c] if c in rows.columns else F.lit(None).cast(store.schema[c].dataType)
        if c == "vector":
            columns.append(F.coalesce(fresh, F.col("a.vector")).alias(c))
        elif c == "created_at":
            columns.append(F.coalesce(F.col(f"a.{c}"), at).alias(c))
        elif c == "updated_at":
            columns.append(F.when(F.col("b.__new").isNotNull(), at).otherwise(F.col(f"a.{c}")).alias(c))
        else:
            columns.append(F.coalesce(F.col(f"a.{c}"), fresh).alias(c))
    return joined.select(*columns)


def last_write_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of each key the row that came last."""
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("__rank = 1").drop("__rank")


def first_of_signature(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of equal signatures the row that came first."""
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("__rank = 1").drop("__rank")


def cascade(deleted: DataFrame, key: str, *children: tuple[DataFrame, str, str]) -> list[DataFrame]:
    """What remains of each child table after rows are deleted above it: ``(table, foreign key, own key)`` from the top down."""
    out, gone = [], deleted.select(F.col(key).alias("__gone")).distinct()
    for table, foreign, own in children:
        out.append(table.join(gone, table[foreign] == F.col("__gone"), "left_anti"))
        gone = table.join(gone, table[foreign] == F.col("__gone"), "left_semi").select(F.col(own).alias("__gone")).distinct()
    return out


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break a uniqueness rule, with their counts."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def cached_text(images: DataFrame, cache: DataFrame, otherwise: str) -> DataFrame:
    """Recognised text by the image's digest; ``otherwise`` where there is none."""
    return images.join(cache, "image_md5", "left").withColumn("text", F.coalesce("text", F.lit(otherwise)))

"""The embedding worker as a stream: queue files in, vectors and marks out, exactly once in effect.

The source's checkpoint is the claim: a file belongs to one micro-batch of one worker, and a failed batch is replayed.
Each micro-batch writes its vectors and its marks (done, or error with the backend's message) to a folder of its run and
number, and a replay writes the same folder again, so at-least-once delivery leaves one result. A run is named by the
identity that its checkpoint keeps: a worker that begins anew with another checkpoint writes beside what is there, and many
workers may share one store. Nothing is rewritten: readers take the newest row of each key, pre-aggregated.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.queue import DONE, ERROR, PENDING
from lexmill.operators.queue import marked as with_marks
from lexmill.operators.vectors import Backend, EmbedConfig, embed_column, unit
from lexmill.sources import EMBEDDING, QUEUE

MARK = T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType()), T.StructField("error", T.StringType()), T.StructField("updated_at", T.TimestampType())])


def embed_rows(queue: DataFrame, make: Callable[[], Backend], config: EmbedConfig) -> DataFrame:
    """``queue_id, chunk_no, vector`` of pending rows."""
    vectors = queue.where(F.col("status") == PENDING).select(F.col("id").alias("queue_id"), "chunk_no", embed_column(make, config)(F.col("chunk")).alias("vector"))
    return vectors.withColumn("vector", unit(F.col("vector"))) if config.normalize else vectors


#: The run of batches that were put together.
FOLDED = "folded"


def _batched(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])


class VectorStore:
    """Vectors and marks of workers: an append-only table of each, a folder for each micro-batch of each run. What is read
    covers ``others`` as well, stores of workers that write elsewhere."""

    def __init__(self, spark: SparkSession, path: str, *others: str) -> None:
        self.spark, self.path, self.paths = spark, path, (path, *others)

    def _rows(self, name: str, schema: T.StructType) -> DataFrame:
        every = _batched(schema)
        found = self.spark.createDataFrame([], every)
        for path in self.paths:
            try:
                found = found.unionByName(self.spark.read.schema(every).parquet(f"{path}/{name}"))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        return found

    def append(self, name: str, rows: DataFrame, batch: int, run: str = "0") -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/run={run}/batch={batch}")

    def read(self) -> DataFrame:
        """The newest vector of each row, with the chunk number and the time of its first."""
        return self._newest(self._rows("vectors", EMBEDDING))

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        order = F.struct("updated_at", "batch", "run", "chunk_no", "vector")
        newest = rows.groupBy("queue_id").agg(F.max(order).alias("new"), F.min(order).alias("old"), F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
        return newest.select("queue_id", F.col("old.chunk_no").alias("chunk_no"), F.col("new.vector").alias("vector"), "created_at", "updated_at")

    def batches(self, name: str) -> list[str]:
        """Folders of this store's batches, folded ones (of run ``folded``) among them."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/run=*/batch=*")
        found = at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(at)
        return sorted(f.getPath().toString() for f in found or [])

    def fold(self, most: int = 8) -> None:
        """Puts the batches written since the last call into one; once there are ``most`` such, these become one as well. So what
        is read and written follows what is new, and a row is written again once for each doubling of levels, not for each batch.

        The newest row of each key and the first one's chunk number and time stay. The new folder is complete before the old ones go, and
        what both hold is the same rows, so a call that breaks off, or is repeated, changes nothing that readers see. Call it where no
        reader has a query running over the old folders."""
        folded = f"run={FOLDED}/"
        for name, read in (("vectors", self._newest), ("marks", self._last_marks)):
            made = self.batches(name)
            old = [p for p in made if folded not in p]
            if not old:
                continue
            whole = [p for p in made if folded in p]
            old += whole if len(whole) + 1 >= most else []
            number = 1 + max((int(p.rpartition("=")[2]) for p in whole), default=-1)
            schema = EMBEDDING if name == "vectors" else MARK
            rows = self.spark.read.schema(_batched(schema)).option("basePath", f"{self.path}/{name}").parquet(*old)
            self.append(name, read(rows), number, FOLDED)
            for p in old:
                at = self.spark._jvm.org.apache.hadoop.fs.Path(p)
                at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)

    def marks(self) -> DataFrame:
        return self._rows("marks", MARK).drop("run", "batch")

    def marked(self, queue: DataFrame) -> DataFrame:
        """The queue as the workers' marks leave it."""
        return with_marks(queue, self.marks())

    @staticmethod
    def _last_marks(rows: DataFrame) -> DataFrame:
        last = rows.groupBy("id").agg(F.max(F.struct("updated_at", "status", "error")).alias("m"))
        return last.select("id", "m.status", "m.error", "m.updated_at")

    def upsert(self, batch: DataFrame, number: int, make: Callable[[], Backend], config: EmbedConfig, run: str = "0") -> None:
        """Embeds a batch's pending rows, and writes their vectors and marks as batch ``number`` of ``run``."""
        told = batch.where(F.col("status") == PENDING).select("id", "chunk_no", embed_column(make, config, keep_errors=True)(F.col("chunk")).alias("r"), F.current_timestamp().alias("at")).persist()
        try:
            vector = unit(F.col("r.vector")) if config.normalize else F.col("r.vector")
            good = F.col("r.error").isNull()
            self.append("vectors", told.where(good).select(F.col("id").alias("queue_id"), "chunk_no", vector.alias("vector"), F.col("at").alias("created_at"), F.col("at").alias("updated_at")), number, run)
            self.append("marks", told.select("id", F.when(good, DONE).otherwise(ERROR).alias("status"), F.col("r.error").alias("error"), F.col("at").alias("updated_at")), number, run)
        finally:
            told.unpersist()


def start_worker(spark: SparkSession, queue_path: str, store_path: str, checkpoint: str, make: Callable[[], Backend], config: EmbedConfig, once: bool = True, poll: str = "2 seconds", files: int = 16, worker: int = 0, workers: int = 1):
    """Starts a worker; ``once`` processes what is there and stops, else it polls. Of several ``workers``, each with a
    checkpoint of its own, each takes its share of the ids; they may share a store. Rows go to the backend ``config.batch`` at a
    time; a micro-batch holds the rows of ``files`` files. Returns the streaming query."""
    store = VectorStore(spark, store_path)
    stream = spark.readStream.schema(QUEUE).option("maxFilesPerTrigger", files).parquet(queue_path)
    if workers > 1:
        stream = stream.where(F.pmod("id", F.lit(workers)) == worker)
    started, run = threading.Event(), []

    def embed(batch: DataFrame, number: int) -> None:
        started.wait()
        store.upsert(batch, number, make, config, run[0])

    writer = stream.writeStream.foreachBatch(embed).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()
    run.append(str(query.id))  # the checkpoint keeps it
    started.set()
    return query

"""What the operators share: reading documents, writing intermediate tables, walking Arrow batches.

Defined results for odd input, in every operator of this subpackage:

* a null text counts as an empty text; an empty table gives an empty result;
* only the columns an operator names are read, so extra columns, whatever their names, have no effect;
* rows that repeat a ``doc_id`` are all kept and each gets its own result row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.sources import shared_dir

#: Bytes of text that Python code looks at together: keeps a worker's memory small.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and a Python worker, whatever the number of rows.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
#: Shuffle files go when the execution that made them ends: what is needed later has been written as a table by then.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """The intermediate tables of one run, in a folder of their own within the shared folder.

    A table is written once and read back: later steps neither compute it again nor need the executors that made it.
    Tables that no later step reads are dropped at once; the others go with the session.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.made = spark, 0
        self.root = f"{shared_dir(spark)}/lexmill/{name}-{uuid.uuid4().hex}"
        spark.conf.set(CLEANUP, "true")
        spark.conf.set(*BATCH_BYTES)
        self._files().mkdirs(self._path(self.root))
        self._files().deleteOnExit(self._path(self.root))

    def _path(self, path: str) -> object:
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self) -> object:
        return self._path(self.root).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.written_to = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing unfinished reads any more."""
        for df in tables:
            self._files().delete(self._path(df.written_to), True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` as long and ``text`` without nulls, for Python code that gets them in batches of bounded size."""
    docs.sparkSession.conf.set(*BATCH_BYTES)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches of about ``SLICE_BYTES`` of ``column``. What Arrow holds without using it goes back at the end
    of a task: workers wait for further tasks of other steps."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32)[col.offset : col.offset + len(col) + 1]
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(sizes, sizes[at] + SLICE_BYTES, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    pa.default_memory_pool().release_unused()


def boundaries_of(df: DataFrame, column: str, parts: int) -> list[int]:
    """Ascending split points of a long column that cut it into about ``parts`` even ranges (at most ``parts - 1``
    values reach the driver)."""
    if parts < 2:
        return []
    cuts = df.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], 10_000).alias("q")).first()["q"]
    return sorted(set(cuts or []))

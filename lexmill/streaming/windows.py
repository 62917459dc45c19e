"""Event time: windows, sessions and late rows, the same over a table and over a stream.

Each function takes either kind of DataFrame. On a stream a watermark stays ``late`` behind the newest event; what is older
than it when it arrives is dropped by Spark and counted in the query's progress (:func:`dropped`). A finished stream
of a table so ends with the batch result, apart from windows that the watermark has not passed (:func:`closed`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.sources import scratch_path


def _timed(events: DataFrame, ts: str, late: str) -> DataFrame:
    return events.withWatermark(ts, late) if events.isStreaming else events


def tumbling(events: DataFrame, ts: str, width: str, keys: list[str], sums: dict[str, Column], late: str = "0 seconds") -> DataFrame:
    """``keys, start, end`` and aggregates of each window of ``width``."""
    return sliding(events, ts, width, width, keys, sums, late)


def sliding(events: DataFrame, ts: str, width: str, step: str, keys: list[str], sums: dict[str, Column], late: str = "0 seconds") -> DataFrame:
    """The same for windows of ``width`` that begin every ``step``: each event is in all that hold it."""
    found = _timed(events, ts, late).groupBy(F.window(ts, width, step).alias("__w"), *keys).agg(*(c.alias(n) for n, c in sums.items()))
    return found.select(*keys, F.col("__w.start").alias("start"), F.col("__w.end").alias("end"), *sums)


def sessions(events: DataFrame, ts: str, gap: str, keys: list[str], sums: dict[str, Column], late: str = "0 seconds") -> DataFrame:
    """Sessions of a key: events less than ``gap`` apart; a session ends ``gap`` after its last event.

    Both ends are aggregates: Spark pushes a filter on a session window's own ends below the merging of sessions, where they
    are still those of single events."""
    found = _timed(events, ts, late).groupBy(F.session_window(ts, gap).alias("__w"), *keys).agg(F.min(ts).alias("start"), (F.max(ts) + F.expr(f"INTERVAL {gap}")).alias("end"), *(c.alias(n) for n, c in sums.items()))
    return found.select(*keys, "start", "end", *sums)


def matched(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, late: str = "0 seconds") -> DataFrame:
    """Rows of ``left`` with those of ``right`` (no columns in common but ``key``) that follow them within ``within``: queue rows with their marks. Both
    watermarks bound what a stream must keep."""
    a = _timed(left, left_ts, late).withColumnRenamed(key, "__key")
    b = _timed(right, right_ts, late)
    near = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within}"))
    return a.join(b, (F.col("__key") == F.col(key)) & near).drop("__key")


def closed(found: DataFrame, watermark: Column) -> DataFrame:
    """The windows of a batch result that a stream's watermark has passed: what append mode has given out."""
    return found.where(F.col("end") <= watermark)


def finished(stream: DataFrame, name: str) -> tuple[DataFrame, StreamingQuery]:
    """Runs a stream over what its source holds now, in append mode, and reads its rows back."""
    spark: SparkSession = stream.sparkSession
    path = scratch_path(spark, name)
    query = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows"), query


def dropped(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, over all batches that the query still knows."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])

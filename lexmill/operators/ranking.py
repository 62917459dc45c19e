"""Ranks over whole tables: competition, dense and percent rank, and quantiles, without a task that sees all rows.

Equal values are counted first, so a value that most rows have is one row; the different values are sorted by ranges, each
range starts with the counts of those before it, and every row takes its ranks by a join on its value that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.sources import scratch, shuffle_partitions


def value_ranks(df: DataFrame, column: str) -> DataFrame:
    """``value, n, rank, dense_rank, percent_rank, cume_dist`` of the different values of ``column``, null first.

    The sorted values are written to the shared folder when this is called."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ranges = counted.repartitionByRange(shuffle_partitions(df.sparkSession), "value").sortWithinPartitions("value")
    placed = scratch(ranges.withColumn("__at", F.monotonically_increasing_id()), "ranks").withColumn("__range", F.shiftrightunsigned("__at", 33))
    sums = placed.groupBy("__range").agg(F.sum("n").alias("__rows"), F.count("*").alias("__values"))  # a row for each partition
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    carried = sums.select("__range", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("__rows", "__values")), F.sum("__rows").over(total).alias("__total"))
    here = Window.partitionBy("__range").orderBy("__at")
    own = placed.select("*", F.row_number().over(here).alias("__i"), (F.sum("n").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("__less"))
    met = own.join(F.broadcast(carried), "__range")
    rank = F.col("__rows") + F.col("__less") + 1
    percent = F.when(F.col("__total") > 1, (rank - 1) / (F.col("__total") - 1)).otherwise(F.lit(0.0))
    return met.select("value", "n", rank.alias("rank"), (F.col("__values") + F.col("__i")).alias("dense_rank"), percent.alias("percent_rank"), ((rank - 1 + F.col("n")) / F.col("__total")).alias("cume_dist"))


def ranked(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``rank, dense_rank, percent_rank, cume_dist`` of each row by ``column``."""
    ranks = value_ranks(df, column).drop("n").withColumnRenamed("value", "__value")
    return df.join(ranks, df[column].eqNullSafe(ranks["__value"])).drop("__value")

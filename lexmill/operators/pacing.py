"""Rate caps: when each of many requests may start, domain by domain, without a driver that walks through them.

A domain starts at most one request in ``gap`` after a burst of ``burst``. One after the other, the slot of a request is
``max(arrival, slot before + gap)``; with its place ``i`` in the domain that is ``i * gap`` plus the largest
``arrival - place * gap`` so far, a running maximum. So requests are sorted by ranges of (domain, arrival), each range works
out its own, and what lies before it in the domain (a count and a maximum) is carried over: a domain with a third of all
requests is many ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.sources import scratch, shuffle_partitions


def schedule(requests: DataFrame, domain: str, arrival: str, order: str, gap: int, burst: int = 1) -> DataFrame:
    """``requests`` with ``place`` (from 0) in their domain and ``start``, in the unit of ``arrival`` (long) and ``gap``.

    Equal arrivals go by ``order``. Rows with a null arrival have no start; a null domain is a domain. The sorted requests are
    written to the shared folder when this is called."""
    spark = requests.sparkSession
    known = requests.where(F.col(arrival).isNotNull())
    ranges = known.repartitionByRange(shuffle_partitions(spark), domain, arrival, order).sortWithinPartitions(domain, arrival, order)
    ranged = scratch(ranges.withColumn("__at", F.monotonically_increasing_id()), "paced").withColumn("__range", F.shiftrightunsigned("__at", 33))
    here = Window.partitionBy(domain, "__range").orderBy("__at")
    # places from 0 in the range: its first request of the domain has the lowest number
    own = ranged.withColumn("__i", F.col("__at") - F.first("__at").over(here))
    own = own.withColumn("__most", F.max(F.col(arrival) - F.col("__i") * gap).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    sums = own.groupBy(domain, "__range").agg(F.count("*").alias("__n"), F.max("__most").alias("__top")).select(F.col(domain).alias("__domain"), F.col("__range").alias("__of"), "__n", "__top")
    before = Window.partitionBy("__domain").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    counted = sums.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    # a range's maximum, counted from the domain's first request
    carried = counted.withColumn("__carried", F.max(F.col("__top") - F.col("__before") * gap).over(before))
    met = own.join(carried.select("__domain", "__of", "__before", "__carried"), own[domain].eqNullSafe(F.col("__domain")) & (F.col("__range") == F.col("__of")))
    place = F.col("__before") + F.col("__i")
    slot = place * gap + F.greatest(F.col("__most") - F.col("__before") * gap, F.col("__carried"))
    timed = met.withColumn("place", place).withColumn("start", F.greatest(F.col(arrival), slot - (burst - 1) * gap))
    out = timed.select(*requests.columns, "place", "start")
    never = requests.where(F.col(arrival).isNull()).select("*", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("start"))
    return out.unionByName(never)

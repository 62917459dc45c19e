"""A crawl's frontier to its fixpoint: rounds that follow only links of what the round before has found.

What was seen is an append-only table, a folder for each run and round, so a later run goes on where earlier ones ended, and a
round that is repeated writes its folder again. A round is one join of the last folder with the links and one
anti-join with everything seen; links to a page from a third of all pages are one row after the pre-aggregation.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEEN = T.StructType([T.StructField("url", T.StringType()), T.StructField("run", T.IntegerType()), T.StructField("depth", T.IntegerType())])


class Seen:
    """The table of what was seen: ``url, run, depth`` (rounds from the seeds of its run)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def rows(self, run: int | None = None, depth: int | None = None) -> DataFrame:
        try:
            rows = self.spark.read.schema(SEEN).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return self.spark.createDataFrame([], SEEN)
        rows = rows if run is None else rows.where(F.col("run") == run)
        return rows if depth is None else rows.where(F.col("depth") == depth)

    def add(self, urls: DataFrame, run: int, depth: int) -> DataFrame:
        """Writes the different ``urls`` that no other round has seen as a round of their own, and reads them back."""
        before = self.rows().where(~((F.col("run") == run) & (F.col("depth") == depth))).select(F.col("url").alias("__url"))
        new = urls.where(F.col("url").isNotNull()).select("url").distinct()
        new.join(before, new["url"] == before["__url"], "left_anti").write.mode("overwrite").parquet(f"{self.path}/run={run}/depth={depth}")
        return self.rows(run, depth).select("url")


def crawl(links: DataFrame, seeds: DataFrame, seen: Seen, run: int = 0, most_depth: int | None = None) -> DataFrame:
    """Follows ``links(source, target)`` from ``seeds(url)`` until nothing is new (or for ``most_depth`` rounds); returns what
    this run has seen first: ``url, depth``.

    A later run also follows links of pages that earlier runs saw, once, in its first round: they may have links that they had
    not then. Null targets and links to oneself lead nowhere; repeated links and cycles are followed once."""
    edges = links.where(F.col("source") != F.col("target")).select("source", "target")
    new = seen.add(seeds, run, 0)
    earlier = seen.rows().where(F.col("run") < run).select("url")
    depth, going_on = 0, True
    while going_on and (most_depth is None or depth < most_depth):
        depth += 1
        from_here = new.unionByName(earlier) if depth == 1 else new
        targets = edges.join(from_here, edges["source"] == from_here["url"], "left_semi").select(F.col("target").alias("url"))
        new = seen.add(targets, run, depth)
        going_on = not new.isEmpty()
    return seen.rows(run).select("url", "depth")

"""Readers and writers: JSON lines, CSV with nested fields flattened, routed and merged outputs, recognised pages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

BOM = "﻿"
_S = T.StringType()

DOCUMENT = T.StructType([T.StructField(n, _S) for n in ("doc_id", "title", "subtitle", "source_url")])
URL_ENTRY = T.StructType([T.StructField(n, _S) for n in ("name", "url")])
METADATA = T.StructType([T.StructField("chapter", _S), T.StructField("source_type", _S)])
CHUNK = T.StructType([*(T.StructField(n, _S) for n in ("chunk_id", "doc_id", "title", "text")), T.StructField("metadata", METADATA), T.StructField("source_url", _S)])
CASE = T.StructType(
    [
        *(T.StructField(n, _S) for n in ("source_url", "title", "subtitle1")),
        T.StructField("sections", T.StructType([*(T.StructField(n, _S) for n in ("판시사항", "판결요지", "참조조문")), T.StructField("전문", T.StructType([T.StructField("주문", _S), T.StructField("이유", _S)]))])),
    ]
)
QUEUE = T.StructType(
    [T.StructField("id", T.LongType()), *(T.StructField(n, _S) for n in ("source_url", "title", "subtitle1")), T.StructField("chunk_no", T.IntegerType()), *(T.StructField(n, _S) for n in ("chunk", "status", "error")), *(T.StructField(n, T.TimestampType()) for n in ("created_at", "updated_at"))]
)
EMBEDDING = T.StructType([T.StructField("queue_id", T.LongType()), T.StructField("chunk_no", T.IntegerType()), T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])
_LONG, _INT, _TIME = T.LongType(), T.IntegerType(), T.TimestampType()
#: The relational model of statutes; every table has a key of its own, and the audit of its uniqueness is a query.
LAW = T.StructType([T.StructField("id", _LONG, False), T.StructField("lsi_seq", _LONG), T.StructField("source_url", _S, False), T.StructField("title_line", _S, False), T.StructField("department", _S), T.StructField("content_hash", _S, False), T.StructField("fetched_at", _TIME, False)])
LAW_ARTICLE = T.StructType([T.StructField("id", _LONG, False), T.StructField("law_id", _LONG), T.StructField("art_no", _INT), *(T.StructField(n, _S, False) for n in ("heading", "body", "content_hash"))])
ARTICLE_CHUNK = T.StructType([T.StructField("id", _LONG, False), T.StructField("article_id", _LONG), T.StructField("chunk_no", _INT, False), *(T.StructField(n, _S, False) for n in ("text", "content_hash"))])
TABLES = {"laws": LAW, "law_articles": LAW_ARTICLE, "article_chunks": ARTICLE_CHUNK, "embedding_queue": QUEUE, "embeddings": EMBEDDING}


def ensure_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """Creates the tables that are not there yet, the queue partitioned by status; returns the names of all."""
    for name, schema in TABLES.items():
        if not spark.catalog.tableExists(f"{database}.{name}"):
            writer = spark.createDataFrame([], schema).writeTo(f"{database}.{name}").using("parquet")
            (writer.partitionedBy(F.col("status")) if "status" in schema.fieldNames() else writer).create()
    return [f"{database}.{name}" for name in TABLES]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; a local session without one gets its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(at)
    files.deleteOnExit(at)
    return path


def scratch(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once to a scratch path and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column | str], name: str = "id", after: int = 0) -> DataFrame:
    """``name``: 1, 2, ... (beyond ``after``) in order, without a task that sees all rows: rows are sorted by ranges and
    written (when this is called), and each range starts where the counts of those before it end."""
    columns = [c if isinstance(c, Column) else F.col(c) for c in order]
    ranges = df.repartitionByRange(shuffle_partitions(df.sparkSession), *columns).sortWithinPartitions(*columns)
    placed = scratch(ranges.withColumn("__place", F.monotonically_increasing_id()), "numbered").withColumn("__range", F.shiftrightunsigned("__place", 33))
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__n"))  # a row for each partition
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    number = F.col("__start") + (F.col("__place") % (1 << 33)) + 1 + after
    return placed.join(F.broadcast(starts), "__range").withColumn(name, number).drop("__range", "__place", "__start")


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files of a Parquet table as a stream, whether the table is a folder or one file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(at).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines by an explicit schema. ``strict`` fails on a bad line; otherwise it lands in ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt_record", _S)])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, nulls written, overwriting."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def flattened(df: DataFrame) -> DataFrame:
    """Nested structs as columns named by their path (``metadata.chapter``)."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Column]:
        out: list[Column] = []
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here)))
        return out

    return df.select(*leaves(df.schema))


def write_csv(df: DataFrame, path: str, bom: bool = True) -> bool:
    """CSV of the flattened rows with a header and doubled quotes; a byte-order mark leads the header. Nothing is
    written for an empty table (False)."""
    flat = flattened(df)
    if flat.isEmpty():
        return False
    if bom and flat.columns:
        flat = flat.toDF(BOM + flat.columns[0], *flat.columns[1:])
    flat.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)
    return True


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return df.toDF(*(c.lstrip(BOM) for c in df.columns))


def merged(parts: DataFrame, name: str = "name", suffix: str = "_document.jsonl", within: list[str] | None = None, place: str | None = None) -> DataFrame:
    """Rows in the byte order of the files they would have stood in, and ``within`` a file in order of these columns;
    with ``place``, each row's place in the merged output."""
    order = [F.concat(F.col(name), F.lit(suffix)), *(within or [])]
    return numbered(parts, order, place) if place else parts.orderBy(*order)


def routed(df: DataFrame, path: str, by: str = "kind") -> None:
    """One output for each kind of record."""
    df.write.mode("overwrite").partitionBy(by).json(path)


def route(spark: SparkSession, path: str, kind: str, schema: T.StructType, by: str = "kind") -> DataFrame:
    """Reads one kind of record back; of a kind that is not there, no rows."""
    every = T.StructType([*schema.fields, T.StructField(by, _S)])
    return spark.read.schema(every).json(path).where(F.col(by) == kind).drop(by)


def run_metrics(spark: SparkSession, path: str, run: str, counts: dict[str, int], level: str = "INFO") -> None:
    """Appends what a run counted to a table of metrics: ``run, at, level, metric, value``."""
    rows = spark.createDataFrame([(run, level, k, int(v)) for k, v in counts.items()], "run string, level string, metric string, value long")
    rows.select("run", F.current_timestamp().alias("at"), "level", "metric", "value").write.mode("append").parquet(path)


def log_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of run logs (``2025-08-20 22:59:59,123 - INFO - text``) as ``at, level, message``; other lines are left out."""
    pattern = r"\A(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),\d+ - (?:\S+ - )?(DEBUG|INFO|WARNING|ERROR|CRITICAL) - (.*)\z"
    part = lambda k: F.regexp_extract(column, pattern, k)
    return lines.select(F.try_to_timestamp(part(1), F.lit("yyyy-MM-dd HH:mm:ss")).alias("at"), part(2).alias("level"), part(3).alias("message")).where("level <> ''")


def quarantine(df: DataFrame, bad: Column, path: str) -> DataFrame:
    """Writes the rows where ``bad`` holds to a table of their own and returns the others."""
    df.where(bad).write.mode("append").parquet(path)
    return df.where(~bad)


def savable(documents: DataFrame) -> DataFrame:
    """Documents that have a title."""
    return documents.where(F.coalesce("title", F.lit("")) != "")


def recognised_text(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The pages of each document joined in order, empty pages left out: ``keys, text``."""
    rows = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return pages.where(F.coalesce("text", F.lit("")) != "").groupBy(*keys).agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n").alias("text"))


def field_text(response: Column) -> Column:
    """The fields of a recognition response (JSON), joined by blanks."""
    parsed = F.from_json(response, "images array<struct<fields array<struct<inferText string>>>>")
    return F.array_join(F.transform(F.get(parsed["images"], 0)["fields"], lambda f: f["inferText"]), " ")

"""Queries over keyed tables: queue, joins, upserts, audits, vectors, flattening."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill import sources
from lexmill.catalog import Catalog, table
from lexmill.operators import queue, vectors
from lexmill.streaming import VectorStore, embed_rows

CATALOG = Catalog()

QUEUE_SQL = """
q AS (SELECT event_id AS id, user_id, CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'working' WHEN 'purchase' THEN 'done' ELSE 'error' END AS status, value FROM events)"""


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "view", "pending").when(F.col("event_type") == "click", "working").when(F.col("event_type") == "purchase", "done").otherwise("error")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "user_id", status.alias("status"), "value")


@CATALOG.add("queue_claim", f"WITH {QUEUE_SQL} SELECT id, user_id, status, value FROM q WHERE status = 'pending' ORDER BY id LIMIT 64")
def queue_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of a worker: the limit is the feature."""
    return queue.claimable(_queue(spark, sf_dir), 64)


@CATALOG.add("queue_mark_working", f"WITH {QUEUE_SQL}, c AS (SELECT id FROM q WHERE status = 'pending' ORDER BY id LIMIT 64) SELECT id, user_id, CASE WHEN id IN (SELECT id FROM c) THEN 'working' ELSE status END AS status, value FROM q")
def queue_mark_working(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.claim(_queue(spark, sf_dir), 64)[1]


@CATALOG.add("queue_mark_done", f"WITH {QUEUE_SQL} SELECT id, user_id, CASE WHEN status = 'working' AND user_id % 2 = 0 THEN 'done' ELSE status END AS status, value FROM q")
def queue_mark_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _queue(spark, sf_dir)
    return queue.with_status(q, q.where("user_id % 2 = 0").select("id"), queue.DONE, only=queue.WORKING)


@CATALOG.add("queue_mark_error", f"WITH {QUEUE_SQL} SELECT id, user_id, CASE WHEN value < 5 THEN 'error' ELSE status END AS status, value, CASE WHEN value < 5 THEN 'low value' END AS error FROM q")
def queue_mark_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _queue(spark, sf_dir).withColumn("error", F.lit(None).cast("string"))
    return queue.with_status(q, q.where("value < 5").select("id"), queue.ERROR, F.lit("low value"))


@CATALOG.add("queue_state_counts", f"WITH {QUEUE_SQL} SELECT status, count(*) AS n FROM q GROUP BY status")
def queue_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


@CATALOG.add(
    "embedding_upsert",
    """
WITH old AS (SELECT vec_id AS queue_id, CAST(label AS INTEGER) AS chunk_no, 1.0 AS gen FROM embeddings WHERE vec_id % 3 <> 0),
new AS (SELECT vec_id AS queue_id, CAST(label + 1 AS INTEGER) AS chunk_no, CASE WHEN vec_id % 4 = 0 THEN 3.0 ELSE 2.0 END AS gen FROM embeddings WHERE vec_id % 2 = 0)
SELECT coalesce(o.queue_id, n.queue_id) AS queue_id, coalesce(o.chunk_no, n.chunk_no) AS chunk_no, CAST(coalesce(n.gen, o.gen) AS DOUBLE) AS generation,
  CASE WHEN o.queue_id IS NULL THEN 2020 ELSE 2010 END AS created, CASE WHEN n.queue_id IS NULL THEN 2010 ELSE 2020 END AS updated FROM old o FULL JOIN new n ON o.queue_id = n.queue_id
""",
)
def embedding_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New vectors over old ones; of keys that come twice the larger id wins, whatever its chunk number."""
    e = table(spark, sf_dir, "embeddings")
    row = lambda d, k, c, g: d.select(k.alias("id"), F.col("vec_id").alias("queue_id"), c.cast("int").alias("chunk_no"), F.array(F.lit(g)).alias("vector"))
    old = row(e.where("vec_id % 3 <> 0"), F.col("vec_id"), F.col("label"), 1.0).drop("id").withColumns({c: F.lit("2010-01-01").cast("timestamp") for c in ("created_at", "updated_at")})
    new = row(e.where("vec_id % 2 = 0"), F.col("vec_id"), F.col("label") + 1, 2.0).unionByName(row(e.where("vec_id % 4 = 0"), F.col("vec_id") + 1_000_000, F.col("label") + 1, 3.0))
    merged = queue.upsert_vectors(old, new, now=F.lit("2020-01-01").cast("timestamp"))
    return merged.select("queue_id", "chunk_no", F.get("vector", 0).alias("generation"), F.year("created_at").cast("int").alias("created"), F.year("updated_at").cast("int").alias("updated"))


@CATALOG.add(
    "cascade_delete",
    """
WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), o AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM gone)),
go AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone)), l AS (SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM go))
SELECT 'orders' AS table_name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM o UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM l
""",
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    orders, items = queue.cascade(t("customer").where("c_acctbal < 0"), "c_custkey", (t("orders"), "o_custkey", "o_orderkey"), (t("lineitem"), "l_orderkey", "l_linenumber"))
    total = lambda d, name, key: d.agg(F.count("*").alias("n"), F.sum(key).alias("keys")).select(F.lit(name).alias("table_name"), "n", "keys")
    return total(orders, "orders", "o_orderkey").unionByName(total(items, "lineitem", "l_orderkey"))


@CATALOG.add(
    "hierarchy_join",
    """
SELECT r_name, n_name, count(*) AS n_orders, CAST(round(sum(o_totalprice), 2) AS DOUBLE) AS total FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2
""",
)
def hierarchy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads down a chain of foreign keys, as from statutes to articles to chunks."""
    t = lambda n: table(spark, sf_dir, n)
    joined = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", "n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@CATALOG.add("missing_docs_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_docs_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@CATALOG.add(
    "ocr_cache_join",
    "WITH c AS (SELECT md5(source) AS image_md5, min(lang) AS text FROM documents WHERE doc_id % 2 = 0 GROUP BY 1) SELECT doc_id, md5(source || CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE '' END) AS image_md5, coalesce(c.text, '[no text]') AS text FROM documents d LEFT JOIN c ON c.image_md5 = md5(source || CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE '' END)",
)
def ocr_cache_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cache = docs.where("doc_id % 2 = 0").groupBy(F.md5("source").alias("image_md5")).agg(F.min("lang").alias("text"))
    images = docs.select("doc_id", F.md5(F.concat("source", F.when(F.col("doc_id") % 5 == 0, "x").otherwise(""))).alias("image_md5"))
    return queue.cached_text(images, cache, "[no text]").select("doc_id", "image_md5", "text")


@CATALOG.add("ocr_pages_join", "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations WHERE coalesce(text, '') <> '' GROUP BY conv_id")
def ocr_pages_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a document in order; here turns of a conversation."""
    return sources.recognised_text(table(spark, sf_dir, "conversations").withColumnRenamed("turn", "page_no"), ["conv_id"])


@CATALOG.add("last_write_wins", "WITH r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn FROM documents) SELECT source, doc_id, n_chars FROM r WHERE rn = 1")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.last_write_wins(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source"], "doc_id")


@CATALOG.add("uniqueness_audit", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def uniqueness_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.duplicates(table(spark, sf_dir, "orders"), ["o_custkey"])


@CATALOG.add("json_normalize_flatten", """SELECT event_id AS id, event_type AS "metadata.chapter", CAST(json_extract(props, '$.k') AS BIGINT) AS "metadata.inner.k" FROM events""")
def json_normalize_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = F.from_json("props", "k long")
    nested = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("chapter"), inner.alias("inner")).alias("metadata"))
    return sources.flattened(nested)


@CATALOG.add("kind_router", "SELECT 'document' AS kind, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS keys FROM documents UNION ALL SELECT 'chunk', count(*), CAST(sum(conv_id) AS BIGINT) FROM conversations")
def kind_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two kinds in one stream, routed to an output for each kind and read back from it."""
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("key"))
    both = docs.unionByName(table(spark, sf_dir, "conversations").select(F.lit("chunk").alias("kind"), F.col("conv_id").alias("key")))
    path = sources.scratch_path(spark, "routed")
    sources.routed(both, path)
    one = lambda kind: sources.route(spark, path, kind, T.StructType([T.StructField("key", T.LongType())])).agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.sum("key").alias("keys"))
    return one("document").unionByName(one("chunk"))


@CATALOG.add("queue_enqueue", "SELECT row_number() OVER (ORDER BY conv_id, turn, text) + 100 AS id, CAST(conv_id AS VARCHAR) AS source_url, CAST(turn AS INTEGER) AS chunk_no, 'pending' AS status, created_at = updated_at AS fresh FROM (SELECT *, 1 AS created_at, 1 AS updated_at FROM conversations)")
def queue_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as new queue rows, numbered on from the queue's last id."""
    t = table(spark, sf_dir, "conversations")
    chunks = t.select(F.lpad(F.col("conv_id").cast("string"), 12, "0").alias("source_url"), F.col("role").alias("title"), F.lit("").alias("subtitle1"), F.col("turn").alias("chunk_no"), F.col("text").alias("chunk"))
    return queue.enqueue(chunks, after=100).select("id", F.regexp_replace("source_url", "^0+(?=.)", "").alias("source_url"), "chunk_no", "status", (F.col("created_at") == F.col("updated_at")).alias("fresh"))


@CATALOG.add(
    "worker_marks",
    "SELECT conv_id * 1000 + turn AS id, CASE WHEN turn % 4 = 3 THEN 'done' WHEN role = 'user' THEN 'error' ELSE 'done' END AS status, CASE WHEN turn % 4 <> 3 AND role = 'user' THEN 'no vector for user' END AS error, turn % 4 <> 3 AND role <> 'user' AS embedded FROM conversations",
)
def worker_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A worker's batch: rows whose backend fails end as errors with its message, the others as done with a vector."""
    t = table(spark, sf_dir, "conversations")
    status = F.when(F.col("turn") % 4 == 3, queue.DONE).otherwise(queue.PENDING)
    rows = t.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("u").alias("source_url"), F.lit("t").alias("title"), F.lit("").alias("subtitle1"), F.col("turn").cast("int").alias("chunk_no"), F.col("role").alias("chunk"), status.alias("status"), F.lit(None).cast("string").alias("error"), F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"))
    store = VectorStore(spark, sources.scratch_path(spark, "worker"))
    store.upsert(rows, 0, no_users, vectors.EmbedConfig(dim=4, batch=1, attempts=1))
    found = store.read().select(F.col("queue_id").alias("id"), F.lit(True).alias("embedded"))
    return store.marked(rows).join(found, "id", "left").select("id", "status", "error", F.coalesce("embedded", F.lit(False)).alias("embedded"))


def no_users() -> vectors.Backend:
    """A backend that fails on one text, to be marked as an error."""
    embed = vectors.stub_backend(4)

    def checked(texts: list[str]) -> list[list[float]]:
        if "user" in texts:
            raise ValueError("no vector for user")
        return embed(texts)

    return checked


@CATALOG.add("claims_of_two_workers", f"WITH {QUEUE_SQL}, r AS (SELECT id, id % 2 AS worker, row_number() OVER (PARTITION BY id % 2 ORDER BY id) AS k FROM q WHERE status = 'pending') SELECT id, CAST(worker AS INTEGER) AS worker FROM r WHERE k <= 64")
def claims_of_two_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of 64 rows for each of two workers, from their shares of the ids."""
    q = _queue(spark, sf_dir)
    each = [queue.claimable(q, 64, k, 2).select("id", F.lit(k).alias("worker")) for k in range(2)]
    return each[0].unionByName(each[1])


@CATALOG.add(
    "jsonl_round_trip",
    "SELECT doc_id, source AS title, lang AS subtitle, n_chars FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(source, '') AS source, lang, CAST(n_chars AS INTEGER) AS n_chars FROM documents) WHERE doc_id NOT LIKE '%7'",
)
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a title, written as JSON lines, read back by their schema, and joined to what they came from."""
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").cast("string").alias("doc_id"), F.when(~F.col("doc_id").cast("string").endswith("7"), F.col("source")).alias("title"), F.col("lang").alias("subtitle"), F.concat(F.lit("u"), "doc_id").alias("source_url"))
    path = sources.scratch_path(spark, "jsonl")
    sources.write_jsonl(sources.savable(rows), path)
    back = sources.read_jsonl(spark, path, sources.DOCUMENT)
    return back.join(d.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("n_chars").cast("int").alias("n_chars")), "doc_id").select("doc_id", "title", "subtitle", "n_chars")


@CATALOG.add("csv_round_trip", """SELECT CAST(event_id AS VARCHAR) AS id, event_type AS "metadata.chapter", props AS text FROM events""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records as CSV with a byte-order mark and quoted JSON in a field, and back."""
    path = sources.scratch_path(spark, "csv")
    nested = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), F.struct(F.col("event_type").alias("chapter")).alias("metadata"), F.col("props").alias("text"))
    sources.write_csv(nested, path)
    return sources.read_csv(spark, path)


@CATALOG.add("quarantined_rows", "SELECT CASE WHEN o_totalprice < 50000 THEN 'bad' ELSE 'good' END AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.scratch_path(spark, "quarantine")
    good = sources.quarantine(table(spark, sf_dir, "orders"), F.col("o_totalprice") < 50000, path)
    both = good.select(F.lit("good").alias("part"), "o_orderkey").unionByName(spark.read.parquet(path).select(F.lit("bad").alias("part"), "o_orderkey"))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@CATALOG.add("run_log_records", "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CASE WHEN value < 10 THEN 'ERROR' ELSE 'INFO' END AS level, event_type || ' ' || event_id AS message FROM events")
def run_log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a run log, read as records; stack traces between them are left out."""
    level = F.when(F.col("value") < 10, "ERROR").otherwise("INFO")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" - "), level, F.lit(" - "), "event_type", F.lit(" "), F.col("event_id").cast("string"))
    lines = table(spark, sf_dir, "events").select(F.explode(F.array(line, F.lit("  File \"x.py\", line 3"))).alias("value"))
    return sources.log_records(lines).select(F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), "level", "message")


@CATALOG.add("run_metric_totals", "SELECT 'run ' || (page_id % 3) AS run, 'pages' AS metric, count(*) AS value FROM pages GROUP BY 1")
def run_metric_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.scratch_path(spark, "metrics")
    for r in table(spark, sf_dir, "pages").groupBy((F.col("page_id") % 3).alias("k")).agg(F.count("*").alias("n")).collect():  # three rows
        sources.run_metrics(spark, path, f"run {r['k']}", {"pages": r["n"]})
    return spark.read.parquet(path).select("run", "metric", "value")


@CATALOG.add("table_schemas", "SELECT t AS table_name, c AS column_name FROM (VALUES ('laws', 'id,lsi_seq,source_url,title_line,department,content_hash,fetched_at'), ('law_articles', 'id,law_id,art_no,heading,body,content_hash'), ('article_chunks', 'id,article_id,chunk_no,text,content_hash'), ('embeddings', 'queue_id,chunk_no,vector,created_at,updated_at'), ('embedding_queue', 'id,source_url,title,subtitle1,chunk_no,chunk,error,created_at,updated_at,status')) v(t, cs), unnest(string_split(cs, ',')) u(c)")
def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of the model, created where they are not there yet, twice, and their columns."""
    name = f"model_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{sources.shared_dir(spark)}/{name}'")
    sources.ensure_tables(spark, name)
    rows = [(t.split(".")[1], c.name) for t in sources.ensure_tables(spark, name) for c in spark.catalog.listColumns(t)]
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.createDataFrame(rows, "table_name string, column_name string")


@CATALOG.add("l2_normalize", "SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))), 6)) AS unit FROM embeddings")
def l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform(vectors.unit(F.transform("embedding", lambda x: x.cast("double"))), lambda x: F.round(x, 6)).alias("unit"))


@CATALOG.add("vector_dim_check", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings")
def vector_dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.size(vectors.checked(F.col("embedding"), vectors.probed_dim(lambda: vectors.stub_backend(64), 64))).alias("dim"))


@CATALOG.add("vector_literal", "SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: printf('%.8f', CAST(x AS DOUBLE))), ',') || ']' AS literal FROM embeddings")
def vector_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", vectors.literal(F.transform("embedding", lambda x: x.cast("double"))).alias("literal"))


@CATALOG.add(
    "cosine_topk",
    """
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), q AS (SELECT * FROM n WHERE vec_id % 20 = 0),
s AS (SELECT q.vec_id AS query_id, n.vec_id AS id, list_cosine_similarity(q.v, n.v) AS score FROM q, n), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score FROM r WHERE rank <= 5
""",
)
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five most similar vectors for every vector whose id is divisible by 20."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    found = vectors.top_similar(e.where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("q")), e, 5)
    return found.withColumn("score", F.round("score", 6))


@CATALOG.add("stub_embed")
def stub_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stub vectors of all conversation turns as queue rows; tested against the standard library's generator."""
    t = table(spark, sf_dir, "conversations")
    rows = t.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("turn").cast("int").alias("chunk_no"), F.col("text").alias("chunk"), F.lit(queue.PENDING).alias("status"))
    config = vectors.EmbedConfig(dim=16)
    return embed_rows(rows, lambda: vectors.stub_backend(16), config)


@CATALOG.add(
    "subtitle_facts",
    r"""
WITH s AS (SELECT o_orderkey, '[시행 ' || year(o_orderdate) || '. ' || month(o_orderdate) || '. ' || day(o_orderdate) || '.] [대통령령 제' || o_orderkey || '호, ' || o_orderpriority || ', 타법개정]' AS s FROM orders)
SELECT o_orderkey, CAST(regexp_extract(s, '시행 ([0-9]+)', 1) AS INTEGER) AS year, CAST(regexp_extract(s, '제([0-9]+)호', 1) AS BIGINT) AS number, regexp_extract(s, ', ([^,\]]+)\]', 1) AS kind FROM s
""",
)
def subtitle_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date, number and kind of an amendment, read from a subtitle."""
    d = F.col("o_orderdate")
    s = F.concat(F.lit("[시행 "), F.year(d).cast("string"), F.lit(". "), F.month(d).cast("string"), F.lit(". "), F.dayofmonth(d).cast("string"), F.lit(".] [대통령령 제"), F.col("o_orderkey").cast("string"), F.lit("호, "), "o_orderpriority", F.lit(", 타법개정]"))
    pick = lambda p: F.regexp_extract("s", p, 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", pick("시행 ([0-9]+)").cast("int").alias("year"), pick("제([0-9]+)호").cast("long").alias("number"), pick(r", ([^,\]]+)\]").alias("kind"))

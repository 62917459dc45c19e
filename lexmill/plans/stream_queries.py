"""Queries of event time, leases, rate caps and crawls: streams over the given tables, held against SQL over the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import sources
from lexmill.catalog import Catalog, table
from lexmill.operators import crawl, html, pacing
from lexmill.streaming import leases, windows

CATALOG = Catalog()


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(table(spark, sf_dir, "events"))


def _stamped(events: DataFrame) -> DataFrame:
    """Event times are stored without a zone; the session's stands for it."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files."""
    return _stamped(sources.parquet_stream(spark, f"{sf_dir}/events.parquet", table(spark, sf_dir, "events").schema))


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


WATERMARK = "(SELECT max(ts) FROM events)"


@CATALOG.add(
    "event_windows",
    f"SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS \"end\", count(*) AS n, max(value) AS most FROM events GROUP BY 1, 2, 3 HAVING \"end\" <= {WATERMARK}",
)
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that a stream of events has closed, by type."""
    found, _ = windows.finished(windows.tumbling(_stream(spark, sf_dir), "ts", "1 hour", ["event_type"], {"n": F.count("*"), "most": F.max("value")}), "windows")
    return _plain(found, "start", "end")


@CATALOG.add(
    "event_sliding",
    f"""
WITH e AS (SELECT event_type, ts, unnest([0, 1, 2, 3]) AS k FROM events),
w AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS start FROM e)
SELECT event_type, start, start + INTERVAL 2 HOUR AS "end", count(*) AS n FROM w GROUP BY 1, 2 HAVING start + INTERVAL 2 HOUR <= {WATERMARK}
""",
)
def event_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of two hours that begin every half hour, of a stream."""
    found, _ = windows.finished(windows.sliding(_stream(spark, sf_dir), "ts", "2 hours", "30 minutes", ["event_type"], {"n": F.count("*")}), "sliding")
    return _plain(found, "start", "end")


@CATALOG.add(
    "event_sessions",
    f"""
WITH e AS (SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL 8 HOUR, true) AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 8 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 8 HOUR <= {WATERMARK}
""",
)
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users with pauses under eight hours, of a stream, those that are over."""
    found, _ = windows.finished(windows.sessions(_stream(spark, sf_dir), "ts", "8 hours", ["user_id"], {"n": F.count("*")}), "sessions")
    return _plain(found, "start", "end")


@CATALOG.add(
    "event_marks_join",
    """
SELECT a.event_id AS id, b.event_id AS mark_id, a.user_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 3 HOUR
WHERE a.event_type = 'click' AND b.event_type = 'purchase'
""",
)
def event_marks_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-stream join: clicks as queue rows, purchases of the same user within three hours as their marks."""
    rows = _stream(spark, sf_dir).where("event_type = 'click'").select("user_id", F.col("event_id").alias("id"), F.col("ts").alias("asked_at"))
    marks = _stream(spark, sf_dir).where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("mark_id"), F.col("ts").alias("marked_at"))
    found, _ = windows.finished(windows.matched(rows, marks, "user_id", "asked_at", "marked_at", "3 hours"), "marks")
    return found.select("id", "mark_id", "user_id")


LEASE = 86_400_000_000
END = 1_706_745_600_000_000
KINDS = {"click": leases.CLAIM, "signup": leases.CLAIM, "view": leases.BEAT, "error": leases.FAIL}


def _requests(events: DataFrame) -> DataFrame:
    """Events as requests for the row of their user: most claim or keep it, errors give it back, few purchases end it."""
    kind: Column = F.when(F.col("value") < 8, leases.DONE).otherwise(leases.CLAIM)
    for name, of in KINDS.items():
        kind = F.when(F.col("event_type") == name, of).otherwise(kind)
    worker = F.concat(F.lit("w"), (F.col("event_id") % 2).cast("string"))
    return events.select(F.col("user_id").alias("id"), F.unix_micros("ts").alias("at"), F.col("event_id").alias("request_id"), worker.alias("worker"), kind.alias("kind"))


LEASE_SQL = f"""
WITH RECURSIVE r AS (
  SELECT user_id AS id, epoch_us(ts) AS "at", event_id AS request_id, 'w' || (event_id % 2) AS worker, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k,
    CASE WHEN event_type IN ('click', 'signup') THEN 'claim' WHEN event_type = 'view' THEN 'beat' WHEN event_type = 'error' THEN 'fail' WHEN value < 8 THEN 'done' ELSE 'claim' END AS kind
  FROM events
), s AS (
  SELECT id, 0::BIGINT AS k, NULL::VARCHAR AS holder, 0::BIGINT AS until, false AS done, NULL::VARCHAR AS outcome, NULL::VARCHAR AS lost, NULL::BIGINT AS lost_at FROM (SELECT DISTINCT id FROM r)
  UNION ALL
  SELECT id, k, CASE WHEN outcome = 'granted' THEN worker WHEN outcome IN ('marked', 'freed') THEN NULL ELSE h END, CASE WHEN outcome IN ('granted', 'kept') THEN "at" + {LEASE} ELSE until END,
    done OR outcome = 'marked', outcome, CASE WHEN ran THEN holder END, CASE WHEN ran THEN until END
  FROM (
    SELECT *, CASE WHEN done THEN 'over' WHEN kind = 'claim' THEN CASE WHEN h IS NULL THEN 'granted' ELSE 'busy' END WHEN h IS DISTINCT FROM worker THEN 'lost' WHEN kind = 'beat' THEN 'kept' WHEN kind = 'done' THEN 'marked' ELSE 'freed' END AS outcome
    FROM (SELECT r.id, r.k, r."at", r.worker, r.kind, s.holder, s.until, s.done, coalesce(s.holder IS NOT NULL AND r."at" >= s.until, false) AS ran, CASE WHEN r."at" >= s.until THEN NULL ELSE s.holder END AS h FROM s JOIN r ON r.id = s.id AND r.k = s.k + 1)
  )
), told AS (
  SELECT r.id, r."at", r.request_id, r.worker, r.kind, s.outcome FROM s JOIN r USING (id, k)
  UNION ALL SELECT id, lost_at, NULL, lost, NULL, 'expired' FROM s WHERE lost IS NOT NULL
  UNION ALL SELECT id, until, NULL, holder, NULL, 'expired' FROM s SEMI JOIN (SELECT id, max(k) AS k FROM s GROUP BY id) z USING (id, k) WHERE holder IS NOT NULL AND until <= {END}
)
"""


@CATALOG.add("lease_outcomes", LEASE_SQL + "SELECT id, \"at\", request_id, worker, kind, outcome FROM told")
def lease_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims, beats, marks and leases that ran out, from a log of what workers asked for."""
    return leases.lease_log(_requests(_events(spark, sf_dir)), LEASE, END)


@CATALOG.add(
    "lease_statuses",
    LEASE_SQL
    + """SELECT id, CASE outcome WHEN 'marked' THEN 'done' WHEN 'granted' THEN 'working' ELSE 'pending' END AS status, CASE WHEN outcome IN ('marked', 'granted') THEN worker END AS worker
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "at" DESC, coalesce(request_id, -1) DESC) AS r FROM told WHERE outcome IN ('granted', 'marked', 'freed', 'expired')) WHERE r = 1""",
)
def lease_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue as its leases leave it."""
    return leases.statuses(leases.lease_log(_requests(_events(spark, sf_dir)), LEASE, END))


@CATALOG.add("lease_stream", LEASE_SQL + f"SELECT id, \"at\", request_id, worker, kind, outcome FROM told WHERE outcome <> 'expired' OR \"at\" < (SELECT max(epoch_us(ts)) // 1000 * 1000 FROM events)")
def lease_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of requests in keyed state, whose timers give back what ran out before the watermark."""
    found, _ = windows.finished(leases.leased(_requests(_stream(spark, sf_dir)), LEASE), "leases")
    return found


@CATALOG.add(
    "paced_requests",
    """
WITH RECURSIVE r AS (SELECT event_id, event_type, epoch_us(ts) // 1000000 AS arrival, row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 1000000, event_id) AS k FROM events),
s AS (
  SELECT event_type, k, event_id, arrival AS slot, arrival FROM r WHERE k = 1
  UNION ALL SELECT r.event_type, r.k, r.event_id, greatest(r.arrival, s.slot + 1300), r.arrival FROM s JOIN r ON r.event_type = s.event_type AND r.k = s.k + 1
)
SELECT event_id, k - 1 AS place, greatest(arrival, slot - 2600) AS start FROM s
""",
)
def paced_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When requests start if each domain (here a type of event) has one in 1,300 seconds, after a burst of three."""
    asked = _events(spark, sf_dir).select("event_id", "event_type", F.floor(F.unix_micros("ts") / 1_000_000).alias("arrival"))
    return pacing.schedule(asked, "event_type", "arrival", "event_id", 1300, burst=3).select("event_id", "place", "start")


CRAWL_SQL = r"""
WITH RECURSIVE a AS (SELECT url, regexp_extract(url, '//([^/]+)', 1) AS host, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages),
links AS (SELECT url AS source, unnest(hrefs) AS target FROM a UNION SELECT hrefs[1], url FROM a),
found AS (
  SELECT url, 0 AS depth FROM a WHERE host = (SELECT min(host) FROM a)
  UNION SELECT l.target, f.depth + 1 FROM found f JOIN links l ON l.source = f.url AND l.source <> l.target WHERE f.depth < 5
)
SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM found WHERE url IS NOT NULL GROUP BY url
"""


@CATALOG.add("crawl_frontier", CRAWL_SQL)
def crawl_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one host, the lists they link to, the pages those list, and so on for five rounds: a list is the address that a page
    names first."""
    pages = table(spark, sf_dir, "pages")
    anchors = html.links(pages, ["url"], "html").where("href IS NOT NULL")
    lists = anchors.groupBy("url").agg(F.min_by("href", "ord").alias("source")).select("source", F.col("url").alias("target"))
    links = anchors.select(F.col("url").alias("source"), F.col("href").alias("target")).unionByName(lists)
    host = F.regexp_extract("url", "//([^/]+)", 1)
    first = pages.agg(F.min(host).alias("host"))  # one row
    seeds = pages.join(F.broadcast(first), host == F.col("host")).select("url")
    return crawl.crawl(sources.scratch(links, "links"), seeds, crawl.Seen(spark, sources.scratch_path(spark, "seen")), most_depth=5)

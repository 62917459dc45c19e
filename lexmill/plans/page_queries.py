"""Queries over ``pages`` and synthesised list links: URLs, links, page text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.catalog import Catalog, table
from lexmill.functions import text, urls
from lexmill.operators import html

CATALOG = Catalog()
BASE = "https://portal.example/doc"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


@CATALOG.add("url_query_params", r"SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') AS utm_source, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS ref FROM pages")
def url_query_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", *(urls.query_value(F.col("url"), k).alias(k) for k in ("utm_source", "page", "ref")))


@CATALOG.add("url_document_id", r"SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), ''), nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), ''), regexp_replace(url, '[^a-zA-Z0-9]', '', 'g')) AS doc_id FROM pages")
def url_document_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", urls.document_id(F.col("url"), F.col("url"), ("ref", "page")).alias("doc_id"))


@CATALOG.add("url_strip_fragment", "SELECT page_id, split_part(url, '#', 1) AS url FROM pages")
def url_strip_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", urls.without_fragment(F.col("url")).alias("url"))


@CATALOG.add(
    "url_join",
    r"""
WITH b AS (SELECT page_id, url, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) AS root, regexp_extract(url, '^([^?#]*)', 1) AS page FROM pages)
SELECT page_id, k, CASE k WHEN 'root' THEN root || '/x/y' WHEN 'query' THEN page || '?q=1' WHEN 'full' THEN 'https://other.example/z'
  WHEN 'relative' THEN (CASE WHEN length(page) > length(root) THEN regexp_replace(page, '[^/]*$', '') ELSE root || '/' END) || 'z.html' END AS url
FROM b, (VALUES ('root'), ('query'), ('full'), ('relative')) t(k)
""",
)
def url_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = {"root": "/x/y", "query": "?q=1", "full": "https://other.example/z", "relative": "z.html"}
    rows = F.array(*(F.struct(F.lit(k).alias("k"), urls.absolute(F.lit(v), F.col("url")).alias("url")) for k, v in forms.items()))
    return _pages(spark, sf_dir).select("page_id", F.inline(rows))


@CATALOG.add(
    "detail_url_build",
    """
SELECT o_orderkey, CASE WHEN o_orderkey + 100000 IS NOT NULL THEN 'https://portal.example/doc/lsInfoP.do?lsiSeq=' || (o_orderkey + 100000) || '&efYd=' || strftime(o_orderdate, '%Y%m%d') END AS statute,
  CASE WHEN o_orderkey % 2 = 0 THEN 'https://portal.example/doc/admRulInfoP.do?admRulSeq=' || (o_orderkey + 100000) END AS rule
FROM orders
""",
)
def detail_url_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages of list links, built from orders: a date, an id and empty arguments in a script call."""
    seq, date = (F.col("o_orderkey") + 100000).cast("string"), F.date_format("o_orderdate", "yyyyMMdd")
    statute = F.concat(F.lit("lsReturnSearch('x','"), date, F.lit("','"), seq, F.lit("','');return false;"))
    rule = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("admRulReturnSearch('','"), seq, F.lit("')"))).otherwise(F.lit("admRulReturnSearch('12')"))
    return table(spark, sf_dir, "orders").select("o_orderkey", urls.detail_url(statute, urls.STATUTE, BASE).alias("statute"), urls.detail_url(rule, urls.RULE, BASE).alias("rule"))


@CATALOG.add("safe_name", r"""SELECT p_partkey, trim(regexp_replace(' ' || p_name || '?:' || p_brand || '/<' || p_type || '>| ', '[\\/*?:"<>|]', '', 'g')) AS name FROM part""")
def safe_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" "), "p_name", F.lit("?:"), "p_brand", F.lit("/<"), "p_type", F.lit(">| "))
    return table(spark, sf_dir, "part").select("p_partkey", urls.safe_name(raw).alias("name"))


@CATALOG.add(
    "page_range_explode",
    """
WITH c AS (SELECT o_orderkey, CAST(o_orderkey % 2 + 1 AS INTEGER) AS cur, CAST(o_orderkey % 6 AS INTEGER) AS last FROM orders)
SELECT o_orderkey, CAST(unnest(range(2, least(last, 4) + 1)) AS INTEGER) AS page FROM c WHERE cur = 1
""",
)
def page_range_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    counter = urls.page_counter(F.concat(F.lit("total ("), (F.col("o_orderkey") % 2 + 1).cast("string"), F.lit(" / "), (F.col("o_orderkey") % 6).cast("string"), F.lit(")")))
    return table(spark, sf_dir, "orders").withColumn("c", counter).select("o_orderkey", F.explode(urls.following_pages(F.col("c.current"), F.col("c.last"), 4)).alias("page"))


@CATALOG.add("request_filter", "SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('image', 'font', 'media') AND NOT regexp_matches(props, '\"k\": 8')")
def request_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that are worth fetching: wanted types, unwanted hosts left out."""
    return table(spark, sf_dir, "events").where(urls.is_wanted(F.col("event_type"), F.col("props"), ('"k": 8',))).select("event_id", "event_type", "value")


HTML_SQL = r"""
SELECT page_id, trim(regexp_replace({e}, '[ \t\n\r\f\v]+', ' ', 'g')) AS text FROM pages
""".replace(
    "{e}",
    "replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?i)<br[ ]*/?>', chr(10), 'g'), '(?i)</p[ ]*>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')",
)


@CATALOG.add("html_to_text", HTML_SQL)
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", text.html_to_text(F.col("html")).alias("text"))


@CATALOG.add("html_title_header", r"SELECT page_id, replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '&amp;', '&') AS title, replace(trim(regexp_extract(html, '<h1[^>]*>([^<]*)', 1)), '&amp;', '&') AS heading FROM pages")
def html_title_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and first heading from the parsed page; the SQL reads them by pattern."""
    nodes = F.col("nodes")
    parsed = _pages(spark, sf_dir).select("page_id", html.parse(F.col("html"), "text").alias("nodes"))
    own = lambda tag: F.coalesce(html.own_text(html.first(nodes, html.is_tag(tag)), ""), F.lit(""))
    return parsed.select("page_id", own("title").alias("title"), own("h1").alias("heading"))


LINKS_SQL = r"""
WITH p AS (SELECT page_id, url, string_split(html, '<a ') AS parts FROM pages), a AS (SELECT page_id, url, parts, unnest(range(2, len(parts) + 1)) AS i FROM p),
l AS (SELECT *, regexp_extract(parts[i], 'href="([^"]*)"', 1) AS href, replace(regexp_extract(parts[i], '^[^>]*>([^<]*)</a>', 1), '&amp;', '&') AS text FROM a)
SELECT page_id, url, CAST(list_sum(list_transform(parts[1:i - 1], lambda x: len(regexp_extract_all(x, '<[a-z]')))) + i - 2 AS INTEGER) AS ord, trim(text) AS text, href, CAST(NULL AS VARCHAR) AS onclick,
  regexp_extract(url, '^[a-z]+://[^/]+') || href AS target
FROM l
"""


@CATALOG.add("html_links", LINKS_SQL)
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.links(_pages(spark, sf_dir), ["page_id", "url"], "html").withColumn("target", urls.absolute(F.coalesce("href", F.lit("")), F.col("url")))


@CATALOG.add("html_block_rows")
def html_block_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each block, nested ones too, in document order."""
    parsed = _pages(spark, sf_dir).select("page_id", html.parse(F.col("html"), "text").alias("nodes"))
    blocks = html.select(F.col("nodes"), html.is_tag("p", "div", "li", "table", "blockquote"))
    return parsed.select("page_id", F.explode(blocks).alias("n")).select("page_id", "n.ord", "n.tag", "n.depth", text.clean_block(F.col("n.text")).alias("text")).where("text <> ''")


@CATALOG.add("page_classify", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'STRUCTURED' WHEN page_id % 3 = 1 THEN 'PDF' ELSE 'UNSTRUCTURED' END AS kind FROM pages")
def page_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages wrapped in one of three forms, and told apart again by their nodes."""
    k = F.col("page_id") % 3
    head = F.when(k == 0, F.lit('<div class="pgroup x"><span class="bl"><label>제1조(목적)</label></span></div>')).when(k == 1, F.lit('<iframe class="fancybox-iframe"></iframe>')).otherwise(F.lit('<div class="pgroup"><label>제1조</label></div>'))
    parsed = _pages(spark, sf_dir).select("page_id", html.parse(F.concat(head, F.col("html")), "text").alias("nodes"))
    return parsed.select("page_id", html.page_kind(F.col("nodes")).alias("kind"))


@CATALOG.add(
    "page_ready",
    HTML_SQL.replace("SELECT page_id, trim(", "WITH t AS (SELECT page_id, html, trim(").replace("FROM pages", "FROM pages) SELECT page_id, length(text) AS n_chars, length(trim(regexp_extract(html, '<title>([^<]*)', 1))) >= 2 AND length(text) >= 120 AS ready FROM t"),
)
def page_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a page holds a title and enough text to be parsed."""
    told = _pages(spark, sf_dir).select("page_id", F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"), text.html_to_text(F.col("html")).alias("body"))
    return told.select("page_id", F.length("body").cast("long").alias("n_chars"), text.is_ready(F.col("title"), F.col("body")).alias("ready"))


@CATALOG.add(
    "list_frontier",
    """
WITH l AS (SELECT trim(p_name) AS name, 'https://portal.example/doc/lsInfoP.do?lsiSeq=' || (p_partkey + 10000) || '&efYd=20240101' AS url, p_partkey AS list_pos FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY list_pos DESC) AS rn FROM l)
SELECT name, url FROM r WHERE rn = 1
""",
)
def list_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages to a frontier: links parsed from HTML, names made safe, the last link of a name kept."""
    from lexmill.operators.queue import last_write_wins

    anchor = F.concat(F.lit("<li><a onclick=\"lsReturnSearch('','20240101','"), (F.col("p_partkey") + 10000).cast("string"), F.lit("')\">"), "p_name", F.lit("</a></li>"))
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_no"), F.concat(F.lit("<ul>"), anchor, F.lit("</ul>")).alias("html"))
    return last_write_wins(html.list_entries(pages, urls.STATUTE, BASE), ["name"], "list_pos").select("name", "url")

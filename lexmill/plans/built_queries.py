"""Queries over pages built from columns, so that SQL can state what the parsers must find in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.catalog import Catalog, table
from lexmill.functions import urls
from lexmill.operators import html, segment
from lexmill.plans import pipelines

CATALOG = Catalog()
BASE = "https://portal.example/doc"


def filled(template: str, **values: Column) -> Column:
    """``template`` with ``{name}`` replaced by columns."""
    parts: list[Column] = []
    for i, piece in enumerate(template.replace("{", "\0").replace("}", "\0").split("\0")):
        parts.append(values[piece].cast("string") if i % 2 else F.lit(piece))
    return F.concat(*parts)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _values() -> dict[str, Column]:
    return {"id": F.col("doc_id") + 10_000, "source": F.col("source"), "lang": F.col("lang"), "n": F.col("doc_id") % 90 + 1}


CASE = (
    '<h2 data-brl-use="PH/H1"> {source}  {id} <i>x</i></h2><div class="subtit1">[{lang} <b>{n}</b>]</div><div><h4 data-brl-use="PH/H2">【판시사항】</h4><p>one {source}.</p><p>two {lang}</p><span>no</span>'
    '<h4 data-brl-use="PH/H2">【참조조문】</h4><ul><li>{lang}</li></ul><h4 data-brl-use="PH/H2">【전문】</h4><h5>【주문】</h5><p>main {n}</p><h5>【이유】</h5><p>why</p><p>{source}</p></div>'
)


@CATALOG.add(
    "case_pages",
    """
SELECT 'http://h/' || (doc_id + 10000) AS source_url, source || ' ' || (doc_id + 10000) AS title, '[' || lang || ' ' || (doc_id % 90 + 1) || ' ]' AS subtitle1, 'one ' || source || '.' || chr(10) || chr(10) || 'two ' || lang AS holding, '' AS summary, lang AS provisions,
  'main ' || (doc_id % 90 + 1) AS main, 'why' || chr(10) || chr(10) || source AS reasons FROM documents
""",
)
def case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases whose sections are headed by marked headings."""
    pages = _documents(spark, sf_dir).select(filled("http://h/{id}", **_values()).alias("url"), filled(CASE, **_values()).alias("html"))
    s = F.col("sections")
    return html.cases(pages).select("source_url", "title", "subtitle1", s["판시사항"].alias("holding"), s["판결요지"].alias("summary"), s["참조조문"].alias("provisions"), s["전문"]["주문"].alias("main"), s["전문"]["이유"].alias("reasons"))


@CATALOG.add(
    "case_chunks",
    """
SELECT 'http://h/' || (doc_id + 10000) AS source_url, CAST(1 AS INTEGER) AS chunk_no, row_number() OVER (ORDER BY 'http://h/' || (doc_id + 10000)) AS id,
  source || ' ' || (doc_id + 10000) || ' ([' || lang || ' ' || (doc_id % 90 + 1) || ' ]) [판시사항] one ' || source || '. two ' || lang || ' [참조조문] ' || lang || ' [전문] [주문] main ' || (doc_id % 90 + 1) || ' [이유] why ' || source AS chunk FROM documents
""",
)
def case_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case pages to queue rows: one line each, chunked and numbered."""
    pages = _documents(spark, sf_dir).select(filled("http://h/{id}", **_values()).alias("url"), filled(CASE, **_values()).alias("html"))
    return pipelines.case_queue(pages).select("source_url", "chunk_no", "id", "chunk")


DETAIL = {
    0: '<div id="conTop"><h1>{source}</h1><h2>other</h2></div><p class="subTit1">[{lang}]</p><dl><dt>판시사항<dd>held {n}<dt>판결요지<dd>sum</dl><table><tr><th>참조조문 등<td>law {id}</table><h4>전문</h4><div>주문 a 이유 b {source}</div>',
    1: '<div id="conTop"><h2>{source}</h2></div><div data-subtitle1="1">so[{lang}</div><div class="tit">판시사항 x</div><div>held {n}</div><p aria-label="판결요지">sum</p><h5>주문</h5><p>main {id}</p><h5>이유</h5><p>why</p>',
}


@CATALOG.add(
    "case_detail",
    """
SELECT doc_id % 2 = 0 AS labelled, source AS title, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'so[' || lang END AS subtitle1, 'held ' || (doc_id % 90 + 1) AS holding, 'sum' AS summary,
  CASE WHEN doc_id % 2 = 0 THEN 'law ' || (doc_id + 10000) ELSE '' END AS provisions, CASE WHEN doc_id % 2 = 0 THEN '주문 a 이유 b ' || source ELSE 'main ' || (doc_id + 10000) END AS main, CASE WHEN doc_id % 2 = 0 THEN '주문 a 이유 b ' || source ELSE 'why' END AS reasons
FROM documents
""",
)
def case_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases of other layouts, read by labels: definition lists, tables, titles and named blocks, with implied ends."""
    even = F.col("doc_id") % 2 == 0
    pages = _documents(spark, sf_dir).select(F.when(even, "even").otherwise("odd").alias("url"), F.when(even, filled(DETAIL[0], **_values())).otherwise(filled(DETAIL[1], **_values())).alias("html"))
    s = F.col("sections")
    found = html.case_details(pages)
    return found.select((F.col("source_url") == "even").alias("labelled"), "title", "subtitle1", s["판시사항"].alias("holding"), s["판결요지"].alias("summary"), s["참조조문"].alias("provisions"), s["전문"]["주문"].alias("main"), s["전문"]["이유"].alias("reasons"))


STATUTE = (
    '<div id="conTop"><h2> {source} </h2></div><div class="ct_sub">[{lang}]</div><div id="conScroll"><div class="pgroup"><p class="gtit">제{n}장 총칙</p></div>'
    '<div class="pgroup"><span class="bl"><label>제1조(목적)</label></span><p> a <a href="#">{lang}</a>b<br>c</p></div><div class="pgroup"><span class="bl"><label>제{n}조의2(뜻)</label></span><p>{id}</p></div><div class="pgroup"><p>none</p></div></div>'
)


def _statutes(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    return _documents(spark, sf_dir).select(filled("https://h/x?lsiSeq={id}&efYd=20240101#top", **_values()).alias("url"), filled(template, **_values()).alias("html"))


@CATALOG.add(
    "statute_articles",
    """
WITH d AS (SELECT CAST(doc_id + 10000 AS VARCHAR) AS id, lang, doc_id % 90 + 1 AS n FROM documents)
SELECT 'doc:' || id || ':article_1' AS chunk_id, '제1조(목적)' AS title, '제1조(목적) a ' || lang || 'b' || chr(10) || 'c' AS text, '제' || n || '장 총칙' AS chapter FROM d
UNION ALL SELECT 'doc:' || id || ':article_' || n || '2', '제' || n || '조의2(뜻)', '제' || n || '조의2(뜻)' || id, '제' || n || '장 총칙' FROM d
""",
)
def statute_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of statute pages, with the chapter carried forward."""
    headers = html.document_header(_statutes(spark, sf_dir, STATUTE), urls.STATUTE)
    return html.statute_chunks(headers).select("chunk_id", "title", "text", F.col("metadata.chapter").alias("chapter"))


RULE = {
    0: '<div id="conTop"><h2>{source}</h2></div><div class="pgroup"><p class="gtit">part "{n}"</p><span class="bl"><label>제{n}조(범위)</label></span><div class="lawcon"><p>one {lang}</p><p>two</p></div></div>',
    1: '<div id="conTop"><h2>{source}</h2></div><div class="lawcon"><p>note {id}</p><p>Ⅰ. first</p><p>{lang}</p><p>b</p><p>Ⅱ. end</p></div>',
}


@CATALOG.add(
    "rule_articles",
    """
WITH d AS (SELECT doc_id, CAST(doc_id + 10000 AS VARCHAR) AS id, lang, source, doc_id % 90 + 1 AS n FROM documents)
SELECT 'doc:' || id || ':article_' || n AS chunk_id, '제' || n || '조(범위)' AS title, 'one ' || lang || chr(10) || 'two' AS text, 'part ' || n AS chapter FROM d WHERE doc_id % 2 = 0
UNION ALL SELECT 'doc:' || id || ':preamble', source, 'note ' || id, source FROM d WHERE doc_id % 2 = 1
UNION ALL SELECT 'doc:' || id || ':section_1', 'Ⅰ. first', lang || chr(10) || 'b', source FROM d WHERE doc_id % 2 = 1
""",
)
def rule_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of structured rule pages, and sections of the others, each page by its kind."""
    pages = _documents(spark, sf_dir).select(filled("https://h/x?admRulSeq={id}", **_values()).alias("url"), F.when(F.col("doc_id") % 2 == 0, filled(RULE[0], **_values())).otherwise(filled(RULE[1], **_values())).alias("html"))
    typed = html.document_header(pages, urls.RULE).withColumn("kind", html.page_kind(F.col("nodes")))
    both = html.rule_chunks(typed.where("kind = 'STRUCTURED'")).unionByName(html.section_chunks(typed.where("kind = 'UNSTRUCTURED'")))
    return both.select("chunk_id", "title", "text", F.col("metadata.chapter").alias("chapter"))


def grouped(template: str, mark: str, last: Column) -> Column:
    """``template`` for each number from 1 to ``last`` as ``{i}``, every seventh after ``mark`` with ``{c}``, side by side."""
    one = lambda i: F.concat(F.when(i % 7 == 1, filled(mark, c=(i / 7).cast("int") + 1, **_values())).otherwise(F.lit("")), filled(template, i=i, **_values()))
    return F.array_join(F.transform(F.sequence(F.lit(1), last), one), "")


LONG_SQL = """
WITH d AS (SELECT *, CAST(doc_id + 10000 AS VARCHAR) AS id, unnest(range(1, 21 + doc_id % 20)) AS i FROM documents)
SELECT 'doc:' || id || ':article_' || i AS chunk_id, '제' || i || '조(가)' AS title, {text} AS text, {chapter} AS chapter FROM d
"""


@CATALOG.add("long_statute_articles", LONG_SQL.format(text="'제' || i || '조(가)' || lang || ' ' || i", chapter="'제' || ((i - 1) // 7 + 1) || '장 ' || source"))
def long_statute_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statutes of 20 to 39 articles; a chapter begins at every seventh group, and groups without a label are between."""
    body = grouped('<div class="pgroup"><span class="bl"><label>제{i}조(가)</label></span><p>{lang} {i}</p></div><div class="pgroup"><p>none</p></div>', '<div class="pgroup"><p class="gtit">제{c}장 {source}</p></div>', 20 + F.col("doc_id") % 20)
    pages = _documents(spark, sf_dir).select(filled("https://h/x?lsiSeq={id}&efYd=20240101", **_values()).alias("url"), F.concat(filled('<div id="conTop"><h2>{source}</h2></div><div id="conScroll">', **_values()), body, F.lit("</div>")).alias("html"))
    return html.statute_chunks(html.document_header(pages, urls.STATUTE)).select("chunk_id", "title", "text", F.col("metadata.chapter").alias("chapter"))


@CATALOG.add("long_rule_articles", LONG_SQL.format(text="lang || chr(10) || i", chapter="'part ' || ((i - 1) // 7 + 1)"))
def long_rule_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of 20 to 39 articles, in parts of seven groups."""
    body = grouped('<div class="pgroup"><span class="bl"><label>제{i}조(가)</label></span><div class="lawcon"><p>{lang}</p><p>{i}</p></div></div>', '<div class="pgroup"><p class="gtit">part {c}</p></div>', 20 + F.col("doc_id") % 20)
    pages = _documents(spark, sf_dir).select(filled("https://h/x?admRulSeq={id}", **_values()).alias("url"), F.concat(filled('<div id="conTop"><h2>{source}</h2></div>', **_values()), body).alias("html"))
    return html.rule_chunks(html.document_header(pages, urls.RULE)).select("chunk_id", "title", "text", F.col("metadata.chapter").alias("chapter"))


LAW = (
    '<h2> {source} </h2><p class="ct_sub">고용노동부 [{lang}]</p><p>(약칭: s{n})</p><div id="contentBody"><p>연혁</p><p>제{n}장 총칙</p><p>제1조(목적)</p><p>① a {lang}.</p><p>② b</p><p>제2조</p><p>only {id}</p></div>'
)


@CATALOG.add(
    "statute_headers",
    """
SELECT 'law:' || (doc_id + 10000) || ':20240101' AS doc_id, source AS title, 's' || (doc_id % 90 + 1) AS short_title, '고용노동부' AS ministry, array_to_string(list_sort(list_distinct(['s' || (doc_id % 90 + 1), source])), ',') AS aliases,
  'https://h/x?lsiSeq=' || (doc_id + 10000) || '&efYd=20240101' AS source_url, '제' || (doc_id % 90 + 1) || '장 총칙' || chr(10) || '제1조(목적)' || chr(10) || '① a ' || lang || '.' || chr(10) || '② b' || chr(10) || '제2조' || chr(10) || 'only ' || (doc_id + 10000) AS body FROM documents
""",
)
def statute_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of each statute page: names, ministry, identifiers, and its text without noise."""
    found = html.statute_header(_statutes(spark, sf_dir, LAW))
    return found.select("doc_id", "title", "short_title", "ministry", F.array_join("aliases", ",").alias("aliases"), "source_url", "body")


@CATALOG.add(
    "statute_lines",
    """
WITH d AS (SELECT CAST(doc_id + 10000 AS VARCHAR) AS id, lang, source, doc_id % 90 + 1 AS n FROM documents)
SELECT 'law:' || id || ':20240101:ch0:art0:paraNA' AS id, '연혁' AS text, '서문' AS section_path, source AS law_title FROM d WHERE false
UNION ALL SELECT 'law:' || id || ':20240101:ch0:art0:para0', '연혁', '서문', source FROM d
UNION ALL SELECT 'law:' || id || ':20240101:ch' || n || ':art1:para1', 'a ' || lang || '.', '제' || n || '장 총칙 > 제1조(목적) > 1항', source FROM d
UNION ALL SELECT 'law:' || id || ':20240101:ch' || n || ':art1:para2', 'b', '제' || n || '장 총칙 > 제1조(목적) > 2항', source FROM d
UNION ALL SELECT 'law:' || id || ':20240101:ch' || n || ':art2:para0', 'only ' || id, '제' || n || '장 총칙 > 제2조', source FROM d
""",
)
def statute_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statute pages to flat lines, one for each paragraph of an article."""
    return pipelines.statute_lines(_statutes(spark, sf_dir, LAW), "d1").select("id", "text", "section_path", "law_title")


@CATALOG.add(
    "rich_statute_chunks",
    """
WITH d AS (SELECT CAST(doc_id + 10000 AS VARCHAR) AS id, lang, doc_id % 90 + 1 AS n FROM documents)
SELECT 'law:' || id || ':20240101:ch' || n || ':art1:para1:item0' AS logical_key, '제' || n || '장 총칙 > 제1조(목적) > 1항 — 이 법은 「' || lang || '」 제' || n || '조를 따른다.' AS display_text, lang || ' ' || n AS links FROM d
UNION ALL SELECT 'law:' || id || ':20240101:ch' || n || ':art1:para2:item1', '제' || n || '장 총칙 > 제1조(목적) > 2항 > 1호 — one ' || lang, '' FROM d
UNION ALL SELECT 'law:' || id || ':20240101:ch' || n || ':art1:para2:item2', '제' || n || '장 총칙 > 제1조(목적) > 2항 > 2호 — two', '' FROM d
UNION ALL SELECT 'law:' || id || ':20240101:ch' || n || ':art2:para0:item0', '제' || n || '장 총칙 > 제2조 — plain ' || id, '' FROM d
""",
)
def rich_statute_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statute bodies to chunks with their place: chapters, articles, paragraphs, items; and what they cite."""
    body = filled("연혁\n제{n}장 총칙\n제1조(목적)\n① 이 법은 「{lang}」 제{n}조를 따른다.\n② lead\n1. one {lang}\n2. two\n제2조\nplain {id}", **_values())
    rows = _documents(spark, sf_dir).select(filled("https://h/x?lsiSeq={id}&efYd=20240101", **_values()).alias("url"), F.col("source").alias("title"), body.alias("body"))
    cited = F.array_join(F.transform("links_out", lambda x: F.concat(x["law"], F.lit(" "), x["article"].cast("string"))), ",")
    return pipelines.rich_chunks(rows).select("logical_key", "display_text", cited.alias("links"))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = filled("제{n}장 총칙\n제1조(목적)\n① 이 법은 「{lang}」 제{n}조와 「{source}」 제3조를 따른다.\n② lead {id}\n제2조(뜻)\nplain {id}", **_values())
    return _documents(spark, sf_dir).select(filled("https://h/x?lsiSeq={id}&efYd=20240101", **_values()).alias("url"), F.col("source").alias("title"), body.alias("body"))


@CATALOG.add(
    "citation_graph",
    """
WITH d AS (SELECT 'law:' || (doc_id + 10000) || ':20240101:ch' || (doc_id % 90 + 1) || ':art1:para1:item0' AS key, lang, source, doc_id % 90 + 1 AS n FROM documents)
SELECT key AS logical_key, lang AS law, CAST(n AS INTEGER) AS article FROM d UNION ALL SELECT key, source, 3 FROM d
""",
)
def citation_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which articles of which statutes the chunks of statutes cite."""
    cited = pipelines.citations(pipelines.rich_chunks(_bodies(spark, sf_dir)))
    return cited.select(F.regexp_replace("chunk_id", ":[^:]*$", "").alias("logical_key"), "law", F.col("article").cast("int").alias("article"))


@CATALOG.add(
    "statute_model",
    """
WITH d AS (SELECT CAST(doc_id + 10000 AS VARCHAR) AS id, lang, source, doc_id % 90 + 1 AS n FROM documents),
c AS (SELECT id, 1 AS art, '목적' AS heading, '이 법은 「' || lang || '」 제' || n || '조와 「' || source || '」 제3조를 따른다.' AS text FROM d UNION ALL SELECT id, 1, '목적', 'lead ' || id FROM d UNION ALL SELECT id, 2, '뜻', 'plain ' || id FROM d)
SELECT id AS lsi_seq, CAST(NULL AS INTEGER) AS article_no, 'https://h/x?lsiSeq=' || id || '&efYd=20240101' AS told, count(*) AS n FROM c GROUP BY id
UNION ALL SELECT id, CAST(art AS INTEGER), any_value(heading) || ' ' || sha256(string_agg(text, chr(10) ORDER BY text)), count(*) FROM c GROUP BY id, art
""",
)
def statute_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statutes with the number of their chunks, and articles with heading, digest and number of theirs."""
    laws, articles, pieces = pipelines.normalised_model(pipelines.rich_chunks(_bodies(spark, sf_dir)))
    n = pieces.groupBy("lsiSeq", "article_no").agg(F.count("*").alias("n"))
    told = articles.join(n, ["lsiSeq", "article_no"]).select(F.col("lsiSeq").alias("lsi_seq"), F.col("article_no").cast("int").alias("article_no"), F.concat_ws(" ", "heading", "content_hash").alias("told"), "n")
    return laws.select(F.col("lsiSeq").alias("lsi_seq"), F.lit(None).cast("int").alias("article_no"), F.col("source_url").alias("told"), F.col("n_chunks").alias("n")).unionByName(told)


@CATALOG.add(
    "article_sessions",
    """
WITH d AS (SELECT doc_id, lang, doc_id % 90 + 1 AS n FROM documents)
SELECT doc_id, CAST(NULL AS INTEGER) AS chapter_no, CAST(0 AS INTEGER) AS article_no, '서문' AS article_title, 'head ' || lang AS body FROM d
UNION ALL SELECT doc_id, NULL, CAST(n AS INTEGER), 'a', 'x' || chr(10) || chr(10) || lang FROM d UNION ALL SELECT doc_id, CAST(n AS INTEGER), 0, '서문', 'tail' FROM d UNION ALL SELECT doc_id, CAST(n AS INTEGER), 2, NULL, '' FROM d
""",
)
def article_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to articles: sessions between heading lines, chapters carried forward, prologues as article 0."""
    listed = F.array(filled("head {lang}", **_values()), filled("제{n}조(a)", **_values()), F.lit("x"), F.col("lang"), filled("제{n}장 end", **_values()), F.lit("tail"), F.lit("제2조"))
    lines = _documents(spark, sf_dir).select("doc_id", F.posexplode(listed).alias("ord", "line"))
    return segment.statute_articles(lines, ["doc_id"], "ord", "line").select("doc_id", "chapter_no", "article_no", "article_title", "body")


@CATALOG.add(
    "listed_pages",
    """
WITH p AS (SELECT doc_id, doc_id % 7 AS k, unnest(range(1, 7)) AS page_no FROM documents)
SELECT 'd' || doc_id AS department, CAST(page_no AS INTEGER) AS page_no FROM p WHERE page_no <= least(CASE WHEN k = 0 THEN 1 ELSE k END, 4) AND NOT (k = 5 AND page_no >= 3)
""",
)
def listed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list pages that a crawl visits, six for each document: up to the counter's last page or the limit, none after an empty one."""
    rows = _documents(spark, sf_dir).select("doc_id", (F.col("doc_id") % 7).alias("k"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("page_no"))
    counter = F.when(F.col("k") == 0, "").otherwise(filled('<span class="page">(1 / {k})</span>', k=F.col("k")))
    links = F.when((F.col("k") == 5) & (F.col("page_no") == 3), "").otherwise("<a onclick=\"lsReturnSearch('','20240101','123456')\">x</a>")
    pages = rows.select(filled("d{doc}", doc=F.col("doc_id")).alias("department"), "page_no", F.concat(counter, links).alias("html"))
    return pipelines.listed_pages(pages, pipelines.RunConfig(urls.STATUTE, BASE, max_pages=4)).select("department", "page_no")


@CATALOG.add(
    "department_frontier",
    """
SELECT 'n' || doc_id AS name, 'https://portal.example/doc/lsInfoP.do?lsiSeq=' || (doc_id + 10000) || '&efYd=20240101' AS url FROM documents WHERE lang = 'en'
UNION ALL SELECT 'first', 'https://portal.example/doc/lsInfoP.do?lsiSeq=10000&efYd=20240101' FROM documents WHERE lang = 'en' GROUP BY lang
""",
)
def department_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of one department's list pages: a first page with the counter, and a page for each document."""
    link = "<a onclick=\"lsReturnSearch('x','20240101','{id}')\">{name}</a>"
    docs = _documents(spark, sf_dir)
    first = docs.select("lang").distinct().select(F.col("lang").alias("department"), F.lit(1).cast("long").alias("page_no"), F.lit("<b>(1 / 999999999)</b>" + link.format(id=10_000, name="first")).alias("html"))
    page = filled(link, id=F.col("doc_id") + 10_000, name=F.concat(F.lit("n"), F.col("doc_id").cast("string")))
    pages = first.unionByName(docs.select(F.col("lang").alias("department"), (F.col("doc_id") + 2).alias("page_no"), page.alias("html")))
    config = pipelines.RunConfig(urls.STATUTE, BASE, max_pages=1 << 30, department="en")
    found = html.links(pipelines.listed_pages(pages, config), ["department"], "html")
    return found.select(F.col("text").alias("name"), urls.detail_url(F.col("onclick"), urls.STATUTE, BASE, every=True, filled=True).alias("url"))


@CATALOG.add(
    "case_links",
    "SELECT doc_id, 'https://h/LSW/precInfoP.do?precSeq=' || (doc_id + 10000) AS url FROM documents UNION SELECT doc_id, 'https://h/LSW/precInfoP.do?precSeq=' || (doc_id % 90 + 1) FROM documents",
)
def case_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct case links from addresses and from script calls."""
    hrefs = F.array(filled("/LSW/precInfoP.do?precSeq={id}", **_values()), F.lit("/other"), filled("https://h/LSW/precInfoP.do?precSeq={id}", **_values()))
    calls = F.array(filled("view('precInfoP.do?precSeq={n}')", **_values()), F.lit("none()"))
    return _documents(spark, sf_dir).select("doc_id", F.explode(urls.case_links(hrefs, calls, F.lit("https://h/list?p=1"))).alias("url"))


@CATALOG.add("block_rows", """
SELECT doc_id, ord, tag, text FROM (SELECT doc_id, unnest([0, 1, 2, 4, 5, 6]) AS ord, unnest(['div', 'p', 'p', 'li', 'li', 'p']) AS tag,
  unnest([lang || chr(10) || 'b' || chr(10) || source || chr(10) || 'y', lang, 'b', source, 'y', 'tail ' || doc_id]) AS text FROM documents)
""")
def block_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of pages with implied ends and text outside any element."""
    page = filled("<div><p>{lang}<p>b<ul><li>{source}<li>y</ul></div>tail {doc}", doc=F.col("doc_id"), **_values())
    parsed = _documents(spark, sf_dir).select("doc_id", html.parse(page, "text").alias("nodes"))
    blocks = html.select(F.col("nodes"), html.is_tag("p", "div", "li"))
    return parsed.select("doc_id", F.explode(blocks).alias("n")).select("doc_id", "n.ord", "n.tag", "n.text")


@CATALOG.add("entity_text", "SELECT doc_id, 'café ’ … € ' || lang || ' &unknown; <' || source || '> A' AS text FROM documents")
def entity_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character references of every kind, named, decimal and hexadecimal."""
    from lexmill.functions.text import html_to_text

    page = filled("<p>caf&eacute; &#8217; &hellip;&nbsp;&#x20AC;<br>{lang} &unknown; &lt;{source}&gt; &#65</p>", **_values())
    return _documents(spark, sf_dir).select("doc_id", html_to_text(page).alias("text"))

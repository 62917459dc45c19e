"""End-to-end runs over the three families of pages: one lazy plan each, from raw pages to documents and chunks.

The only shuffles are those the results need: the last link of each name, the join of links and pages, and the order
of merged outputs. Network access is not part of the engine: pages come from tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill import sources
from lexmill.functions import ids, text, urls
from lexmill.operators import chunking, html, segment
from lexmill.operators.queue import enqueue, first_of_signature, last_write_wins


@dataclass(frozen=True)
class RunConfig:
    """``base``: address that detail links are built on; ``max_pages``: list pages to read; ``version_key``: keep
    versions of one name apart by their address instead of letting the last one win."""

    family: urls.Family
    base: str
    max_pages: int = 3
    version_key: bool = False
    department: str | None = None


def listed_pages(list_pages: DataFrame, config: RunConfig, key: str = "department") -> DataFrame:
    """The list pages that a crawl would visit: of the department, if one is named and the pages tell theirs, up to the
    last page that the first page's counter names (1 without one) or ``max_pages``, and none after an empty page."""
    wanted = list_pages
    if config.department is not None and key in list_pages.columns:
        wanted = wanted.where(F.col(key) == config.department)
    wanted = wanted.withColumn("__list", F.col(key) if key in list_pages.columns else F.lit(0))
    full = wanted.select("__list", "page_no", "html", F.col("html").contains(config.family.call).alias("full"))
    limits = full.groupBy("__list").agg(F.max(F.when(F.col("page_no") == 1, urls.page_counter(F.col("html"))["last"])).alias("last"), F.min(F.when(~F.col("full"), F.col("page_no"))).alias("empty"))
    joined = full.join(limits, full["__list"].eqNullSafe(limits["__list"])).drop(limits["__list"])
    most = F.least(F.coalesce("last", F.lit(1)), F.lit(config.max_pages))
    return joined.where((F.col("page_no") <= most) & (F.col("empty").isNull() | (F.col("page_no") < F.col("empty")))).select(F.col("__list").alias(key), "page_no", "html")


def frontier(list_pages: DataFrame, config: RunConfig) -> DataFrame:
    """``name, url, list_pos`` from ``page_no, html``: the last link of each name wins."""
    wanted = list_pages.where(F.col("page_no") <= config.max_pages)
    entries = html.list_entries(wanted, config.family, config.base)
    return last_write_wins(entries, ["name", "url"] if config.version_key else ["name"], "list_pos")


def _pages_of(links: DataFrame, pages: DataFrame) -> DataFrame:
    return links.join(pages, "url").select("name", "url", "html")


def statutes(list_pages: DataFrame, pages: DataFrame, config: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Documents and article chunks of statute pages."""
    headers = html.document_header(_pages_of(frontier(list_pages, config), pages), config.family)
    return sources.savable(headers.drop("nodes")), html.statute_chunks(headers)


def recognised_chunks(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks of scanned documents from their recognised pages (``doc_id, page_no, text``)."""
    joined = sources.recognised_text(pages, ["doc_id"]).join(documents.select("doc_id", F.col("title").alias("doc_title"), "source_url"), "doc_id")
    rows = joined.select("doc_id", "doc_title", "source_url", F.inline(segment.ordered_sections(F.col("text"))))
    identity = F.when(F.col("no") == 0, ids.chunk_id(F.col("doc_id"), "preamble_ocr")).otherwise(ids.chunk_id(F.col("doc_id"), "section", F.col("no"), "_ocr"))
    return rows.select(identity.alias("chunk_id"), "doc_id", "title", "text", F.struct(F.col("doc_title").alias("chapter"), F.lit("pdf_ocr").alias("source_type")).alias("metadata"), "source_url")


def rules(list_pages: DataFrame, pages: DataFrame, ocr_pages: DataFrame, config: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Documents and chunks of rule pages, each parsed by its kind."""
    headers = html.document_header(_pages_of(frontier(list_pages, config), pages), config.family)
    typed = headers.withColumn("kind", html.page_kind(F.col("nodes")))
    structured = html.rule_chunks(typed.where("kind = 'STRUCTURED'"))
    sections = html.section_chunks(typed.where("kind = 'UNSTRUCTURED'"))
    scanned = recognised_chunks(typed.where("kind = 'PDF'"), ocr_pages)
    return sources.savable(headers.drop("nodes")), structured.unionByName(sections).unionByName(scanned)


def case_queue(pages: DataFrame) -> DataFrame:
    """Case pages (``url, html``) to queue rows."""
    cases = html.cases(pages)
    s = F.col("sections")
    named = {"holding": s["판시사항"], "summary": s["판결요지"], "provisions": s["참조조문"]}
    body = chunking.case_body(F.col("title"), F.col("subtitle1"), named, s["전문"]["주문"], s["전문"]["이유"])
    chunks = chunking.numbered(chunking.overlapping_chunks(chunking.case_sentences(body)))
    return enqueue(cases.select("source_url", "title", "subtitle1", F.inline(chunks)))


def statute_lines(pages: DataFrame, dept_id: str | None = None) -> DataFrame:
    """Statute pages (``url, html``) to flat lines, one for each paragraph of an article: articles by sessions over the
    blocks of a page, cut into paragraphs, with the place of each and its id."""
    lines = html.block_lines(pages)
    articles = segment.statute_articles(lines, ["url"], "ord", "line")
    titles = pages.select("url", html.parse(F.col("html"), "text").alias("nodes")).select("url", html.own_text(html.first(F.col("nodes"), html.is_tag("h2"))).alias("law_title"))
    cut = articles.join(titles, "url").select("*", F.posexplode(segment.plain_paragraphs(F.col("body"))).alias("p_pos", "p"))
    seq, date = urls.query_value(F.col("url"), "lsiSeq"), urls.query_value(F.col("url"), "efYd")
    prologue = F.col("article_no") == 0
    chapter = F.when(~prologue, F.col("chapter_no"))
    path = F.when(prologue, F.lit("서문")).otherwise(F.array_join(ids.breadcrumbs(chapter, F.col("chapter_title"), F.col("article_no"), F.col("article_title"), F.col("p.no")), " > "))
    return cut.select(
        ids.line_id(seq, date, chapter, F.col("article_no"), F.col("p.no")).alias("id"), F.col("p.text").alias("text"), "law_title", chapter.alias("chapter_no"), F.when(~prologue, F.col("chapter_title")).alias("chapter_title"),
        "article_no", "article_title", F.col("p.no").alias("paragraph_no"), path.alias("section_path"), seq.alias("lsiSeq"), date.alias("efYd"), F.col("url").alias("source_url"), F.lit(dept_id).alias("dept_id"), F.lit("ko").alias("lang"),
    )


def rich_chunks(bodies: DataFrame, target: int = chunking.TARGET, most: int = chunking.MOST) -> DataFrame:
    """Statute bodies (``url, title, body``) to chunks with their place in the statute.

    Articles and their chapters by sessions over lines, then paragraphs, items and packed sentences by array cuts; equal
    chunks of one document at one place are kept once.
    """
    lines = bodies.select("url", "title", F.posexplode(text.without_noise(text.lines_of(F.col("body")))).alias("ord", "line"))
    articles = segment.statute_articles(lines, ["url", "title"], "ord", "line").where("article_no > 0")
    numbered = articles.select("*", F.posexplode(segment.paragraphs(F.col("body"))).alias("p_pos", "p"))
    itemised = numbered.select("*", F.posexplode(segment.items(F.col("p.text"))).alias("i_pos", "i"))
    packed = itemised.select("*", F.posexplode(chunking.greedy_chunks(chunking.statute_sentences(F.col("i.text")), target, most)).alias("c_pos", "text")).where("length(text) >= 2")
    url = urls.without_fragment(F.col("url"))
    seq, date = urls.query_value(F.col("url"), "lsiSeq"), urls.query_value(F.col("url"), "efYd")
    key = ids.logical_key(seq, date, F.col("chapter_no"), F.col("article_no"), F.col("p.no"), F.col("i.no"))
    crumbs = ids.breadcrumbs(F.col("chapter_no"), F.col("chapter_title"), F.col("article_no"), F.col("article_title"), F.col("p.no"), F.col("i.no"))
    rows = packed.select(
        key.alias("logical_key"), "text", crumbs.alias("breadcrumbs"), "chapter_no", "chapter_title", "article_no", "article_title",
        F.col("p.no").alias("paragraph_no"), F.col("i.no").alias("item_no"), text.token_estimate(F.col("text")).alias("tokens_est"), text.references(F.col("text")).alias("links_out"),
        url.alias("source_url"), date.alias("efYd"), seq.alias("lsiSeq"), F.lit("ko").alias("lang"), F.lit("chunk").alias("kind"),
        F.struct("first", "p_pos", "i_pos", "c_pos").alias("place"),
    )
    rows = rows.withColumn("revision", ids.blake2s(4)(F.col("text"))).withColumn("chunk_id", F.concat_ws(":", "logical_key", "revision"))
    rows = rows.withColumn("display_text", F.concat(F.array_join("breadcrumbs", " > "), F.lit(" — "), "text"))
    return first_of_signature(rows, ["source_url", "chunk_id"], "place").drop("place", "revision")


def citations(chunks: DataFrame) -> DataFrame:
    """The citation graph of chunks: ``chunk_id, law, article``."""
    return chunks.select("chunk_id", F.inline("links_out"))


def normalised_model(chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Statutes, their articles and the articles' chunks as three keyed tables with content hashes."""
    laws = chunks.groupBy("lsiSeq").agg(F.min("source_url").alias("source_url"), F.count("*").alias("n_chunks"))
    articles = chunks.groupBy("lsiSeq", "article_no").agg(F.min("article_title").alias("heading"), F.sha2(F.array_join(F.array_sort(F.collect_set("text")), "\n"), 256).alias("content_hash"))
    pieces = chunks.select("lsiSeq", "article_no", "chunk_id", "text", ids.content_hash(F.col("text")).alias("content_hash"))
    return laws, articles, pieces

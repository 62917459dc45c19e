"""Segmentation: cutting texts at marks, carrying headings forward, sessions between headings.

Cuts within one text are array expressions (no shuffle). Operators over rows of a document use windows partitioned by
the document and ordered by an explicit ``ord``, never by arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import numbering as N
from lexmill.functions.text import clean_line, clean_spaces, clean_statute, ocr_lead, strip, text_of

CUT = "\u0001"
OCR_TITLE = r"\A([^:]*?(?:여부|기간:|기준|방법|금액))"  # fixed value: words that end a section's title


def cut_at(text: Column, mark: str) -> tuple[Column, Column]:
    """Pieces that start at each match of ``mark``, and the text before the first."""
    pieces = F.split(F.regexp_replace(text, mark, CUT + "$0"), CUT)
    return F.slice(pieces, F.lit(2), F.size(pieces)), F.get(pieces, 0)


def _numbered(text: Column, mark: str, lead: str, syllables: bool, clean, keep_prefix: bool) -> Column:
    pieces, before = cut_at(text_of(text), mark)
    found = F.transform(pieces, lambda p: F.struct(N.mark_number(p, syllables).alias("no"), clean(F.regexp_replace(p, lead, "")).alias("text")))
    if keep_prefix:
        found = F.concat(F.array(F.struct(F.lit(None).cast("int").alias("no"), clean(before).alias("text"))), found)
    whole = F.array(F.struct(F.lit(None).cast("int").alias("no"), strip(text_of(text)).alias("text")))
    return F.when(F.size(pieces) == 0, whole).otherwise(F.filter(found, lambda x: x["text"] != ""))


def paragraphs(text: Column, keep_prefix: bool = False) -> Column:
    """Array of ``no, text``, cut at ``제n항`` and circled digits. Text before the first mark is dropped unless
    ``keep_prefix``; without marks the text is one unnumbered paragraph."""
    return _numbered(text, N.PARAGRAPH_MARK, N.PARAGRAPH_MARK, False, clean_statute, keep_prefix)


def plain_paragraphs(text: Column) -> Column:
    """Like :func:`paragraphs`, only stripped; an empty text has none."""
    cut = _numbered(text, N.PARAGRAPH_MARK, N.PARAGRAPH_MARK, False, strip, False)
    return F.when(strip(text_of(text)) == "", F.slice(cut, 1, 0)).otherwise(cut)


def items(text: Column, keep_prefix: bool = False) -> Column:
    """Array of ``no, text``, cut at ``n.`` and ``가.``; the number is null for other syllables."""
    return _numbered(text, N.ITEM_MARK, N.ITEM_LEAD, True, clean_statute, keep_prefix)


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``name``: the last ``value`` that is not null up to each row (a running heading)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """Each row of ``left`` with the ``values`` of the last row of ``right`` whose ``at`` is not after its own.

    Both sides go through one shuffle by ``keys`` and one running window; equal places count as before.
    """
    packed = right.select(*keys, at, F.lit(0).alias("__side"), F.struct(*values).alias("__v"))
    rows = left.select(*keys, at, F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"))
    both = packed.unionByName(rows, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__side = 1")
    return found.select("__row.*", *(F.col("__v")[v].alias(v) for v in values))


def spans(df: DataFrame, keys: list[str], start: str, length: Column) -> DataFrame:
    """``end``: the start of the next mark in the same document, or its length."""
    w = Window.partitionBy(*keys).orderBy(start)
    return df.withColumn("end", F.coalesce(F.lead(start).over(w), length))


def sessions(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str = "section") -> DataFrame:
    """``name``: 0 before the first row where ``starts`` holds, then 1, 2, ..."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(w).cast("int"))


def joined_text(df: DataFrame, keys: list[str], order: str, text: str, separator: str, name: str) -> DataFrame:
    """Texts of a group in order, joined; the order never depends on arrival."""
    rows = F.array_sort(F.collect_list(F.struct(order, text)))
    return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda x: x[text]), separator).alias(name))


def take_until(nodes: Column, stops, kinds: tuple[str, ...] = ("p", "div", "ul", "ol", "table", "blockquote")) -> Column:
    """Texts of block nodes up to the first that ``stops``, joined by an empty line. ``nodes``: array of ``tag, text, ..``."""
    state = F.aggregate(
        nodes,
        F.struct(F.lit(False).alias("over"), F.array().cast("array<string>").alias("out")),
        lambda s, n: F.struct(
            (s["over"] | stops(n)).alias("over"),
            F.when(~s["over"] & ~stops(n) & n["tag"].isin(*kinds) & (n["text"] != ""), F.concat(s["out"], F.array(n["text"]))).otherwise(s["out"]).alias("out"),
        ),
    )
    return F.array_join(state["out"], "\n\n")


def statute_articles(lines: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """Lines of statutes -> articles: ``keys, chapter_no, chapter_title, article_no, article_title, first, body``.

    A chapter or article line opens a session. Chapters carry forward over articles; lines of a session that no
    article opened become prologue rows with article 0.
    """
    t = F.col(text)
    chapter, article = F.regexp_extract(t, N.CHAPTER_LINE, 1), F.regexp_extract(t, N.ARTICLE_LINE, 1)
    marked = lines.withColumn("chapter", F.when(chapter != "", F.struct(chapter.cast("int").alias("no"), clean_line(F.regexp_extract(t, N.CHAPTER_LINE, 2)).alias("title"))))
    marked = marked.withColumn("article", F.when((article != "") & F.col("chapter").isNull(), F.struct(article.cast("int").alias("no"), clean_line(F.regexp_extract(t, N.ARTICLE_LINE, 2)).alias("title"))))
    marked = sessions(marked, keys, [order], F.col("chapter").isNotNull() | F.col("article").isNotNull(), "session")
    marked = carry_forward(marked, keys, [order], F.col("chapter"), "current")
    marked = carry_forward(marked, [*keys, "session"], [order], F.col("article"), "open")
    body = marked.where("chapter IS NULL AND article IS NULL")
    heads = marked.where("article IS NOT NULL").select(*keys, "session", "current", "open", order)
    bodies = joined_text(body, [*keys, "session", "current", "open"], order, text, "\n\n", "body")
    firsts = body.groupBy(*keys, "session").agg(F.min(order).alias("first_line"))
    bodies = bodies.join(firsts, [*keys, "session"])
    joined = bodies.join(heads.select(*keys, "session", F.col(order).alias("head_line"), F.col("current").alias("head_chapter"), F.col("open").alias("head")), [*keys, "session"], "full")
    chapter, article = F.coalesce("current", "head_chapter"), F.coalesce("open", "head")
    return joined.select(
        *keys,
        chapter["no"].alias("chapter_no"),
        chapter["title"].alias("chapter_title"),
        F.coalesce(article["no"], F.lit(0)).alias("article_no"),
        F.when(article.isNull(), F.lit("서문")).otherwise(F.nullif(article["title"], F.lit(""))).alias("article_title"),
        F.coalesce("head_line", "first_line").alias("first"),
        F.coalesce("body", F.lit("")).alias("body"),
    )


def ordered_sections(text: Column) -> Column:
    """Sections ``1. 2. 3.`` of recognised text, in exact order: array of ``no, title, text``, the preamble first (no 0).

    Marks are numbers between white space and ``. ``. From the first 1 on each next number opens a section; smaller
    ones are passed over, and a larger one ends the search, so what follows stays in the last section.
    """
    clean = ocr_lead(text)
    mark = r"(?U)\s(\d+)\.\s"
    pieces = F.split(F.regexp_replace(clean, mark, CUT + "$0"), CUT)
    numbers = F.transform(pieces, lambda p: F.nullif(F.regexp_extract(p, r"(?U)\A\s(\d+)\.\s", 1), F.lit("")).try_cast("long"))
    state = F.aggregate(
        F.arrays_zip(pieces.alias("p"), numbers.alias("n")),
        F.struct(F.lit(1).cast("long").alias("next"), F.lit(False).alias("over"), F.array(F.lit("")).alias("out")),
        lambda s, x: F.struct(
            F.when(~s["over"] & (F.coalesce(x["n"], F.lit(-1)) == s["next"]), s["next"] + 1).otherwise(s["next"]).alias("next"),
            (s["over"] | ((s["next"] > 1) & (F.coalesce(x["n"], F.lit(-1)) > s["next"]))).alias("over"),
            F.when(~s["over"] & (F.coalesce(x["n"], F.lit(-1)) == s["next"]), F.concat(s["out"], F.array(x["p"])))
            .otherwise(F.concat(F.slice(s["out"], F.lit(1), F.size(s["out"]) - 1), F.array(F.concat(F.element_at(s["out"], -1), x["p"]))))
            .alias("out"),
        ),
    )

    def section(piece: Column, i: Column) -> Column:
        whole = strip(piece)
        title = strip(F.regexp_extract(whole, OCR_TITLE, 1))
        rest = strip(F.substring(whole, F.length(title) + 1, F.length(whole)))
        return F.struct(
            i.cast("int").alias("no"),
            clean_spaces(F.when(i == 0, F.lit("서문")).when(title != "", title).otherwise(whole), quotes=False).alias("title"),
            clean_spaces(F.when(i == 0, whole).when(title != "", rest).otherwise(F.lit("")), quotes=False).alias("text"),
        )

    return F.filter(F.transform(state["out"], section), lambda x: (x["no"] > 0) | (x["text"] != ""))

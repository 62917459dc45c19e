"""Identifiers and digests."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blake2s(size: int = 8):
    """A vectorised blake2s of ``size`` bytes as hex (Spark has no such function)."""

    @F.pandas_udf(T.StringType())
    def digest(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else hashlib.blake2s(t.encode(), digest_size=size).hexdigest())

    return digest


def content_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def or_none(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def logical_key(seq: Column, date: Column, chapter: Column, article: Column, paragraph: Column, item: Column) -> Column:
    """Position of a piece of a statute; missing numbers count as 0."""
    number = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    return F.concat(F.lit("law:"), or_none(seq), F.lit(":"), or_none(date), F.lit(":ch"), number(chapter), F.lit(":art"), number(article), F.lit(":para"), number(paragraph), F.lit(":item"), number(item))


def line_id(seq: Column, date: Column, chapter: Column, article: Column, paragraph: Column) -> Column:
    part = lambda c: F.coalesce(c.cast("string"), F.lit("NA"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    return F.concat(F.lit("law:"), part(seq), F.lit(":"), part(date), F.lit(":ch"), number(chapter), F.lit(":art"), number(article), F.lit(":para"), number(paragraph))


def chunk_id(doc_id: Column, kind: str, number: Column | None = None, suffix: str = "") -> Column:
    """``doc:<id>:article_3``, ``doc:<id>:section_1_ocr``, ``doc:<id>:preamble`` ..."""
    parts = [F.lit("doc:"), doc_id, F.lit(f":{kind}")]
    if number is not None:
        parts += [F.lit("_"), number.cast("string")]
    return F.concat(*parts, F.lit(suffix))


def breadcrumbs(chapter_no: Column, chapter_title: Column, article_no: Column, article_title: Column, paragraph: Column, item: Column | None = None) -> Column:
    """Names of the levels above and of a piece, outermost first. A number of 0 counts as missing."""
    title = F.coalesce(chapter_title, F.lit(""))
    chapter = F.when(chapter_no.isNotNull(), F.rtrim(F.concat(F.lit("제"), chapter_no.cast("string"), F.lit("장 "), title)))
    named = F.concat(F.lit("제"), article_no.cast("string"), F.lit("조"))
    article = F.when(F.coalesce(article_title, F.lit("")) != "", F.concat(named, F.lit("("), article_title, F.lit(")"))).otherwise(named)
    levels = [chapter, article, F.when(paragraph > 0, F.concat(paragraph.cast("string"), F.lit("항")))]
    if item is not None:
        levels.append(F.when(item > 0, F.concat(item.cast("string"), F.lit("호"))))
    return F.array_compact(F.array(*levels))


def seed_of(text: Column) -> Column:
    """The first 64 bits of a SHA-256, as a number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")

"""Text cleaning as Column expressions; only character references are decoded by an Arrow-batched function.

White space means Unicode white space (``(?U)``), as in most languages' ``strip`` and ``\\s``; ``^`` at line starts
means after ``\\n`` only (``(?d)``).
"""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

NBSP = "\u00a0"

# Words, marks and patterns that results depend on.
NOISE_WORDS = ("판례", "연혁", "위임행정규칙", "규제", "생활법령", "한눈보기")
PHONE = r"[0-9]{2,3}-[0-9]{3,4}-[0-9]{4}"
BULLETS = r"^[▷▶◀◁■□●○\-–—•·*]+$"
FULL_WIDTH = ("［］（）", "[]()")
REFERENCE = r"「\s*([^」]+?)\s*」\s*제\s*(\d+)\s*조"
SHORT_TITLE = r"약칭[:：]\s*([^)]+)\)"
MINISTRY = r"(고용노동부|.*부)\s*"
# End of fixed values.


def text_of(c: Column) -> Column:
    """Null as an empty string."""
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def spaces_for_nbsp(c: Column) -> Column:
    return F.replace(text_of(c), F.lit(NBSP), F.lit(" "))


def clean_line(c: Column, entities: bool = True) -> Column:
    """One line: no-break spaces, the word NBSP and (with ``entities``) ``&nbsp;`` become spaces; runs of white space one space."""
    c = F.regexp_replace(spaces_for_nbsp(c), r"(?iU)\bNBSP\b", " ")
    if entities:
        c = F.regexp_replace(c, "(?i)&nbsp;", " ")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def squeeze(c: Column, around_breaks: bool = True) -> Column:
    """Runs of blanks become one; blanks around line breaks go; three or more breaks become two."""
    c = F.regexp_replace(c, r"[ \t]+", " ")
    if around_breaks:
        c = F.regexp_replace(c, r"[ \t]*\n[ \t]*", "\n")
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def clean_block(c: Column) -> Column:
    """Several lines, cleaned like :func:`clean_line` within each."""
    c = F.regexp_replace(spaces_for_nbsp(c), r"(?iU)\bNBSP\b", " ")
    return strip(squeeze(F.regexp_replace(c, "(?i)&nbsp;", " ")))


def clean_statute(c: Column) -> Column:
    """Blocks of statute text: full-width brackets become ASCII."""
    c = squeeze(F.regexp_replace(spaces_for_nbsp(c), "(?i)&nbsp;", " "))
    return strip(F.translate(c, *FULL_WIDTH))


def clean_spaces(c: Column, quotes: bool = True) -> Column:
    """Blanks and breaks only; without ``quotes`` double quotes go too."""
    c = spaces_for_nbsp(c)
    if not quotes:
        c = F.replace(c, F.lit('"'), F.lit(""))
    return strip(squeeze(c, around_breaks=False))


def unwrap_brackets(c: Column) -> Column:
    """``[x]`` -> ``x``; anything else stays."""
    inner = F.regexp_extract(text_of(c), r"(?Us)\A\s*\[(.+?)\]\s*\z", 1)
    return strip(F.when(inner != "", inner).otherwise(text_of(c)))


def drop_brackets(c: Column) -> Column:
    """A cleaned line without its outer brackets, or without its only pair of brackets."""
    c = clean_line(c, entities=False)
    outer = c.startswith("[") & c.endswith("]") & (F.length(c) >= 2)
    single = (F.regexp_count(c, F.lit(r"\[")) == 1) & (F.regexp_count(c, F.lit(r"\]")) == 1)
    return F.when(outer, strip(F.substring(c, F.lit(2), F.length(c) - 2))).when(single, strip(F.translate(c, "[]", ""))).otherwise(c)


def lines_of(c: Column) -> Column:
    return F.split(text_of(c), r"\R")


def normal_lines(c: Column) -> Column:
    """Stripped lines without empty ones."""
    return F.array_join(F.filter(F.transform(lines_of(c), strip), lambda x: x != ""), "\n")


def is_noise(c: Column) -> Column:
    """Lines of menus and decoration: empty, a menu word, at most two characters without a digit, a phone number, bullets."""
    t = strip(text_of(c))
    short = (F.length(t) <= 2) & ~t.rlike("[0-9]")
    return t.isin("", *NOISE_WORDS) | short | t.rlike(PHONE) | t.rlike(BULLETS)


def without_noise(lines: Column) -> Column:
    return F.filter(F.transform(lines, clean_statute), lambda x: ~is_noise(x))


def first_of(*columns: Column) -> Column:
    """The first that is not empty after cleaning, else an empty string."""
    return F.coalesce(*(F.nullif(clean_line(c, entities=False), F.lit("")) for c in columns), F.lit(""))


def token_estimate(c: Column) -> Column:
    """About one token for two and a half characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(text_of(c)) / 2.5).cast("int"))


def references(c: Column) -> Column:
    """Cited statutes: array of ``law, article``."""
    pairs = F.arrays_zip(F.regexp_extract_all(text_of(c), F.lit(REFERENCE), 1).alias("law"), F.regexp_extract_all(text_of(c), F.lit(REFERENCE), 2).alias("article"))
    return F.transform(pairs, lambda x: F.struct(x["law"].alias("law"), x["article"].cast("int").alias("article")))


def aliases(short_title: Column, title: Column) -> Column:
    """The distinct names that are not empty, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.array(text_of(short_title), text_of(title)), lambda x: x != "")))


def short_title(html: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(text_of(html), SHORT_TITLE, 1)), F.lit(""))


def ministry(c: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(text_of(c), MINISTRY, 1)), F.lit(""))


def ocr_lead(c: Column) -> Column:
    """Without a stray x that recognition puts before a page's text."""
    return strip(F.regexp_replace(strip(text_of(c)), r"\A[xX](?U:\s*)", ""))


def is_ready(title: Column, body: Column, least: int = 120) -> Column:
    """Whether a page is worth parsing: a title of two characters and ``least`` characters of text, white space as one."""
    return (F.length(strip(text_of(title))) >= 2) & (F.length(clean_line(body, entities=False)) >= least)


def blank_lines_gone(c: Column) -> Column:
    return F.regexp_replace(text_of(c), r"\n\s*\n", "\n")


def embed_text(c: Column) -> Column:
    """What an embedding backend gets of a text."""
    return strip(spaces_for_nbsp(c))


@arrow_udf(StringType())
def unescape(texts: pa.Array) -> pa.Array:
    """All character references of HTML, by the standard library."""
    return pa.array([html.unescape(t) if t and "&" in t else t for t in texts.to_pylist()], pa.string())


def html_to_text(c: Column) -> Column:
    """Breaks and paragraph ends, then tags, as space; entities decoded; one cleaned line."""
    c = F.regexp_replace(text_of(c), r"(?i)<br\s*/?>", "\n")
    c = F.regexp_replace(F.regexp_replace(c, r"(?i)</p\s*>", "\n"), "<[^>]+>", " ")
    return clean_line(unescape(c), entities=False)

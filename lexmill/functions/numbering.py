"""Numbers of paragraphs and items: circled digits, ``제n항``, syllables and ``n.``"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order of item syllables, and the marks at line starts.
SYLLABLES = "가나다라마바사아자차카타파하"
PARAGRAPH_MARK = r"(?Umd)^\s*(?:제\s*\d+\s*항|[\u2460-\u2473])\s*"
ITEM_MARK = r"(?Umd)^\s*(?:\d+|[가-힣])\.\s+"
ITEM_LEAD = r"(?U)\A\s*(?:\d+|[가-힣])\.\s*"
ARTICLE_LINE = r"(?U)\A\s*제\s*(\d+)\s*조\s*[（(]?([^)）]*)[)）]?\s*\z"
CHAPTER_LINE = r"(?U)\A\s*제\s*(\d+)\s*장\s*(.*?)\s*\z"
ROMAN_LEAD = r"(?U)\A\s*[Ⅰ-Ⅹ]+\.\s"
# End of fixed values.


def to_int(text: Column) -> Column:
    return F.expr("null").cast("int") if text is None else F.nullif(text, F.lit("")).try_cast("int")


def mark_number(token: Column, syllables: bool = True) -> Column:
    """The number a mark stands for; null for any other text."""
    t = F.regexp_replace(F.coalesce(token, F.lit("")), r"(?U)\A\s+", "")
    first = F.substring(t, 1, 1)
    code = F.when(first == "", F.lit(0)).otherwise(F.ascii(first))
    found = F.when(code.between(0x2460, 0x2473), code - 0x245F).otherwise(to_int(F.regexp_extract(t, r"(?U)\A제\s*(\d+)\s*항", 1)))
    if syllables:
        at = F.when(first == "", F.lit(0)).otherwise(F.instr(F.lit(SYLLABLES), first))
        found = F.coalesce(found, F.when(at > 0, at), to_int(F.regexp_extract(t, r"\A([0-9]+)\.", 1)))
    return found.cast("int")

"""Pages as rows of nodes.

Python does one thing here: an Arrow-batched function turns a page into an array of nodes in document order (the
standard library's tokenizer, with void tags, implied ends, a paragraph for text outside any element, and skipped scripts). Selecting, joining,
classifying and cutting are Column expressions over that array, so a page is parsed once and never shuffled.

A node: ``ord, parent, depth, last`` (the last node below it), ``tag, id, class`` (padded with blanks), ``attrs``,
``own`` (own text pieces), ``text`` (all text below, pieces stripped and joined by line breaks), ``flat`` (all text
below, as it stands, with a line break after ``p`` and ``br``), ``line`` (that as one cleaned line, to look for labels in).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from lexmill.functions.ids import chunk_id, or_none
from lexmill.functions.text import aliases, clean_block, clean_line, clean_spaces, drop_brackets, first_of, ministry, normal_lines, short_title, strip, without_noise
from lexmill.functions.urls import Family, document_id, query_value, without_fragment
from lexmill.operators.segment import take_until

NODE = "struct<ord:int,parent:int,depth:int,last:int,tag:string,id:string,class:string,attrs:map<string,string>,own:array<string>,text:string,flat:string,line:string>"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

BLANK_WORD = re.compile(r"\bNBSP\b", re.I)
#: A start tag ends open elements of these tags, up to the nearest element of the others.
IMPLIED_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    **{t: (("dt", "dd"), ("dl",)) for t in ("dt", "dd")},
    **{t: (("td", "th"), ("tr", "table")) for t in ("td", "th")},
    "tr": (("td", "th", "tr"), ("table",)),
    **{t: (("td", "th", "tr", "thead", "tbody", "tfoot"), ("table",)) for t in ("thead", "tbody", "tfoot")},
    "option": (("option",), ("select", "datalist")),
}

# Selectors and labels of the page families.
USE = "data-brl-use"
STATUTE_BODIES = ("contentBody", "conScroll")
STATUTE_BODY_CLASS = "law-view-content"
CHAPTER_LEAD = r"(?U)\A제\s*\d+\s*장"
ROMAN_LEAD = r"(?U)\A\s*[Ⅰ-Ⅹ]+\.\s"
TITLES = (("h2", USE, "PH/H1"), ("conTop", "h1"), ("conTop", "h2"))
SUBTITLES = ("subtitle1", "subtit1", "subTit1")
SUBTITLE_ATTRIBUTE = "data-subtitle1"
BODY_IDS = ("contentBody", "conScroll", "content")
STATUTE_NAME = "법령"
LIST_TABLE = "resultTableDiv"
HEAD_LABELS = ("판시사항", "판결요지", "참조조문")
WHOLE, ORDER, REASONS, PREAMBLE = "전문", "주문", "이유", "서문"
# End of fixed values.


#: Text and a tag as most pages write them, which need none of the tokenizer's tolerance, and the elements whose content it reads otherwise.
PLAIN = re.compile(r'([^<]*)<(?:/([a-zA-Z][a-zA-Z0-9]*)>|([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z][-a-zA-Z0-9_]*="[^"&]*")*)>)')
PLAIN_ATTRIBUTE = re.compile(r' ([^=]+)="([^"]*)"')
OWN_CONTENT = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())


class _Nodes(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.pieces: list[str] = []  # text in order, with the line breaks of the flat text

    def updatepos(self, i: int, j: int) -> int:  # lines are not counted
        return j

    def goahead(self, end: bool) -> None:
        self.rawdata = self.rawdata[self._plain(0) :]
        super().goahead(end)

    def parse_starttag(self, i: int) -> int:
        plain = self._plain(i, 1)
        return plain if plain > i else super().parse_starttag(i)

    def parse_endtag(self, i: int) -> int:
        plain = self._plain(i, 1)
        return plain if plain > i else super().parse_endtag(i)

    def _plain(self, i: int, most: int = -1) -> int:
        """Reads texts with plain tags after them from ``i`` on, as far as they go or ``most`` of them; where the next thing begins."""
        raw, match = self.rawdata, PLAIN.match
        while most and self.cdata_elem is None and (plain := match(raw, i)):
            text, ends, starts, attrs = plain.groups()
            tag = (ends or starts).lower()
            if tag in OWN_CONTENT:
                break
            if text:
                self.handle_data(unescape(text))
            if ends:
                self.handle_endtag(tag)
            else:
                self.handle_starttag(tag, [(k.lower(), v) for k, v in PLAIN_ATTRIBUTE.findall(attrs)] if attrs else [])
            i = plain.end()
            most -= 1
        return i

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in IMPLIED_ENDS:
            self._imply_ends(tag)
        elif tag in ENDS_PARAGRAPH and self.open and self.rows[self.open[-1]]["tag"] == "p":
            self._close(len(self.open) - 1)
        parent = self.open[-1] if self.open else None
        at = {k: v or "" for k, v in reversed(attrs)} if attrs else {}
        n = len(self.rows)
        self.rows.append({"ord": n, "parent": parent, "depth": len(self.open), "tag": tag, "id": at.get("id"), "class": f" {' '.join(at['class'].split())} " if "class" in at else "  ", "attrs": at, "own": [], "first": len(self.pieces)})
        if tag in VOID:
            if tag == "br":
                self.pieces.append("\n")
            self.rows[-1] |= {"last": n, "end": len(self.pieces)}
        else:
            self.open.append(n)

    def _imply_ends(self, tag: str) -> None:
        over, within = IMPLIED_ENDS[tag]
        last = None
        for k in range(len(self.open) - 1, -1, -1):
            here = self.rows[self.open[k]]["tag"]
            if here in within:
                break
            if here in over:
                last = k
        if last is not None:
            self._close(last)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[k]]["tag"] == tag:
                return self._close(k)

    def _close(self, k: int) -> None:
        last = len(self.rows) - 1
        for at in reversed(self.open[k:]):
            row = self.rows[at]
            if row["tag"] == "p":
                self.pieces.append("\n")
            row["last"], row["end"] = last, len(self.pieces)
        del self.open[k:]

    def handle_data(self, data: str) -> None:
        if not self.open and data.strip():  # text outside any element begins a paragraph
            self.handle_starttag("p", [])
        if self.open and (row := self.rows[self.open[-1]])["tag"] not in ("script", "style"):
            row["own"].append(data)
            self.pieces.append(data)


#: Fields that hold all text below a node. A page repeats its text in them for each level, so a plan asks for those it reads.
TEXTS = ("text", "flat", "line")


def nodes_of(page: str | None, texts: tuple[str, ...] = TEXTS) -> list[dict]:
    """The nodes of one page, with the fields ``texts`` of :data:`TEXTS`; none for a null or empty page."""
    parser = _Nodes()
    parser.feed(page or "")
    parser.close()
    parser._close(0)
    pieces = parser.pieces
    if "text" in texts:
        stripped = [t.strip() for t in pieces]
        before = [0, *accumulate(1 if s else 0 for s in stripped)]  # pieces with text before each place
        stripped = [s for s in stripped if s]
    for row in parser.rows:
        low, high = row.pop("first"), row.pop("end")
        if "text" in texts:
            row["text"] = "\n".join(stripped[before[low] : before[high]])
        if "flat" in texts:
            row["flat"] = "".join(pieces[low:high])
        if "line" in texts:
            row["line"] = " ".join(BLANK_WORD.sub(" ", "".join(pieces[low:high]).replace("\u00a0", " ")).split())
    return parser.rows


_FIELDS = {"ord": T.IntegerType(), "parent": T.IntegerType(), "depth": T.IntegerType(), "last": T.IntegerType(), "tag": T.StringType(), "id": T.StringType(), "class": T.StringType(), "attrs": T.MapType(T.StringType(), T.StringType()), "own": T.ArrayType(T.StringType()), "text": T.StringType(), "flat": T.StringType(), "line": T.StringType()}
NODES = T.ArrayType(T.StructType([T.StructField(k, v) for k, v in _FIELDS.items()]))


_ARROW = {T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.ArrayType(T.StringType()): pa.list_(pa.string()), T.MapType(T.StringType(), T.StringType()): pa.map_(pa.string(), pa.string())}
ARROW_NODES = pa.list_(pa.struct([(k, _ARROW[v]) for k, v in _FIELDS.items()]))


#: Bytes of pages whose nodes a worker holds at once, and sends back as one batch: nodes take many times a page's bytes.
SLICE_BYTES = 1 << 16


def _slices(pages: pa.Array) -> Iterator[pa.Array]:
    """The same pages in smaller arrays of about ``SLICE_BYTES``; a longer page is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(pages):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield pages.slice(at, end - at)
        at = end


def parse(page: Column, *texts: str) -> Column:
    """The nodes of pages; of :data:`TEXTS` only ``texts`` are filled in (all, if none is named)."""
    wanted = texts or TEXTS

    @arrow_udf(NODES)
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for pages in _slices(batch):
                yield pa.array([nodes_of(page, wanted) for page in pages.to_pylist()], ARROW_NODES)

    return parsed(page)


Test = Callable[[Column], Column]


def has_class(name: str) -> Test:
    return lambda n: n["class"].contains(f" {name} ")


def is_tag(*names: str) -> Test:
    return lambda n: n["tag"].isin(*names)


def select(nodes: Column, test: Test) -> Column:
    return F.filter(nodes, test)


def first(nodes: Column, test: Test) -> Column:
    return F.get(F.filter(nodes, test), 0)


def of_first(nodes: Column, test: Test, make: Callable[[Column], Column]) -> Column:
    """``make`` of the first node that passes, which is looked for once; null if there is none."""
    return F.get(F.transform(F.slice(F.filter(nodes, test), F.lit(1), F.lit(1)), make), F.lit(0))


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)`` with the value worked out once, not for each element of the lambdas that ``make`` may hold."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def below(nodes: Column, node: Column) -> Column:
    """All nodes under a node of the page's ``nodes``: they lie side by side from the place after its own up to ``last``,
    so looking below all groups of a page takes time in proportion to the page."""
    return F.slice(nodes, node["ord"] + 2, node["last"] - node["ord"])


def children(nodes: Column, node: Column) -> Column:
    return F.filter(below(nodes, node), lambda n: n["parent"] == node["ord"])


def following(nodes: Column, node: Column) -> Column:
    """Siblings after a node of the page's ``nodes``."""
    last = F.coalesce(F.get(nodes, node["parent"])["last"], F.size(nodes) - 1)
    return F.filter(F.slice(nodes, node["last"] + 2, last - node["last"]), lambda n: n["parent"].eqNullSafe(node["parent"]))


def runs(items: Column, starts: Test) -> Column:
    """``items`` cut before each one that ``starts`` holds for: an array of arrays, in one pass. The first run, which may
    be empty, is what lies before the first of these."""
    cuts = F.filter(F.transform(items, lambda x, i: F.when(starts(x), i)), lambda i: i.isNotNull())
    both = F.concat(F.array(F.lit(0)), cuts, F.array(F.size(items)))
    return bound(both, lambda at: F.transform(F.slice(at, F.lit(1), F.size(at) - 1), lambda low, k: F.slice(items, low + 1, F.element_at(at, k + 2) - low)))


def tight(c: Column) -> Column:
    """Text pieces stripped and put together without anything between."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(""))


def own_text(node: Column, separator: str = " ") -> Column:
    return clean_line(F.array_join(F.coalesce(node["own"], F.array().cast("array<string>")), separator), entities=False)


def texts(found: Column, separator: str = "\n") -> Column:
    """All texts of several nodes, as they nest, one after the other."""
    return F.array_join(F.transform(found, lambda n: n["text"]), separator)


def links(pages: DataFrame, keys: list[str], page: str) -> DataFrame:
    """A row for each anchor: ``keys, ord, text, href, onclick``."""
    parsed = pages.select(*keys, parse(F.col(page), "text").alias("nodes"))
    found = parsed.select(*keys, F.explode(select(F.col("nodes"), is_tag("a"))).alias("n"))
    return found.select(*keys, F.col("n.ord").alias("ord"), strip(F.replace("n.text", F.lit("\n"), F.lit(" "))).alias("text"), F.try_element_at("n.attrs", F.lit("href")).alias("href"), F.try_element_at("n.attrs", F.lit("onclick")).alias("onclick"))


def list_entries(pages: DataFrame, family: Family, base: str, page_no: str = "page_no", page: str = "html") -> DataFrame:
    """The frontier of list pages: ``name, url, list_pos`` of links with an address and a name."""
    from lexmill.functions.urls import detail_url, safe_name

    found = links(pages, [page_no], page).where(F.col("onclick").contains(family.call))
    url = detail_url(F.col("onclick"), family, base)
    return found.select(safe_name(F.col("text")).alias("name"), url.alias("url"), (F.col(page_no).cast("long") * 1_000_000 + F.col("ord")).alias("list_pos")).where("url IS NOT NULL AND name <> ''")


def has_links(pages: DataFrame, family: Family, page: str = "html") -> bool:
    """The gate before a run: whether any page holds a link of the family. Stops at the first."""
    return not links(pages, [], page).where(F.col("onclick").contains(family.call)).limit(1).isEmpty()


def groups(nodes: Column) -> Column:
    return select(nodes, lambda n: (n["tag"] == "div") & has_class("pgroup")(n))


def label_of(nodes: Column, group: Column) -> Column:
    """The article label of a group: ``span.bl label``."""
    spans = select(below(nodes, group), lambda n: (n["tag"] == "span") & has_class("bl")(n))
    return F.get(F.flatten(F.transform(spans, lambda s: F.filter(below(nodes, s), is_tag("label")))), F.lit(0))


def page_kind(nodes: Column) -> Column:
    """STRUCTURED if a group's label starts with the article mark, PDF with a viewer frame, else UNSTRUCTURED."""
    labelled = F.exists(groups(nodes), lambda g: tight(label_of(nodes, g)["text"]).startswith("제"))
    framed = F.exists(nodes, lambda n: (n["tag"] == "iframe") & has_class("fancybox-iframe")(n))
    return F.when(labelled, "STRUCTURED").when(framed, "PDF").otherwise("UNSTRUCTURED")


def document_header(pages: DataFrame, family: Family) -> DataFrame:
    """``doc_id, title, subtitle, source_url`` with the page's nodes, from ``url, html``."""
    parsed = pages.select("url", parse(F.col("html"), "text", "flat").alias("nodes"))
    nodes = F.col("nodes")
    title = tight(of_first(nodes, lambda n: n["id"] == "conTop", lambda frame: first(below(nodes, frame), is_tag("h2"))["text"]))
    subtitle = tight(first(nodes, lambda n: (n["tag"] == "div") & has_class("ct_sub")(n))["text"])
    return parsed.select(document_id(F.col("url"), title, family.id_keys).alias("doc_id"), title.alias("title"), subtitle.alias("subtitle"), F.col("url").alias("source_url"), "nodes")


def article_number(label: Column) -> Column:
    """All digits before the bracket: an inserted article 10 of 2 counts as 102."""
    return F.regexp_replace(F.substring_index(label, "(", 1), r"(?U)[^\d]", "")


CHUNK = ("chunk_id", "doc_id", "title", "text", "metadata", "source_url")


def _carried(found: DataFrame, chapter: Callable[[Column], Column], row: Callable[[Column], list[Column]]) -> DataFrame:
    """A row ``r`` for each of ``groups``, with ``r.chapter``: the last one up to it that has a chapter (null before).

    One pass: groups are marked with their chapters, cut before each marked one, and take what their run begins with."""
    marked = found.withColumn("groups", F.transform("groups", lambda g: F.struct(*row(g), chapter(g).alias("own"))))
    cut = marked.withColumn("runs", runs(F.col("groups"), lambda g: g["own"].isNotNull()))
    told = F.flatten(F.transform("runs", lambda run: F.transform(run, lambda g: F.struct(g.alias("g"), F.get(run, F.lit(0))["own"].alias("chapter")))))
    return cut.withColumn("r", F.explode(told)).drop("groups", "runs")


def statute_chunks(documents: DataFrame) -> DataFrame:
    """Articles of statute pages (rows of :func:`document_header`). The chapter carries forward within a page.

    A page without a body has null groups, so no rows; a filter would be pushed below and parse each page a second time."""
    nodes = F.col("nodes")
    inside = of_first(nodes, lambda n: n["id"].isin(*STATUTE_BODIES) | has_class(STATUTE_BODY_CLASS)(n), lambda n: groups(below(nodes, n)))
    found = documents.withColumn("groups", inside)
    lead = lambda g: tight(first(below(nodes, g), lambda n: (n["tag"] == "p") & has_class("gtit")(n))["text"])
    chapter = lambda g: bound(lead(g), lambda c: F.when(c.rlike(CHAPTER_LEAD), c))
    rows = _carried(found, chapter, lambda g: [tight(label_of(nodes, g)["text"]).alias("label"), normal_lines(g["flat"]).alias("text")])
    number = article_number(F.col("r.g.label"))
    return rows.where(number != "").select(
        chunk_id(F.col("doc_id"), "article", number).alias("chunk_id"), "doc_id", F.col("r.g.label").alias("title"), F.col("r.g.text").alias("text"),
        F.struct(F.coalesce("r.chapter", F.lit("")).alias("chapter"), F.lit(None).cast("string").alias("source_type")).alias("metadata"), "source_url",
    )


def rule_chunks(documents: DataFrame) -> DataFrame:
    """Articles of structured rule pages: text of ``.lawcon`` only; any chapter line counts; else the document's title."""
    nodes = F.col("nodes")
    found = documents.withColumn("groups", groups(nodes)).withColumnRenamed("title", "doc_title")
    lead = lambda g: first(below(nodes, g), lambda n: (n["tag"] == "p") & has_class("gtit")(n))["flat"]
    chapter = lambda g: bound(lead(g), lambda c: F.when(c.isNotNull(), clean_spaces(c, quotes=False)))
    text = lambda g: bound(first(below(nodes, g), has_class("lawcon"))["flat"], lambda x: F.when(x.isNotNull(), normal_lines(x)))
    rows = _carried(found, chapter, lambda g: [tight(label_of(nodes, g)["text"]).alias("label"), text(g).alias("text")])
    number = article_number(F.col("r.g.label"))
    return rows.where(F.col("r.g.text").isNotNull() & (number != "")).select(
        chunk_id(F.col("doc_id"), "article", number).alias("chunk_id"), "doc_id", clean_spaces(F.col("r.g.label"), quotes=False).alias("title"), clean_spaces(F.col("r.g.text"), quotes=False).alias("text"),
        F.struct(F.coalesce(F.nullif("r.chapter", F.lit("")), "doc_title").alias("chapter"), F.lit(None).cast("string").alias("source_type")).alias("metadata"), "source_url",
    )


def section_chunks(documents: DataFrame) -> DataFrame:
    """Sections of unstructured pages: children of ``.lawcon`` (or the top nodes), cut where one starts with a Roman numeral."""
    nodes = F.col("nodes")
    found = documents.withColumn("holder", first(nodes, has_class("lawcon"))).withColumnRenamed("title", "doc_title")
    inside = F.when(F.col("holder").isNull(), F.filter(nodes, lambda n: n["parent"].isNull())).otherwise(children(nodes, F.col("holder")))
    lines = F.filter(F.transform(inside, lambda n: tight(n["text"])), lambda t: t != "")
    parts = found.withColumn("parts", F.transform(lines, lambda t: F.struct(t.alias("t"), t.rlike(ROMAN_LEAD).alias("head"))))
    cut = parts.select("doc_id", "source_url", "doc_title", F.posexplode(runs(F.col("parts"), lambda x: x["head"])).alias("no", "run")).where(F.size("run") > 0)
    head = F.get("run", F.lit(0))["head"]
    rows = cut.select("doc_id", "source_url", "doc_title", "no", head.alias("head"), F.get("run", F.lit(0))["t"].alias("lead"), F.array_join(F.transform(F.when(head, F.slice("run", 2, F.size("run"))).otherwise(F.col("run")), lambda x: x["t"]), "\n").alias("text"))
    title = F.when(F.col("head"), F.col("lead")).otherwise(F.coalesce(F.nullif("doc_title", F.lit("")), F.lit(PREAMBLE)))
    kept = rows.where((strip(F.col("text")) != "") | (strip(title) == F.col("doc_title")))
    identity = F.when(F.col("head"), chunk_id(F.col("doc_id"), "section", F.col("no"))).otherwise(chunk_id(F.col("doc_id"), "preamble"))
    return kept.select(
        identity.alias("chunk_id"), "doc_id", clean_spaces(title, quotes=False).alias("title"), clean_spaces(F.col("text"), quotes=False).alias("text"),
        F.struct(F.col("doc_title").alias("chapter"), F.lit(None).cast("string").alias("source_type")).alias("metadata"), "source_url",
    )


def _head(n: Column) -> Column:
    return (n["tag"] == "h4") & F.coalesce(F.try_element_at(n["attrs"], F.lit(USE)), F.lit("")).contains("PH/H2")


def _named(tag: str, label: str) -> Test:
    return lambda n: (_head(n) if tag == "h4" else n["tag"] == "h5") & n["line"].contains(label)


def cases(pages: DataFrame) -> DataFrame:
    """``source_url, title, subtitle1, sections`` of case pages (``url, html``)."""
    parsed = pages.select("url", parse(F.col("html"), "text", "line").alias("nodes"))
    nodes = F.col("nodes")
    title = clean_line(F.get(first(nodes, lambda n: (n["tag"] == "h2") & (F.try_element_at(n["attrs"], F.lit(USE)) == "PH/H1"))["own"], 0))
    subtitle = clean_line(F.replace(first(nodes, lambda n: (n["tag"] == "div") & has_class("subtit1")(n))["text"], F.lit("\n"), F.lit(" ")))
    either = lambda n: _head(n) | (n["tag"] == "h5")
    under = lambda nodes, test, stops: F.coalesce(of_first(nodes, test, lambda n: take_until(following(nodes, n), stops)), F.lit(""))
    sections = [under(nodes, _named("h4", label), _head).alias(label) for label in HEAD_LABELS]

    def order_of(whole: Column) -> Column:
        """Of the headings after the one of the whole text and before the next of its kind, the order's."""
        before = bound(following(nodes, whole), lambda rest: F.get(runs(rest, _head), F.lit(0)))
        return of_first(before, lambda n: (n["tag"] == "h5") & n["line"].contains(ORDER), lambda n: take_until(following(nodes, n), either))

    order = F.coalesce(of_first(nodes, _named("h4", WHOLE), order_of), F.lit(""))
    reasons = F.when(F.exists(nodes, _named("h4", WHOLE)), under(nodes, _named("h5", REASONS), either)).otherwise(F.lit(""))
    full = F.struct(order.alias(ORDER), reasons.alias(REASONS))
    return parsed.select(F.col("url").alias("source_url"), title.alias("title"), subtitle.alias("subtitle1"), F.struct(*sections, full.alias(WHOLE)).alias("sections"))


def labelled_block(nodes: Column, label: str) -> Column:
    """The text a label announces: ``dt`` (exactly) then ``dd``; ``th`` then ``td``; a heading then its next sibling;
    a node whose ``aria-label`` or ``title`` holds it; else empty."""
    after = lambda test, then: of_first(nodes, test, lambda n: first(following(nodes, n), then)["text"])
    found = [
        after(lambda n: (n["tag"] == "dt") & (n["line"] == label), is_tag("dd")),
        after(lambda n: (n["tag"] == "th") & n["line"].contains(label), is_tag("td")),
        after(lambda n: (n["tag"].isin("h3", "h4", "h5") | has_class("tit")(n)) & n["line"].contains(label), lambda n: n["ord"] >= 0),
        first(nodes, lambda n: F.coalesce(F.try_element_at(n["attrs"], F.lit("aria-label")), F.try_element_at(n["attrs"], F.lit("title")), F.lit("")).contains(label))["text"],
    ]
    return F.coalesce(*(F.nullif(clean_line(x, entities=False), F.lit("")) for x in found), F.lit(""))


def _own(nodes: Column, test: Test) -> Column:
    """The own text of all nodes that pass, as one cleaned line."""
    return clean_line(F.array_join(F.flatten(F.transform(select(nodes, test), lambda n: F.coalesce(n["own"], F.array().cast("array<string>")))), " "), entities=False)


def case_header(nodes: Column) -> Column:
    """``title, subtitle`` of a case: the first of three, and of four, places that holds text; the subtitle loses its brackets."""
    tag, attribute, value = TITLES[0]
    framed = lambda t: of_first(nodes, lambda n: n["id"] == "conTop", lambda frame: _own(below(nodes, frame), is_tag(t)))
    titles = [_own(nodes, lambda n: (n["tag"] == tag) & (F.try_element_at(n["attrs"], F.lit(attribute)) == value)), *(framed(t) for _, t in TITLES[1:])]
    subtitles = [*(_own(nodes, has_class(c)) for c in SUBTITLES), _own(nodes, lambda n: F.map_contains_key(n["attrs"], SUBTITLE_ATTRIBUTE))]
    return F.struct(first_of(*titles).alias("title"), drop_brackets(first_of(*subtitles)).alias("subtitle"))


def whole_text(blocks: dict[str, Column]) -> Column:
    """``주문, 이유``: from the block of 전문 if it names them (then the block as a whole), else from the page at large."""
    part = lambda label: F.when(blocks[WHOLE].contains(label), blocks[WHOLE]).otherwise(blocks[label]).alias(label)
    return F.struct(part(ORDER), part(REASONS))


def case_details(pages: DataFrame) -> DataFrame:
    """``source_url, title, subtitle1, sections`` of case pages of any layout (``url, html``), found by labels."""
    nodes, labels = F.col("nodes"), (*HEAD_LABELS, WHOLE, ORDER, REASONS)
    parsed = pages.select("url", parse(F.col("html"), "text", "line").alias("nodes"))
    found = parsed.select("url", case_header(nodes).alias("h"), *(labelled_block(nodes, label).alias(f"b{i}") for i, label in enumerate(labels)))
    blocks = {label: F.col(f"b{i}") for i, label in enumerate(labels)}
    sections = F.struct(*(blocks[label].alias(label) for label in HEAD_LABELS), whole_text(blocks).alias(WHOLE))
    return found.select(F.col("url").alias("source_url"), F.col("h.title").alias("title"), F.col("h.subtitle").alias("subtitle1"), sections.alias("sections"))


def statute_header(pages: DataFrame) -> DataFrame:
    """A record for each statute page (``url, html``): names, ministry and identifiers, and the lines of its body without
    noise: ``doc_id, title, short_title, ministry, efYd, lsiSeq, source_url, aliases, lang, kind, body``."""
    parsed = pages.select("url", "html", parse(F.col("html"), "text").alias("nodes"))
    nodes = F.col("nodes")
    subtitle = F.array_join(F.flatten(F.transform(select(nodes, has_class("ct_sub")), lambda n: F.transform(F.split(n["text"], "\n"), strip))), " ")
    bodies = F.flatten(F.transform(select(nodes, lambda n: n["id"].isin(*BODY_IDS)), lambda n: F.split(n["text"], "\n")))
    named = clean_spaces(F.array_join(F.flatten(F.transform(select(nodes, is_tag("h2")), lambda n: n["own"])), ""))
    seq, date = query_value(F.col("url"), "lsiSeq"), query_value(F.col("url"), "efYd")
    title = F.coalesce(F.nullif(named, F.lit("")), F.lit(STATUTE_NAME))
    brief = short_title(F.col("html"))
    return parsed.select(
        F.concat(F.lit("law:"), or_none(seq), F.lit(":"), or_none(date)).alias("doc_id"), title.alias("title"), brief.alias("short_title"), ministry(subtitle).alias("ministry"),
        date.alias("efYd"), seq.alias("lsiSeq"), without_fragment(F.col("url")).alias("source_url"), aliases(brief, named).alias("aliases"), F.lit("ko").alias("lang"), F.lit("document").alias("kind"),
        F.array_join(without_noise(F.transform(bodies, lambda x: clean_spaces(x, quotes=False))), "\n").alias("body"),
    )


def block_lines(pages: DataFrame) -> DataFrame:
    """``url, ord, line``: the blocks of each page's body, nested ones too, in document order."""
    parsed = pages.select("url", parse(F.col("html"), "text").alias("nodes"))
    nodes = F.col("nodes")
    holders = select(nodes, lambda n: n["id"].isin(*BODY_IDS))
    inside = F.filter(nodes, lambda n: n["tag"].isin("p", "div", "li", "table", "blockquote") & F.exists(holders, lambda h: (n["ord"] > h["ord"]) & (n["ord"] <= h["last"])))
    found = parsed.select("url", F.explode(inside).alias("n"))
    return found.select("url", F.col("n.ord").alias("ord"), clean_block(F.col("n.text")).alias("line")).where("line <> ''")

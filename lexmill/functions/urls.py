"""URLs and the links of list pages, as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and paths of the two list families.
STATUTE_CALL, STATUTE_PAGE, STATUTE_ID = "lsReturnSearch", "lsInfoP.do", "lsiSeq"
RULE_CALL, RULE_PAGE, RULE_ID = "admRulReturnSearch", "admRulInfoP.do", "admRulSeq"
CASE_PAGE = "precInfoP.do"
UNSAFE_IN_NAMES = r'[\\/*?:"<>|]'
# End of fixed values.


@dataclass(frozen=True)
class Family:
    """A document family: the script call of its list links, its detail page and the id's name."""

    call: str
    page: str
    id_name: str
    id_keys: tuple[str, ...]


STATUTE = Family(STATUTE_CALL, STATUTE_PAGE, STATUTE_ID, ("lsiSeq", "lsId"))
RULE = Family(RULE_CALL, RULE_PAGE, RULE_ID, ("admRulSeq", "admRulId"))


def call_arguments(onclick: Column, call: str, filled: bool = False) -> Column:
    """The quoted arguments of a script call; ``filled`` skips empty ones."""
    inside = F.regexp_extract(F.coalesce(onclick, F.lit("")), rf"{call}\((.*?)\)", 1)
    return F.regexp_extract_all(inside, F.lit("'([^']+)'" if filled else "'([^']*)'"), 1)


def detail_parts(onclick: Column, family: Family, every: bool = False, filled: bool = False) -> Column:
    """``id`` and ``date`` of a list link. The date is the first argument of eight digits, the id the last other
    number of five digits or more. Without ``every`` only one occurrence of the date is set aside; ``filled`` reads
    quoted arguments that are not empty."""
    args = call_arguments(onclick, family.call, filled)
    date = F.get(F.filter(args, lambda a: a.rlike("^[0-9]{8}$")), 0)
    numbers = F.filter(args, lambda a: a.rlike("^[0-9]{5,}$"))
    at = F.array_position(numbers, date).cast("int")
    once = F.concat(F.slice(numbers, F.lit(1), at - 1), F.slice(numbers, at + 1, F.size(numbers)))
    rest = F.when(date.isNull(), numbers).otherwise(F.array_remove(numbers, date) if every else once)
    return F.struct(F.try_element_at(rest, F.lit(-1)).alias("id"), date.alias("date"))


def detail_url(onclick: Column, family: Family, base: str, every: bool = False, filled: bool = False) -> Column:
    """The detail page of a list link; null if it has no id."""
    parts = detail_parts(onclick, family, every, filled)
    return F.when(parts["id"].isNotNull(), F.concat(F.lit(f"{base}/{family.page}?{family.id_name}="), parts["id"], F.when(parts["date"].isNull(), F.lit("")).otherwise(F.concat(F.lit("&efYd="), parts["date"]))))


def query_value(url: Column, key: str) -> Column:
    """A query parameter's first value, decoded; null if absent or empty. Works on URLs with raw non-ASCII text."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), rf"^[^?#]*\?(?:[^#]*&)?{key}=([^&#]+)", 1)
    return F.nullif(F.coalesce(F.try_url_decode(raw), raw), F.lit(""))


def document_id(url: Column, title: Column, keys: tuple[str, ...]) -> Column:
    """The first id parameter; without any, the title's ASCII letters and digits."""
    return F.coalesce(*(query_value(url, k) for k in keys), F.regexp_replace(F.coalesce(title, F.lit("")), "[^a-zA-Z0-9]", ""))


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def safe_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), UNSAFE_IN_NAMES, ""), r"(?U)\A\s+|\s+\z", "")


def page_counter(text: Column) -> Column:
    """``current`` and ``last`` of ``(3 / 14)``; 1 and 1 without a counter."""
    pattern = r"\(([0-9]+)\s*/\s*([0-9]+)\)"
    one = lambda k: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, k), F.lit("")), F.lit("9999999999")).cast("int"), F.lit(1))
    return F.struct(one(1).alias("current"), one(2).alias("last"))


def following_pages(current: Column, last: Column, most: int, from_first: bool = True) -> Column:
    """Pages still to visit, as an array: 2 to the last when on the first page, or (not ``from_first``) from the next on."""
    start = F.lit(2) if from_first else current + 1
    end = F.least(last, F.lit(most))
    here = end >= start
    if from_first:
        here = here & (current == 1)
    return F.when(here, F.sequence(start, F.greatest(start, end))).otherwise(F.array().cast("array<int>"))


def absolute(url: Column, base: Column) -> Column:
    """``url`` against ``base``: absolute, protocol-relative, root-relative, query-only and relative forms."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(F.length(page) > F.length(root), F.regexp_replace(page, "[^/]*$", "")).otherwise(F.concat(root, F.lit("/")))
    return (
        F.when(url.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), url)
        .when(url.startswith("//"), F.concat(scheme, url))
        .when(url.startswith("/"), F.concat(root, url))
        .when(url.startswith("?"), F.concat(page, url))
        .when(url.startswith("#"), F.concat(F.substring_index(base, "#", 1), url))
        .when(url == "", base)
        .otherwise(F.concat(folder, url))
    )


def case_links(hrefs: Column, onclicks: Column, base: Column) -> Column:
    """Distinct absolute case links of a list page, from hrefs and from script calls."""
    direct = F.filter(hrefs, lambda h: h.contains(f"/LSW/{CASE_PAGE}"))
    called = F.filter(F.transform(onclicks, lambda o: F.regexp_extract(o, rf"""({CASE_PAGE.replace(".", "[.]")}\?[^'"()]+)""", 1)), lambda x: x != "")
    rooted = F.transform(called, lambda x: F.concat(F.lit("/LSW/"), x))
    return F.array_sort(F.array_distinct(F.transform(F.concat(direct, rooted), lambda u: absolute(u, base))))


def is_wanted(kind: Column, url: Column, hosts: tuple[str, ...] = ()) -> Column:
    """Requests worth fetching: no images, fonts or media, and none of ``hosts``."""
    good = ~kind.isin("image", "font", "media")
    return good & ~url.rlike("|".join(h.replace(".", "[.]") for h in hosts)) if hosts else good

"""CSS selectors as expressions over a page's array of nodes.

Compounds of tag, ``*``, ``.class``, ``#id``, attributes (``[a]``, ``=``, ``~=``, ``^=``, ``$=``, ``*=``) and ``:first-child``, joined by
a blank, ``>``, ``+`` or ``~``; groups by commas. Every step looks only below, or beside, what the step before has found:
nodes lie in document order, so what is below a node is a slice, and nothing is compared with all nodes of a page.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import clean_line, strip
from lexmill.operators.html import LIST_TABLE, Test, below, bound, children, following

_PART = re.compile(r"""\*|(?P<tag>[\w-]+)|\.(?P<class>[\w-]+)|\#(?P<id>[\w-]+)|\[\s*(?P<name>[\w-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?P<quote>["']?)(?P<value>[^"'\]]*)(?P=quote)\s*)?\]|(?P<first>:first-child)""")
_STEP = re.compile(r"\s*([>+~])\s*|\s+")

# What list and detail pages must show before they are read.
DETAIL_HEAD = "#contentBody h2, #conScroll h2, h2"
DETAIL_BODY = "#contentBody, #conScroll, #content"
# End of fixed values.


def _attribute(name: str, op: str | None, value: str | None) -> Test:
    def test(n: Column) -> Column:
        held = F.try_element_at(n["attrs"], F.lit(name))
        if op is None:
            return held.isNotNull()
        told = {
            "=": held == F.lit(value),
            "~=": F.concat(F.lit(" "), F.regexp_replace(held, r"\s+", " "), F.lit(" ")).contains(f" {value} "),
            "^=": held.startswith(F.lit(value)),
            "$=": held.endswith(F.lit(value)),
            "*=": held.contains(F.lit(value)),
        }[op]
        return F.coalesce(told, F.lit(False)) & F.lit(bool(value) or op == "=")

    return test


def _compound(css: str, at: int) -> tuple[Callable[[Column, Column], Column], int]:
    """The test ``(nodes, node)`` of the compound that begins at ``at``, and where it ends."""
    tests: list[Callable[[Column, Column], Column]] = []
    while (m := _PART.match(css, at)) and m.end() > at:
        at = m.end()
        if m["tag"]:
            tests.append(lambda _, n, v=m["tag"].lower(): n["tag"] == v)
        elif m["class"]:
            tests.append(lambda _, n, v=m["class"]: n["class"].contains(f" {v} "))
        elif m["id"]:
            tests.append(lambda _, n, v=m["id"]: F.coalesce(n["id"] == v, F.lit(False)))
        elif m["name"]:
            tests.append(lambda _, n, t=_attribute(m["name"].lower(), m["op"], m["value"]): t(n))
        elif m["first"]:  # right after its parent in document order; a top node: the page's first
            tests.append(lambda _, n: n["ord"] == F.coalesce(n["parent"] + 1, F.lit(0)))
        else:
            tests.append(lambda _, n: n["ord"] >= 0)
    if not tests:
        raise ValueError(f"no selector at {css[at:]!r}")
    return lambda nodes, n: reduce(lambda a, b: a & b, (t(nodes, n) for t in tests)), at


def _steps(css: str) -> list[tuple[str, Callable[[Column, Column], Column]]]:
    out, at, combinator, css = [], 0, "", css.strip()
    while at < len(css):
        test, at = _compound(css, at)
        out.append((combinator, test))
        if at < len(css):
            m = _STEP.match(css, at)
            if not m:
                raise ValueError(f"no selector at {css[at:]!r}")
            combinator, at = m[1] or " ", m.end()
    return out


def outermost(found: Column) -> Column:
    """Nodes (in document order) without those below another of them."""
    return F.aggregate(found, F.slice(found, F.lit(1), F.lit(0)), lambda s, n: F.when((F.size(s) > 0) & (n["ord"] <= F.get(s, F.size(s) - 1)["last"]), s).otherwise(F.concat(s, F.array(n))))


def _in_order(found: Column) -> Column:
    """Different nodes in document order."""
    ordered = F.array_sort(found, lambda a, b: a["ord"] - b["ord"])
    return bound(ordered, lambda o: F.filter(o, lambda n, i: (i == 0) | (n["ord"] != F.get(o, i - 1)["ord"])))


def _passing(nodes: Column, some: Column, test: Callable[[Column, Column], Column]) -> Column:
    return F.filter(some, lambda n: test(nodes, n))


def _next(nodes: Column, found: Column, step: tuple[str, Callable[[Column, Column], Column]]) -> Column:
    return bound(found, lambda f: _step(nodes, f, *step))


def _step(nodes: Column, found: Column, combinator: str, test: Callable[[Column, Column], Column]) -> Column:
    passing = lambda some: _passing(nodes, some, test)
    if combinator == " ":
        return bound(outermost(found), lambda tops: F.flatten(F.transform(tops, lambda s: passing(below(nodes, s)))))
    if combinator == ">":
        return _in_order(F.flatten(F.transform(found, lambda s: passing(children(nodes, s)))))
    if combinator == "+":
        return _in_order(F.flatten(F.transform(found, lambda s: passing(F.slice(following(nodes, s), F.lit(1), F.lit(1))))))
    return _in_order(F.flatten(F.transform(found, lambda s: passing(following(nodes, s)))))


def css(nodes: Column, selector: str) -> Column:
    """All nodes of a page that ``selector`` names, in document order."""
    groups = []
    for one in selector.split(","):
        steps = _steps(one)
        if not steps:
            raise ValueError(f"no selector in {selector!r}")
        (_, first), *rest = steps
        groups.append(reduce(partial(_next, nodes), rest, _passing(nodes, nodes, first)))
    return groups[0] if len(groups) == 1 else _in_order(F.concat(*groups))


def css_first(nodes: Column, selector: str) -> Column:
    return F.get(css(nodes, selector), F.lit(0))


def text_from(nodes: Column, selector: str, separator: str = " ") -> Column:
    """The own texts of all nodes that ``selector`` names, joined and cleaned to one line."""
    return clean_line(F.array_join(F.flatten(F.transform(css(nodes, selector), lambda n: F.coalesce(n["own"], F.array().cast("array<string>")))), separator), entities=False)


def rich_text(nodes: Column, selector: str, separator: str = "\n") -> Column:
    """The whole texts of all nodes that ``selector`` names, those within others again, joined and cleaned to one line."""
    return clean_line(F.array_join(F.transform(css(nodes, selector), lambda n: n["flat"]), separator), entities=False)


def list_ready(nodes: Column, call: str, box: str = f"#{LIST_TABLE}") -> Column:
    """Whether a list page shows its box with a link of the family."""
    return F.size(css(nodes, f'{box} a[onclick*="{call}"]')) > 0


def detail_ready(nodes: Column, least: int = 50) -> Column:
    """Whether a detail page shows a heading of two characters and a body of more than ``least``: the first of each counts."""
    text = lambda selector: F.coalesce(strip(css_first(nodes, selector)["flat"]), F.lit(""))
    return (F.length(text(DETAIL_HEAD)) >= 2) & (F.length(text(DETAIL_BODY)) > least)

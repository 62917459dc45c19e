"""The registered queries over the engine's own operators."""

from __future__ import annotations

from importlib import import_module

from lexmill.catalog import Catalog

#: Modules that each hold a ``CATALOG``.
MODULES: tuple[str, ...] = ("text_queries", "page_queries", "table_queries", "built_queries", "stream_queries", "operator_queries")


def all_queries() -> Catalog:
    every = Catalog()
    for name in MODULES:
        part: Catalog = import_module(f"lexmill.plans.{name}").CATALOG
        for key, f in part.queries.items():
            every.add(key, part.sql.get(key))(f)
    return every

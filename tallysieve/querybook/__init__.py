"""Queries over the driver's tables, one or more per operator."""

from __future__ import annotations

from . import book, io_queries, scalar_queries, table_queries  # noqa: F401  (importing registers the queries)


def all_queries() -> dict[str, book.Query]:
    return dict(book.QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(book.ORACLES)

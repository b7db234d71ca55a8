"""The registry: name -> (query on the shared tables, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.oracle import with_views
from checks.tables import CheckTables, tables

ENTRIES: dict[str, tuple[Callable[[CheckTables], DataFrame], str | None]] = {}


def add(name: str, query: Callable[[CheckTables], DataFrame], sql: str | None = None) -> None:
    if name in ENTRIES:
        raise ValueError(f"{name} is registered twice")
    ENTRIES[name] = (query, sql)


def _bound(query):
    def run(spark, sf_dir: str) -> DataFrame:
        return query(tables(spark, sf_dir))

    return run


def _load() -> None:
    from checks import basics, given, models, reports, streams, warehouse  # noqa: F401


def all_queries() -> dict[str, Callable]:
    _load()
    return {name: _bound(query) for name, (query, _) in sorted(ENTRIES.items())}


def all_sql() -> dict[str, str]:
    _load()
    return {name: with_views(sql) for name, (_, sql) in sorted(ENTRIES.items()) if sql is not None}

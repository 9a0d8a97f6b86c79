"""Query registry: each entry is a Spark query over the test tables plus, when the
operator has an exact SQL form, the DuckDB text that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ids)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    """Import every catalog module so their ``@register`` calls run."""
    import importlib
    import pkgutil

    import chronoweave.plans as plans
    for m in pkgutil.iter_modules(plans.__path__):
        if m.name.startswith("catalog_"):
            importlib.import_module(f"chronoweave.plans.{m.name}")
    return REGISTRY

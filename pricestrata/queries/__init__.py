"""Registered queries: one callable per operator and, where possible, comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its survey ids; ``sql`` is what the comparison engine runs."""

    def add(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, tuple(ids.split()), run, sql)
        return run

    return add


def load() -> dict[str, Query]:
    import importlib
    import pkgutil

    for module in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name):
        importlib.import_module(f"{__name__}.{module.name}")
    return REGISTRY

"""Registry of paired queries: a Spark callable and, where SQL can express it, an oracle.

Each plan module decorates a ``(spark, sf_dir) -> DataFrame`` function with
``@paired(name, sql)``. The oracle states the result from the rule, in SQL of its own, for DuckDB;
it shares neither plan nor helper tables with the operator, so the pair tests the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


def paired(name: str, sql: str | None = None, covers: tuple[str, ...] = ()):
    """Register ``fn`` under ``name`` with its oracle ``sql`` (None = no SQL form)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        COVERS[name] = covers
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    import importlib
    import pkgutil

    import growthframe.plans as pkg

    for m in sorted(pkgutil.iter_modules(pkg.__path__), key=lambda x: x.name):
        if m.name != "registry":
            importlib.import_module(f"growthframe.plans.{m.name}")

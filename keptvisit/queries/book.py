"""The book of registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keptvisit.sources.fixtures import Clinic, with_views

QUERIES: dict[str, Callable[[Clinic], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **steps: str):
    """Register a query under `name`; `sql` and its named `steps` must give the same rows."""

    def register(run: Callable[[Clinic], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, **steps)
        return run

    return register


def runners() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as a function of session and data folder."""
    return {
        name: (lambda spark, folder, run=run: run(Clinic(spark, folder)))
        for name, run in QUERIES.items()
    }

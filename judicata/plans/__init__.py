"""Named queries over the driver tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and, where the semantics are
SQL-expressible, carries an independent DuckDB oracle with the same output
column names.  Importing this package fills :data:`QUERIES` and :data:`ORACLE`.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all():
    from judicata.plans import (  # noqa: F401
        courts, delay, events_q, family_q, ingest_q, jobs_q, model_q, quality, series_q, territory, text_q,
    )
    return QUERIES, ORACLE

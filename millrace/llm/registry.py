"""Queries of the language-model data operators, filled by the modules of :mod:`millrace.llm.queries`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from millrace.plans.registry import Query
from millrace.sources.tables import Tables

LLM: dict[str, Query] = {}


def llm_query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is an independent formulation, where SQL can express it."""
    def add(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in LLM:
            raise ValueError(f"query {name!r} is registered twice")
        LLM[name] = Query(run, sql)
        return run

    return add

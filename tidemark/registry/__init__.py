"""Registered queries: each runs an operator over the driver's tables, beside its SQL check."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ["market", "measures", "answers", "landing", "texts", "corpora"]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Callable], Callable]:
    """Registers ``run(market) -> DataFrame`` under a name, with SQL that gives the same rows."""
    def wrap(run: Callable) -> Callable:
        from tidemark.sources.star import Market
        if name in _queries:
            raise ValueError(f"query {name!r} is registered twice")
        _queries[name] = lambda spark, folder: run(Market(spark, folder))
        if oracle is not None:
            _oracles[name] = oracle
        return run
    return wrap


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        importlib.import_module(f"tidemark.registry.{module}")
    return dict(_queries), dict(_oracles)

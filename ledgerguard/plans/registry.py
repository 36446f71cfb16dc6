"""Query registry: name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # importing the modules registers their queries
    import importlib
    for mod in ("card_queries", "eval_queries", "wide_queries", "model_queries", "stream_queries", "demo_runs"):
        try:
            importlib.import_module(f"ledgerguard.plans.{mod}")
        except ModuleNotFoundError as exc:  # module not written yet
            if exc.name != f"ledgerguard.plans.{mod}":
                raise

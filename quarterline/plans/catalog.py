"""Registry of query plans: name -> (plan(spark, sf_dir) -> DataFrame, oracle SQL or None).

Names carry the inventory ID of the operator they exercise. Every plan reads the
driver tables (or panels Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PlanFn = Callable[[SparkSession, str], DataFrame]

_PLANS: dict[str, PlanFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: PlanFn) -> PlanFn:
        if name in _PLANS:
            raise ValueError(f"duplicate plan {name}")
        _PLANS[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def plans() -> dict[str, PlanFn]:
    _load()
    return dict(_PLANS)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # importing the plan modules fills the registry
    from . import (panel_plans, feature_plans, model_plans, segment_plans,  # noqa: F401
                   profile_plans, report_plans, window_plans, ingest_plans,
                   extra_plans, forecast_plans, hot_plans, learner_plans)

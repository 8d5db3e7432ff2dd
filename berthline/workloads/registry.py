"""Registered queries: a Spark plan over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from berthline.session import apply_recommended
from berthline.workloads.fixtures import Tables, duckdb_sql

_PLANS: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(plan: Callable[[Tables], DataFrame]):
        _PLANS[name] = plan
        if sql is not None:
            _SQL[name] = duckdb_sql(sql)
        return plan

    return add


def plans() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(Tables(apply_recommended(spark), sf_dir))

        return run

    return {name: runner(plan) for name, plan in _PLANS.items()}


def oracle() -> dict[str, str]:
    return dict(_SQL)

"""Registry of checks: name -> (Spark job over the fixture views, oracle SQL).

Spark side: ``fn(spark) -> DataFrame`` after ``tables.register(spark, sf_dir)``.
Oracle side: DuckDB SQL over the same views (prefixed with the view texts).
A check without SQL is compared on rows only by the driver and is covered by
pytest against hand-made rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import tables

CHECKS: dict[str, tuple[Callable[[SparkSession], DataFrame], str | None]] = {}


def check(name: str, oracle: str | None = None):
    def deco(fn):
        CHECKS[name] = (fn, oracle)
        return fn
    return deco


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    load_all()
    tables.register(spark, sf_dir)
    return CHECKS[name][0](spark)


def oracle(name: str) -> str | None:
    load_all()
    sql = CHECKS[name][1]
    return None if sql is None else tables.with_views(sql)


def load_all() -> None:
    from . import checks_orders, checks_pricing, checks_shipping, checks_documents  # noqa: F401

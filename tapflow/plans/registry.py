"""All registered plans and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapflow.session import ensure_checkpoint_dir, ship_package

Plan = Callable[[SparkSession, str], DataFrame]


def _prepared(fn: Plan) -> Plan:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Results are naive-UTC timestamps; keep any string rendering in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "plan")
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Plan]:
    from tapflow.plans.batch import BATCH_QUERIES
    out: dict[str, Plan] = {}
    for registry in (BATCH_QUERIES, _extra_queries()):
        for k, v in registry.items():
            out[k] = _prepared(v)
    return out


def _extra_queries() -> dict[str, Plan]:
    from tapflow.plans.io import IO_QUERIES
    from tapflow.plans.stream import STREAM_QUERIES
    return {**IO_QUERIES, **STREAM_QUERIES}


def all_oracle_sql() -> dict[str, str]:
    from tapflow.plans.oracle import ORACLE_SQL
    return dict(ORACLE_SQL)

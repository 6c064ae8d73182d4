"""All registered queries of the engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ingestion, oracle, relational, scalars
from .models import MODELS, Lakehouse


def model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    table, step = MODELS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        house = Lakehouse(spark, sf_dir, store=step.startswith("gold_") or table == "coverage")
        return house.staged(table) if step.startswith("stg_") else getattr(house, table)

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: model(name) for name in MODELS} | scalars.queries() | relational.QUERIES | ingestion.QUERIES


def oracle_sql() -> dict[str, str]:
    return {name: oracle.sql_of(step) for name, (_, step) in MODELS.items()} | scalars.oracle_sql() | relational.SQL | ingestion.SQL

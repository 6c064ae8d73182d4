"""Thresholds of the marts, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Every number that a model or check compares with; ``as_of_date`` None means the latest crawl day in the data."""

    as_of_date: date | None = None
    recent_days: int = 90
    min_history_months: int = 12
    min_active_months: int = 6
    sparse_max_months: int = 2
    min_snapshots: int = 2
    rating_trend: float = 0.05
    momentum_growth_pct: float = 20.0
    momentum_decline_pct: float = -30.0
    momentum_min_reviews: int = 5
    surging_views_a_day: float = 100.0
    bronze_to_silver_ratio: float = 0.95
    boundary_tolerance_m: float = 1000.0


DEFAULTS = Settings()

#: HotSpot never compiles a method of more bytes than this, so a wide projection in one generated method would be
#: interpreted; with this limit Spark runs such operators apart, in methods that are compiled.
METHOD_BYTES = "8000"


def tune(spark: SparkSession) -> None:
    """Lower the session's limit for generated methods, unless the user has set one."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":
        spark.conf.set(key, METHOD_BYTES)

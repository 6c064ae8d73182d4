"""Data-quality checks: each gives the rows that violate it, so that no rows is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the range; null passes."""
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad |= (c < low) if inclusive else (c <= low)
    if high is not None:
        bad |= (c > high) if inclusive else (c >= high)
    return df.where(bad)


def not_negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def expression_is_true(df: DataFrame, expression: Column) -> DataFrame:
    """Rows where it is false; null passes."""
    return df.where(~expression)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with n_records."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values (with their count) that are not accepted; null passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key the parent lacks; null passes."""
    keys = parent.select(F.col(parent_column).alias("_key"))
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def size_of(df: DataFrame, distinct: Sequence[str] | None, name: str) -> DataFrame:
    """One row: the number of rows, or of distinct keys without a null."""
    return df.agg((F.countDistinct(*distinct) if distinct else F.count(F.lit(1))).alias(name))


def row_counts(df: DataFrame, other: DataFrame, distinct: Sequence[str] | None = None) -> DataFrame:
    return size_of(df, None, "row_count").crossJoin(size_of(other, distinct, "compare_count"))  # one row each


def equal_row_count(df: DataFrame, other: DataFrame, distinct: Sequence[str] | None = None) -> DataFrame:
    return row_counts(df, other, distinct).where("row_count <> compare_count")


def row_count_ratio(df: DataFrame, other: DataFrame, low: float, high: float | None = None, distinct: Sequence[str] | None = None) -> DataFrame:
    """Violated outside low..high; nothing to compare with is the ratio 0."""
    ratio = F.when(F.col("compare_count") > 0, F.col("row_count").cast("double") / F.col("compare_count")).otherwise(F.lit(0.0))
    out = row_counts(df, other, distinct).withColumn("ratio", ratio)
    return out.where((F.col("ratio") < low) | (F.lit(False) if high is None else F.col("ratio") > high))


def reconcile(checks: dict[str, tuple[DataFrame, DataFrame]], every: bool = False) -> DataFrame:
    """check, left_value and right_value of the pairs of one-row, one-column frames that differ; ``every``: of all pairs, and ``differs``."""

    def one(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
        pair = left.toDF("left_value").crossJoin(right.toDF("right_value"))  # one row each
        return pair.select(F.lit(name).alias("check"), F.col("left_value").cast("bigint").alias("left_value"), F.col("right_value").cast("bigint").alias("right_value"))

    rows = reduce(DataFrame.unionByName, [one(n, *pair) for n, pair in checks.items()])
    differs = ~F.col("left_value").eqNullSafe(F.col("right_value"))
    return rows.withColumn("differs", differs) if every else rows.where(differs)


def missing_months(df: DataFrame, month: str, spine: DataFrame) -> DataFrame:
    """Months of the spine that have no row."""
    return spine.join(df.select(F.col(month).alias("month")), "month", "left_anti")


def key_coverage(before: DataFrame, after: DataFrame, keys: Sequence[str], least: float) -> DataFrame:
    """One row if fewer than this share of the valid keys before are there after."""
    pair = size_of(before, keys, "before").crossJoin(size_of(after, keys, "after"))  # one row each
    return pair.withColumn("ratio", F.col("after").cast("double") / F.nullif(F.col("before"), F.lit(0))).where(F.col("ratio") < least)


def report(checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """check, severity and violations of named (severity, violating rows)."""
    rows = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "violations") for name, (severity, df) in checks.items()]
    return reduce(DataFrame.unionByName, rows)


@dataclass(frozen=True)
class Gate:
    """What a stage's table must have: columns, unique keys, numbers, pairs of numbers in order, ranges, filled columns, allowed values, and rules that hold for every row."""

    columns: tuple[str, ...]
    unique: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    in_order: tuple[tuple[str, str], ...] = ()
    ranges: tuple[tuple[str, float, float], ...] = ()
    filled: tuple[str, ...] = ()
    values: tuple[tuple[str, tuple[str, ...]], ...] = ()
    rules: tuple[tuple[str, str], ...] = ()


# ---- Fixed values: the stages' contracts ----
VALIDATION = ("validation_status", ("valid", "invalid", "review", "quarantine"))
GATES = {
    "provinces": Gate(("province_id", "province_name", "min_lon", "min_lat", "max_lon", "max_lat"), unique=("province_id",), numbers=("min_lon", "min_lat", "max_lon", "max_lat"), in_order=(("min_lon", "max_lon"), ("min_lat", "max_lat"))),
    "candidates": Gate(("osm_type", "osm_id", "place_name", "latitude", "longitude", "province_id"), unique=("osm_type", "osm_id")),
    "validated": Gate(("osm_type", "osm_id", "validation_status", "spatial_status"), values=(VALIDATION,)),
    "places": Gate(
        ("place_id", "place_name", "province_id", "latitude", "longitude", "validation_status", "tourism_status", "tourism_reason", "crawl_eligible", "tourism_rule_version"),
        unique=("place_id",), ranges=(("latitude", -90, 90), ("longitude", -180, 180)),
        filled=("place_id", "place_name", "province_id", "validation_status", "tourism_status", "tourism_reason", "crawl_eligible", "tourism_rule_version"),
        values=(VALIDATION, ("tourism_status", ("eligible", "review", "rejected")), ("crawl_eligible", ("true", "false", "1", "0", "yes", "no"))),
        rules=(("crawl_eligible_as_statuses", "(lower(crawl_eligible) IN ('true', '1', 'yes')) = (lower(tourism_status) = 'eligible' AND lower(validation_status) = 'valid')"),),
    ),
}
# ---- End of fixed values ----


def gate_report(df: DataFrame, stage: str) -> DataFrame:
    """check and violations of a stage's gate: an empty table or a missing column is one violation, else rows, or keys, that fail."""
    g, have = GATES[stage], {c.lower() for c in df.columns}
    missing = [c for c in g.columns if c.lower() not in have]
    number = lambda c: F.col(c).cast("string").try_cast("double")
    fails = {f"filled:{c}": F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "" for c in g.filled}
    fails |= {f"number:{c}": number(c).isNull() for c in g.numbers}
    fails |= {f"order:{a}": number(a) > number(b) for a, b in g.in_order}
    fails |= {f"range:{c}": number(c).isNull() | ~number(c).between(lo, hi) for c, lo, hi in g.ranges}
    fails |= {f"values:{c}": F.col(c).isNotNull() & ~F.lower(F.col(c).cast("string")).isin(*allowed) for c, allowed in g.values}
    fails |= {f"rule:{name}": ~F.expr(rule) for name, rule in g.rules}
    spark = df.sparkSession
    if missing:
        return spark.createDataFrame([(f"column:{c}", 1) for c in missing], "check string, violations long")
    # all row rules in one pass over the table
    found = {name: F.count_if(F.coalesce(fail, F.lit(False))) for name, fail in fails.items()} | {"not_empty": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)}
    row = df.agg(*[v.cast("long").alias(k) for k, v in found.items()])
    out = row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").alias("violations")) for k in found])).alias("x")).select("x.*")
    if g.unique:
        out = out.unionByName(unique_combination(df, list(g.unique)).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"unique:{','.join(g.unique)}").alias("check"), "violations"))
    return out


def pass_gate(df: DataFrame, stage: str) -> None:
    """An error that names the checks of the stage that have violations."""
    failed = [r["check"] for r in gate_report(df, stage).where("violations > 0").collect()]  # a row a check
    if failed:
        raise ValueError(f"stage gate {stage}: {', '.join(failed)}")


def gate(checks: dict[str, DataFrame]) -> None:
    """An error that names the checks with violations."""
    failed = [name for name, df in checks.items() if not df.isEmpty()]
    if failed:
        raise ValueError(f"stage gate: {', '.join(failed)}")

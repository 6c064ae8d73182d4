"""Dedup, series, ranks and joins: DataFrames to DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cast import rounded
from ..sources.tables import stored
from . import scan


def live(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with all keys that are not in quarantine."""
    keep = F.coalesce("bronze_record_status", F.lit("success")) == "success"
    for k in keys:
        keep &= F.col(k).isNotNull()
    return df.where(keep)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. A full tie goes to the least hash of the row, so that runs agree."""
    tie = F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith("map")])
    rn = "_first_by"
    return df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order, tie))).where(F.col(rn) == 1).drop(rn)


def latest_by(df: DataFrame, keys: Sequence[str], at: str = "crawled_at_utc", then: Sequence[Column] = ()) -> DataFrame:
    return first_by(df, keys, [F.col(at).desc_nulls_last(), F.col("bronze_ingested_at_utc").desc_nulls_last(), *then])


def latest_observed(df: DataFrame, keys: Sequence[str], at: str = "crawled_at_utc") -> DataFrame:
    """The latest row of each key, with observation_count and first_crawled_at_utc of all its rows: one shuffle, one sort, one aggregation.

    The order is that of ``latest_by``.
    """
    rest = [c for c in df.columns if c not in keys]
    tie = F.bitwise_not(F.xxhash64(*[F.col(c) for c in df.columns]))  # of a full tie the least hash
    order = F.struct(F.col(at).alias("a"), F.col("bronze_ingested_at_utc").alias("i"), tie.alias("t"))
    # dealt by key first: a partial aggregation of rows with texts would sort all of a task's rows before the shuffle too
    one = df.repartition(*keys).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_latest"), F.count(F.lit(1)).alias("observation_count"), F.min("crawled_at_utc").alias("first_crawled_at_utc"))
    return one.select(*keys, "_latest.*", "observation_count", "first_crawled_at_utc")


def lifecycle(df: DataFrame, key: str, day: str = "bronze_crawl_date") -> DataFrame:
    """First and last day and number of days that a key was seen."""
    return df.groupBy(key).agg(F.min(day).alias("first_seen_crawl_date"), F.max(day).alias("last_seen_crawl_date"), F.countDistinct(day).alias("snapshot_count"))


def observations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("observation_count"), F.min("crawled_at_utc").alias("first_crawled_at_utc"))


def series(df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], most: int | None = scan.HOT_ROWS) -> DataFrame:
    """Adds snapshot_seq_num, prev_<day>, days_since_prev_snapshot and prev_<value> for each value.

    ``most``: keys with more rows are cut into ranges; None if days bound the rows of a key.
    """
    out = scan.followed(df, keys, [F.col(day).asc_nulls_last()], "snapshot_seq_num", [day, *values], most)
    return out.withColumn("days_since_prev_snapshot", F.datediff(day, f"prev_{day}").cast("bigint"))


def velocity(delta: Column, days: Column) -> Column:
    """Change a day, to two digits; null without a positive gap."""
    return F.when(days > 0, rounded(delta * F.lit(1.0) / days))


def conform(fact: DataFrame, places: DataFrame) -> DataFrame:
    """Place columns from the dimension where it has the place, else the fact's own. Keeps every row."""
    dim = places.select("place_id", *[F.col(c).alias(f"_dim_{c}") for c in ("place_name", "province_id", "province_name")], F.lit(True).alias("_dim"))
    out = fact.join(dim, "place_id", "left")
    names = {c: F.coalesce(f"_dim_{c}", c) if c in fact.columns else F.col(f"_dim_{c}") for c in ("place_name", "province_id", "province_name")}
    return out.withColumns(names | {"is_place_in_dim": F.coalesce("_dim", F.lit(False))}).drop(*[c for c in out.columns if c.startswith("_dim")])


def nearest_asof(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, values: Sequence[str], most: int | None = scan.HOT_ROWS) -> DataFrame:
    """For each left row the newest right row of its key up to its day, or else the first one after it.

    Both sides are put in one series a key and filled forward, and backward where nothing came before: one shuffle and
    one sort, where an equi-join would make all pairs of a key. ``right`` has one row a (key, day). ``most``: keys with
    more rows are cut into ranges; None if days bound the rows of a key.
    """
    packed = F.struct(F.col(right_day).alias(right_day), *values)
    a = left.select("*", F.col(left_day).alias("_day"), F.lit(1).alias("_side"), F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType).alias("_match"))
    b = right.select(key, F.col(right_day).alias("_day"), F.lit(0).alias("_side"), packed.alias("_match"))
    both = a.unionByName(b, allowMissingColumns=True)
    found = scan.filled(both, [key], [F.col("_day").asc_nulls_first(), F.col("_side").asc()], "_match", "_found", most).where("_side = 1")
    return found.select(*left.columns, F.col("_found")[right_day].alias(right_day), *[F.col("_found")[v].alias(v) for v in values])


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """A number from 1 over all rows in this order, without one task that sorts everything.

    Rows are cut to ranges of the order and numbered there; the ranges' sizes give each its offset. The numbered ranges
    are stored once, since a second sampling would cut them elsewhere.
    """
    pid, at = "_range", "_at"
    ranged = df.repartitionByRange(*order).withColumn(pid, F.spark_partition_id())
    local = stored(ranged.withColumn(at, F.row_number().over(Window.partitionBy(pid).orderBy(*order))), "global-rank")
    sizes = local.groupBy(pid).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = sizes.select(pid, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(F.broadcast(offsets), pid).withColumn(name, (F.col("_before") + F.col(at)).cast("bigint")).drop(pid, at, "_before")


def weighted_average(value: Column, weight: Column) -> Column:
    """Sum of value * weight over the weights of rows with a value, rounded to 2; null without such weight.

    Values have at most two decimals and weights none, so that the sums are exact and do not depend on their order.
    """
    mass = F.sum(F.when(value.isNotNull(), weight).otherwise(F.lit(0)))
    total = F.sum(F.rint(value.cast("double") * F.lit(100.0)).cast("bigint") * weight)
    return F.when(mass > 0, F.round(total.cast("double") / mass) / F.lit(100.0))


def require_ids(wanted: DataFrame, found: DataFrame, key: str) -> None:
    """An error with some of the wanted keys that are not found."""
    missing = wanted.select(key).join(found.select(key), key, "left_anti").limit(10)
    names = [str(r[0]) for r in missing.collect()]  # at most ten, for the message
    if names:
        raise ValueError(f"unknown {key}: {', '.join(names)}")


def per_key_limit(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: str) -> DataFrame:
    """The first rows of each key, as many as its column ``limit`` says."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= F.col(limit)).drop("_n")


def new_keys(batch: DataFrame, stored_keys: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows whose keys are not stored, one a key."""
    return first_by(batch.join(stored_keys.select(*keys).distinct(), list(keys), "left_anti"), keys, order)


def dealt_join(left: DataFrame, right: DataFrame, on: Sequence[str], most: int) -> DataFrame:
    """The inner join on ``on``, in which a key that more than ``most`` rows of ``left`` have is dealt to so many parts that none has more.

    The keys of ``left`` are counted, with partial sums; only rows of ``right`` with such a key are repeated, once a part.
    Keys are without nulls. ``left`` is read twice, so it should be stored or cheap.
    """
    hot = stored(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*on, F.ceil(F.col("_n") / most).cast("int").alias("_parts")), "hot-keys")
    n = hot.limit(scan.FEW + 1).count()
    if not n:
        return left.join(right, list(on))
    side = F.broadcast(hot) if n <= scan.FEW else hot
    part = F.pmod(F.xxhash64(*[F.col(c) for c, t in left.dtypes if not t.startswith("map")]), F.coalesce("_parts", F.lit(1)))
    a = left.join(side, list(on), "left").withColumn("_part", part.cast("int")).drop("_parts")
    b = right.join(side, list(on), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return a.join(b, [*on, "_part"]).drop("_part")

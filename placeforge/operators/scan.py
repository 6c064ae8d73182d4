"""Series of keys of any size: a key with more rows than a task should hold is cut into ranges that hand on what they know.

Rows of such keys are sorted by key and order over the whole cluster and cut into even ranges, so a key with a third of all
rows is many ranges. Windows run within a range. What a row needs from outside it (how many rows came before, the last row
before, the next value after) is carried from range to range by one row for each key at an end of a range. Other
keys take a plain window. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored

#: A key with more rows than this is cut into ranges.
HOT_ROWS = 1_000_000
RANGE, AT = "_range", "_at"
INSIDE = (1 << 33) - 1
#: So many hot keys may be broadcast.
FEW = 10_000


def same(keys: Sequence[str], other: str) -> Column:
    """Equal keys, null as any other, where the other side has them as <other><name>."""
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).eqNullSafe(F.col(other + k))
    return out


def by_size(df: DataFrame, keys: Sequence[str], most: int | None, plain: Callable[[DataFrame], DataFrame], ranged: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``plain`` of the keys with at most ``most`` rows and ``ranged`` of the others. None: all are plain, as the caller knows of a bound."""
    if most is None:
        return plain(df)
    hot = stored(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*[F.col(k).alias(f"_hot_{k}") for k in keys]), "hot-keys")
    n = hot.limit(FEW + 1).count()
    if not n:
        return plain(df)
    side = F.broadcast(hot) if n <= FEW else hot
    return plain(df.join(side, same(keys, "_hot_"), "left_anti")).unionByName(ranged(df.join(side, same(keys, "_hot_"), "left_semi")))


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows in the order of keys and ``order`` with their range and their place in it; stored, since another sampling would cut elsewhere.

    A full tie goes by the hash of the row, so that ties can be cut too.
    """
    tie = F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith("map")])
    whole = [*[F.col(k).asc_nulls_first() for k in keys], *order, tie]
    rows = df.repartitionByRange(*whole).sortWithinPartitions(*whole).withColumn("_id", F.monotonically_increasing_id())
    return stored(rows.select("*", F.shiftright("_id", 33).cast("int").alias(RANGE), F.col("_id").bitwiseAND(F.lit(INSIDE)).alias(AT)).drop("_id"), "ranges")


def handed_on(rows: DataFrame, keys: Sequence[str], own: dict[str, Column], carried: dict[str, Callable[[Window, Window], Column]]) -> DataFrame:
    """``rows`` with the columns ``carried``: windows over what the key's ranges before, and after, sum up to in ``own``.

    Only keys at an end of a range can go on in another: two rows a range at most are summed up, carried and broadcast.
    """
    ends = rows.groupBy(RANGE).agg(F.min_by(F.struct(*keys), AT).alias("first"), F.max_by(F.struct(*keys), AT).alias("last"))
    at_ends = ends.select(F.col(RANGE).alias("_edge"), F.explode(F.array_distinct(F.array("first", "last"))).alias("k")).select("_edge", *[F.col(f"k.{k}").alias(f"_edge_{k}") for k in keys])
    here = (F.col(RANGE) == F.col("_edge")) & same(keys, "_edge_")
    parts = stored(rows.join(F.broadcast(at_ends), here).groupBy("_edge", *[f"_edge_{k}" for k in keys]).agg(*[v.alias(c) for c, v in own.items()]), "range-sums")
    w = Window.partitionBy(*[f"_edge_{k}" for k in keys]).orderBy("_edge")  # a row a range
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    parts = parts.select("_edge", *[f"_edge_{k}" for k in keys], *[f(before, after).alias(c) for c, f in carried.items()])
    return rows.join(F.broadcast(parts), here, "left").drop("_edge", *[f"_edge_{k}" for k in keys])


def window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(RANGE, *keys).orderBy(AT)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, most: int | None = HOT_ROWS) -> DataFrame:
    """Adds the number, from 1, of a row within its key."""

    def ranged(rows: DataFrame) -> DataFrame:
        local = handed_on(cut(rows, keys, order), keys, {"_n": F.count(F.lit(1))}, {"_before": lambda before, _: F.sum("_n").over(before)})
        number = F.row_number().over(window(keys)) + F.coalesce("_before", F.lit(0))
        return local.withColumn(name, number.cast("bigint")).drop(RANGE, AT, "_before")

    plain = lambda rows: rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    return by_size(df, keys, most, plain, ranged)


def followed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], number: str, values: Sequence[str], most: int | None = HOT_ROWS) -> DataFrame:
    """Adds the row's number within its key and prev_<value>, the value of the row before, for each value."""

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumns({number: F.row_number().over(w).cast("bigint"), **{f"prev_{v}": F.lag(v).over(w) for v in values}})

    def ranged(rows: DataFrame) -> DataFrame:
        own = {"_n": F.count(F.lit(1)), "_last": F.max_by(F.struct(*values), AT)}
        local = handed_on(cut(rows, keys, order), keys, own, {"_before": lambda before, _: F.sum("_n").over(before), "_row": lambda before, _: F.last("_last").over(before)})
        w = window(keys)
        first = F.row_number().over(w) == 1
        out = local.withColumns({number: (F.row_number().over(w) + F.coalesce("_before", F.lit(0))).cast("bigint"), **{f"prev_{v}": F.when(first, F.col("_row")[v]).otherwise(F.lag(v).over(w)) for v in values}})
        return out.drop(RANGE, AT, "_before", "_row")

    return by_size(df, keys, most, plain, ranged)


def filled(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str, most: int | None = HOT_ROWS) -> DataFrame:
    """Adds the last ``value`` that is not null up to the row, or else the first one after it.

    A row with none before it is before the first of all, so that one is taken from the whole frame, in one pass: a frame
    from the row to the end would be read anew for each row.
    """
    up_to, whole = (lambda w, end=end: w.rowsBetween(Window.unboundedPreceding, end) for end in (0, Window.unboundedFollowing))

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.coalesce(F.last(value, True).over(up_to(w)), F.first(value, True).over(whole(w))))

    def ranged(rows: DataFrame) -> DataFrame:
        place = F.when(F.col(value).isNotNull(), F.col(AT))
        own = {"_first": F.min_by(value, place), "_last": F.max_by(value, place)}
        local = handed_on(cut(rows, keys, order), keys, own, {"_before": lambda before, _: F.last("_last", True).over(before), "_after": lambda _, after: F.first("_first", True).over(after)})
        w = window(keys)
        found = F.coalesce(F.last(value, True).over(up_to(w)), "_before", F.first(value, True).over(whole(w)), "_after")
        return local.withColumn(name, found).drop(RANGE, AT, "_before", "_after")

    return by_size(df, keys, most, plain, ranged)

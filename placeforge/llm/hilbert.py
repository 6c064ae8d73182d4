"""Operator 6, sharding along a Hilbert curve.

Method. The source, the language and the text's size are quantised to BITS bits each, in their order: each
column is cut to near equal numbers of bytes, counted over all rows, and what is less than a cut has a
lower code. If a column has fewer values than codes, these are dealt over the whole range. Each row gets the index of its
cell on the Hilbert curve, rows are ordered by it, and the order is cut into runs of near equal bytes. Neighbours on the
curve are neighbours in every dimension, so each shard covers a compact box, and a reader can prune files by the least
and greatest value of any of the columns, which Parquet keeps.

Scale. No global sort: the order is (cell, part, row number), where a cell has as many parts as its rows need. Bytes and
rows are summed by (cell, part); running totals over the cells (at most 2 ** (3 * BITS), whatever the input) and over
each cell's parts give each group its place, and a window in the group gives each row its own. Only numbers are shuffled;
texts never are. Rows are numbered once, in a stored table, so a lost executor's work can be done again with the
same outcome, and rows that are equal in everything are dealt to parts like others.

Cases. A null text has size 1 and the checksum of no bytes, 0. Null dimensions are a value of their own. Repeated rows
are placed each. Rows that tie in everything are interchangeable. Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ._common import fresh, materialize

BITS = 4
SHARDS = 16
#: Rows of a group of a cell, about.
ROWS_A_PART = 50_000
#: Rows of a file at most, about.
ROWS_A_FILE = 100_000


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of an (n, dims) array of numbers below 2 ** bits.

    The transpose form: undo the rotations from the highest bit down, Gray-code, then interleave the bits.
    """
    x = coords.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit = np.int64(1 << level)
        low = bit - 1
        for d in range(dims):
            flip = (x[d] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    fix = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        fix ^= np.where((x[dims - 1] & np.int64(1 << level)) != 0, np.int64((1 << level) - 1), 0)
    x ^= fix
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> level) & 1)
    return out


def curve(*dims: Column) -> Column:
    """The curve index of quantised columns."""

    @pandas_udf("long")
    def index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([a.to_numpy(), b.to_numpy(), c.to_numpy()], axis=1), BITS))

    return index(*dims)


def cuts_of(sample: list[tuple], levels: int) -> list:
    """Values that cut (value, bytes) pairs into ``levels`` runs of near equal bytes, each once; a row's code is how many are up to its value."""
    order = sorted(sample)
    different = sorted({v for v, _ in order})
    if len(different) <= levels:  # each value has a code of its own
        return different[1:]
    ends = np.cumsum([n for _, n in order])
    places = np.searchsorted(ends, np.arange(1, levels) * (float(ends[-1]) / levels))
    return sorted({order[k][0] for k in places} - {order[0][0]})


def all_cuts(rows: DataFrame, column: str, levels: int) -> list:
    """``cuts_of`` over the bytes of all rows: values are summed up, ranked in ranges, and only those where a run ends are collected."""
    sums = materialize(rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.sum("size").alias("n")), "shard-values")
    few = sums.limit(levels + 1).collect()  # one more than there are codes
    if len(few) <= levels:
        return cuts_of([(r["v"], r["n"]) for r in few], levels)
    ranged = materialize(sums.repartitionByRange("v").withColumn("range", F.spark_partition_id()), "shard-ranges")
    sizes = ranged.groupBy("range").agg(F.sum("n").alias("bytes"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = sizes.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("at"))
    total, least = sums.agg(F.sum("n"), F.min("v")).first()
    inside = Window.partitionBy("range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ends = ranged.join(F.broadcast(offsets), "range").select("v", "n", (F.col("at") + F.sum("n").over(inside)).alias("end"))
    run = lambda c: f"CAST(({levels} * CAST({c} AS DECIMAL(30,0))) div {int(total)} AS BIGINT)"
    ended = ends.where(F.least(F.expr(run("end")), F.lit(levels - 1)) > F.expr(run("end - n")))
    return sorted({r["v"] for r in ended.select("v").collect()} - {least})  # at most levels - 1


def code(value: Column, cuts: list, kind: str, levels: int = 1 << BITS) -> Column:
    """0 .. levels - 1, in the order of the values; nulls are before all."""
    if not cuts:
        return F.lit(0)
    place = F.coalesce(F.size(F.filter(F.array(*[F.lit(c).cast(kind) for c in cuts]), lambda c: c <= value)), F.lit(0))
    return F.floor(place * levels / (len(cuts) + 1)).cast("int")


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", shards: int = SHARDS, carry: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, cell, shard and slot of every row; with ``carry`` also ``row``, a struct of all its columns."""
    row = ["row"] if carry else []
    there = F.coalesce(F.col(text), F.lit(""))
    size = (F.octet_length(there) + 1).cast("long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), size.alias("size"), F.crc32(F.encode(there, "UTF-8")).alias("text_crc32"), F.col(source).cast("string").alias("a"), F.col(lang).cast("string").alias("b"), *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if carry else []))
    rows = materialize(rows.withColumn("number", F.monotonically_increasing_id()), "shard-rows")
    codes = [code(F.col(c), all_cuts(rows, c, 1 << BITS), kind) for c, kind in (("a", "string"), ("b", "string"), ("size", "long"))]
    rows = rows.select("doc_id", "size", "text_crc32", "number", curve(*codes).alias("cell"), *row)
    cells = materialize(rows.groupBy("cell").agg(F.sum("size").alias("cell_bytes"), F.count(F.lit(1)).alias("cell_n")), "shard-cells")
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # over at most 2 ** (3 * BITS) cells
    cells = cells.select("cell", F.ceil(F.col("cell_n") / ROWS_A_PART).alias("parts"), F.coalesce(F.sum("cell_bytes").over(before), F.lit(0)).alias("cell_at"), F.coalesce(F.sum("cell_n").over(before), F.lit(0)).alias("cell_rank"))
    rows = rows.join(F.broadcast(cells), "cell").withColumn("part", F.pmod(F.xxhash64("number"), F.col("parts")))
    groups = materialize(rows.groupBy("cell", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.first("cell_at").alias("cell_at"), F.first("cell_rank").alias("cell_rank")), "shard-groups")
    inside = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each ROWS_A_PART rows
    at = groups.select("cell", "part", (F.col("cell_at") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))).alias("at"), (F.col("cell_rank") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("rank"))
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(1))).first()[0]
    own = Window.partitionBy("cell", "part").orderBy("number")
    placed = rows.drop("cell_at", "cell_rank", "parts").withColumns({"own_rank": F.row_number().over(own) - 1, "own_at": F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0))})
    placed = placed.join(at, ["cell", "part"]).withColumns({"rank": F.col("rank") + F.col("own_rank"), "end": F.col("at") + F.col("own_at")})
    middle = (2 * F.col("end") - F.col("size")).cast("decimal(38,0)")  # twice the middle byte
    cut = F.least(F.floor(middle * shards / (2 * F.lit(int(total)))).cast("int"), F.lit(shards - 1))
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "cell", cut.alias("shard"), "rank", *row), "shard-placed")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("first_rank")))  # a row a shard
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", "cell", F.col("shard").cast("int"), (F.col("rank") - F.col("first_rank")).cast("long").alias("slot"), *row)


def write_shards(docs: DataFrame, path: str, **columns) -> None:
    """Write ``docs`` as a Parquet folder a shard, in curve order. Each row is carried to its place, so repeated rows and null ids stay; a column ``shard`` gives way to the folder's."""
    placed = shard(docs, carry=True, **columns)
    own = [c for c in docs.columns if c.lower() != "shard"]
    at = fresh(docs.drop("shard"), "_slot")[0]
    out = placed.select(*[F.col("row")[c].alias(c) for c in own], "shard", F.col("slot").alias(at))
    dealt = out.repartition(F.col("shard"), F.floor(F.col(at) / ROWS_A_FILE)).sortWithinPartitions("shard", at)
    dealt.drop(at).write.partitionBy("shard").parquet(path)

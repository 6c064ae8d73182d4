"""What the operators of this subpackage share: shared storage, size-checked broadcasts, fresh column names."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most this many rows and bytes may be broadcast; beyond it, joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20
#: White space as the word rules of this package know it: blank and the controls 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
BLANKS = " \t\n\x0b\f\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where none is set and all runs in one process."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="placeforge-")
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(df: DataFrame) -> Column:
    """Bytes of a row, about: of texts and lists as many as they have, of the rest eight a column."""
    sizes = {"string": F.octet_length, "binary": F.octet_length, "array": lambda c: 16 * F.size(c), "map": lambda c: 32 * F.size(c)}
    parts = [sizes[k](c) for c, kind in df.dtypes if (k := kind.split("<")[0]) in sizes]
    return sum((F.coalesce(p, F.lit(0)) for p in parts), F.lit(8 * len(df.columns)))


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint if it has at most ``rows`` rows of at most ``size`` bytes together, and whether it has. ``df`` should be materialized."""
    n, held = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width(df)), F.lit(0))).first()
    fits = n <= rows and held <= size
    return (F.broadcast(df) if fits else df), fits


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (Spark compares them without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs without blanks and the controls 9 to 13; a null text has none."""
    left = F.ltrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    # a trim at the right goes over the whole text, so only those that end in a blank get one
    ends = reduce(Column.__or__, [F.endswith(left, F.lit(c)) for c in BLANKS])
    bare = F.when(ends, F.rtrim(left, F.lit(BLANKS))).otherwise(left)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE}+", -1))


def unit_interval(*parts: Column) -> Column:
    """A number in [0, 1) that only the parts decide: the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def hash_sample(df: DataFrame, by: str, total: int, size: int) -> DataFrame:
    """The ``size`` rows of least hash of a column, of ``total`` rows; the same in every run.

    A filter on the hash comes before the sort, so all tasks together hand on a quarter more than ``size`` rows, not each of
    them ``size``.
    """
    h = F.xxhash64(F.col(by).cast("string"))
    share = (5 * size + 4 * 64 * 16) / (4 * max(total, 1))  # with room for chance where the sample is small
    near = df.where(F.pmod(h, F.lit(1 << 40)) < int(share * (1 << 40))) if share < 1 else df
    return near.orderBy(F.pmod(h, F.lit(1 << 40)), h, by).limit(size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

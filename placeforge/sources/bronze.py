"""Reading landed files: partitioned JSON lines, broken JSON, CSV of several layouts, the newest partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cast import repair_json
from .tables import file_system

PARTITION = "crawl_date"


def strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def partition_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"crawl_date=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit(""))


def read_jsonl(spark: SparkSession, root: str, fields: Sequence[str], since: str | None = None) -> DataFrame:
    """JSON lines under crawl_date= folders, every field text, fields that a file lacks null; with file_path and crawl_date.

    ``since`` prunes partitions.
    """
    df = spark.read.schema(strings([*fields, PARTITION])).option("basePath", root).json(root)
    df = df.withColumns({"file_path": F.col("_metadata.file_path"), PARTITION: F.col(PARTITION).cast("string")})
    return df.where(F.col(PARTITION) >= since) if since else df


def read_landed(spark: SparkSession, root: str, dataset: str, fields: Sequence[str], quarantine: bool = False, since: str | None = None) -> DataFrame:
    """The rows of committed batches that ``sinks.land`` wrote, accepted or quarantined, with file_path and crawl_date."""
    rows = read_jsonl(spark, f"{root}/{'quarantine/' if quarantine else ''}{dataset}", [*fields, "batch"], since)
    committed = spark.read.schema(strings(["run_id", "batch"])).json(f"{root}/_commits/{dataset}").select("batch")
    return rows.join(F.broadcast(committed), "batch", "left_semi").drop("batch")  # a name a batch


def read_text_json(spark: SparkSession, root: str, fields: Sequence[str]) -> DataFrame:
    """The same from files with NaN and Infinity tokens: lines as text, repaired, then parsed; blank lines go."""
    lines = spark.read.text(root).select(F.col("value"), F.col("_metadata.file_path").alias("file_path")).where(F.trim("value") != "")
    parsed = F.from_json(repair_json(F.col("value")), strings(fields))
    return lines.select(parsed.alias("j"), "file_path", partition_of(F.col("file_path")).alias(PARTITION)).select("j.*", "file_path", PARTITION)


def read_csv(spark: SparkSession, path: str, drop_malformed: bool = False) -> DataFrame:
    """CSV with a header, all text, missing values as '', a byte-order mark taken from the first name."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE").csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns]).na.fill("")


def read_csv_layouts(spark: SparkSession, path: str, layouts: Sequence[Sequence[str]]) -> DataFrame:
    """CSV without trusting its header: each row by its number of columns, as the last (newest) layout; others raise.

    Columns that an older layout lacks are null. Fields must not hold line ends.
    """
    newest = list(layouts[-1])
    width = max(map(len, layouts))
    wide = spark.read.schema(strings([f"_c{k}" for k in range(width + 1)])).option("mode", "PERMISSIVE").option("escape", '"').option("nullValue", "\x00").option("emptyValue", "").csv(path)
    n = F.size(F.filter(F.array(*[F.col(f"_c{k}") for k in range(width + 1)]), lambda v: v.isNotNull()))
    parts = None
    for layout in layouts:
        rows = wide.where((n == len(layout)) & (F.col("_c0") != layout[0]))
        at = {c: k for k, c in enumerate(layout)}
        frame = rows.select(*[(F.col(f"_c{at[c]}") if c in at else F.lit(None).cast("string")).alias(c) for c in newest])
        parts = frame if parts is None else parts.unionByName(frame)
    odd = wide.where(~n.isin(*map(len, layouts)))
    guard = odd.select(F.raise_error(F.lit("a row of neither layout")).cast("string").alias("x")).select(*[F.col("x").alias(c) for c in newest])
    return parts.unionByName(guard)


def newest_partition(spark: SparkSession, root: str, fields: Sequence[str]) -> DataFrame:
    """The rows of JSON lines in the last crawl_date= folder; no other folder is read.

    The date comes from the folders' names: a scan of the partition column alone reads no file, and the filter is a literal.
    """
    last = newest_date(spark, root)
    return read_jsonl(spark, root, fields).where(F.col(PARTITION) == F.lit(last)) if last else read_jsonl(spark, root, fields).limit(0)


def newest_date(spark: SparkSession, root: str) -> str | None:
    """The greatest date among the crawl_date= folders that stand right in the dataset's folder."""
    fs, path = file_system(spark, root)
    names = [str(f.getPath().getName()) for f in fs.listStatus(path) if f.isDirectory()]
    return max((n.split("=", 1)[1] for n in names if n.startswith(f"{PARTITION}=")), default=None)

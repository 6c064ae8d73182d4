"""Writing: appended partitions, tables that are replaced, files that must be new, and the check afterwards."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import ingest
from .tables import exists, remove, swap


def land(df: DataFrame, root: str, dataset: str, run_id: str, now: Column, batch: str | None = None, **stamps) -> dict[str, int] | None:
    """Add accepted rows to <root>/<dataset> and the others to <root>/quarantine/<dataset>, by batch and event date.

    Both sides are written, then the batch is committed by one marker in <root>/_commits/<dataset>, and readers
    (``bronze.read_landed``) take committed batches only. So a batch that failed between the two writes is not seen, and one that
    is run again replaces what it left; a batch that is committed already is not written again, and None is returned. Without
    ``batch`` the run is the batch. ``stamps`` go to ``ingest.stamped``. The rows are stamped once and read for both writes. Returns how many went where.
    """
    spark, batch = df.sparkSession, batch or run_id
    marker = f"{root}/_commits/{dataset}/batch={batch}"
    if exists(spark, f"{marker}/_SUCCESS"):
        return None
    stamped = ingest.stamped(df, dataset, run_id, now, **stamps).persist()
    counts = {}
    try:
        for (side, place), rows in zip((("success", dataset), ("quarantine", f"quarantine/{dataset}")), ingest.split(stamped), strict=True):
            seen = Observation()
            write_side(rows.observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/{place}/batch={batch}")
            counts[side] = seen.get["n"]
    finally:
        stamped.unpersist()
    spark.createDataFrame([(run_id, counts["success"], counts["quarantine"])], "run_id string, success long, quarantine long").coalesce(1).write.mode("overwrite").json(marker)
    return counts


def write_side(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").partitionBy("crawl_date").json(folder)


def write_new(df: DataFrame, path: str) -> None:
    """JSON lines at a path that must not exist."""
    df.write.mode("errorifexists").json(path)


def replace(df: DataFrame, path: str, write: Callable[[DataFrame, str], None], attempts: int = 3, wait_s: float = 3.0) -> int:
    """Replace a folder by what ``write`` makes of the frame: written beside it, counted, then put in its place by renaming.

    The old folder stays until the new one is whole, whatever fails, and the frame may read it. A failed write is tried again,
    ``attempts`` times in all. Returns the number of rows; an empty frame is refused.
    """
    spark = df.sparkSession
    for attempt in range(1, attempts + 1):
        beside, seen = f"{path}.new-{uuid.uuid4().hex}", Observation()
        try:
            write(df.observe(seen, F.count(F.lit(1)).alias("n")), beside)
            break
        except Exception:
            remove(spark, beside)
            if attempt == attempts:
                raise
            time.sleep(wait_s)
    if not seen.get["n"]:
        remove(spark, beside)
        raise ValueError(f"no rows for {path}")
    swap(spark, beside, path)
    return seen.get["n"]


def write_table(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def replace_table(df: DataFrame, path: str, attempts: int = 3, wait_s: float = 3.0) -> int:
    """Replace a Parquet table, columns included."""
    return replace(df, path, write_table, attempts, wait_s)


def verify_table(df: DataFrame, path: str) -> int:
    """The stored number of rows, if it is that of the source and not 0; else an error."""
    stored, source = df.sparkSession.read.parquet(path).count(), df.count()
    if stored != source or not stored:
        raise ValueError(f"{path}: {stored} rows stored, {source} in the source")
    return stored


def sync_dataset(df: DataFrame, path: str, partition: str = "crawl_date", attempts: int = 3, wait_s: float = 3.0) -> int:
    """Replace a partitioned dataset of JSON lines."""
    return replace(df, path, lambda rows, beside: rows.write.partitionBy(partition).json(beside), attempts, wait_s)


def append_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append rows as CSV with this order of columns."""
    df.select(*columns).write.mode("append").option("header", True).csv(path)

"""Structured Streaming over landed feeds. ``*_to_end`` run a stream over a stored table until it is used up.

What a batch writes goes under its number and replaces what a failed run of the same batch left, so each row is written once.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources import sinks
from ..sources.tables import new_path
from .keys import KeyStore

C = F.col
#: How late a row may come to its day's or month's count, and how far apart repeats of a key are still seen.
LATE, HORIZON = "1 day", "31 days"
#: How long the status of an item is kept without news of it, in the time of the events.
STATUS_TTL = "90 days"
STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on disk and by key, which user-defined state needs."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


def files(spark: SparkSession, path: str, schema, per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def split_ingest(stream: DataFrame, root: str, dataset: str, run_id: str, now, checkpoint: str):
    """Each micro-batch validated and committed once, accepted and quarantined together. Late rows go to the day they belong to."""
    return start(stream, lambda batch, n: sinks.land(batch, root, dataset, f"{run_id}-{n}", now), checkpoint)


def dedup_within(stream: DataFrame, keys: list[str], at: str, horizon: str) -> DataFrame:
    """One row a key within the horizon; state is dropped behind the watermark."""
    return stream.withWatermark(at, horizon).dropDuplicatesWithinWatermark(keys)


def dedup_forever(stream: DataFrame, keys: list[str], path: str, checkpoint: str, order: list[str]):
    """Keys without horizon, in a ``KeyStore`` under ``path``; a batch reads only the buckets of its own keys."""
    store = KeyStore(stream.sparkSession, path, tuple(keys))
    return start(stream, lambda batch, n: store.add(batch, n, order), checkpoint)


def dedup_state(stream: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key for as long as the stream runs, the keys in the stream's own state: start it within ``keyed_state``."""
    return stream.dropDuplicates(keys)


class Latest(StatefulProcessor):
    """Keeps the newest event of an item, by time and number; gives out an item whenever its newest event changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.latest = handle, handle.getValueState("latest", "at_us long, seq long, status string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = tuple(self.latest.get()) if self.latest.exists() else None
        order = lambda r: tuple((x is not None, x or 0) for x in r[:2])
        new = max(((r.at_us, r.seq, r.status) for r in rows), key=order)
        if old is None or order(new) > order(old):
            self.latest.update(new)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if new[0] is not None:
                self.handle.registerTimer(max(new[0] // 1000, timerValues.getCurrentWatermarkInMs()) + 1)
            yield Row(item=key[0], at_us=new[0], seq=new[1], status=new[2])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.latest.clear()
        return iter(())

    def close(self) -> None:
        pass


def latest_status(stream: DataFrame, key: str, ttl: str = STATUS_TTL) -> DataFrame:
    """item, at, seq and status of each item whose newest event a batch has changed, for output mode update.

    One row of state an item. It goes, by a timer, when the watermark passes the item's newest event, that is when other
    items have events ``ttl`` after it; events that old are not looked at. Start it within ``keyed_state``.
    """
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.withColumn("at", C("at").cast("timestamp")).withWatermark("at", ttl).select(C(key).alias("item"), "at", F.unix_micros("at").alias("at_us"), "seq", "status")
    out = rows.groupBy("item").transformWithState(Latest(), f"item {kind}, at_us long, seq long, status string", "Update", "EventTime")
    return out.select("item", F.timestamp_micros("at_us").alias("at"), "seq", "status")


def daily_counts(stream: DataFrame, at: str, by: str, late: str) -> DataFrame:
    """Counts by day windows; a window is given out once the watermark has passed it."""
    return stream.withWatermark(at, late).groupBy(F.window(at, "1 day"), by).agg(F.count(F.lit(1)).alias("n"))


class Months(StatefulProcessor):
    """Adds up the days of a month, gives the month out when the watermark has passed its end, and forgets it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.total = handle, handle.getValueState("total", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.total.get()[0] if self.total.exists() else 0
        self.total.update((before + sum(r.n for r in rows),))
        month = key[1]
        following = datetime.datetime(month.year + month.month // 12, month.month % 12 + 1, 1, tzinfo=datetime.timezone.utc)
        self.handle.registerTimer(int(following.timestamp() * 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n = self.total.get()[0]
        self.total.clear()
        yield Row(by=key[0], month=key[1], n=n)

    def close(self) -> None:
        pass


def monthly_counts(stream: DataFrame, at: str, by: str, late: str) -> DataFrame:
    """by, month and n of months that the watermark has passed, each given out once, in UTC.

    Calendar months are no windows of a fixed length: days are counted first, with partial sums, and a second operator
    adds the days that are given out. Its state is one number a month that is open.
    """
    days = daily_counts(stream, at, by, late).select(C(by).alias("by"), C("window").alias("window"), "n")
    days = days.select("by", F.window_time("window").alias("at"), "n").withColumn("month", F.trunc(C("at").cast("date"), "MM"))
    kind = stream.schema[by].dataType.simpleString()
    return days.groupBy("by", "month").transformWithState(Months(), f"by {kind}, month date, n long", "Append", "EventTime")


def stored_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table as a stream."""
    path = f"{sf_dir}/{name}.parquet"
    stored = spark.read.parquet(path)
    whole = spark.readStream.schema(stored.schema)
    files_ = stored.select("_metadata.file_path").limit(1).first()
    if files_ is None or not files_[0].endswith(f"/{name}.parquet"):
        return whole.parquet(path)
    return whole.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)  # a single file is read through its folder


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_stream(spark, sf_dir, "events")


def to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what there is now, and read what it wrote, with the number of the batch as ``batch``."""
    spark = stream.sparkSession
    path = new_path(spark, name)
    start(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch={n}"), f"{path}-state", mode).awaitTermination()
    return spark.read.schema(T.StructType([*stream.schema, T.StructField("batch", T.LongType())])).parquet(path)


def ingest_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.bronze import read_landed

    rows = events(spark, sf_dir).select(C("event_id"), F.concat(F.lit("p"), "user_id").alias("place_id"), F.lit("e").alias("error_type"), F.when(C("event_id") % 4 != 0, C("ts").cast("string")).alias("failed_at"))
    root = new_path(spark, "stream-landing")
    split_ingest(rows, root, "google_maps/errors", "run", F.lit("2026-02-01 00:00:00").cast("timestamp_ntz"), f"{root}-state").awaitTermination()
    parts = [read_landed(spark, root, "google_maps/errors", ["event_id", "record_status"], quarantine) for quarantine in (False, True)]
    return parts[0].unionByName(parts[1]).select(C("event_id").cast("long").alias("event_id"), "record_status")


def distinct_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stream-keys")
    rows = events(spark, sf_dir).select("user_id", "event_type", "event_id")
    dedup_forever(rows, ["user_id", "event_type"], path, f"{path}-state", ["event_id"]).awaitTermination()
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


def status_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item and status: what the stream gave out last of each item."""
    log = events(spark, sf_dir).select(C("user_id").alias("item"), C("ts").alias("at"), C("event_id").alias("seq"), F.when(C("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"))
    with keyed_state(spark):
        changes = to_end(latest_status(log, "item"), "stream-status", "update")
    return changes.groupBy("item").agg(F.max_by("status", "batch").alias("status"))


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("ts", C("ts").cast("timestamp"))


def daily_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that the watermark has passed, each given out once; the last ones stay in the state."""
    counts = daily_counts(timed(spark, sf_dir), "ts", "event_type", LATE).select("event_type", C("window.start").cast("date").alias("day"), "n")
    return to_end(counts, "stream-daily").drop("batch")


def monthly_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of orders that the watermark has passed, each given out once."""
    rows = stored_stream(spark, sf_dir, "orders").select(C("o_orderdate").cast("timestamp").alias("at"), "o_orderstatus")
    with keyed_state(spark):
        return to_end(monthly_counts(rows, "at", "o_orderstatus", LATE), "stream-monthly").drop("batch")


def recent_distinct_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a user and type of event within the horizon, as user_id and event_type."""
    rows = dedup_within(timed(spark, sf_dir), ["user_id", "event_type"], "ts", HORIZON).select("user_id", "event_type")
    return to_end(rows, "stream-recent").drop("batch")

"""Failures between writes, retries, restarts and expiry: streams and sinks."""

import datetime

import pytest
from pyspark.sql import functions as F
from test_streams import at, batches

from placeforge.sources import bronze, sinks
from placeforge.sources.tables import exists
from placeforge.streaming import streams
from placeforge.streaming.keys import KeyStore

ERRORS = "google_maps/errors"



def now():
    return F.lit("2026-02-01 00:00:00").cast("timestamp_ntz")


def landed(spark, root, quarantine=False):
    return sorted(r.place_id for r in bronze.read_landed(spark, root, ERRORS, ["place_id"], quarantine).collect())


def rows(spark, ids):
    """Errors of places; an odd id has no time and goes to quarantine."""
    return spark.createDataFrame([(f"p{k}", "e", None if k % 2 else "2026-01-05T00:00:00Z") for k in ids], "place_id string, error_type string, failed_at string")


def test_a_batch_that_fails_between_its_two_writes_is_landed_once(spark, tmp_path, monkeypatch):
    root, write, calls = str(tmp_path), sinks.write_side, []

    def broken(df, folder):
        calls.append(folder)
        if len(calls) == 4:  # the second batch's quarantine
            raise RuntimeError("lost")
        write(df, folder)

    monkeypatch.setattr(sinks, "write_side", broken)
    sinks.land(rows(spark, [0, 1]), root, ERRORS, "run", now(), "0")
    with pytest.raises(RuntimeError):
        sinks.land(rows(spark, [2, 3]), root, ERRORS, "run", now(), "1")
    assert landed(spark, root) == ["p0"] and landed(spark, root, True) == ["p1"]  # half a batch is not seen
    assert sinks.land(rows(spark, [2, 3]), root, ERRORS, "run", now(), "1") == {"success": 1, "quarantine": 1}
    assert sinks.land(rows(spark, [2, 3, 4]), root, ERRORS, "run", now(), "1") is None  # committed: not written again
    assert landed(spark, root) == ["p0", "p2"] and landed(spark, root, True) == ["p1", "p3"]


def test_a_stream_goes_on_after_a_failed_batch(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    stream = batches(spark, source, [[(k, "e", at(1 + k))] for k in range(4)])
    stream = stream.select(F.concat(F.lit("p"), "user_id").alias("place_id"), F.col("event_type").alias("error_type"), F.when(F.col("user_id") % 2 == 0, F.col("ts").cast("string")).alias("failed_at"))
    write, failed = sinks.write_side, []

    def broken(df, folder):
        if "quarantine" in folder and folder.endswith("-2") and not failed:
            failed.append(folder)
            raise RuntimeError("lost")
        write(df, folder)

    monkeypatch.setattr(sinks, "write_side", broken)
    with pytest.raises(Exception, match="lost"):
        streams.split_ingest(stream, root, ERRORS, "run", now(), f"{root}-state").awaitTermination()
    assert landed(spark, root) == ["p0"]
    streams.split_ingest(stream, root, ERRORS, "run", now(), f"{root}-state").awaitTermination()
    assert failed and landed(spark, root) == ["p0", "p2"] and landed(spark, root, True) == ["p1", "p3"]


def files_read(df):
    """Files that the plan's scan opens, after partitions are pruned."""
    return df._jdf.queryExecution().sparkPlan().collectLeaves().apply(0).selectedPartitions().totalNumberOfFiles()


def test_key_store_reads_few_files_and_survives_retries(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path), ("k", "s"), buckets=4, fan=3)
    frame = lambda keys: spark.createDataFrame([(k, s, o) for o, (k, s) in enumerate(keys)], "k long, s string, _o int")
    seen, sizes = set(), []
    for n in range(14):
        keys = [(n * 3 + j, "x") for j in range(5)] + [(None, "x"), (None, None), (n % 4, None)] * 2
        for _ in range(2 if n in (2, 8, 9) else 1):  # a batch that ends in a merge runs again, and so does one after it
            new = sorted(map(tuple, store.add(frame(keys), n, ["_o"]).collect()), key=repr)
            assert new == sorted(set(keys) - seen, key=repr)
        seen |= set(keys)
        one = store.hashed(frame([(0, "x")]))
        sizes.append(files_read(store.known(one, n + 1)))
    assert store.segments(14) == [(0, 9), (9, 12), (12, 13), (13, 14)]
    assert max(sizes) <= 2 * 3  # one bucket, at most two segments of a size
    assert sorted(map(tuple, store.all(14, store.hashed(frame([(0, "x")])).select("k", "s", "_hash", "_bucket").schema).collect()), key=repr) == sorted(seen, key=repr)
    assert not exists(spark, store.segment(0, 1)) and not exists(spark, store.segment(3, 6))


def test_status_gives_out_changes_and_forgets_old_items(spark, tmp_path):
    parts = [[(1, "SUCCESS", at(1)), (2, "FAILED", at(1))], [(1, "FAILED", at(1)), (2, "SUCCESS", at(2))], [(1, "SUCCESS", at(1, 1)), (2, "SUCCESS", at(1))], [(3, "SUCCESS", at(20))], [(3, "SUCCESS", at(21))], [(1, "FAILED", at(19))]]
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def run(n):
        stream = batches(spark, source, parts[:n]) if n else streams.files(spark, f"{source}/*", "user_id long, event_type string, ts timestamp", per_trigger=1)
        log = stream.select(F.col("user_id").alias("item"), F.col("event_type").alias("status"), F.col("ts").alias("at"), F.lit(0).cast("long").alias("seq"))
        with streams.keyed_state(spark):
            streams.start(streams.latest_status(log, "item", "10 days"), lambda b, k: b.write.mode("overwrite").parquet(f"{out}/batch={k}"), state, "update").awaitTermination()

    run(6)
    got = sorted((r.batch, r.item, r.status) for r in spark.read.parquet(out).collect())
    # batch 2 changes nothing of item 2 (older), batch 1 nothing of item 1 (a tie); items 1 and 2 are forgotten after day 20
    changes = [(i, s) for _, i, s in got]
    assert sorted(changes) == sorted([(1, "SUCCESS"), (2, "FAILED"), (2, "SUCCESS"), (1, "SUCCESS"), (3, "SUCCESS"), (3, "SUCCESS"), (1, "FAILED")])
    run(0)  # started again, it has nothing to give out
    assert spark.read.parquet(out).count() == len(got)


def test_months_are_given_out_once_when_they_are_over(spark, tmp_path):
    day = lambda m, d, h=0: datetime.datetime(2024, m, d, h)
    parts = [[(1, "a", day(1, 3)), (2, "a", day(1, 31, 23)), (3, "b", day(1, 5))], [(4, "a", day(2, 1)), (5, "a", day(1, 30))], [(6, "a", day(2, 4))], [(7, "a", day(1, 9))], [(8, "a", day(2, 29, 22))], [(9, "a", day(4, 2))], [(9, "b", day(4, 3))]]
    stream = batches(spark, str(tmp_path), parts)
    with streams.keyed_state(spark):
        got = streams.to_end(streams.monthly_counts(stream, "ts", "event_type", "2 days"), "months").collect()
    # the late row of the second batch counts, that of the fourth comes after its day was given out
    assert sorted((r.by, r.month.month, r.n) for r in got) == [("a", 1, 3), ("a", 2, 3), ("b", 1, 1)]


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path, write, tries = str(tmp_path / "t"), sinks.write_table, []
    sinks.replace_table(spark.range(5), path)

    def broken(df, folder):
        tries.append(folder)
        write(df.select((F.col("id") + 1).alias("id")), folder)
        if len(tries) <= fail:
            raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "write_table", broken)
    fail = 3
    with pytest.raises(RuntimeError):
        sinks.replace_table(spark.range(9), path, wait_s=0)
    assert len(tries) == 3 and spark.read.parquet(path).count() == 5
    fail, tries = 2, []
    # the third try does it; the frame reads the table that it replaces
    assert sinks.replace_table(spark.read.parquet(path), path, wait_s=0) == 5 and len(tries) == 3
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        sinks.replace_table(spark.range(0), path, wait_s=0)
    assert spark.read.parquet(path).count() == 5 and len(list(tmp_path.iterdir())) == 1


def test_only_the_newest_folder_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(6).selectExpr("cast(id as string) AS id", "concat('2024-01-0', 1 + id % 3) AS crawl_date").write.partitionBy("crawl_date").json(path)
    df = bronze.newest_partition(spark, path, ["id"])
    assert sorted(r.id for r in df.collect()) == ["2", "5"]
    assert "PartitionFilters: [isnotnull(crawl_date" in df._jdf.queryExecution().executedPlan().toString()

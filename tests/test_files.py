"""Sources and sinks on files of every layout."""

import pytest
from pyspark.sql import functions as F

from placeforge.sources import bronze, sinks


def test_csv_with_byte_order_mark_and_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,name\n1,\n2,b\n", encoding="utf-8")
    df = bronze.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id", "name"] and sorted(map(tuple, df.collect())) == [("1", ""), ("2", "b")]
    (tmp_path / "b.csv").write_text("id,name\n1,a\n2,b,x\n")
    rows = bronze.read_csv_layouts(spark, str(tmp_path / "b.csv"), [["id", "name"], ["id", "name", "more"]]).collect()
    assert sorted(map(tuple, rows), key=repr) == [("1", "a", None), ("2", "b", "x")]
    (tmp_path / "c.csv").write_text("1,a,x,y\n")
    with pytest.raises(Exception, match="neither layout"):
        bronze.read_csv_layouts(spark, str(tmp_path / "c.csv"), [["id", "name"], ["id", "name", "more"]]).collect()


def test_json_partitions_and_missing_fields(spark, tmp_path):
    day = tmp_path / "ds" / "crawl_date=2024-01-02"
    day.mkdir(parents=True)
    (day / "a.jsonl").write_text('{"a": "1"}\n{"a": "2", "b": "x"}\n')
    df = bronze.read_jsonl(spark, str(tmp_path / "ds"), ["a", "b"])
    assert sorted((r.a, r.b, r.crawl_date) for r in df.collect()) == [("1", None, "2024-01-02"), ("2", "x", "2024-01-02")]
    assert bronze.read_jsonl(spark, str(tmp_path / "ds"), ["a"], since="2024-01-03").count() == 0


def test_tables_are_replaced_verified_and_never_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    assert sinks.verify_table(spark.range(3), path) == 3
    with pytest.raises(ValueError):
        sinks.verify_table(spark.range(4), path)
    with pytest.raises(ValueError):
        sinks.replace_table(spark.range(0), path)
    sinks.write_new(spark.range(1), path + "-new")
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_new(spark.range(1), path + "-new")


def test_landing_splits_and_keeps_raw_values(spark, tmp_path):
    df = spark.createDataFrame([("r1", "p", "2024-01-02T03:00:00Z", "9", "1"), ("r2", "p", "2024-01-02T03:00:00Z", "5", "1")], "review_id string, place_id string, crawled_at_utc string, rating string, likes_count string")
    counts = sinks.land(df, str(tmp_path), "google_maps/reviews", "run", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    good, bad = (bronze.read_landed(spark, str(tmp_path), "google_maps/reviews", ["review_id", "rating"], quarantine).collect() for quarantine in (False, True))
    assert counts == {"success": 1, "quarantine": 1}
    assert [(r.review_id, r.rating) for r in good] == [("r2", "5")] and [(r.review_id, r.crawl_date) for r in bad] == [("r1", "2024-01-02")]

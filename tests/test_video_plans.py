"""Videos and their days: how often their rows are shuffled, and times in UTC under any session zone."""

import datetime

import pytest
from pyspark.sql import functions as F

from placeforge.functions import times
from placeforge.operators import scan
from placeforge.plans import models, registry, silver
from placeforge.plans.models import Lakehouse

DATA = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


def test_days_of_a_video_need_one_shuffle(spark):
    exchanges = [line for line in plan_of(spark, "mdl16_video_snapshots").splitlines() if "Exchange hashpartitioning(" in line]
    assert not [line for line in exchanges if "snapshot_date" in line]
    assert len([line for line in exchanges if "video_id" in line]) == 1


def test_videos_are_dealt_before_they_are_aggregated(spark):
    lines = plan_of(spark, "mdl15_videos").splitlines()
    at = next(k for k, line in enumerate(lines) if "partial_max_by" in line)
    below = [line.split("- ")[-1] for line in lines[at + 1 : at + 4]]
    assert any("Exchange hashpartitioning" in line for line in below)


@pytest.mark.parametrize(("text", "hour"), [("2024-11-03T05:30:00Z", 5), ("2024-11-03T06:30:00Z", 6), ("2024-11-03T06:30:00.250Z", 6)])
def test_utc_times_where_the_session_zone_sets_clocks_back(spark, text, hour):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/New_York")
    try:
        got = spark.createDataFrame([(text,)], "v string").select(times.utc_timestamp(F.col("v")).cast("string")).collect()[0][0]
    finally:
        spark.conf.set(key, before)
    assert datetime.datetime.fromisoformat(got).hour == hour


def house_of(spark):
    return Lakehouse(spark, DATA, store=True)


@pytest.mark.parametrize("table", ["profile", "video_performance"])
def test_marts_of_places_write_no_days_of_videos(spark, table):
    house = house_of(spark)
    getattr(house, table)
    assert "video_days" not in house.__dict__


def test_a_place_with_too_many_rows_for_a_task_gives_the_same_sums(spark, monkeypatch):
    def rows(df):
        sets = {c: F.array_sort(c) for c, t in df.dtypes if t.startswith("array")}
        return sorted(map(str, df.withColumns(sets).select(*sorted(df.columns)).collect()))

    reach, videos = rows(house_of(spark).video_reach), rows(house_of(spark).video_performance)
    monkeypatch.setattr(scan, "HOT_ROWS", 1)
    assert silver.by_place(house_of(spark).staged("videos")) is None
    assert rows(house_of(spark).video_reach) == reach
    assert rows(house_of(spark).video_performance) == videos


def test_rows_are_dealt_to_as_many_tasks_as_they_fill(spark, monkeypatch):
    staged = house_of(spark).staged("videos")
    monkeypatch.setattr(silver, "ROWS_A_TASK", 100)
    assert silver.by_place(staged)(staged).rdd.getNumPartitions() == -(-staged.count() // 100)


def test_only_wanted_places_are_cleaned_and_cast(spark):
    house = house_of(spark)
    wanted = house.staged("videos").select("place_id").distinct().orderBy("place_id").limit(3)
    at, all_rows = house.staged_at("videos", wanted), house.staged("videos").join(wanted, "place_id", "left_semi").select(*house.staged("videos").columns)
    assert at.count() and not at.exceptAll(all_rows).count() and not all_rows.exceptAll(at).count()


def test_gold_reconciles_without_days_of_videos(spark, monkeypatch):
    """dq9 counts videos by what places sum up of them; their days, a row a video and day with its texts, are not written for a count."""
    written, plain = [], models.stored
    monkeypatch.setattr(models, "stored", lambda df, name: written.append(name) or plain(df, name))
    rows = {r["check"]: r for r in registry.queries()["dq9_set3_gold_reconciles"](spark, DATA).collect()}
    assert "video_reach" in written and "video_days" not in written
    assert rows["video_performance_row_count"].right_value == silver.valid_videos(house_of(spark).staged("videos")).select("place_id", "video_id").distinct().count() > 0

"""Golden rows for the rules that are easy to get wrong."""

import datetime

import pytest
from pyspark.sql import functions as F

from placeforge.functions import cast, text, times
from placeforge.operators import checks, ingest, reference, shaping

C = F.col


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_clean_null_and_casts(spark):
    rows = [(" NaN ",), ("none",), ("  ",), ("　x ",), ("5d",), ("1_000",), ("2.5",), ("1.5",), (None,)]
    assert values(spark, rows, "v string", text.clean_null(C("v"))) == [None, None, None, "x", "5d", "1_000", "2.5", "1.5", None]
    assert values(spark, rows, "v string", cast.to_int(C("v"))) == [None, None, None, None, None, None, 2, 2, None]


def test_rounding_is_half_away_on_the_double(spark):
    assert values(spark, [(1.005,), (None,)], "v double", cast.rounded(C("v"))) == [1.0, None]
    assert values(spark, [(0.125,), (-0.125,)], "v double", cast.rounded(C("v"))) == [0.13, -0.13]


def test_offsets_shift_to_utc(spark):
    rows = [("2024-01-01T00:30:00+07:00",), ("2024-01-01 00:30:00",), ("2024-01-01T00:30:00Z",), ("never",), ("2024-02-30",)]
    d = datetime.datetime
    assert values(spark, rows, "v string", times.utc_timestamp(C("v"))) == [d(2023, 12, 31, 17, 30), d(2024, 1, 1, 0, 30), d(2024, 1, 1, 0, 30), None, None]


@pytest.mark.parametrize(("said", "day"), [("8 giờ trước", "2024-03-30"), ("một tháng trước", "2024-02-29"), ("Thời gian chỉnh sửa: 2 năm trước", "2022-03-31"), ("a day ago (edited)", "2024-03-30"), ("3 weeks ago", "2024-03-10"), ("just now", "2024-03-31"), ("last month", "2024-02-29"), ("some day", None)])
def test_relative_dates(spark, said, day):
    t = times.relative_text(C("v"))
    got = values(spark, [(said,)], "v string", times.relative_date(times.relative_unit(t), times.relative_quantity(t), F.lit("2024-03-31").cast("date")))
    assert got == [day and datetime.date.fromisoformat(day)]


def test_nearest_asof_prefers_the_past_then_the_nearest_future(spark):
    left = spark.createDataFrame([(1, "2024-01-05"), (1, "2024-01-01"), (2, "2024-01-01")], "k int, a string")
    right = spark.createDataFrame([(1, "2024-01-04", 10), (1, "2024-01-06", 20)], "k int, b string, v int")
    got = {(r.k, r.a): (r.b, r.v) for r in shaping.nearest_asof(left, right, "k", "a", "b", ["v"]).collect()}
    assert got == {(1, "2024-01-05"): ("2024-01-04", 10), (1, "2024-01-01"): ("2024-01-04", 10), (2, "2024-01-01"): (None, None)}


def test_global_rank_numbers_all_rows_in_order(spark):
    df = spark.range(1000).select(((C("id") * 37) % 1000).alias("v"))
    rows = shaping.global_rank(df, [C("v").desc()]).collect()
    assert sorted((r["rank"], r["v"]) for r in rows) == [(k + 1, 999 - k) for k in range(1000)]


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 1), (2, 5)], "k int, v int")
    once = shaping.first_by(df, ["k"], [C("v").desc()])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, shaping.first_by(once, ["k"], [C("v").desc()]).collect())) == [(1, 2), (2, 5)]


def test_row_errors_treat_nan_as_present_and_out_of_range(spark):
    df = spark.createDataFrame([("r", "p", "t", "NaN", "NaN"), ("", None, "t", "9", "-1"), ("r", "p", "t", "x", "")], "review_id string, place_id string, crawled_at_utc string, rating string, likes_count string")
    got = values(spark, df.collect(), df.schema, ingest.row_errors(df, ingest.DATASETS["google_maps/reviews"]))
    assert got == [["range:rating"], ["missing:review_id", "missing:place_id", "range:rating", "negative:likes_count"], ["numeric:rating"]]


def test_eligibility_prefers_tags_over_columns(spark):
    df = spark.createDataFrame([('{"tourism":"artwork","wikidata":"Q"}', "museum"), ('{"shop":"gift"}', "museum"), ("[1", None), ("", "museum")], "tags string, tourism string")
    e = reference.eligibility(C("tags"), {"tourism": C("tourism")})
    assert values(spark, df.collect(), df.schema, e["tourism_reason"]) == ["conditional_tag_with_independent_evidence", "strong_tourism_tag", "malformed_tags_json", "strong_tourism_tag"]


def test_checks_pass_nulls_and_gates_raise(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    assert checks.accepted_range(df, "v", 0, 4).count() == 1
    assert checks.expression_is_true(df, C("v") > 3).count() == 0
    with pytest.raises(ValueError, match="v_not_null"):
        checks.gate({"v_not_null": checks.not_null(df, "v"), "k_unique": checks.unique_combination(df, ["k"])})


def test_classification_falls_back(spark):
    df = spark.createDataFrame([(1, "museum", None, "castle", None), (2, None, None, None, None), (3, "aquarium", None, None, None)], "place_id int, tourism string, natural string, historic string, leisure string")
    rows = sorted((r.place_id, r.subcategory_name, r.is_primary) for r in reference.classify(df).collect())
    assert rows == [(1, "monument", False), (1, "museum", True), (2, "general_attraction", True), (3, "zoo", True)]

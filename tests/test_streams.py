"""Streams over several batches: late rows, horizons, windows given out once; argument checks; the similarity ratio."""

import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

from placeforge.functions import text
from placeforge.operators import checks, scope
from placeforge.streaming import streams

SCHEMA = "user_id long, event_type string, ts timestamp"


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def batches(spark, path, parts):
    """A stream with one batch for each list of rows."""
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/part={k}")
        for name in os.listdir(f"{path}/part={k}"):
            os.utime(f"{path}/part={k}/{name}", (time.time() - 1000 + 10 * k,) * 2)
    return streams.files(spark, f"{path}/*", SCHEMA, per_trigger=1)


def test_late_rows_count_until_their_day_is_given_out(spark, tmp_path):
    parts = [[(1, "a", at(1)), (2, "a", at(1, 5))], [(3, "a", at(2, 23)), (4, "a", at(1, 7))], [(5, "a", at(9))], [(9, "a", at(9, 1))], [(6, "a", at(1, 8)), (7, "a", at(8, 3))], [(8, "a", at(20))]]
    counts = streams.daily_counts(batches(spark, str(tmp_path), parts), "ts", "event_type", "1 day")
    got = streams.to_end(counts.select(F.col("window.start").alias("day"), "n"), "late").collect()
    # the row of day 1 in the fifth batch is behind the watermark, day 8's is not; day 20 stays open
    assert sorted((r.day.day, r.n) for r in got) == [(1, 3), (2, 1), (8, 1), (9, 2)]


def test_repeats_are_dropped_within_the_horizon_only(spark, tmp_path):
    parts = [[(1, "a", at(1))], [(1, "a", at(2)), (2, "a", at(2))], [(3, "a", at(20))], [(4, "a", at(20, 1))], [(1, "a", at(21)), (3, "a", at(21))]]
    got = streams.to_end(streams.dedup_within(batches(spark, str(tmp_path), parts), ["user_id"], "ts", "2 days"), "recent").collect()
    assert sorted((r.user_id, r.ts.day) for r in got) == [(1, 1), (1, 21), (2, 2), (3, 20), (4, 20)]


def test_request_arguments():
    assert scope.words_given({"province": " a "}, "province", "provinces") == ["a"]
    assert scope.words_given({"provinces": ["b", "a ", "b"], "province": "x"}, "province", "provinces") == ["b", "a"]
    assert scope.words_given({}, "province", "provinces") == []
    for bad in ([], ["a", " "], [1], ""):
        with pytest.raises(ValueError):
            scope.words_given({"provinces": bad}, "province", "provinces")
    assert scope.datasets_given(None) == list(scope.DATASETS)
    assert scope.datasets_given(["YouTube_Comments ", "ratings", "comments"]) == ["ratings", "comments"]
    for bad in ([], "ratings", ["other"]):
        with pytest.raises(ValueError):
            scope.datasets_given(bad)


def test_scope_intersects_and_refuses(spark):
    rows = [("p1", "A", "01", "Hà Nội", "valid", "true", "museum", None, None, None), ("p2", "B", "01", "Hà Nội", "VALID", "yes", None, "peak", None, None), ("p3", "C", "02", "Huế", "valid", "true", "hotel", None, None, None), ("p4", "D", "01", "Hà Nội", "review", "true", "museum", None, None, None), ("p5", "E", "01", "Hà Nội", "valid", "no", "museum", None, None, None), ("p1", "A", "01", "Hà Nội", "valid", "true", "museum", None, None, None)]
    places = spark.createDataFrame(rows, "place_id string, place_name string, province_id string, province_name string, validation_status string, crawl_eligible string, tourism string, natural string, historic string, leisure string")
    terms = spark.createDataFrame([("p2", "Núi")], "place_id string, term string")
    ids = lambda **k: sorted(r.place_id for r in scope.in_scope(places, **k).collect())
    assert ids() == ["p1", "p3"] and ids(core_only=False) == ["p1", "p2", "p3"]
    assert ids(provinces=["ha noi"]) == ["p1"] and ids(provinces=["02", "HUE"]) == ["p3"]
    assert ids(place_ids=["p2"]) == ["p2"] and ids(category="nui", categories=terms, core_only=False) == ["p2"] and ids(category="Hotel", categories=terms) == ["p3"]
    for bad in ({"category": "nowhere", "categories": terms}, {"place_ids": ["p4"]}, {"place_ids": ["p3"], "provinces": ["01"]}):
        with pytest.raises(ValueError):
            ids(**bad)


def test_gates_name_what_fails(spark):
    good = spark.createDataFrame([("01", "A", "1", "2", "3", "4")], "province_id string, province_name string, min_lon string, min_lat string, max_lon string, max_lat string")
    checks.pass_gate(good, "provinces")
    with pytest.raises(ValueError, match="unique:province_id"):
        checks.pass_gate(good.unionByName(good), "provinces")
    with pytest.raises(ValueError, match="number:min_lon"):
        checks.pass_gate(good.withColumn("min_lon", F.lit("x")), "provinces")
    with pytest.raises(ValueError, match="column:max_lat"):
        checks.pass_gate(good.drop("max_lat"), "provinces")
    with pytest.raises(ValueError, match="not_empty"):
        checks.pass_gate(good.limit(0), "provinces")


def brute_ratio(a, b):
    """Ratcliff-Obershelp: twice the matched characters over all, by longest common blocks, the first ones in ties."""

    def blocks(x, y):
        best = (0, 0, 0)
        for i in range(len(x)):
            for j in range(len(y)):
                k = 0
                while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        return k + blocks(x[:i], y[:j]) + blocks(x[i + k :], y[j + k :]) if k else 0

    return 2 * blocks(a, b) / (len(a) + len(b)) if a or b else 1.0


def test_similarity_matches_brute_force(spark):
    pairs = [("old harbour", "harbour old"), ("chùa một cột", "chua mot cot"), ("abc", ""), ("", ""), ("museum of art", "art museum"), ("aaaa", "aa"), (None, "x")]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    got = {r.k: (r.s, r.m) for r in df.select("k", text.similarity(F.col("a"), F.col("b")).alias("s"), text.names_match(F.col("a"), F.col("b")).alias("m")).collect()}
    for k, (a, b) in enumerate(pairs):
        a, b = a or "", b or ""
        assert got[k][0] == pytest.approx(brute_ratio(a, b))
        assert got[k][1] == (not a or not b or a in b or b in a or brute_ratio(a, b) >= text.RATIO)

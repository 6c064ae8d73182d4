"""Rules of reference data, ingestion and planning on rows that tell them from near ones."""

import json

import pytest
from pyspark.sql import functions as F

from placeforge.functions import cast
from placeforge.operators import ingest, plan, reference
from placeforge.sources import backfill, bronze

NOW = "2026-02-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_namesakes_count_whatever_their_status(spark):
    rows = [(1, "01", "Lake", "valid", ""), (2, "01", " lake ", "invalid", "x"), (3, "02", "Lake", "valid", ""), (4, "01", " ", "valid", ""), (5, "01", None, "valid", ""), (6, None, "Hill", "valid", ""), (7, None, "hill", "review", "y")]
    df = spark.createDataFrame(rows, "id int, province_id string, place_name string, validation_status string, validation_reason string")
    got = {r.id: (r.validation_status, r.validation_reason) for r in reference.suspect_namesakes(df).collect()}
    assert got == {1: ("review", "duplicate_name"), 2: ("invalid", "x"), 3: ("valid", ""), 4: ("valid", ""), 5: ("valid", ""), 6: ("review", "duplicate_name"), 7: ("review", "y")}


def test_province_fallbacks(spark):
    feature = lambda i=None, box=None, **p: {"id": i, "bbox": box, "properties": p}
    stored = [
        {"features": [feature("X", province_code="09", name="N", province_name="P", province_id="07")]},
        {"bbox": [1, 2, 3, 4], "features": [feature(code="C", full_name="F"), feature("second")]},
        {"bbox": [1, 2, 3, 4], "features": [feature("", [5, 6, 7, 8], province_code="", code="K", name="", province_name="P", full_name="F")]},
        {"bbox": [1, 2, 3, 4], "features": []},
        {"features": [feature()]},
    ]
    df = spark.createDataFrame([(k, json.dumps(c)) for k, c in enumerate(stored)] + [(9, "broken"), (10, None)], "k int, collection string")
    got = {r.k: tuple(r)[1:] for r in reference.province_features(df).collect()}
    assert got == {0: ("X", "N", None, None, None, None), 1: ("C", "F", 1, 2, 3, 4), 2: ("K", "P", 5, 6, 7, 8), 4: (None, None, None, None, None, None)}


@pytest.mark.parametrize(
    ("text", "tags"),
    [('{"a":"x"}', {"a": "x"}), (' {"a" : 1, "b": " y "} ', {"a": "1", "b": "y"}), ("{}", {}), ("{'shop':'gift'}", None), ('{"wikidata":"Q1"} junk', None), ('{"a":"x"}, {"b":"y"}', None), ('{"a":"x"}] [{"b":"y"}', None), ('{"a":"x"}} {"c":{"b":"y"}', None), ('["a"]', None), ('"a"', None), ("7", None), ("null", None), ('{"a":', None), ("", {}), (None, {}), ("NaN", {}), (" None ", {})],
)
def test_tags_are_strict_json(spark, text, tags):
    found, malformed = cast.tag_map(F.col("t"), {})
    row = spark.createDataFrame([(text,)], "t string").select(found.alias("tags"), malformed.alias("bad")).first()
    assert row.bad == (tags is None) and row.tags == (tags or {})


def test_provenance_takes_the_first_id_that_is_not_empty(spark):
    rows = [("", "r1", "p1", "u", "m", None), (None, None, "p1", "", "m", "2026-01-05T00:00:00Z"), ("v", "r", "p", None, None, "2026-01-05T00:00:00Z")]
    df = spark.createDataFrame(rows, "video_id string, review_id string, place_id string, url string, google_maps_url string, crawled_at_utc string")
    got = [(r.source_id, r.source_url, r.record_status, r.quality_errors) for r in ingest.stamped(df, "google_maps/reviews", "run", now()).collect()]
    assert got == [("r1", "u", "quarantine", '["missing:crawled_at_utc"]'), ("p1", "m", "quarantine", '["missing:review_id"]'), ("v", "", "success", None)]
    named = ingest.stamped(df, "google_maps/reviews", "run", now(), source_id="S", source_url="U", pipeline_version="2").first()
    assert (named.source_id, named.source_url, named.pipeline_version) == ("S", "U", "2") and json.loads(named.quality_errors) == ["missing:crawled_at_utc"]


def test_legacy_mapping_joins_only_if_something_is_missing(spark):
    mapping = spark.createDataFrame([("01", "a", "A"), ("01", "b", "B")], "current_province_id string, legacy_province_id string, legacy_province_name string")
    whole = spark.createDataFrame([("p", "01", "One", "x", "X")], "place_id string, province_id string, province_name string, legacy_province_id string, legacy_province_name string")
    assert [tuple(r) for r in reference.enrich_admin(whole, mapping).select("current_province_name", "legacy_province_id").collect()] == [("One", "x")]
    part = whole.drop("legacy_province_name").withColumn("province_id", F.lit("01"))
    got = reference.enrich_admin(part, mapping).collect()
    assert sorted((r.current_province_id, r.legacy_province_id, r.legacy_province_name) for r in got) == [("01", "x", "A"), ("01", "x", "B")]


def test_files_are_landed_once_and_again_by_force(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "google_maps_reviews.csv").write_text("﻿review_id,place_id,rating,crawled_at\nr1,p,5,2026-01-02T03:04:05Z\nr2,p,4,\nr3,p,9,2026-01-02T03:04:05Z\n", encoding="utf-8")
    first = backfill.backfill(spark, str(folder), root, now())
    assert first == {"google_maps_reviews.csv": {"success": 2, "quarantine": 1}}
    assert backfill.backfill(spark, str(folder), root, now()) == {"google_maps_reviews.csv": {"skipped": 1}}
    assert backfill.backfill(spark, str(folder), root, now(), force=True) == first
    rows = bronze.read_landed(spark, root, "google_maps/reviews", ["review_id", "crawled_at_utc", "crawler_version"]).collect()
    assert sorted((r.review_id, r.crawled_at_utc, r.crawler_version, r.crawl_date) for r in rows) == [("r1", "2026-01-02T03:04:05Z", "historical-backfill", "2026-01-02"), ("r2", backfill.NO_TIME, "historical-backfill", "2026-08-30")]


def planned(spark, places, seen, videos=None, successful=(), **options):
    at = spark.createDataFrame([(k, f"2026-01-{d:02d} 00:00:00") for k, d in seen.items()], "item_id string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    request = plan.Request(now(), {"ratings": 10, "reviews": 10, "videos": 10, "comments": 10}, **options)
    pairs = None if videos is None else spark.createDataFrame(videos, "item_id string, place_id string")
    found = plan.work_plan(request, spark.createDataFrame([(p,) for p in places], "item_id string"), dict.fromkeys(plan.OPERATIONS, at), pairs, spark.createDataFrame([(k,) for k in successful], "item_id string"))
    return {r.dataset: (r.due_items, r.include_new_videos, r.would_run, r.should_run, r.reason) for r in found.summary.collect()}


def test_comments_hang_on_videos(spark):
    two = ("videos", "comments")
    fresh, stale = {"p": 30, "v": 30, "w": 2}, {"p": 2, "v": 30, "w": 2}
    both = [("v", "p"), ("w", "p"), ("x", "elsewhere"), ("v", "p")]
    assert planned(spark, ["p"], fresh, both, datasets=two) == {"videos": (0, False, False, False, plan.FRESH), "comments": (1, False, True, True, plan.STALE)}
    assert planned(spark, ["p"], fresh, both, ["v", "w"], datasets=two)["comments"] == (0, False, False, False, plan.SUCCESSFUL)
    assert planned(spark, ["p"], fresh, both, ["w"], datasets=two)["comments"] == (0, False, False, False, plan.FRESH)
    # videos are due: comments run for the new ones, whatever the old ones are
    assert planned(spark, ["p"], stale, both, ["v", "w"], datasets=two)["comments"] == (0, True, True, True, plan.SUCCESSFUL)
    assert planned(spark, ["p"], stale, both, ["v", "w"], datasets=two, dry_run=True) == {"videos": (1, False, True, False, plan.DRY_RUN), "comments": (0, False, False, False, plan.SUCCESSFUL)}
    assert planned(spark, ["p"], stale, both, ["v", "w"], datasets=two, force=True)["comments"] == (2, True, True, True, plan.STALE)
    assert planned(spark, ["p"], fresh, [], datasets=two)["comments"] == (0, False, False, False, plan.NO_VIDEOS)
    assert planned(spark, ["p"], fresh, None, datasets=two)["comments"] == (0, False, False, False, plan.NO_TABLE)
    assert planned(spark, [], fresh, both, datasets=two) == {"videos": (0, False, False, False, plan.FRESH), "comments": (0, False, False, False, plan.NO_VIDEOS)}


def test_eligibility_reads_its_json_once(spark):
    """Each of the rules names the tags; written out each time, the text was parsed anew for each name."""
    df = spark.createDataFrame([('{"tourism":"museum"}', "x"), ("{broken", None), ('{"natural":"peak","wikidata":"Q1"}', None)], "t string, tourism string")
    out = df.select(reference.eligibility(F.col("t"), {"tourism": F.col("tourism")}).alias("e")).select("e.*")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") <= 2
    assert [r.tourism_reason for r in out.collect()] == ["strong_tourism_tag", "malformed_tags_json", "conditional_tag_with_independent_evidence"]


def test_a_large_province_is_filled_in_pieces(spark, monkeypatch):
    table = spark.createDataFrame([(k, ["01", "02", None, "09"][k % 4], None, "own" if k % 3 else None) for k in range(400)], "id int, province_id string, legacy_province_id string, legacy_province_name string").coalesce(1)
    mapping = spark.createDataFrame([(p, f"l{k}", f"n{k}") for p in ("01", None, "02") for k in range(30 if p != "02" else 1)], "current_province_id string, legacy_province_id string, legacy_province_name string")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    whole = rows(reference.enrich_admin(table, mapping))
    monkeypatch.setattr(reference, "PIECE", 300)
    cut = reference.enrich_admin(table, mapping)
    assert rows(cut) == whole and len(whole) == 100 * (30 + 1 + 30 + 1)
    sizes = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 8 and max(sizes) < len(whole) / 4


def shuffled_rows(spark, run):
    """Rows that the shuffles of ``run`` write."""
    bus, store, double = spark._jsc.sc().listenerBus(), spark._jsc.sc().statusStore(), spark._jvm.double

    def total():
        bus.waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(double, 0), None)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_a_large_province_repeats_neither_side_for_all_its_pieces(spark, monkeypatch):
    """The legacy fill of a province with many rows on both sides: its shuffle is a small part of its result, which is whole."""
    table = spark.createDataFrame([(k, None if k % 9 == 0 else "1", "own" if k % 2 else None) for k in range(900)] + [(k, "2", None) for k in range(900, 930)], "k int, province_id string, legacy_province_id string")
    mapping = spark.createDataFrame([(p, f"l{k % 250}", None if k % 7 == 0 else f"n{k % 250}") for p in ("1", None) for k in range(300)] + [("3", "l", "n")], "current_province_id string, legacy_province_id string, legacy_province_name string")
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    whole = rows(reference.enrich_admin(table, mapping))
    assert len(whole) == 900 * 300 + 30
    for piece, column, tasks in ((50, 40, 64), (50, 2, 4096), (3000, 1000, 4096)):
        for name, value in (("PIECE", piece), ("COLUMN", column), ("TASKS", tasks)):
            monkeypatch.setattr(reference, name, value, raising=False)
        assert rows(reference.enrich_admin(table, mapping)) == whole
    monkeypatch.setattr(reference, "PIECE", 50)
    monkeypatch.setattr(reference, "COLUMN", 40, raising=False)
    monkeypatch.setattr(reference, "TASKS", 64)
    assert shuffled_rows(spark, lambda: reference.enrich_admin(table, mapping).write.format("noop").mode("overwrite").save()) < len(whole) / 10

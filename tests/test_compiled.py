"""The models' generated code compiles: with the fallback off, code beyond the limits of a method is an error."""

import pytest

from placeforge.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["mdl4_stg_places", "mdl7_stg_comments", "mdl11_places", "mdl13_travel_reviews", "mdl14_rating_snapshots", "mdl15_videos", "mdl16_video_snapshots", "mdl17_comments"])
def test_generated_code_compiles(spark, name):
    key = "spark.sql.codegen.fallback"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        registry.queries()[name](spark, DATA).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set(key, before)

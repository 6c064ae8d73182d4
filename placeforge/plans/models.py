"""The staging, silver and gold tables as one lazy graph for a session and a folder of input."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_null
from ..settings import DEFAULTS, Settings, tune
from ..sources.tables import stored
from . import gold, silver
from .inputs import raw
from .staging import SPECS, stage


def table(build: Callable[[Lakehouse], DataFrame]) -> cached_property:
    """A table of the graph, written once if the graph stores its tables."""

    def get(house: Lakehouse) -> DataFrame:
        df = build(house)
        return stored(df, build.__name__) if house.store else df

    get.__name__ = build.__name__
    return cached_property(get)


class Lakehouse:
    """Each attribute is a DataFrame built from those before it.

    With ``store`` each is written once and read by those after it, as marts that read many tables should; without it
    all stay lazy, and one query runs as one plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = DEFAULTS, store: bool = False) -> None:
        self.spark, self.sf_dir, self.settings, self.store = spark, sf_dir, settings, store
        tune(spark)
        self.feeds: dict[str, DataFrame] = {}

    def staged(self, feed: str) -> DataFrame:
        """The staging table of a feed. It is never stored: one table reads all of its rows, and others a few columns."""
        if feed not in self.feeds:
            self.feeds[feed] = stage(feed, raw(self.spark, self.sf_dir, feed))
        return self.feeds[feed]

    def staged_at(self, feed: str, places: DataFrame) -> DataFrame:
        """The staging rows of a feed at these places; no other row is cleaned and cast."""
        rows, there = raw(self.spark, self.sf_dir, feed), places.select(F.col("place_id").alias("_there"))
        return stage(feed, rows.join(there, clean_null(F.col("place_id")) == F.col("_there"), "left_semi"))

    def at_once(self, *names: str) -> None:
        """Write these tables side by side, as a table alone seldom has work for all cores; the dimensions that they share come first."""
        if self.store:
            for some in (["places", *(["taxonomy"] if "place_categories" in names else [])], names):
                todo = [n for n in some if n not in self.__dict__]
                with ThreadPoolExecutor(len(some)) as pool:
                    list(pool.map(inheritable_thread_target(self.spark)(lambda n: getattr(self, n)), todo))

    @table
    def provinces(self) -> DataFrame:
        return silver.provinces(self.staged("provinces"))

    @table
    def taxonomy(self) -> DataFrame:
        return silver.taxonomy(self.staged("taxonomy"))

    @table
    def places(self) -> DataFrame:
        return silver.places(self.staged("places"), self.provinces)

    @table
    def place_categories(self) -> DataFrame:
        return silver.place_categories(self.staged("place_categories"), self.taxonomy, self.places)

    @table
    def rating_days(self) -> DataFrame:
        return silver.rating_snapshots(self.staged("ratings"), self.places)

    @cached_property
    def ratings(self) -> DataFrame:
        return self.rating_days.drop("is_latest")

    @table
    def video_days(self) -> DataFrame:
        """Videos and their days in one table, for the marts."""
        return silver.video_days(self.staged("videos"))

    @table
    def video_reach(self) -> DataFrame:
        """What places sum up of their videos."""
        return silver.video_reach(self.staged("videos"))

    @cached_property
    def newest_videos(self) -> DataFrame:
        return silver.newest_videos(self.video_days)

    @table
    def videos(self) -> DataFrame:
        return silver.videos(self.staged("videos"), self.places)

    @table
    def video_snapshots(self) -> DataFrame:
        return silver.video_snapshots(self.staged("videos"), self.places)

    @table
    def comments(self) -> DataFrame:
        return silver.comments(self.staged("comments"), self.places)

    @table
    def reviews(self) -> DataFrame:
        return silver.reviews(self.staged("reviews"), self.places, [partial(self.staged_at, f) for f in ("ratings", "videos")], self.provinces)

    @table
    def coverage(self) -> DataFrame:
        self.at_once("video_reach", "reviews", "rating_days", "comments")
        return silver.coverage(self.places, self.reviews, self.video_reach, self.comments, self.rating_days, self.settings)

    @table
    def monthly(self) -> DataFrame:
        self.at_once("video_days", "place_categories", "reviews", "comments")
        return gold.monthly_growth(self.reviews, self.newest_videos, self.comments, self.places, self.place_categories)

    @table
    def trajectory(self) -> DataFrame:
        self.at_once("video_days", "place_categories", "rating_days")
        return gold.snapshot_trajectory(self.ratings, self.video_days, self.places, self.place_categories)

    @cached_property
    def video_performance(self) -> DataFrame:
        """As large as the videos and read by no other table, so it is not written."""
        videos = self.staged("videos")
        dealt = silver.by_place(videos)
        if dealt is None:
            return gold.video_performance(self.newest_videos, self.places, self.comments)
        # read once, so the videos' days are not written before
        return gold.video_performance(silver.newest_videos(silver.video_days(videos, dealt)), self.places, self.comments, None)

    @table
    def profile(self) -> DataFrame:
        self.at_once("video_reach", "place_categories", "reviews", "rating_days", "comments")
        return gold.place_360(self.places, self.coverage, self.place_categories, self.rating_days, self.reviews, self.video_reach, self.settings)

    @table
    def province_summary(self) -> DataFrame:
        return gold.province_summary(self.provinces, self.profile)

    @table
    def category_summary(self) -> DataFrame:
        return gold.category_summary(self.taxonomy, self.place_categories, self.profile)


#: Registered name -> (table of the graph, step of the SQL).
MODELS = {f"mdl{k}_stg_{feed}": (feed, f"stg_{feed}") for k, feed in zip((5, 4, 6, 3, 1, 8, 2, 7), SPECS, strict=True)} | {
    "mdl9_provinces": ("provinces", "sil_provinces"), "mdl10_taxonomy": ("taxonomy", "sil_taxonomy"), "mdl11_places": ("places", "sil_places"), "mdl12_place_categories": ("place_categories", "sil_place_categories"),
    "mdl13_travel_reviews": ("reviews", "sil_reviews"), "mdl14_rating_snapshots": ("ratings", "sil_ratings"), "mdl15_videos": ("videos", "sil_videos"), "mdl16_video_snapshots": ("video_snapshots", "sil_video_snapshots"),
    "mdl17_comments": ("comments", "sil_comments"), "mdl18_temporal_coverage": ("coverage", "sil_coverage"), "mdl19_monthly_growth": ("monthly", "gold_monthly"), "mdl20_snapshot_trajectory": ("trajectory", "gold_trajectory"),
    "mdl21_video_performance": ("video_performance", "gold_videos"), "mdl22_place_360": ("profile", "gold_profile"), "mdl23_province_summary": ("province_summary", "gold_provinces"), "mdl24_category_summary": ("category_summary", "gold_categories"),
}

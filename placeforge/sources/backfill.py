"""Files of earlier crawls, landed once each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bronze import read_csv
from .sinks import land
from .tables import exists, remove

# ---- Fixed values: the files, and the time that rows of some datasets have if they have none ----
FILES = {
    "google_maps_ratings.csv": "google_maps/ratings",
    "google_maps_reviews.csv": "google_maps/reviews",
    "google_maps_errors.csv": "google_maps/errors",
    "youtube_videos.csv": "youtube/videos",
    "youtube_comments.csv": "youtube/comments",
    "youtube_crawl_log.csv": "youtube/crawl_log",
    "youtube_comments_crawl_log.csv": "youtube/comments_crawl_log",
}
TIMED = ("google_maps/reviews", "youtube/comments")
NO_TIME = "2026-08-30T00:00:00.000000"
# ---- End of fixed values ----


def with_time(df: DataFrame, dataset: str) -> DataFrame:
    """Reviews and comments have crawled_at_utc: crawled_at under its new name, and NO_TIME where it is empty."""
    if dataset not in TIMED:
        return df
    if "crawled_at_utc" not in df.columns and "crawled_at" in df.columns:
        df = df.withColumnRenamed("crawled_at", "crawled_at_utc")
    return df.withColumn("crawled_at_utc", F.coalesce(F.nullif("crawled_at_utc", F.lit("")), F.lit(NO_TIME))) if "crawled_at_utc" in df.columns else df


def backfill(spark: SparkSession, folder: str, root: str, now: Column, force: bool = False) -> dict[str, dict[str, int]]:
    """Land each file of ``folder`` that is there and not landed yet; how many rows went where, or that it was skipped.

    The batch of a file is named after it, so the commit of the landing is the mark that it is done: both come in one step. By
    ``force`` the batch is taken back and landed again, in the place of what it was.
    """
    out = {}
    for name, dataset in FILES.items():
        if not exists(spark, f"{folder}/{name}"):
            continue
        batch = f"historical-{name.removesuffix('.csv')}"
        if force:
            remove(spark, f"{root}/_commits/{dataset}/batch={batch}")
        counts = land(with_time(read_csv(spark, f"{folder}/{name}"), dataset), root, dataset, batch, now, crawler_version="historical-backfill")
        out[name] = {"skipped": 1} if counts is None else counts
    return out

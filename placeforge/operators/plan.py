"""The work plan: which items of which dataset are due, where one dataset's decision hangs on another's."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from .ingest import review_limit

# ---- Fixed values: the datasets in the order of planning, what runs for each, and the reasons ----
OPERATIONS = {"ratings": "google_maps_ratings", "reviews": "google_maps_reviews", "videos": "youtube_videos", "comments": "youtube_comments"}
DRY_RUN, STALE, FRESH, SUCCESSFUL = "dry_run", "stale_or_missing_items", "all_items_fresh", "all_items_successful"
NO_VIDEOS, NO_TABLE = "no_videos_in_scope", "youtube_video_snapshot_missing"
# ---- End of fixed values ----


@dataclass(frozen=True)
class Request:
    """What is asked for: datasets, days for which an item of each stays fresh, and whether to force or only to look."""

    now: Column
    days: dict[str, int]
    datasets: tuple[str, ...] = tuple(OPERATIONS)
    force: bool = False
    dry_run: bool = False


@dataclass
class Plan:
    """``items``: dataset, item_id, last_at, would_run, max_reviews of every candidate. ``summary``: a row a dataset."""

    items: DataFrame
    summary: DataFrame
    frames: dict[str, DataFrame] = field(default_factory=dict)


def due(candidates: DataFrame, seen: DataFrame, request: Request, dataset: str, successful: DataFrame | None = None) -> DataFrame:
    """Each candidate (item_id) with last_at, successful and would_run.

    An item is due if it is not fresh; one of ``successful`` never is again, unless forced.
    """
    out = candidates.join(seen.select("item_id", F.col("at").alias("last_at")), "item_id", "left")
    if successful is None:
        out = out.withColumn("successful", F.lit(False))
    else:
        out = out.join(successful.select("item_id", F.lit(True).alias("successful")), "item_id", "left").withColumn("successful", F.coalesce("successful", F.lit(False)))
    fresh = times.is_fresh(F.col("last_at"), request.now, request.days[dataset])
    return out.withColumn("would_run", F.lit(request.force) | (~F.col("successful") & ~fresh))


def work_plan(request: Request, places: DataFrame, seen: dict[str, DataFrame], videos: DataFrame | None = None, successful_comments: DataFrame | None = None, terms: DataFrame | None = None) -> Plan:
    """The plan for places (item_id) in scope.

    ``seen``: item_id and at by dataset (``ingest.latest_seen``). Comments are asked for by video, of the ``videos`` (item_id,
    place_id) of these places: those not yet successful and not fresh. If videos are to be fetched in the same run, comments run
    too, for the videos that will be new (include_new_videos). ``terms``: item_id and category terms, for the depth of reviews.
    """
    spark, frames = places.sparkSession, {}
    for name in request.datasets:
        if name == "comments":
            if videos is None:
                continue
            inside = videos.join(places.select(F.col("item_id").alias("place_id")), "place_id", "left_semi").select("item_id").distinct()
            frames[name] = due(inside, seen[name], request, name, successful_comments)
        else:
            frames[name] = due(places.select("item_id").distinct(), seen[name], request, name)
    columns = ["item_id", "last_at", "successful", "would_run"]
    items = None
    for name, df in frames.items():
        limit = F.lit(None).cast("int")
        if name == "reviews" and terms is not None:
            df = df.join(terms.select("item_id", "terms"), "item_id", "left")
            limit = F.when(F.col("would_run"), review_limit(F.col("terms")))
        part = df.select(F.lit(name).alias("dataset"), *columns, limit.alias("max_reviews"))
        items = part if items is None else items.unionByName(part)
    return Plan(items, summary(spark, request, places, items, videos is None), frames)


def summary(spark, request: Request, places: DataFrame, items: DataFrame, no_videos: bool) -> DataFrame:
    """A row a dataset: operation, items, due_items, include_new_videos, would_run, should_run, reason and freshness_days."""
    asked = spark.createDataFrame([(name, OPERATIONS[name], request.days[name]) for name in request.datasets], "dataset string, operation string, freshness_days int")
    counts = items.groupBy("dataset").agg(F.count(F.lit(1)).alias("items"), F.count_if("would_run").alias("due_items"), F.count_if("successful").alias("successful_items"))
    out = asked.join(F.broadcast(counts), "dataset", "left").na.fill(0, ["items", "due_items", "successful_items"])  # a row a dataset
    comments = F.col("dataset") == "comments"
    # one row: whether videos are due, and whether there is a place at all
    videos = counts.agg(F.coalesce(F.max(F.when(F.col("dataset") == "videos", F.col("due_items") > 0)), F.lit(False)).alias("_videos"))
    out = out.crossJoin(videos).crossJoin(places.select("item_id").limit(1).agg((F.count(F.lit(1)) > 0).alias("_places")))
    out = out.withColumn("include_new_videos", comments & F.col("_videos") & F.col("_places") & F.lit(not request.dry_run))
    reason = F.when(F.col("due_items") > 0, STALE).when(comments & F.lit(no_videos), NO_TABLE).when(comments & (F.col("items") == 0), NO_VIDEOS).when(comments & (F.col("successful_items") == F.col("items")), SUCCESSFUL).otherwise(FRESH)
    out = out.withColumn("would_run", (F.col("due_items") > 0) | F.col("include_new_videos"))
    out = out.withColumns({"should_run": F.col("would_run") & F.lit(not request.dry_run), "reason": F.when(F.col("would_run") & F.lit(request.dry_run), DRY_RUN).otherwise(reason)})
    return out.select("dataset", "operation", "items", "due_items", "include_new_videos", "would_run", "should_run", "reason", "freshness_days")

"""Silver tables: staging rows, one a business key, domain-checked and conformed to the place dimension."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cast, text, times
from ..operators import scan
from ..operators import shaping as op
from ..settings import DEFAULTS, Settings
from ..sources.tables import stored



def newest_crawl(df: DataFrame, *keys: str, then=()) -> DataFrame:
    return op.latest_by(df, keys, "bronze_crawl_date", then)


def provinces(staged: DataFrame) -> DataFrame:
    valid = op.live(staged, "province_id", "province_name")
    top = newest_crawl(valid, "province_id").withColumn("admin_scope", F.coalesce("admin_scope", F.lit("current_34")))
    checked = {}
    for axis, most in (("lon", 180), ("lat", 90)):
        low, high = F.col(f"min_{axis}"), F.col(f"max_{axis}")
        good = low.between(-most, most) & high.between(-most, most) & (low <= high)
        checked |= {f"min_{axis}": F.when(good, low), f"max_{axis}": F.when(good, high), f"center_{axis}": F.when(good, (low + high) / 2)}
    top = top.withColumns(checked).join(op.lifecycle(valid, "province_id"), "province_id")
    return top.select("province_id", "province_name", "min_lon", "min_lat", "max_lon", "max_lat", "center_lat", "center_lon", "geojson_url", "admin_scope", "province_set_version", "fetched_at_utc", "first_seen_crawl_date", "last_seen_crawl_date", "snapshot_count", "bronze_run_id", "bronze_ingested_at_utc")


def taxonomy(staged: DataFrame) -> DataFrame:
    valid = op.live(staged, "category_id")
    top = newest_crawl(valid, "category_id").join(op.lifecycle(valid, "category_id"), "category_id")
    return top.select("category_id", "category_group", "category_name", "subcategory_name", "name_vi", "name_en", "first_seen_crawl_date", "last_seen_crawl_date", "snapshot_count", "bronze_run_id", "bronze_ingested_at_utc")


def places(staged: DataFrame, provinces_: DataFrame) -> DataFrame:
    valid = op.live(staged, "place_id", "place_name")
    latest = valid.agg(F.max("bronze_crawl_date").alias("latest"))  # one row
    dim = provinces_.select("province_id", F.col("province_name").alias("dim_name"), F.lit(True).alias("in_dim"))
    out = newest_crawl(valid, "place_id").join(op.lifecycle(valid, "place_id"), "place_id").join(dim, "province_id", "left").crossJoin(F.broadcast(latest))
    out = out.withColumns({
        "province_name": F.coalesce("dim_name", "province_name"), "is_province_in_dim": F.coalesce("in_dim", F.lit(False)),
        "latitude": cast.in_range(F.col("latitude"), -90, 90), "longitude": cast.in_range(F.col("longitude"), -180, 180),
        "crawl_eligible": F.coalesce("crawl_eligible", F.lit(False)), "is_in_latest_snapshot": F.col("last_seen_crawl_date") == F.col("latest"),
    })
    return out.select("place_id", "place_name", "name_vi", "name_en", "province_id", "province_name", "is_province_in_dim", "admin_scope", "latitude", "longitude", "osm_type", "osm_id", "osm_tourism_tag", "osm_natural_tag", "osm_historic_tag", "osm_leisure_tag", "validation_status", "tourism_status", "crawl_eligible", "first_seen_crawl_date", "last_seen_crawl_date", "snapshot_count", "is_in_latest_snapshot", "bronze_run_id", "bronze_ingested_at_utc")


def place_categories(staged: DataFrame, taxonomy_: DataFrame, places_: DataFrame) -> DataFrame:
    valid = op.live(staged, "place_id", "category_id")
    top = newest_crawl(valid, "place_id", "category_id", then=[F.col("is_primary").desc_nulls_last()])
    names = ("category_group", "category_name", "subcategory_name")
    dim = taxonomy_.select("category_id", *[F.col(c).alias(f"t_{c}") for c in names], F.col("name_vi").alias("category_name_vi"), F.col("name_en").alias("category_name_en"), F.lit(True).alias("in_taxonomy"))
    out = op.conform(top, places_).join(dim, "category_id", "left")
    out = out.withColumns({c: F.coalesce(f"t_{c}", c) for c in names} | {
        "place_category_id": op_id("place_id", "category_id"), "is_primary": F.coalesce("is_primary", F.lit(False)), "is_category_in_dim": F.coalesce("in_taxonomy", F.lit(False)),
        "classification_confidence": F.when(F.col("classification_confidence").isin("high", "medium", "low"), F.col("classification_confidence")),
    })
    return out.select("place_category_id", "place_id", "place_name", "province_id", "province_name", "is_place_in_dim", "category_id", *names, "category_name_vi", "category_name_en", "is_category_in_dim", "is_primary", "classification_method", "classification_confidence", "bronze_crawl_date", "bronze_run_id", "bronze_ingested_at_utc")


def op_id(*columns: str):
    return text.row_id(*[F.col(c) for c in columns])


STARS = [f"rating_{k}_count" for k in (5, 4, 3, 2, 1)]


def rating_snapshots(staged: DataFrame, places_: DataFrame) -> DataFrame:
    """A row a place and day; ``is_latest`` marks the place's last day, for the marts."""
    valid = op.live(staged, "place_id", "crawled_at_utc").where("crawl_status = 'SUCCESS'").withColumn("snapshot_date", F.col("crawled_at_utc").cast("date"))
    top = op.latest_by(valid, ["place_id", "snapshot_date"])
    top = top.withColumns({"google_rating": cast.in_range(F.col("google_rating"), 0, 5)} | {c: cast.not_negative(F.col(c)) for c in ("google_review_count", *STARS)})
    top = top.withColumn("rating_distribution_total", sum((F.coalesce(c, F.lit(0)) for c in STARS), F.lit(0).cast("bigint")))
    out = op.series(top, ["place_id"], "snapshot_date", ["google_rating", "google_review_count"], None)
    out = out.withColumn("is_latest", F.lead("snapshot_date").over(Window.partitionBy("place_id").orderBy(F.col("snapshot_date").asc_nulls_last())).isNull())
    out = out.withColumns({
        "rating_delta": cast.rounded(F.col("google_rating") - F.col("prev_google_rating"), 4), "review_count_delta": F.col("google_review_count") - F.col("prev_google_review_count"),
        "rating_snapshot_id": op_id("place_id", "snapshot_date"), "has_rating_value": F.col("google_rating").isNotNull(), "has_rating_distribution": F.col("rating_distribution_total") > 0, "source": F.lit("google_maps"),
    })
    return op.conform(out, places_).select("rating_snapshot_id", "place_id", "place_name", "province_id", "province_name", "is_place_in_dim", "snapshot_date", "crawled_at_utc", "google_maps_url", "google_rating", "google_review_count", *STARS, "rating_distribution_total", "has_rating_value", "has_rating_distribution", "snapshot_seq_num", "prev_snapshot_date", "days_since_prev_snapshot", "prev_google_rating", "rating_delta", "prev_google_review_count", "review_count_delta", "crawl_status", "source", "bronze_run_id", "is_latest")


def not_ahead(t: str):
    """Null if more than a day after the crawl."""
    return F.when(~(F.col(t) > F.col("crawled_at_utc") + F.expr("INTERVAL '1' DAY")), F.col(t))


def valid_videos(staged: DataFrame) -> DataFrame:
    return op.live(staged, "place_id", "video_id", "crawled_at_utc")


def checked_videos(df: DataFrame) -> DataFrame:
    numbers = {c: cast.not_negative(F.col(c)) for c in ("views", "duration_seconds") if c in df.columns}
    out = df.withColumns({"published_at_utc": not_ahead("published_at_utc"), **numbers, "source": F.lit("youtube")})
    return out.withColumns({"published_date": F.col("published_at_utc").cast("date"), "published_month": times.month_of(F.col("published_at_utc"))})


VIDEO = ("video_id", "video_title", "channel_id", "channel_name", "search_query")


def videos(staged: DataFrame, places_: DataFrame) -> DataFrame:
    keys = ["place_id", "video_id"]
    out = checked_videos(op.latest_observed(valid_videos(staged), keys))
    return op.conform(out, places_).select("place_id", "place_name", "province_id", "province_name", "is_place_in_dim", *VIDEO, "views", "duration_seconds", "category", "video_url", "published_at_raw", "published_at_utc", "published_date", "published_month", "crawled_at_utc", "first_crawled_at_utc", "observation_count", "source", "bronze_run_id")


def by_video(rows: DataFrame) -> DataFrame:
    return rows.repartition(*VIDEO_KEYS)


def by_place(staged: DataFrame) -> Callable[[DataFrame], DataFrame] | None:
    """Deals a feed's rows by place, to so many tasks that ROWS_A_TASK rows are in each, about; None if a place has more than a task should hold.

    What is worked out a video, a day and a place then needs no other shuffle.
    """
    n = staged.where("place_id IS NOT NULL").groupBy("place_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if (n["most"] or 0) > scan.HOT_ROWS:
        return None
    tasks = -(-(n["all"] or 0) // ROWS_A_TASK)
    many = tasks > int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lambda rows: rows.repartition(tasks, "place_id") if many else rows.repartition("place_id")


def video_series(staged: DataFrame, dealt: Callable[[DataFrame], DataFrame] = by_video) -> DataFrame:
    """The latest row of a video on each of its days, with the change since the day before.

    One shuffle and one sort serve the windows of a day and of a video. ``_n`` and ``_first`` are the number and the first
    crawl of the day's rows.
    """
    valid = valid_videos(staged).withColumn("snapshot_date", F.col("crawled_at_utc").cast("date"))
    valid = valid.withColumn("_tie", F.xxhash64(*valid.columns))  # before the shuffle, which then carries no column for it
    day = Window.partitionBy(*VIDEO_KEYS, "snapshot_date").orderBy(F.col("crawled_at_utc").desc_nulls_last(), F.col("bronze_ingested_at_utc").desc_nulls_last(), "_tie")
    seen = whole(day)
    top = dealt(valid).withColumns({"_at": F.row_number().over(day), "_n": F.count(F.lit(1)).over(seen), "_first": F.min("crawled_at_utc").over(seen)})
    top = checked_videos(top.where("_at = 1"))
    w = Window.partitionBy(*VIDEO_KEYS).orderBy("snapshot_date")  # days are never null: crawled_at_utc is there
    out = top.withColumns({"snapshot_seq_num": F.row_number().over(w).cast("bigint"), "prev_snapshot_date": F.lag("snapshot_date").over(w), "prev_views": F.lag("views").over(w), "is_newest": F.lead("snapshot_date").over(w).isNull()})
    out = out.withColumns({"days_since_prev_snapshot": F.datediff("snapshot_date", "prev_snapshot_date").cast("bigint"), "views_delta": F.col("views") - F.col("prev_views")})
    return out.withColumn("views_daily_growth", op.velocity(F.col("views_delta"), F.col("days_since_prev_snapshot"))).drop("_at", "_tie")


#: Places' ids begin alike, so a sort compares the videos' first.
VIDEO_KEYS = ("video_id", "place_id")
#: Rows of a task that sorts rows with texts; fewer than a key may have before it is cut into ranges.
ROWS_A_TASK = 500_000

#: What marts read of a video's latest row, and of all its days.
NEWEST = ("place_name", "province_id", "province_name", "video_title", "channel_id", "channel_name", "duration_seconds", "category", "video_url", "published_date", "published_month", "crawled_at_utc")
OF_DAYS = ("snapshot_count", "first_snapshot_date", "latest_snapshot_date", "first_views", "total_views_delta", "snapshot_daily_view_growth")


def whole(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def video_days(staged: DataFrame, dealt: Callable[[DataFrame], DataFrame] = by_video) -> DataFrame:
    """Videos and their days as marts read them: a row a day with its numbers, and the rest in ``newest``, for the last day alone."""
    every = whole(Window.partitionBy(*VIDEO_KEYS).orderBy("snapshot_date"))
    later = F.col("snapshot_seq_num") >= 2
    out = video_series(staged, dealt).withColumns({
        "snapshot_count": F.count(F.lit(1)).over(every), "first_snapshot_date": F.min("snapshot_date").over(every), "latest_snapshot_date": F.max("snapshot_date").over(every),
        "first_views": F.max(F.when(F.col("snapshot_seq_num") == 1, F.col("views"))).over(every), "total_views_delta": F.sum(F.when(later, F.col("views_delta"))).over(every),
        "snapshot_daily_view_growth": cast.mean_rounded(F.when(later, F.col("views_daily_growth")), over=every),
    })
    newest = F.when(F.col("snapshot_date") == F.col("latest_snapshot_date"), F.struct(*NEWEST, *OF_DAYS))
    return out.select("place_id", "video_id", "snapshot_date", "views", "snapshot_seq_num", "views_delta", "views_daily_growth", newest.alias("newest"))


#: What places sum up of their videos' rows.
OF_REACH = ("place_id", "video_id", "video_title", "channel_id", "views", "published_at_utc", "crawled_at_utc", "bronze_ingested_at_utc", "bronze_record_status")


def video_order() -> list:
    """Ascending, with nulls last: the most viewed, then the newest, then the least id."""
    views, day = F.col("views"), F.unix_date("published_date")
    return [views.isNull(), -views, day.isNull(), -day, F.col("video_id")]


def video_reach(staged: DataFrame) -> DataFrame:
    """A row a place: what coverage and profile sum up of its videos and their days, from narrow rows in one shuffle by place.

    Days and months of a place are as many as the calendar has. If a place has too many rows for a task, rows are dealt by video
    and channels are counted on their own. Full ties go by the hash of these columns.
    """
    narrow, dealt = staged.select(*OF_REACH), by_place(staged)
    days = video_series(narrow, dealt or by_video)
    newest, later = F.col("is_newest"), F.col("snapshot_seq_num") >= 2
    of = lambda c: F.when(newest, F.col(c))
    sums = [
        F.count_if(newest).alias("video_count"), F.min(of("published_date")).alias("video_min_published_date"), F.max(of("published_date")).alias("video_max_published_date"), F.collect_set(of("published_month")).alias("video_months"),
        F.count(F.lit(1)).alias("video_snapshot_count"), F.size(F.collect_set("snapshot_date")).cast("bigint").alias("video_snapshot_date_count"), F.min("snapshot_date").alias("video_min_snapshot_date"), F.max("snapshot_date").alias("video_max_snapshot_date"),
        F.max(of("crawled_at_utc")).alias("last_crawled_at_utc"), F.sum(of("views")).alias("total_youtube_views"), cast.rounded(F.avg(of("views")), 2).alias("avg_views_per_video"), F.max(of("views")).alias("max_video_views"),
        F.min_by(F.struct("video_id", "video_title"), F.when(newest, F.struct(*video_order()))).alias("_top"), F.sum(F.when(later, F.col("views_delta"))).alias("total_youtube_views_delta"), cast.mean_rounded(F.when(later, F.col("views_daily_growth"))).alias("avg_daily_youtube_view_growth"),
    ]
    if dealt:
        out = days.groupBy("place_id").agg(*sums, F.size(F.collect_set(of("channel_id"))).cast("bigint").alias("distinct_channel_count"))
    else:
        days = stored(days.select("place_id", "video_id", "video_title", "channel_id", "views", "published_date", "published_month", "crawled_at_utc", "snapshot_date", "snapshot_seq_num", "views_delta", "views_daily_growth", "is_newest"), "reach-days")
        channels = days.where("is_newest").groupBy("place_id").agg(F.countDistinct("channel_id").alias("distinct_channel_count"))
        out = days.groupBy("place_id").agg(*sums).join(channels, "place_id", "left")
    return out.select("*", F.col("_top.video_id").alias("top_video_id"), F.col("_top.video_title").alias("top_video_title")).drop("_top")


def newest_videos(days: DataFrame) -> DataFrame:
    """A row a video, with the place's names as its latest row has them."""
    return days.where("newest IS NOT NULL").select("place_id", "video_id", "views", "newest.*")


def video_snapshots(staged: DataFrame, places_: DataFrame) -> DataFrame:
    out = video_series(staged).withColumn("video_snapshot_id", op_id("place_id", "video_id", "snapshot_date"))
    return op.conform(out, places_).select("video_snapshot_id", "place_id", "place_name", "province_id", "province_name", "is_place_in_dim", *VIDEO, "category", "video_url", "published_at_utc", "published_date", "snapshot_date", "crawled_at_utc", "views", "duration_seconds", "snapshot_seq_num", "prev_snapshot_date", "days_since_prev_snapshot", "prev_views", "views_delta", "views_daily_growth", "source", "bronze_run_id")


def comments(staged: DataFrame, places_: DataFrame) -> DataFrame:
    key = F.coalesce("comment_id", text.surrogate_key(F.col("video_id"), F.coalesce("author", F.lit("")), F.coalesce("comment_text", F.lit(""))))
    valid = op.live(staged, "place_id", "video_id", "crawled_at_utc").where("comment_id IS NOT NULL OR comment_text IS NOT NULL")
    valid = valid.withColumns({"comment_key": key, "is_surrogate_comment_key": F.col("comment_id").isNull()})
    keys = ["place_id", "comment_key"]
    top = op.latest_observed(valid, keys).withColumn("said", times.relative_text(F.col("comment_created_at_raw")))
    top = top.withColumns({"unit": times.relative_unit(F.col("said")), "exact": times.utc_timestamp(F.col("comment_created_at_raw"))})
    about = times.relative_date(F.col("unit"), times.relative_quantity(F.col("said")), F.col("crawled_at_utc").cast("date")).cast("timestamp_ntz")
    top = top.withColumn("comment_created_at_utc", F.coalesce("exact", about)).withColumn("comment_created_at_utc", not_ahead("comment_created_at_utc"))
    precision = F.when(F.col("comment_created_at_utc").isNull(), "unknown").when(F.col("exact").isNotNull(), "exact").otherwise(times.relative_precision(F.col("unit")))
    out = top.withColumns({"comment_created_at_precision": precision, "comment_created_date": F.col("comment_created_at_utc").cast("date"), "likes": cast.not_negative(F.col("likes")), "is_reply": F.coalesce("is_reply", F.lit(False)), "source": F.lit("youtube")})
    out = op.conform(out, places_)
    return out.select("place_id", "place_name", "province_id", "province_name", "is_place_in_dim", "video_id", "video_title", "comment_key", "comment_id", "is_surrogate_comment_key", "author", "comment_text", "likes", "is_reply", "comment_created_at_raw", "comment_created_at_utc", "comment_created_at_precision", "comment_created_date", "crawled_at_utc", "first_crawled_at_utc", "observation_count", "source", "bronze_run_id")


def fallback_places(feeds: Sequence[Callable[[DataFrame], DataFrame]], wanted: DataFrame) -> DataFrame:
    """The best metadata of the wanted places in staging rows, failed crawls included: earlier feeds first, then the newest.

    ``feeds`` give the staging rows at some places, as only these are to be cleaned and cast.
    """
    wanted = stored(wanted, "wanted-places")
    few = wanted.limit(scan.FEW + 1).count() <= scan.FEW
    columns = ["place_id", "place_name", "province_id", "province_name", "crawled_at_utc"]
    both = reduce(DataFrame.unionByName, [df.select(*columns, F.lit(k).alias("priority")) for k, df in enumerate((at(F.broadcast(wanted) if few else wanted) for at in feeds), 1)])
    named = both.where(F.col("place_id").isNotNull() & F.col("place_name").isNotNull())
    return op.first_by(named, ["place_id"], [F.col("priority"), F.col("crawled_at_utc").desc_nulls_last()]).select("place_id", *[F.col(c).alias(f"fb_{c}") for c in columns[1:4]])


def reviews(staged: DataFrame, places_: DataFrame, feeds: Sequence[Callable[[DataFrame], DataFrame]], provinces_: DataFrame) -> DataFrame:
    valid = op.live(staged, "review_id", "place_id", "crawled_at_utc").where("upper(place_id) <> 'TEST'")
    seen = valid.withColumn("said", times.relative_text(F.col("review_date_raw")))
    seen = seen.withColumn("unit", times.relative_unit(F.col("said")))
    seen = seen.withColumns({"review_date": times.relative_date(F.col("unit"), times.relative_quantity(F.col("said")), F.col("crawled_at_utc").cast("date")), "review_date_precision": times.relative_precision(F.col("unit")), "is_edited": F.coalesce(F.col("review_date_raw").rlike("chỉnh sửa|edited"), F.lit(False))})
    dated = ("review_date_raw", "review_date", "review_date_precision")
    # one aggregation a review: the newest row, and the date of the most precise, then earliest observation
    rank = F.struct(times.precision_rank(F.col("review_date_precision")).alias("p"), F.col("crawled_at_utc").alias("t"), F.coalesce(F.col("bronze_ingested_at_utc"), F.lit("9999-12-31").cast("timestamp_ntz")).alias("i"))
    late = F.struct(F.col("crawled_at_utc").alias("t"), F.coalesce(F.col("bronze_ingested_at_utc"), F.lit("0001-01-01").cast("timestamp_ntz")).alias("i"))
    kept = ("place_id", "rating", "review_text", "is_edited", "likes_count", "source", "crawled_at_utc", "bronze_run_id")
    # stored, so that its size is known: where its places are few they are broadcast, and no other row of staging is sorted
    one = stored(seen.groupBy("review_id").agg(F.max_by(F.struct(*kept), late).alias("latest"), F.min_by(F.struct(*dated), rank).alias("best"), F.count(F.lit(1)).alias("observation_count"), F.min("crawled_at_utc").alias("first_crawled_at_utc")), "latest-reviews")
    out = one.select("review_id", "latest.*", "best.*", "observation_count", "first_crawled_at_utc")
    out = out.withColumns({"rating": cast.in_range(F.col("rating"), 1, 5), "has_review_text": F.col("review_text").isNotNull(), "review_month": times.month_of(F.col("review_date")), "likes_count": cast.not_negative(F.col("likes_count")), "source": F.coalesce("source", F.lit("google_maps"))})
    dim = provinces_.select(F.col("province_id"), F.col("province_name").alias("prov_name"))
    out = op.conform(out, places_)
    open_ = out.where("place_name IS NULL OR province_id IS NULL OR province_name IS NULL").select("place_id").distinct()
    out = out.join(fallback_places(feeds, open_), "place_id", "left")
    out = out.withColumns({"place_name": F.coalesce("place_name", "fb_place_name"), "province_id": F.coalesce("province_id", "fb_province_id")}).join(dim, "province_id", "left")
    out = out.withColumn("province_name", F.coalesce("province_name", "prov_name", "fb_province_name"))
    return out.select("review_id", "place_id", "place_name", "province_id", "province_name", "is_place_in_dim", "rating", "review_text", "has_review_text", *dated, "review_month", "is_edited", "likes_count", "source", "crawled_at_utc", "first_crawled_at_utc", "observation_count", "bronze_run_id")


def coverage(places_: DataFrame, reviews_: DataFrame, reach: DataFrame, comments_: DataFrame, ratings_: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """How far each place's history reaches, and whether a forecast can stand on it. ``reach``: ``video_reach``."""
    n = F.count(F.lit(1))
    known = F.col("review_date_precision").isin("day", "week", "month")
    said = F.col("comment_created_at_precision").isin("exact", "day", "week", "month")
    comment_month = times.month_of(F.col("comment_created_date"))
    stats = [
        reviews_.groupBy("place_id").agg(n.alias("review_count"), F.count("review_date").alias("review_dated_count"), F.min("review_date").alias("review_min_date"), F.max("review_date").alias("review_max_date"), F.countDistinct(F.when(known, F.col("review_month"))).alias("review_active_month_count")),
        reach.select("place_id", "video_count", "video_min_published_date", "video_max_published_date", F.size("video_months").alias("video_active_month_count"), "video_snapshot_count", "video_snapshot_date_count", "video_min_snapshot_date", "video_max_snapshot_date"),
        comments_.groupBy("place_id").agg(n.alias("comment_count"), F.count("comment_created_date").alias("comment_dated_count"), F.min("comment_created_date").alias("comment_min_date"), F.max("comment_created_date").alias("comment_max_date"), F.countDistinct(F.when(said, comment_month)).alias("comment_active_month_count")),
        ratings_.groupBy("place_id").agg(n.alias("rating_snapshot_count"), F.min("snapshot_date").alias("rating_min_snapshot_date"), F.max("snapshot_date").alias("rating_max_snapshot_date")),
    ]
    months = [reviews_.where(known).select("place_id", F.col("review_month").alias("m")), reach.select("place_id", F.explode("video_months").alias("m")), comments_.where(said).select("place_id", comment_month.alias("m"))]
    active = reduce(DataFrame.union, months).where("m IS NOT NULL").distinct().groupBy("place_id").agg(n.alias("total_active_month_count"))
    if settings.as_of_date is None:
        days = [df.agg(F.max(F.col(c).cast("date")).alias("d")) for df, c in ((reviews_, "crawled_at_utc"), (reach, "last_crawled_at_utc"), (comments_, "crawled_at_utc"), (ratings_, "snapshot_date"))]
        as_of = reduce(DataFrame.union, days).agg(F.max("d").alias("as_of_date"))  # one row
    else:
        as_of = places_.sparkSession.range(1).select(F.lit(settings.as_of_date).alias("as_of_date"))
    out = places_.select("place_id", "place_name", "province_id", "province_name", "crawl_eligible", "tourism_status")
    for s in [*stats, active]:
        out = out.join(s, "place_id", "left")
    out = out.crossJoin(F.broadcast(as_of))
    counts = [c for c in out.columns if c.endswith("_count")]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in counts})
    out = out.withColumns({"total_record_count": F.col("review_count") + F.col("video_count") + F.col("comment_count"), "first_activity_date": F.least("review_min_date", "video_min_published_date", "comment_min_date"), "last_activity_date": F.greatest("review_max_date", "video_max_published_date", "comment_max_date")})
    out = out.withColumns({"history_span_months": F.coalesce(times.months_between(F.col("first_activity_date"), F.col("last_activity_date")) + 1, F.lit(0)).cast("bigint"), "days_since_last_activity": times.days_between(F.col("last_activity_date"), F.col("as_of_date"))})
    out = out.withColumns({
        "has_temporal_history": (F.col("history_span_months") >= settings.min_history_months) & (F.col("total_active_month_count") >= settings.min_active_months),
        "has_recent_data": F.coalesce(F.col("days_since_last_activity") <= settings.recent_days, F.lit(False)),
        "is_sparse": (F.col("total_record_count") > 0) & (F.col("total_active_month_count") <= settings.sparse_max_months),
        "has_rating_history": F.col("rating_snapshot_count") >= settings.min_snapshots, "has_video_view_history": F.col("video_snapshot_date_count") >= settings.min_snapshots,
    })
    status = F.when(F.col("total_record_count") == 0, "no_data").when(F.col("has_temporal_history") & F.col("has_recent_data"), "forecast_ready").when(F.col("is_sparse"), "sparse").when(F.col("has_recent_data"), "recent_only").when(F.col("has_temporal_history"), "stale_history").otherwise("partial")
    return out.withColumns({"coverage_status": status, "is_forecast_eligible": F.col("has_temporal_history") & F.col("has_recent_data")})

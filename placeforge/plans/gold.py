"""Gold marts over the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cast, times
from ..operators import scan
from ..operators import shaping as op
from ..settings import DEFAULTS, Settings
from ..sources.tables import stored
from .silver import STARS, op_id

#: So many counts of comments may be broadcast.
FEW_COUNTS = 100_000
CATEGORY = ["primary_category_id", "primary_category_group", "primary_category_name"]


def primary_category(place_categories: DataFrame) -> DataFrame:
    top = op.first_by(place_categories, ["place_id"], [F.col("is_primary").desc_nulls_last(), F.col("category_id").asc_nulls_last()])
    return top.select("place_id", *[F.col(c.removeprefix("primary_")).alias(c) for c in CATEGORY])


def monthly_growth(reviews: DataFrame, videos: DataFrame, comments: DataFrame, places: DataFrame, place_categories: DataFrame) -> DataFrame:
    names = ["place_name", "province_id", "province_name"]
    keys = ["place_id", "activity_month"]
    rating = F.col("rating")
    # a row an event with what it counts for, and one aggregation over all three kinds; videos are unique by place and id
    said = reviews.where("review_month IS NOT NULL").select("place_id", F.col("review_month").alias("activity_month"), *[F.col(c).alias(f"r_{c}") for c in names], F.lit(1).alias("review"), F.col("has_review_text").alias("with_text"), "rating", "likes_count")
    shown = videos.where("published_month IS NOT NULL").select("place_id", F.col("published_month").alias("activity_month"), *[F.col(c).alias(f"v_{c}") for c in names], F.col("video_id").isNotNull().alias("video"), "views")
    answered = comments.where("comment_created_date IS NOT NULL").select("place_id", times.month_of(F.col("comment_created_date")).alias("activity_month"), F.lit(1).alias("comment"))
    every = said.unionByName(shown, allowMissingColumns=True).unionByName(answered, allowMissingColumns=True)
    out = every.groupBy(*keys).agg(
        *[F.max(f"{side}_{c}").alias(f"{side}_{c}") for side in "rv" for c in names], F.count("review").alias("new_reviews_count"), F.count_if(F.col("with_text")).alias("new_reviews_with_text_count"), F.count("rating").alias("rated"),
        cast.rounded(F.avg("rating"), 2).alias("monthly_avg_review_rating"), F.count_if(rating >= 4).alias("positive_reviews_count"), F.count_if(rating == 3).alias("neutral_reviews_count"), F.count_if(rating <= 2).alias("negative_reviews_count"), F.sum("likes_count").alias("review_likes_sum"),
        F.count_if(F.col("video")).alias("new_videos_published_count"), F.sum("views").alias("new_videos_current_views_sum"), F.count("comment").alias("new_comments_count"),
    )
    counts = ["new_reviews_count", "new_reviews_with_text_count", "rated", "positive_reviews_count", "neutral_reviews_count", "negative_reviews_count", "review_likes_sum", "new_videos_published_count", "new_videos_current_views_sum", "new_comments_count"]
    out = out.withColumns({k: F.coalesce(k, F.lit(0)).cast("bigint") for k in counts} | {n: F.coalesce(f"r_{n}", f"v_{n}") for n in names})
    w = Window.partitionBy("place_id").orderBy("activity_month")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({
        "activity_year": F.year("activity_month").cast("bigint"), "activity_quarter": F.quarter("activity_month").cast("bigint"),
        "monthly_net_sentiment_pct": cast.ratio_pct(F.col("positive_reviews_count") - F.col("negative_reviews_count"), F.col("rated")),
        "cumulative_reviews_count": F.sum("new_reviews_count").over(so_far), "cumulative_videos_count": F.sum("new_videos_published_count").over(so_far),
        "prev_month_reviews_count": F.lag("new_reviews_count").over(w), "rolling_3m_reviews_avg": cast.rounded(F.avg("new_reviews_count").over(w.rowsBetween(-2, 0)), 2),
    })
    change = F.col("new_reviews_count") - F.col("prev_month_reviews_count")
    out = out.withColumns({"mom_reviews_delta": change, "mom_reviews_growth_pct": cast.ratio_pct(change, F.col("prev_month_reviews_count")), "place_month_id": op_id("place_id", "activity_month")})
    out = op.conform(out, places).join(primary_category(place_categories), "place_id", "left")
    return out.select("place_month_id", "place_id", *names, "is_place_in_dim", *CATEGORY, "activity_month", "activity_year", "activity_quarter", "new_reviews_count", "new_reviews_with_text_count", "monthly_avg_review_rating", "positive_reviews_count", "neutral_reviews_count", "negative_reviews_count", "monthly_net_sentiment_pct", "review_likes_sum", "new_videos_published_count", "new_videos_current_views_sum", "new_comments_count", "cumulative_reviews_count", "cumulative_videos_count", "prev_month_reviews_count", "mom_reviews_delta", "mom_reviews_growth_pct", "rolling_3m_reviews_avg")


def daily_views(video_snapshots: DataFrame) -> DataFrame:
    """Videos and views of a place on each of its snapshot days, with the change since the last one."""
    # a video has one row a day
    out = video_snapshots.groupBy("place_id", F.col("snapshot_date").alias("youtube_snapshot_date")).agg(F.count("video_id").alias("tracked_videos_count"), F.sum("views").alias("total_youtube_views"))
    w = Window.partitionBy("place_id").orderBy("youtube_snapshot_date")
    out = out.withColumns({"prev_total_youtube_views": F.lag("total_youtube_views").over(w), "_days": F.datediff("youtube_snapshot_date", F.lag("youtube_snapshot_date").over(w))})
    out = out.withColumn("youtube_views_delta", F.col("total_youtube_views") - F.col("prev_total_youtube_views"))
    return out.withColumn("youtube_views_daily_growth", op.velocity(F.col("youtube_views_delta"), F.col("_days"))).drop("_days")


TRACKED = ["tracked_videos_count", "total_youtube_views", "prev_total_youtube_views", "youtube_views_delta", "youtube_views_daily_growth"]


def snapshot_trajectory(ratings: DataFrame, video_snapshots: DataFrame, places: DataFrame, place_categories: DataFrame) -> DataFrame:
    axis = ratings.withColumn("review_daily_velocity", op.velocity(F.col("review_count_delta"), F.col("days_since_prev_snapshot")))
    out = op.nearest_asof(axis, daily_views(video_snapshots), "place_id", "snapshot_date", "youtube_snapshot_date", TRACKED, None)
    out = out.withColumns({"has_youtube_snapshot": F.col("youtube_snapshot_date").isNotNull(), "tracked_videos_count": F.coalesce("tracked_videos_count", F.lit(0)).cast("bigint"), "has_google_maps_snapshot": F.lit(True), "place_snapshot_id": F.col("rating_snapshot_id")})
    out = op.conform(out, places).join(primary_category(place_categories), "place_id", "left")
    return out.select("place_snapshot_id", "place_id", "place_name", "province_id", "province_name", "is_place_in_dim", *CATEGORY, "snapshot_date", "snapshot_seq_num", "prev_snapshot_date", "days_since_prev_snapshot", "has_google_maps_snapshot", "google_rating", "prev_google_rating", "rating_delta", "google_review_count", "prev_google_review_count", "review_count_delta", "review_daily_velocity", *STARS, "rating_distribution_total", "has_youtube_snapshot", *TRACKED)


def by_views() -> list[Column]:
    return [F.col("views").desc_nulls_last(), F.col("published_date").desc_nulls_last(), F.col("video_id").asc_nulls_last()]


def video_performance(videos: DataFrame, places: DataFrame, comments: DataFrame, most: int | None = scan.HOT_ROWS) -> DataFrame:
    """``videos`` carry what their days sum up to. The ranks and the dimension meet them in one shuffle by place.

    ``most``: as in ``scan``; None if no place has more rows than a task should hold. Counts of comments are broadcast if they are few.
    """
    keys = ["place_id", "video_id"]
    c = comments.groupBy(*keys).agg(F.count(F.lit(1)).alias("crawled_comment_count"))
    c = stored(c, "comment-counts")
    c = F.broadcast(c) if c.limit(FEW_COUNTS + 1).count() <= FEW_COUNTS else c
    out = scan.numbered(videos, ["place_id"], by_views(), "place_video_view_rank", most)
    out = op.conform(out, places).join(c, keys, "left")
    age = times.days_between(F.col("published_date"), F.col("latest_snapshot_date"))
    out = out.withColumns({"video_age_days": F.when(age >= 0, age), "avg_daily_views_since_publish": op.velocity(F.col("views"), age), "crawled_comment_count": F.coalesce("crawled_comment_count", F.lit(0)).cast("bigint"), "place_video_id": op_id("place_id", "video_id")})
    return out.select("place_video_id", "place_id", "place_name", "province_id", "province_name", "is_place_in_dim", "video_id", "video_title", "channel_id", "channel_name", "category", "video_url", "published_date", "published_month", "duration_seconds", "video_age_days", "first_snapshot_date", "latest_snapshot_date", "snapshot_count", "first_views", F.col("views").alias("latest_views"), "total_views_delta", "avg_daily_views_since_publish", "snapshot_daily_view_growth", "crawled_comment_count", "place_video_view_rank")


def popularity() -> Column:
    return F.coalesce("latest_google_review_count", "crawled_review_count", F.lit(0))


def by_popularity() -> list[Column]:
    return [popularity().desc(), F.col("total_youtube_views").desc_nulls_last(), F.col("place_id").asc_nulls_last()]


def place_360(places: DataFrame, coverage: DataFrame, place_categories: DataFrame, ratings: DataFrame, reviews: DataFrame, reach: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row a place: who it is, how it is rated, how that moves, how far its videos reach, and its stage."""
    zero = F.lit(0)
    # a place's first and last day, one row each
    first, last = F.col("snapshot_seq_num") == 1, F.col("is_latest")
    picked = [F.max(F.when(last, F.col(c))).alias(a) for c, a in {"snapshot_date": "latest_rating_snapshot_date", "google_rating": "latest_google_rating", "google_review_count": "latest_google_review_count", **{c: c for c in (*STARS, "rating_distribution_total")}}.items()]
    picked += [F.max(F.when(first, F.col(c))).alias(f"first_{a}") for c, a in {"snapshot_date": "rating_snapshot_date", "google_rating": "google_rating", "google_review_count": "google_review_count"}.items()]
    ends = ratings.where(first | last).groupBy("place_id").agg(*picked)
    dated = reviews.crossJoin(F.broadcast(coverage.agg(F.max("as_of_date").alias("as_of_date"))))  # one day for all places
    day, as_of, rating = F.col("review_date"), F.col("as_of_date"), F.col("rating")
    r = dated.groupBy("place_id").agg(
        F.count(F.lit(1)).alias("crawled_review_count"), cast.rounded(F.avg("rating"), 2).alias("crawled_avg_rating"), F.count_if(F.col("has_review_text")).alias("texts"), F.count("rating").alias("rated"), F.count_if(rating >= 4).alias("good"), F.count_if(rating <= 2).alias("bad"),
        F.count_if(day > F.date_sub(as_of, 90)).alias("reviews_last_90d_count"), F.count_if((day > F.date_sub(as_of, 180)) & (day <= F.date_sub(as_of, 90))).alias("reviews_prev_90d_count"),
    )
    v = reach.select("place_id", F.col("video_count").alias("youtube_video_count"), "distinct_channel_count", "total_youtube_views", "avg_views_per_video", "max_video_views", "top_video_id", "top_video_title", "total_youtube_views_delta", "avg_daily_youtube_view_growth")
    cats = place_categories.groupBy("place_id").agg(F.count("category_id").alias("category_count"))  # a place has a category once
    cov = coverage.select("place_id", "rating_snapshot_count", "video_snapshot_date_count", "total_active_month_count", "history_span_months", "coverage_status", "is_forecast_eligible")
    out = places.select("place_id", "place_name", "name_vi", "name_en", "province_id", "province_name", "admin_scope", "latitude", "longitude", "tourism_status", "crawl_eligible").join(cov, "place_id")
    for side in (primary_category(place_categories), cats, ends, r, v):
        out = out.join(side, "place_id", "left")
    out = out.withColumns({c: F.coalesce(c, zero).cast("bigint") for c in ("category_count", "crawled_review_count", "reviews_last_90d_count", "reviews_prev_90d_count", "youtube_video_count", "distinct_channel_count", "total_youtube_views")})
    two, total = F.col("rating_snapshot_count") >= 2, F.coalesce("rating_distribution_total", zero)
    star = lambda k: F.coalesce(f"rating_{k}_count", zero)
    last, prev = F.col("reviews_last_90d_count"), F.col("reviews_prev_90d_count")
    sentiment = F.when(total > 0, cast.rounded((star(5) + star(4) - star(1) - star(2)) * F.lit(100.0) / total, 2)).when(F.col("rated") > 0, cast.rounded((F.col("good") - F.col("bad")) * F.lit(100.0) / F.col("rated"), 2))
    out = out.withColumns({f"rating_{k}_pct": cast.ratio_pct(star(k), total) for k in (5, 4, 3, 2, 1)} | {
        "total_rating_delta": F.when(two, cast.rounded(F.col("latest_google_rating") - F.col("first_google_rating"), 4)), "total_review_count_delta": F.when(two, F.col("latest_google_review_count") - F.col("first_google_review_count")),
        "net_sentiment_score": sentiment, "text_review_ratio": cast.ratio_pct(F.col("texts"), F.col("crawled_review_count")), "recent_review_momentum_pct": cast.ratio_pct(last - prev, prev),
    })
    moved, gained = F.col("total_rating_delta"), F.coalesce("total_youtube_views_delta", zero)
    trend = F.when((F.col("rating_snapshot_count") == 0) | F.col("latest_google_rating").isNull(), "no_data").when((F.col("rating_snapshot_count") == 1) | moved.isNull(), "single_snapshot").when(moved >= settings.rating_trend, "improving").when(moved <= -settings.rating_trend, "declining").otherwise("stable")
    growth = F.when(F.col("youtube_video_count") == 0, "no_video").when(F.col("video_snapshot_date_count") < 2, "single_snapshot").when((gained > 0) & (F.coalesce("avg_daily_youtube_view_growth", zero) >= settings.surging_views_a_day), "surging").when(gained > 0, "growing").when(gained == 0, "steady").otherwise("stagnant")
    out = out.withColumns({"rating_trend_direction": trend, "views_growth_direction": growth, "province_popularity_rank": F.row_number().over(Window.partitionBy("province_id").orderBy(*by_popularity())).cast("bigint")})
    out = op.global_rank(out, by_popularity(), "national_popularity_rank")
    momentum, views = F.coalesce("recent_review_momentum_pct", F.lit(0.0)), F.col("total_youtube_views")
    large = (popularity() >= 500) | (views >= 500_000)
    rising = (F.col("rating_trend_direction") == "improving") | F.col("views_growth_direction").isin("surging", "growing") | (momentum >= settings.momentum_growth_pct)
    falling = (F.col("rating_trend_direction") == "declining") | (F.coalesce("latest_google_rating", "crawled_avg_rating", F.lit(5.0)) < 3.5) | ((momentum <= settings.momentum_decline_pct) & (prev >= settings.momentum_min_reviews))
    stage = (
        F.when(F.col("coverage_status").isin("no_data", "sparse") | ((popularity() < 10) & (views < 1000)), "Emerging / Low Data").when(falling, "Cooling / At Risk").when(large & (rising | (last >= 10)), "Leading Hotspot")
        .when(large, "Established Destination").when(rising | (last >= settings.momentum_min_reviews), "Rising Star").otherwise("Steady Destination")
    )
    return out.withColumn("place_development_stage", stage).select("place_id", "place_name", "name_vi", "name_en", "province_id", "province_name", "admin_scope", "latitude", "longitude", "tourism_status", "crawl_eligible", *CATEGORY, "category_count", "latest_google_rating", "latest_google_review_count", "latest_rating_snapshot_date", "first_google_rating", "first_google_review_count", "first_rating_snapshot_date", "total_rating_delta", "total_review_count_delta", *[f"rating_{k}_pct" for k in (5, 4, 3, 2, 1)], "net_sentiment_score", "rating_trend_direction", "crawled_review_count", "crawled_avg_rating", "text_review_ratio", "reviews_last_90d_count", "reviews_prev_90d_count", "recent_review_momentum_pct", "youtube_video_count", "distinct_channel_count", "total_youtube_views", "avg_views_per_video", "max_video_views", "top_video_id", "top_video_title", "total_youtube_views_delta", "avg_daily_youtube_view_growth", "views_growth_direction", "coverage_status", "is_forecast_eligible", "total_active_month_count", "history_span_months", "province_popularity_rank", "national_popularity_rank", "place_development_stage")


def tourism_totals(prefix: str) -> list[Column]:
    """What provinces and categories sum over their places."""
    rating = F.coalesce("latest_google_rating", "crawled_avg_rating")
    weight = F.greatest(F.coalesce("latest_google_review_count", "crawled_review_count", F.lit(1)), F.lit(1))
    return [
        op.weighted_average(rating, weight).alias(f"{prefix}_weighted_avg_rating"), cast.mean_rounded(rating).alias(f"{prefix}_simple_avg_rating"), F.sum("latest_google_review_count").alias("total_google_review_count"), F.sum("crawled_review_count").alias("total_crawled_review_count"),
        cast.mean_rounded(F.col("net_sentiment_score")).alias(f"{prefix}_net_sentiment_score"), F.sum("youtube_video_count").alias("total_youtube_videos_count"), F.sum("total_youtube_views").alias("total_youtube_views"), cast.rounded(F.avg("total_youtube_views"), 2).alias("avg_views_per_place"), F.sum("total_youtube_views_delta").alias("total_youtube_views_delta"),
    ]


def filled(df: DataFrame, *names: str) -> DataFrame:
    """Null sums and counts as 0."""
    return df.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in names} | {"avg_views_per_place": F.coalesce("avg_views_per_place", F.lit(0.0))})


def reach() -> Column:
    return (F.col("total_google_review_count") + F.col("total_crawled_review_count")).desc()


TOTALS = ("total_google_review_count", "total_crawled_review_count", "total_youtube_videos_count", "total_youtube_views")


def province_summary(provinces: DataFrame, profile: DataFrame) -> DataFrame:
    stage = F.col("place_development_stage")
    active = (F.col("crawled_review_count") > 0) | (F.col("youtube_video_count") > 0) | (F.coalesce("latest_google_review_count", F.lit(0)) > 0)
    agg = profile.groupBy("province_id").agg(F.count(F.lit(1)).alias("total_places_count"), F.count_if(active).alias("active_places_count"), F.count_if(F.col("is_forecast_eligible")).alias("forecast_ready_places_count"), F.count_if(stage == "Leading Hotspot").alias("leading_hotspot_count"), F.count_if(stage == "Rising Star").alias("rising_star_count"), *tourism_totals("province"), cast.mean_rounded(F.col("avg_daily_youtube_view_growth")).alias("province_avg_daily_view_growth"))
    best = lambda order, suffix: op.first_by(profile, ["province_id"], order).select("province_id", F.col("place_id").alias(f"top_place_id_by_{suffix}"), F.col("place_name").alias(f"top_place_name_by_{suffix}"))
    by_views = best([F.col("total_youtube_views").desc_nulls_last(), F.col("crawled_review_count").desc_nulls_last(), F.col("place_id").asc_nulls_last()], "views")
    out = provinces.select("province_id", "province_name", "admin_scope", "center_lat", "center_lon", "min_lat", "max_lat", "min_lon", "max_lon", "geojson_url").join(agg, "province_id", "left").join(by_views, "province_id", "left").join(best(by_popularity(), "reviews"), "province_id", "left")
    out = filled(out, "total_places_count", "active_places_count", "forecast_ready_places_count", "leading_hotspot_count", "rising_star_count", *TOTALS)
    return op.global_rank(out, [reach(), F.col("total_youtube_views").desc(), F.col("province_id").asc()], "national_tourism_rank")


def category_summary(taxonomy: DataFrame, place_categories: DataFrame, profile: DataFrame) -> DataFrame:
    bridge = place_categories.select("category_id", "place_id", "is_primary")
    agg = bridge.join(profile, "place_id", "left").groupBy("category_id").agg(F.countDistinct("place_id").alias("total_places_count"), F.countDistinct(F.when(F.col("is_primary"), F.col("place_id"))).alias("primary_places_count"), F.countDistinct("province_id").alias("provinces_covered_count"), *tourism_totals("category"))
    top = op.first_by(bridge.select("category_id", "place_id").join(profile, "place_id"), ["category_id"], by_popularity()).select("category_id", F.col("place_id").alias("top_place_id"), F.col("place_name").alias("top_place_name"))
    out = taxonomy.select("category_id", "category_group", "category_name", "subcategory_name", "name_vi", "name_en").join(agg, "category_id", "left").join(top, "category_id", "left")
    out = filled(out, "total_places_count", "primary_places_count", "provinces_covered_count", *TOTALS)
    return op.global_rank(out, [reach(), F.col("total_youtube_views").desc(), F.col("category_id").asc()], "category_popularity_rank")

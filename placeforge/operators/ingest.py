"""Ingestion: row errors, quarantine, metadata, event dates, checkpoints and work plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..functions.cast import NUMBER


@dataclass(frozen=True)
class Rules:
    """What a dataset's rows must have: fields, ranges of fields, fields that are not negative."""

    required: tuple[str, ...] = ()
    ranges: tuple[tuple[str, float, float], ...] = ()
    non_negative: tuple[str, ...] = ()


LATITUDE, LONGITUDE = ("latitude", -90, 90), ("longitude", -180, 180)
# ---- Fixed values: the datasets' contracts ----
DATASETS = {
    "reference/provinces": Rules(("province_id", "province_name", "min_lon", "min_lat", "max_lon", "max_lat"), (("min_lon", -180, 180), ("min_lat", -90, 90), ("max_lon", -180, 180), ("max_lat", -90, 90))),
    "osm/candidate_places_raw": Rules(("osm_type", "osm_id", "place_name", "latitude", "longitude"), (LATITUDE, LONGITUDE)),
    "osm/candidate_places_validated": Rules(("osm_type", "osm_id", "validation_status"), (LATITUDE, LONGITUDE)),
    "places": Rules(("place_id", "place_name", "province_id", "latitude", "longitude", "validation_status"), (LATITUDE, LONGITUDE)),
    "reference/place_categories": Rules(("place_id", "category_id")),
    "reference/taxonomy": Rules(("category_id", "group", "category")),
    "google_maps/ratings": Rules(("place_id", "place_name", "crawl_status", "crawled_at"), (("google_rating", 0, 5),), ("google_review_count", "rating_1_count", "rating_2_count", "rating_3_count", "rating_4_count", "rating_5_count")),
    "google_maps/reviews": Rules(("review_id", "place_id", "crawled_at_utc"), (("rating", 1, 5),), ("likes_count",)),
    "google_maps/errors": Rules(("place_id", "error_type", "failed_at")),
    "youtube/videos": Rules(("place_id", "video_id", "crawled_at"), (), ("views", "duration_seconds")),
    "youtube/search_candidates": Rules(("place_id", "query", "video_id", "resolution_status", "resolution_score", "crawled_at"), (), ("views", "resolution_score")),
    "youtube/comments": Rules(("place_id", "video_id", "crawled_at_utc"), (), ("likes",)),
    "youtube/crawl_log": Rules(("place_id", "query", "status", "crawled_at"), (), ("video_count",)),
    "youtube/comments_crawl_log": Rules(("place_id", "video_id", "status", "crawled_at"), (), ("comment_count",)),
}
EVENT_TIMES = ("crawled_at_utc", "crawled_at", "failed_at", "ingested_at_utc")
TIERS = ((("attraction", "museum", "theme_park", "monument", "historic", "resort"), 100), (("viewpoint", "peak", "beach", "cave", "waterfall"), 30))
LOWEST_TIER = 15
# ---- End of fixed values ----


def field(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def number(x: Column) -> Column:
    """The number in a text, null if there is none; NaN is one."""
    v = F.trim(x)
    return F.when(v.rlike(NUMBER), v.try_cast("double"))


def row_errors(df: DataFrame, rules: Rules) -> Column:
    """The array of faults of a row: missing:f, range:f, numeric:f, negative:f. NaN is present and out of any range."""
    out = [F.when(F.coalesce(F.trim(field(df, f)), F.lit("")) == "", f"missing:{f}") for f in rules.required]
    malformed = lambda f: F.when((field(df, f) != "") & number(field(df, f)).isNull(), f"numeric:{f}")
    for f, low, high in rules.ranges:
        v = number(field(df, f))
        out += [F.when(F.isnan(v) | (v < low) | (v > high), f"range:{f}"), malformed(f)]
    for f in rules.non_negative:
        v = number(field(df, f))
        out += [F.when(~F.isnan(v) & (v < 0), f"negative:{f}"), malformed(f)]
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


def event_date(df: DataFrame, now: Column) -> Column:
    """The date of the first field that holds a time, or else of ``now``."""
    found = [times.utc_timestamp(F.col(f)) for f in EVENT_TIMES if f in df.columns]
    return F.coalesce(*found, now).cast("date")


def stamped(df: DataFrame, dataset: str, run_id: str, now: Column, source_id: str = "", source_url: str = "", attempt: int = 1, pipeline_version: str = "1.0", crawler_version: str = "adapter-1") -> DataFrame:
    """Rows with their errors (JSON, null without), status, metadata and partition date. Raw fields stay as they are.

    What the caller does not name as source comes from the row: the first id of video, review and place that is not
    empty, and its url, or else the map's.
    """
    own = lambda fields: [F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields if f in df.columns]
    name = F.lit(source_id) if source_id else F.coalesce(*own(("video_id", "review_id", "place_id")), F.lit(""))
    url = F.lit(source_url) if source_url else F.coalesce(*own(("url", "google_maps_url")), F.lit(""))
    found = row_errors(df, DATASETS[dataset])
    out = df.withColumn("_errors", found)
    return out.withColumns({
        "quality_errors": F.when(F.size("_errors") > 0, F.concat(F.lit('["'), F.array_join("_errors", '", "'), F.lit('"]'))), "record_status": F.when(F.size("_errors") == 0, "success").otherwise("quarantine"), "run_id": F.lit(run_id), "source": F.lit(dataset.split("/")[0]), "source_id": name,
        "source_url": url, "pipeline_version": F.lit(pipeline_version), "crawler_version": F.lit(crawler_version), "attempt": F.lit(attempt), "ingested_at_utc": now.cast("string"), "crawl_date": event_date(df, now).cast("string"),
    }).drop("_errors")


def split(stamped_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and quarantined ones with their errors."""
    return stamped_rows.where("record_status = 'success'").drop("quality_errors"), stamped_rows.where("record_status = 'quarantine'")


def rescue(quarantined: DataFrame, dataset: str, time_field: str, fallback: str, run_id: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Quarantined rows with a missing time repaired from another field, validated anew."""
    columns = [c for c in ("quality_errors", "record_status", "run_id", "source_id", "source_url", "pipeline_version", "crawler_version", "attempt", "crawl_date") if c in quarantined.columns]
    repaired = quarantined.withColumn(time_field, F.coalesce(F.nullif(F.trim(F.col(time_field)), F.lit("")), F.col(fallback))).drop(*columns)
    return split(stamped(repaired, dataset, run_id, now))


def latest_status(log: DataFrame, key: str, at: str = "at", status: str = "status", seq: str = "seq") -> DataFrame:
    """The newest event of each item: later times, then later lines win."""
    return log.groupBy(key).agg(F.max_by(status, F.struct(at, seq)).alias(status), F.max(at).alias(at))


def latest_success(log: DataFrame, key: str, at: str = "at", status: str = "status") -> DataFrame:
    return log.groupBy(key).agg(F.max(F.when(F.col(status) == "SUCCESS", F.col(at))).alias(at))


def recency(sources: list[DataFrame], key: str, at: str = "at") -> DataFrame:
    """The newest evidence of several sources of (key, at); rows without a time are none."""
    out = sources[0].select(key, at)
    for s in sources[1:]:
        out = out.unionByName(s.select(key, at))
    return out.where(F.col(at).isNotNull()).groupBy(key).agg(F.max(at).alias(at))


def latest_seen(key: str, history: DataFrame | None = None, data: DataFrame | None = None, checkpoint: DataFrame | None = None) -> DataFrame:
    """When an item was last dealt with: a success in the history, a row of data, or a checkpoint that stands at success or empty.

    ``history``: key, at and status (without a status column every row counts); ``data``: key and at; ``checkpoint``: key,
    at, seq and status, of which the last line of an item counts, and only that.
    """
    sources = []
    if history is not None:
        sources.append(history.where(F.upper("status") == "SUCCESS") if "status" in history.columns else history)
    if data is not None:
        sources.append(data)
    if checkpoint is not None:
        last = checkpoint.groupBy(key).agg(F.max_by(F.struct("at", "status"), "seq").alias("c")).select(key, "c.*")
        sources.append(last.where(F.upper("status").isin("SUCCESS", "EMPTY")))
    return recency(sources, key)


def successful_items(key: str, history: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Items whose last status is success: that of the history's last line, or of the checkpoint's for items that the history lacks."""
    both = history.select(key, "seq", "status", F.lit(1).alias("_rank")).unionByName(checkpoint.select(key, "seq", "status", F.lit(0).alias("_rank")))
    last = both.groupBy(key).agg(F.max_by("status", F.struct("_rank", "seq")).alias("status"))
    return last.where(F.upper(F.trim("status")) == "SUCCESS").select(key)


def review_limit(terms: Column) -> Column:
    """How many reviews an item's categories are worth; terms match inside words."""
    v, out = F.lower(F.coalesce(terms, F.lit(""))), None
    for words, limit in TIERS:
        hit = v.rlike("|".join(words))
        out = F.when(hit, limit) if out is None else out.when(hit, limit)
    return out.otherwise(LOWEST_TIER)


def reference_version(*tables: DataFrame) -> DataFrame:
    """One row with ``version``, a SHA-256 of the tables' contents, whatever the order of their rows.

    A row counts as the first 52 bits of the MD5 of its table's number and its values as text, joined by bars, nulls as
    ``~``; the sum of these numbers and the number of rows are hashed.
    """
    out = None
    for k, df in enumerate(tables):
        parts = [F.lit(str(k)), *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns]]
        row = df.select(F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("decimal(38,0)").alias("h"))
        out = row if out is None else out.unionByName(row)
    return out.agg(F.sha2(F.concat_ws("/", F.coalesce(F.sum("h"), F.lit(0)).cast("decimal(38,0)").cast("string"), F.count(F.lit(1)).cast("string")), 256).alias("version"))


# ---- Fixed values: what tells the kind of an error, and the statuses ----
ERROR_WORDS = (
    ("FAILED_RATE_LIMIT", ("429", "rate", "too many requests")),
    ("FAILED_DATA", ("csv", "column", "keyerror", "valueerror")),
    ("FAILED_SEARCH", ("connection", "timeout", "network", "http")),
)
UNKNOWN_ERROR = "FAILED_UNKNOWN"
# ---- End of fixed values ----


def error_status(message: Column, name: Column) -> Column:
    """The status of an error by the first kind that has a word in its message or in the name of its type."""
    both = [F.lower(F.coalesce(c.cast("string"), F.lit(""))) for c in (message, name)]
    out = None
    for status, words in ERROR_WORDS:
        hit = F.lit(False)
        for w in words:
            hit |= F.contains(both[0], F.lit(w)) | F.contains(both[1], F.lit(w))
        out = F.when(hit, status) if out is None else out.when(hit, status)
    return out.otherwise(UNKNOWN_ERROR)


#: The statuses that make up a run's total.
RUN_STATUSES = ("success", "failed", "skipped", "quarantine", "retry", "empty")


def run_metrics(events: DataFrame, run: str = "run_id", status: str = "status", at: str = "at") -> DataFrame:
    """A row a run: a count for each status, their total, the success rate (1 without events), whether it failed, and its seconds.

    Other statuses are in no count. A run with a failure has failed.
    """
    counts = {s: F.count_if(F.lower(status) == s) for s in RUN_STATUSES}
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    out = events.groupBy(run).agg(*[c.alias(s) for s, c in counts.items()], F.round((F.max(micros) - F.min(micros)) / 1e6, 3).alias("duration_seconds"))
    total = sum((F.col(s) for s in RUN_STATUSES), F.lit(0).cast("long"))
    out = out.withColumn("total", total)
    return out.withColumns({"success_rate": F.when(F.col("total") > 0, F.col("success") / F.col("total")).otherwise(F.lit(1.0)), "run_status": F.when(F.col("failed") > 0, "failed").otherwise("success")})


def audit(df: DataFrame) -> DataFrame:
    """One row: comments, distinct videos and places, accepted and quarantined rows."""
    bad = F.col("bronze_record_status") == "quarantine"
    return df.agg(F.count(F.lit(1)).alias("total"), F.countDistinct("video_id").alias("videos"), F.countDistinct("place_id").alias("places"), F.count_if(~F.coalesce(bad, F.lit(False))).alias("accepted"), F.count_if(bad).alias("quarantined"))

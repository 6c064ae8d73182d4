"""Staging: each raw feed renamed, cast and cleaned by a specification. No filter, no dedup, no join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cast, text, times

#: From a raw column.
RAW_KINDS = {"free": text.clean_text, "date": lambda c: c.try_cast("date"), "asis": lambda c: c}
#: From a raw column that ``clean_null`` has cleaned.
CLEAN_KINDS = {"text": lambda v: v, "lower": F.lower, "upper": F.upper, "int": cast.int_of, "double": cast.double_of, "bool": cast.bool_of, "time": times.timestamp_of, "province": cast.province_of}

#: Every feed's rows carry these.
LINEAGE = {"bronze_run_id": ("run_id", "text"), "bronze_ingested_at_utc": ("ingested_at_utc", "time"), "bronze_record_status": ("record_status", "lower"), "bronze_crawl_date": ("crawl_date", "date"), "bronze_file_path": ("file_path", "asis")}

PLACE = {"place_id": ("place_id", "text"), "place_name": ("place_name", "text"), "province_id": ("province_id", "province"), "province_id_raw": ("province_id", "text"), "province_name": ("province_name", "text")}


def same(kind: str, *names: str) -> dict[str, tuple[str, str]]:
    return {n: (n, kind) for n in names}


SPECS = {
    "provinces": {"province_id": ("province_id", "province"), "province_id_raw": ("province_id", "text"), **same("text", "province_name"), **same("double", "min_lon", "max_lon", "min_lat", "max_lat"), **same("text", "geojson_url"), **same("lower", "admin_scope"), **same("text", "province_set_version"), "fetched_at_utc": ("fetched_at", "time")},
    "places": {**PLACE, **same("text", "name_vi", "name_en"), **same("lower", "admin_scope"), **same("double", "latitude", "longitude"), **same("lower", "osm_type"), **same("text", "osm_id"), "osm_tourism_tag": ("tourism", "text"), "osm_natural_tag": ("natural_tag", "text"), "osm_historic_tag": ("historic", "text"), "osm_leisure_tag": ("leisure", "text"), **same("lower", "validation_status", "tourism_status"), **same("bool", "crawl_eligible")},
    "taxonomy": same("text", "category_id", "category_group", "category_name", "subcategory_name", "name_vi", "name_en"),
    "place_categories": {**same("text", "place_id", "category_id", "category_group", "category_name", "subcategory_name"), **same("bool", "is_primary"), **same("text", "classification_method"), **same("lower", "classification_confidence")},
    "ratings": {**PLACE, **same("text", "google_maps_url"), **same("double", "google_rating"), **same("int", "google_review_count", "rating_5_count", "rating_4_count", "rating_3_count", "rating_2_count", "rating_1_count"), **same("upper", "crawl_status"), "crawled_at_utc": ("crawled_at", "time")},
    "videos": {**PLACE, **same("text", "video_id", "video_title", "channel_id", "channel_name", "search_query"), **same("int", "views", "duration_seconds"), **same("text", "category", "video_url"), "published_at_raw": ("published_at", "text"), "published_at_utc": ("published_at", "time"), "crawled_at_utc": ("crawled_at", "time")},
    "reviews": {**same("text", "review_id", "place_id"), **same("int", "rating"), **same("free", "review_text"), "review_date_raw": ("review_date", "text"), **same("int", "likes_count"), **same("text", "source"), "crawled_at_utc": ("crawled_at", "time")},
    "comments": {**PLACE, **same("text", "video_id", "video_title", "comment_id", "author"), **same("free", "comment_text"), **same("int", "likes"), **same("bool", "is_reply"), "comment_created_at_raw": ("created_at", "text"), "crawled_at_utc": ("crawled_at", "time")},
}


#: More partitions than any table has, so that a coalesce to them changes nothing.
ANY = 1 << 30


def apart(df: DataFrame) -> DataFrame:
    """The same rows, with what stands above and below compiled as two pieces.

    Spark fuses a chain of projections into one method. Some thirty cleaned and cast columns exceed the 64 KB that a method
    may have; then the whole chain is not compiled at all. A coalesce that moves nothing is where one piece ends. Unused
    columns are still left out.
    """
    return df.coalesce(ANY)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, below which no filter goes: it would repeat the cleaning and casting of each column that it reads."""
    return df.where(F.monotonically_increasing_id() >= 0)


def stage(feed: str, raw: DataFrame) -> DataFrame:
    """The staging table of a feed; fields that the raw table lacks are null."""
    columns, spec = {c.lower() for c in raw.columns}, {**SPECS[feed], **LINEAGE}
    value = lambda source: F.col(source) if source.lower() in columns else F.lit(None).cast("string")
    # trimmed and cleaned once, as columns of their own, however often the casts read them
    sources = dict.fromkeys(s for s, kind in spec.values() if kind in CLEAN_KINDS)
    trimmed = apart(raw).withColumns({f"_clean_{s}": text.trim_spaces(value(s)) for s in sources})
    cleaned = trimmed.withColumns({f"_clean_{s}": text.not_null_word(F.col(f"_clean_{s}")) for s in sources})
    return apart(settled(apart(cleaned).select(*[(CLEAN_KINDS[kind](F.col(f"_clean_{source}")) if kind in CLEAN_KINDS else RAW_KINDS[kind](value(source))).alias(name) for name, (source, kind) in spec.items()])))

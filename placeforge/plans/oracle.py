"""DuckDB SQL for the registered queries: the same results by another engine, in its own terms."""

from __future__ import annotations

from .inputs import raw_sql
from .staging import LINEAGE, SPECS


def null_of(x: str) -> str:
    return f"nullif(CASE WHEN lower(trim({x})) IN ('nan', 'none', 'null', 'nat') THEN '' ELSE trim({x}) END, '')"


def number_of(x: str) -> str:
    return f"TRY_CAST({null_of(x)} AS DOUBLE)"


def free_of(x: str) -> str:
    v = rf"trim(regexp_replace(regexp_replace({x}, '<br\s*/?>', ' ', 'gi'), '\s+', ' ', 'g'))"
    return f"CASE WHEN {v} NOT IN ('', 'nan', 'NaN') THEN {v} END"


def time_of(x: str) -> str:
    v = null_of(x)
    return f"CASE WHEN regexp_matches({v}, '[0-9]{{2}}:[0-9]{{2}}.*([Zz]|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$') THEN timezone('UTC', TRY_CAST({v} AS TIMESTAMPTZ)) ELSE TRY_CAST({v} AS TIMESTAMP) END"


def province_of(x: str) -> str:
    v = null_of(x)
    return rf"CASE WHEN regexp_full_match({v}, '[0-9]+(\.0+)?') THEN lpad(CAST(CAST({number_of(x)} AS BIGINT) AS VARCHAR), 2, '0') ELSE upper({v}) END"


def bool_of(x: str) -> str:
    v = f"lower({null_of(x)})"
    return f"CASE WHEN {v} IN ('true', 't', '1', 'yes', 'y') THEN TRUE WHEN {v} IN ('false', 'f', '0', 'no', 'n') THEN FALSE END"


KINDS = {"text": null_of, "lower": lambda x: f"lower({null_of(x)})", "upper": lambda x: f"upper({null_of(x)})", "free": free_of, "int": lambda x: f"TRY_CAST({number_of(x)} AS BIGINT)", "double": number_of, "bool": bool_of, "time": time_of, "province": province_of, "date": lambda x: f"TRY_CAST({x} AS DATE)", "asis": lambda x: x}


def mean_of(x: str) -> str:
    """The mean of values of two decimals, from an exact sum."""
    return f"round(CAST(sum(CAST(round(({x}) * 100) AS BIGINT)) AS DOUBLE) / count({x})) / 100"


def error_status_of(message: str, name: str) -> str:
    kinds = (("FAILED_RATE_LIMIT", "429|rate|too many requests"), ("FAILED_DATA", "csv|column|keyerror|valueerror"), ("FAILED_SEARCH", "connection|timeout|network|http"))
    return "CASE " + " ".join(f"WHEN regexp_matches(lower(concat({message}, chr(10), {name})), '{words}') THEN '{status}'" for status, words in kinds) + " ELSE 'FAILED_UNKNOWN' END"


def staged(feed: str) -> str:
    columns = ", ".join(f"{KINDS[kind](source)} AS {name}" for name, (source, kind) in {**SPECS[feed], **LINEAGE}.items())
    return f"SELECT {columns} FROM ({raw_sql(feed)})"


def top(table: str, keys: str, order: str, where: str = "TRUE") -> str:
    """The first row of each key."""
    return f"(SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn_ FROM {table} WHERE {where}) WHERE rn_ = 1)"


LIVE = "coalesce(bronze_record_status, 'success') = 'success'"
NEWEST = "bronze_crawl_date DESC NULLS LAST, bronze_ingested_at_utc DESC NULLS LAST"
LATEST = "crawled_at_utc DESC NULLS LAST, bronze_ingested_at_utc DESC NULLS LAST"
UNITS = {"second": "giây|seconds?", "minute": "phút|minutes?", "hour": "giờ|tiếng|hours?", "day": "ngày|days?", "week": "tuần|weeks?", "month": "tháng|months?", "year": "năm|years?"}


def said_of(x: str) -> str:
    v = rf"regexp_replace(nfc_normalize(lower(trim({x}))), '\s+', ' ', 'g')"
    v = f"regexp_replace({v}, '^(thời gian chỉnh sửa|đã chỉnh sửa|edited) ?:? ?', '')"
    return rf"regexp_replace({v}, ' ?\((đã chỉnh sửa|edited)\)$', '')"


def unit_of(t: str) -> str:
    cases = [f"WHEN {t} IN ('hôm nay', 'today', 'vừa xong', 'just now') THEN 'today' WHEN {t} IN ('hôm qua', 'ngày hôm qua', 'yesterday') THEN 'day'"]
    cases += [f"WHEN regexp_full_match({t}, '(([0-9]+|một|a|an|one) )?({words}) (trước|ago)') OR ('{unit}' IN ('week', 'month', 'year') AND {t} = 'last {unit}') THEN '{unit}'" for unit, words in UNITS.items()]
    return f"CASE {' '.join(cases)} END"


def back_of(unit: str, t: str, day: str) -> str:
    n = f"coalesce(TRY_CAST(nullif(regexp_extract({t}, '^([0-9]+) ', 1), '') AS INTEGER), 1)"
    step = {"today": "0 * INTERVAL 1 DAY", "week": f"{n} * INTERVAL 7 DAY", **{u: f"{n} * INTERVAL 1 {u.upper()}" for u in UNITS if u != "week"}}
    return "CAST(CASE " + " ".join(f"WHEN {unit} = '{u}' THEN CAST({day} AS TIMESTAMP) - {s}" for u, s in step.items()) + " END AS DATE)"


def precision_of(unit: str) -> str:
    return f"CASE WHEN {unit} IN ('week', 'month', 'year') THEN {unit} WHEN {unit} IS NULL THEN 'unknown' ELSE 'day' END"


def lifecycle(table: str, key: str) -> str:
    return f"(SELECT {key}, min(bronze_crawl_date) AS first_seen_crawl_date, max(bronze_crawl_date) AS last_seen_crawl_date, count(DISTINCT bronze_crawl_date) AS snapshot_count FROM {table} GROUP BY {key})"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(({part}) * 100.0 / ({whole}), 2) END"


def bounds(axis: str, most: int, value: str) -> str:
    return f"CASE WHEN min_{axis} BETWEEN -{most} AND {most} AND max_{axis} BETWEEN -{most} AND {most} AND min_{axis} <= max_{axis} THEN {value} END"


CONFORM = "coalesce(p.place_name, x.place_name) AS place_name, coalesce(p.province_id, x.province_id) AS province_id, coalesce(p.province_name, x.province_name) AS province_name, p.place_id IS NOT NULL AS is_place_in_dim"
STARS = [f"rating_{k}_count" for k in (5, 4, 3, 2, 1)]
VIDEO = "x.video_id, x.video_title, x.channel_id, x.channel_name, x.search_query"
VIDEO_CHECKS = "CASE WHEN published_at_utc > crawled_at_utc + INTERVAL 1 DAY THEN NULL ELSE published_at_utc END AS published_at_utc, CASE WHEN views >= 0 THEN views END AS views, CASE WHEN duration_seconds >= 0 THEN duration_seconds END AS duration_seconds"

#: Each table as SQL over the tables before it.
STEPS: dict[str, str] = {f"stg_{feed}": staged(feed) for feed in SPECS}
STEPS["sil_provinces"] = f"""
    WITH v AS (SELECT * FROM stg_provinces WHERE province_id IS NOT NULL AND province_name IS NOT NULL AND {LIVE})
    SELECT province_id, province_name, {", ".join(f"{bounds(a, m, f'{e}_{a}')} AS {e}_{a}" for e in ("min", "max") for a, m in (("lon", 180), ("lat", 90)))}, {bounds("lat", 90, "(min_lat + max_lat) / 2.0")} AS center_lat, {bounds("lon", 180, "(min_lon + max_lon) / 2.0")} AS center_lon,
           geojson_url, coalesce(admin_scope, 'current_34') AS admin_scope, province_set_version, fetched_at_utc, first_seen_crawl_date, last_seen_crawl_date, snapshot_count, bronze_run_id, bronze_ingested_at_utc
    FROM {top("v", "province_id", NEWEST)} JOIN {lifecycle("v", "province_id")} USING (province_id)"""
STEPS["sil_taxonomy"] = f"""
    WITH v AS (SELECT * FROM stg_taxonomy WHERE category_id IS NOT NULL AND {LIVE})
    SELECT category_id, category_group, category_name, subcategory_name, name_vi, name_en, first_seen_crawl_date, last_seen_crawl_date, snapshot_count, bronze_run_id, bronze_ingested_at_utc
    FROM {top("v", "category_id", NEWEST)} JOIN {lifecycle("v", "category_id")} USING (category_id)"""
STEPS["sil_places"] = f"""
    WITH v AS (SELECT * FROM stg_places WHERE place_id IS NOT NULL AND place_name IS NOT NULL AND {LIVE})
    SELECT x.place_id, x.place_name, name_vi, name_en, x.province_id, coalesce(q.province_name, x.province_name) AS province_name, q.province_id IS NOT NULL AS is_province_in_dim, x.admin_scope,
           CASE WHEN latitude BETWEEN -90 AND 90 THEN latitude END AS latitude, CASE WHEN longitude BETWEEN -180 AND 180 THEN longitude END AS longitude, osm_type, osm_id, osm_tourism_tag, osm_natural_tag, osm_historic_tag, osm_leisure_tag,
           validation_status, tourism_status, coalesce(crawl_eligible, FALSE) AS crawl_eligible, b.first_seen_crawl_date, b.last_seen_crawl_date, b.snapshot_count, b.last_seen_crawl_date = (SELECT max(bronze_crawl_date) FROM v) AS is_in_latest_snapshot, x.bronze_run_id, x.bronze_ingested_at_utc
    FROM {top("v", "place_id", NEWEST)} AS x JOIN {lifecycle("v", "place_id")} AS b USING (place_id) LEFT JOIN sil_provinces AS q ON x.province_id = q.province_id"""
STEPS["sil_place_categories"] = f"""
    WITH v AS (SELECT * FROM stg_place_categories WHERE place_id IS NOT NULL AND category_id IS NOT NULL AND {LIVE})
    SELECT x.place_id || '|' || x.category_id AS place_category_id, x.place_id, p.place_name, p.province_id, p.province_name, p.place_id IS NOT NULL AS is_place_in_dim, x.category_id,
           coalesce(t.category_group, x.category_group) AS category_group, coalesce(t.category_name, x.category_name) AS category_name, coalesce(t.subcategory_name, x.subcategory_name) AS subcategory_name, t.name_vi AS category_name_vi, t.name_en AS category_name_en,
           t.category_id IS NOT NULL AS is_category_in_dim, coalesce(x.is_primary, FALSE) AS is_primary, classification_method, CASE WHEN classification_confidence IN ('high', 'medium', 'low') THEN classification_confidence END AS classification_confidence, x.bronze_crawl_date, x.bronze_run_id, x.bronze_ingested_at_utc
    FROM {top("v", "place_id, category_id", NEWEST + ", is_primary DESC NULLS LAST")} AS x LEFT JOIN sil_taxonomy AS t ON x.category_id = t.category_id LEFT JOIN sil_places AS p ON x.place_id = p.place_id"""
STEPS["sil_ratings"] = f"""
    WITH v AS (SELECT *, CAST(crawled_at_utc AS DATE) AS snapshot_date FROM stg_ratings WHERE place_id IS NOT NULL AND crawled_at_utc IS NOT NULL AND crawl_status = 'SUCCESS' AND {LIVE}),
    c AS (SELECT * REPLACE (CASE WHEN google_rating BETWEEN 0 AND 5 THEN google_rating END AS google_rating, {", ".join(f"CASE WHEN {s} >= 0 THEN {s} END AS {s}" for s in ["google_review_count", *STARS])}) FROM {top("v", "place_id, snapshot_date", LATEST)}),
    s AS (SELECT *, CAST({" + ".join(f"coalesce({s}, 0)" for s in STARS)} AS BIGINT) AS rating_distribution_total, row_number() OVER w AS snapshot_seq_num, lag(snapshot_date) OVER w AS prev_snapshot_date, lag(google_rating) OVER w AS prev_google_rating, lag(google_review_count) OVER w AS prev_google_review_count FROM c WINDOW w AS (PARTITION BY place_id ORDER BY snapshot_date))
    SELECT x.place_id || '|' || CAST(snapshot_date AS VARCHAR) AS rating_snapshot_id, x.place_id, {CONFORM}, snapshot_date, crawled_at_utc, google_maps_url, google_rating, google_review_count, {", ".join(STARS)}, rating_distribution_total, google_rating IS NOT NULL AS has_rating_value, rating_distribution_total > 0 AS has_rating_distribution,
           snapshot_seq_num, prev_snapshot_date, date_diff('day', prev_snapshot_date, snapshot_date) AS days_since_prev_snapshot, prev_google_rating, round(google_rating - prev_google_rating, 4) AS rating_delta, prev_google_review_count, google_review_count - prev_google_review_count AS review_count_delta, crawl_status, 'google_maps' AS source, x.bronze_run_id
    FROM s AS x LEFT JOIN sil_places AS p ON x.place_id = p.place_id"""
V = f"WITH v AS (SELECT *, CAST(crawled_at_utc AS DATE) AS snapshot_date FROM stg_videos WHERE place_id IS NOT NULL AND video_id IS NOT NULL AND crawled_at_utc IS NOT NULL AND {LIVE})"
STEPS["sil_videos"] = f"""
    {V}, o AS (SELECT place_id, video_id, count(*) AS observation_count, min(crawled_at_utc) AS first_crawled_at_utc FROM v GROUP BY ALL), c AS (SELECT * REPLACE ({VIDEO_CHECKS}) FROM {top("v", "place_id, video_id", LATEST)})
    SELECT x.place_id, {CONFORM}, {VIDEO}, views, duration_seconds, category, video_url, published_at_raw, published_at_utc, CAST(published_at_utc AS DATE) AS published_date, CAST(date_trunc('month', published_at_utc) AS DATE) AS published_month, crawled_at_utc, first_crawled_at_utc, observation_count, 'youtube' AS source, x.bronze_run_id
    FROM c AS x JOIN o ON x.place_id = o.place_id AND x.video_id = o.video_id LEFT JOIN sil_places AS p ON x.place_id = p.place_id"""
STEPS["sil_video_snapshots"] = f"""
    {V}, c AS (SELECT * REPLACE ({VIDEO_CHECKS}) FROM {top("v", "place_id, video_id, snapshot_date", LATEST)}),
    s AS (SELECT *, row_number() OVER w AS snapshot_seq_num, lag(snapshot_date) OVER w AS prev_snapshot_date, lag(views) OVER w AS prev_views FROM c WINDOW w AS (PARTITION BY place_id, video_id ORDER BY snapshot_date))
    SELECT x.place_id || '|' || x.video_id || '|' || CAST(snapshot_date AS VARCHAR) AS video_snapshot_id, x.place_id, {CONFORM}, {VIDEO}, category, video_url, published_at_utc, CAST(published_at_utc AS DATE) AS published_date, snapshot_date, crawled_at_utc, views, duration_seconds, snapshot_seq_num, prev_snapshot_date,
           date_diff('day', prev_snapshot_date, snapshot_date) AS days_since_prev_snapshot, prev_views, views - prev_views AS views_delta, CASE WHEN snapshot_date > prev_snapshot_date THEN round((views - prev_views) * 1.0 / date_diff('day', prev_snapshot_date, snapshot_date), 2) END AS views_daily_growth, 'youtube' AS source, x.bronze_run_id
    FROM s AS x LEFT JOIN sil_places AS p ON x.place_id = p.place_id"""
STEPS["sil_comments"] = f"""
    WITH v AS (SELECT *, coalesce(comment_id, 'sk_' || md5(concat_ws('||', video_id, coalesce(author, ''), coalesce(comment_text, '')))) AS comment_key FROM stg_comments WHERE place_id IS NOT NULL AND video_id IS NOT NULL AND crawled_at_utc IS NOT NULL AND (comment_id IS NOT NULL OR comment_text IS NOT NULL) AND {LIVE}),
    o AS (SELECT place_id, comment_key, count(*) AS observation_count, min(crawled_at_utc) AS first_crawled_at_utc FROM v GROUP BY ALL),
    a AS (SELECT *, {said_of("comment_created_at_raw")} AS said, {time_of("comment_created_at_raw")} AS exact FROM {top("v", "place_id, comment_key", LATEST)}), b AS (SELECT *, {unit_of("said")} AS unit FROM a),
    c AS (SELECT *, coalesce(exact, CAST({back_of("unit", "said", "CAST(crawled_at_utc AS DATE)")} AS TIMESTAMP)) AS made FROM b), d AS (SELECT *, CASE WHEN made > crawled_at_utc + INTERVAL 1 DAY THEN NULL ELSE made END AS made_ok FROM c)
    SELECT x.place_id, {CONFORM}, video_id, video_title, x.comment_key, comment_id, comment_id IS NULL AS is_surrogate_comment_key, author, comment_text, CASE WHEN likes >= 0 THEN likes END AS likes, coalesce(is_reply, FALSE) AS is_reply, comment_created_at_raw, made_ok AS comment_created_at_utc,
           CASE WHEN made_ok IS NULL THEN 'unknown' WHEN exact IS NOT NULL THEN 'exact' ELSE {precision_of("unit")} END AS comment_created_at_precision, CAST(made_ok AS DATE) AS comment_created_date, crawled_at_utc, first_crawled_at_utc, observation_count, 'youtube' AS source, x.bronze_run_id
    FROM d AS x JOIN o ON x.place_id = o.place_id AND x.comment_key = o.comment_key LEFT JOIN sil_places AS p ON x.place_id = p.place_id"""
STEPS["sil_reviews"] = f"""
    WITH v AS (SELECT *, {said_of("review_date_raw")} AS said FROM stg_reviews WHERE review_id IS NOT NULL AND place_id IS NOT NULL AND upper(place_id) <> 'TEST' AND crawled_at_utc IS NOT NULL AND {LIVE}), u AS (SELECT *, {unit_of("said")} AS unit FROM v),
    d AS (SELECT *, {back_of("unit", "said", "CAST(crawled_at_utc AS DATE)")} AS review_date, {precision_of("unit")} AS review_date_precision, coalesce(regexp_matches(review_date_raw, 'chỉnh sửa|edited'), FALSE) AS is_edited FROM u),
    f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY pri, crawled_at_utc DESC NULLS LAST) AS rn FROM (SELECT place_id, place_name, province_id, province_name, crawled_at_utc, 1 AS pri FROM stg_ratings UNION ALL SELECT place_id, place_name, province_id, province_name, crawled_at_utc, 2 FROM stg_videos) WHERE place_id IS NOT NULL AND place_name IS NOT NULL) WHERE rn = 1),
    n AS (SELECT review_id, count(*) AS observation_count, min(crawled_at_utc) AS first_crawled_at_utc FROM d GROUP BY 1), l AS (SELECT * FROM {top("d", "review_id", LATEST)}), b AS (SELECT review_id, review_date_raw, review_date, review_date_precision FROM {top("d", "review_id", "coalesce(list_position(['day', 'week', 'month', 'year'], review_date_precision), 5), crawled_at_utc, bronze_ingested_at_utc")})
    SELECT l.review_id, l.place_id, coalesce(p.place_name, f.place_name) AS place_name, coalesce(p.province_id, f.province_id) AS province_id, coalesce(p.province_name, q.province_name, f.province_name) AS province_name, p.place_id IS NOT NULL AS is_place_in_dim, CASE WHEN l.rating BETWEEN 1 AND 5 THEN l.rating END AS rating, l.review_text, l.review_text IS NOT NULL AS has_review_text,
           b.review_date_raw, b.review_date, b.review_date_precision, CAST(date_trunc('month', b.review_date) AS DATE) AS review_month, l.is_edited, CASE WHEN l.likes_count >= 0 THEN l.likes_count END AS likes_count, coalesce(l.source, 'google_maps') AS source, l.crawled_at_utc, first_crawled_at_utc, observation_count, l.bronze_run_id
    FROM l JOIN b USING (review_id) JOIN n USING (review_id) LEFT JOIN sil_places AS p ON l.place_id = p.place_id LEFT JOIN f ON l.place_id = f.place_id LEFT JOIN sil_provinces AS q ON coalesce(p.province_id, f.province_id) = q.province_id"""
SAID = "comment_created_at_precision IN ('exact', 'day', 'week', 'month')"
KNOWN = "review_date_precision IN ('day', 'week', 'month')"
COMMENT_MONTH = "CAST(date_trunc('month', comment_created_date) AS DATE)"
STEPS["sil_coverage"] = f"""
    WITH r AS (SELECT place_id, count(*) AS review_count, count(review_date) AS review_dated_count, min(review_date) AS review_min_date, max(review_date) AS review_max_date, count(DISTINCT CASE WHEN {KNOWN} THEN review_month END) AS review_active_month_count FROM sil_reviews GROUP BY 1),
    v AS (SELECT place_id, count(DISTINCT video_id) AS video_count, min(published_date) AS video_min_published_date, max(published_date) AS video_max_published_date, count(DISTINCT published_month) AS video_active_month_count FROM sil_videos GROUP BY 1),
    s AS (SELECT place_id, count(*) AS video_snapshot_count, count(DISTINCT snapshot_date) AS video_snapshot_date_count, min(snapshot_date) AS video_min_snapshot_date, max(snapshot_date) AS video_max_snapshot_date FROM sil_video_snapshots GROUP BY 1),
    c AS (SELECT place_id, count(*) AS comment_count, count(comment_created_date) AS comment_dated_count, min(comment_created_date) AS comment_min_date, max(comment_created_date) AS comment_max_date, count(DISTINCT CASE WHEN {SAID} THEN {COMMENT_MONTH} END) AS comment_active_month_count FROM sil_comments GROUP BY 1),
    g AS (SELECT place_id, count(*) AS rating_snapshot_count, min(snapshot_date) AS rating_min_snapshot_date, max(snapshot_date) AS rating_max_snapshot_date FROM sil_ratings GROUP BY 1),
    m AS (SELECT place_id, count(DISTINCT month_) AS total_active_month_count FROM (SELECT place_id, review_month AS month_ FROM sil_reviews WHERE {KNOWN} UNION SELECT place_id, published_month FROM sil_videos UNION SELECT place_id, {COMMENT_MONTH} FROM sil_comments WHERE {SAID}) GROUP BY 1),
    j AS (SELECT p.place_id, place_name, province_id, province_name, crawl_eligible, tourism_status, coalesce(review_count, 0) AS review_count, coalesce(review_dated_count, 0) AS review_dated_count, review_min_date, review_max_date, coalesce(review_active_month_count, 0) AS review_active_month_count, coalesce(video_count, 0) AS video_count, video_min_published_date, video_max_published_date,
          coalesce(video_active_month_count, 0) AS video_active_month_count, coalesce(video_snapshot_count, 0) AS video_snapshot_count, coalesce(video_snapshot_date_count, 0) AS video_snapshot_date_count, video_min_snapshot_date, video_max_snapshot_date, coalesce(comment_count, 0) AS comment_count, coalesce(comment_dated_count, 0) AS comment_dated_count, comment_min_date, comment_max_date,
          coalesce(comment_active_month_count, 0) AS comment_active_month_count, coalesce(rating_snapshot_count, 0) AS rating_snapshot_count, rating_min_snapshot_date, rating_max_snapshot_date, coalesce(total_active_month_count, 0) AS total_active_month_count,
          (SELECT max(d) FROM (SELECT max(CAST(crawled_at_utc AS DATE)) AS d FROM sil_reviews UNION ALL SELECT max(CAST(crawled_at_utc AS DATE)) FROM sil_videos UNION ALL SELECT max(CAST(crawled_at_utc AS DATE)) FROM sil_comments UNION ALL SELECT max(snapshot_date) FROM sil_ratings)) AS as_of_date
          FROM sil_places AS p LEFT JOIN r USING (place_id) LEFT JOIN v USING (place_id) LEFT JOIN s USING (place_id) LEFT JOIN c USING (place_id) LEFT JOIN g USING (place_id) LEFT JOIN m USING (place_id)),
    k AS (SELECT *, review_count + video_count + comment_count AS total_record_count, least(review_min_date, video_min_published_date, comment_min_date) AS first_activity_date, greatest(review_max_date, video_max_published_date, comment_max_date) AS last_activity_date FROM j),
    h AS (SELECT *, coalesce(date_diff('month', first_activity_date, last_activity_date) + 1, 0) AS history_span_months, date_diff('day', last_activity_date, as_of_date) AS days_since_last_activity FROM k),
    i AS (SELECT *, history_span_months >= 12 AND total_active_month_count >= 6 AS has_temporal_history, coalesce(days_since_last_activity <= 90, FALSE) AS has_recent_data, total_record_count > 0 AND total_active_month_count <= 2 AS is_sparse, rating_snapshot_count >= 2 AS has_rating_history, video_snapshot_date_count >= 2 AS has_video_view_history FROM h)
    SELECT *, CASE WHEN total_record_count = 0 THEN 'no_data' WHEN has_temporal_history AND has_recent_data THEN 'forecast_ready' WHEN is_sparse THEN 'sparse' WHEN has_recent_data THEN 'recent_only' WHEN has_temporal_history THEN 'stale_history' ELSE 'partial' END AS coverage_status, has_temporal_history AND has_recent_data AS is_forecast_eligible FROM i"""
PRIMARY = "(SELECT place_id, category_id AS primary_category_id, category_group AS primary_category_group, category_name AS primary_category_name FROM " + top("sil_place_categories", "place_id", "is_primary DESC NULLS LAST, category_id") + ")"
CATS = "primary_category_id, primary_category_group, primary_category_name"
STEPS["gold_monthly"] = f"""
    WITH r AS (SELECT place_id, review_month AS activity_month, max(place_name) AS place_name, max(province_id) AS province_id, max(province_name) AS province_name, count(*) AS n, sum(has_review_text::INT) AS texts, count(rating) AS rated, round(avg(rating), 2) AS mean, sum((rating >= 4)::INT) AS good, sum((rating = 3)::INT) AS mid, sum((rating <= 2)::INT) AS bad, sum(likes_count) AS likes FROM sil_reviews WHERE review_month IS NOT NULL GROUP BY ALL),
    v AS (SELECT place_id, published_month AS activity_month, max(place_name) AS place_name, max(province_id) AS province_id, max(province_name) AS province_name, count(DISTINCT video_id) AS vids, sum(views) AS views FROM sil_videos WHERE published_month IS NOT NULL GROUP BY ALL),
    c AS (SELECT place_id, {COMMENT_MONTH} AS activity_month, count(*) AS comments FROM sil_comments WHERE comment_created_date IS NOT NULL GROUP BY ALL), k AS (SELECT place_id, activity_month FROM r UNION SELECT place_id, activity_month FROM v UNION SELECT place_id, activity_month FROM c),
    j AS (SELECT k.*, coalesce(r.place_name, v.place_name) AS place_name, coalesce(r.province_id, v.province_id) AS province_id, coalesce(r.province_name, v.province_name) AS province_name, coalesce(n, 0) AS n, coalesce(texts, 0) AS texts, rated, mean, coalesce(good, 0) AS good, coalesce(mid, 0) AS mid, coalesce(bad, 0) AS bad, coalesce(likes, 0) AS likes, coalesce(vids, 0) AS vids, coalesce(views, 0) AS views, coalesce(comments, 0) AS comments FROM k LEFT JOIN r USING (place_id, activity_month) LEFT JOIN v USING (place_id, activity_month) LEFT JOIN c USING (place_id, activity_month)),
    x AS (SELECT *, sum(n) OVER w AS cn, sum(vids) OVER w AS cv, lag(n) OVER (PARTITION BY place_id ORDER BY activity_month) AS prev, round(avg(n) OVER (PARTITION BY place_id ORDER BY activity_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS roll FROM j WINDOW w AS (PARTITION BY place_id ORDER BY activity_month ROWS UNBOUNDED PRECEDING))
    SELECT x.place_id || '|' || CAST(activity_month AS VARCHAR) AS place_month_id, x.place_id, {CONFORM}, {CATS}, activity_month, year(activity_month) AS activity_year, quarter(activity_month) AS activity_quarter, n AS new_reviews_count, CAST(texts AS BIGINT) AS new_reviews_with_text_count, mean AS monthly_avg_review_rating, CAST(good AS BIGINT) AS positive_reviews_count, CAST(mid AS BIGINT) AS neutral_reviews_count, CAST(bad AS BIGINT) AS negative_reviews_count,
           {pct("good - bad", "rated")} AS monthly_net_sentiment_pct, CAST(likes AS BIGINT) AS review_likes_sum, vids AS new_videos_published_count, CAST(views AS BIGINT) AS new_videos_current_views_sum, comments AS new_comments_count, CAST(cn AS BIGINT) AS cumulative_reviews_count, CAST(cv AS BIGINT) AS cumulative_videos_count, prev AS prev_month_reviews_count, n - prev AS mom_reviews_delta, {pct("n - prev", "prev")} AS mom_reviews_growth_pct, roll AS rolling_3m_reviews_avg
    FROM x LEFT JOIN sil_places AS p ON x.place_id = p.place_id LEFT JOIN {PRIMARY} AS m ON x.place_id = m.place_id"""
STEPS["gold_trajectory"] = f"""
    WITH y AS (SELECT place_id, snapshot_date AS day_, count(DISTINCT video_id) AS tracked, CAST(sum(views) AS BIGINT) AS views FROM sil_video_snapshots GROUP BY ALL), z AS (SELECT *, lag(day_) OVER w AS pday, lag(views) OVER w AS pviews FROM y WINDOW w AS (PARTITION BY place_id ORDER BY day_)),
    m AS (SELECT r.place_id, r.snapshot_date, arg_min(z, (CASE WHEN day_ <= r.snapshot_date THEN 0 ELSE 1000000 END) + abs(date_diff('day', day_, r.snapshot_date))) AS z FROM sil_ratings AS r JOIN z ON r.place_id = z.place_id GROUP BY ALL)
    SELECT x.rating_snapshot_id AS place_snapshot_id, x.place_id, {CONFORM}, {CATS}, x.snapshot_date, snapshot_seq_num, prev_snapshot_date, days_since_prev_snapshot, TRUE AS has_google_maps_snapshot, google_rating, prev_google_rating, rating_delta, google_review_count, prev_google_review_count, review_count_delta, CASE WHEN days_since_prev_snapshot > 0 THEN round(review_count_delta * 1.0 / days_since_prev_snapshot, 2) END AS review_daily_velocity, {", ".join(STARS)}, rating_distribution_total,
           m.place_id IS NOT NULL AS has_youtube_snapshot, coalesce(m.z.tracked, 0) AS tracked_videos_count, m.z.views AS total_youtube_views, m.z.pviews AS prev_total_youtube_views, m.z.views - m.z.pviews AS youtube_views_delta, CASE WHEN m.z.day_ > m.z.pday THEN round((m.z.views - m.z.pviews) * 1.0 / date_diff('day', m.z.pday, m.z.day_), 2) END AS youtube_views_daily_growth
    FROM sil_ratings AS x LEFT JOIN m ON x.place_id = m.place_id AND x.snapshot_date = m.snapshot_date LEFT JOIN sil_places AS p ON x.place_id = p.place_id LEFT JOIN {PRIMARY} AS k ON x.place_id = k.place_id"""
BY_VIEWS = "PARTITION BY place_id ORDER BY views DESC NULLS LAST, published_date DESC NULLS LAST, video_id"
STEPS["gold_videos"] = f"""
    WITH s AS (SELECT place_id, video_id, count(*) AS n, max(snapshot_date) AS last_, min(snapshot_date) AS first_, max(CASE WHEN snapshot_seq_num = 1 THEN views END) AS first_views, sum(CASE WHEN snapshot_seq_num > 1 THEN views_delta END) AS gained, {mean_of("CASE WHEN snapshot_seq_num > 1 THEN views_daily_growth END")} AS growth FROM sil_video_snapshots GROUP BY ALL), c AS (SELECT place_id, video_id, count(*) AS said FROM sil_comments GROUP BY ALL),
    j AS (SELECT v.*, n, last_, first_, first_views, gained, growth, said, date_diff('day', published_date, last_) AS age, row_number() OVER ({BY_VIEWS}) AS rank_ FROM sil_videos AS v LEFT JOIN s USING (place_id, video_id) LEFT JOIN c USING (place_id, video_id))
    SELECT place_id || '|' || video_id AS place_video_id, place_id, place_name, province_id, province_name, is_place_in_dim, video_id, video_title, channel_id, channel_name, category, video_url, published_date, published_month, duration_seconds, CASE WHEN age >= 0 THEN age END AS video_age_days, first_ AS first_snapshot_date, last_ AS latest_snapshot_date, coalesce(n, 1) AS snapshot_count, first_views, views AS latest_views, CAST(gained AS BIGINT) AS total_views_delta,
           CASE WHEN age > 0 THEN round(views * 1.0 / age, 2) END AS avg_daily_views_since_publish, growth AS snapshot_daily_view_growth, coalesce(said, 0) AS crawled_comment_count, rank_ AS place_video_view_rank FROM j"""
POP = "coalesce(latest_google_review_count, crawled_review_count, 0)"
STEPS["gold_profile"] = f"""
    WITH e AS (SELECT place_id, count(*) AS k, arg_max(x, (snapshot_date, crawled_at_utc)) AS l, arg_min(x, (snapshot_date, crawled_at_utc)) AS f FROM sil_ratings AS x GROUP BY 1),
    r AS (SELECT r.place_id, count(*) AS n, round(avg(rating), 2) AS mean, sum(has_review_text::INT) AS texts, count(rating) AS rated, sum((rating >= 4)::INT) AS good, sum((rating <= 2)::INT) AS bad, coalesce(sum((review_date > as_of_date - 90)::INT), 0) AS recent, coalesce(sum((review_date > as_of_date - 180 AND review_date <= as_of_date - 90)::INT), 0) AS before_ FROM sil_reviews AS r JOIN sil_coverage USING (place_id) GROUP BY 1),
    v AS (SELECT place_id, count(DISTINCT video_id) AS vids, count(DISTINCT channel_id) AS channels, sum(views) AS views, round(avg(views), 2) AS mean_views, max(views) AS most FROM sil_videos GROUP BY 1), t AS (SELECT place_id, video_id, video_title FROM (SELECT *, row_number() OVER ({BY_VIEWS}) AS rn FROM sil_videos) WHERE rn = 1),
    g AS (SELECT place_id, CAST(sum(views_delta) AS BIGINT) AS gained, {mean_of("views_daily_growth")} AS growth FROM sil_video_snapshots WHERE snapshot_seq_num > 1 GROUP BY 1), c AS (SELECT place_id, count(DISTINCT category_id) AS cats FROM sil_place_categories GROUP BY 1),
    j AS (SELECT p.place_id, p.place_name, name_vi, name_en, p.province_id, p.province_name, admin_scope, latitude, longitude, p.tourism_status, p.crawl_eligible, {CATS}, coalesce(cats, 0) AS category_count, e.l.google_rating AS latest_google_rating, e.l.google_review_count AS latest_google_review_count, e.l.snapshot_date AS latest_rating_snapshot_date, e.f.google_rating AS first_google_rating, e.f.google_review_count AS first_google_review_count, e.f.snapshot_date AS first_rating_snapshot_date,
          CASE WHEN rating_snapshot_count >= 2 THEN round(e.l.google_rating - e.f.google_rating, 4) END AS total_rating_delta, CASE WHEN rating_snapshot_count >= 2 THEN e.l.google_review_count - e.f.google_review_count END AS total_review_count_delta, {", ".join(f"{pct(f'coalesce(e.l.rating_{k}_count, 0)', 'e.l.rating_distribution_total')} AS rating_{k}_pct" for k in (5, 4, 3, 2, 1))},
          CASE WHEN e.l.rating_distribution_total > 0 THEN {pct("coalesce(e.l.rating_5_count, 0) + coalesce(e.l.rating_4_count, 0) - coalesce(e.l.rating_1_count, 0) - coalesce(e.l.rating_2_count, 0)", "e.l.rating_distribution_total")} ELSE {pct("good - bad", "rated")} END AS net_sentiment_score, coalesce(n, 0) AS crawled_review_count, mean AS crawled_avg_rating, {pct("texts", "n")} AS text_review_ratio, CAST(coalesce(recent, 0) AS BIGINT) AS reviews_last_90d_count, CAST(coalesce(before_, 0) AS BIGINT) AS reviews_prev_90d_count, {pct("recent - before_", "before_")} AS recent_review_momentum_pct,
          coalesce(vids, 0) AS youtube_video_count, coalesce(channels, 0) AS distinct_channel_count, CAST(coalesce(views, 0) AS BIGINT) AS total_youtube_views, mean_views AS avg_views_per_video, most AS max_video_views, t.video_id AS top_video_id, t.video_title AS top_video_title, gained AS total_youtube_views_delta, growth AS avg_daily_youtube_view_growth, rating_snapshot_count, video_snapshot_date_count, coverage_status, is_forecast_eligible, total_active_month_count, history_span_months
          FROM sil_places AS p JOIN sil_coverage AS o ON p.place_id = o.place_id LEFT JOIN {PRIMARY} AS m ON p.place_id = m.place_id LEFT JOIN c ON p.place_id = c.place_id LEFT JOIN e ON p.place_id = e.place_id LEFT JOIN r ON p.place_id = r.place_id LEFT JOIN v ON p.place_id = v.place_id LEFT JOIN t ON p.place_id = t.place_id LEFT JOIN g ON p.place_id = g.place_id),
    d AS (SELECT *, CASE WHEN rating_snapshot_count = 0 OR latest_google_rating IS NULL THEN 'no_data' WHEN rating_snapshot_count = 1 OR total_rating_delta IS NULL THEN 'single_snapshot' WHEN total_rating_delta >= 0.05 THEN 'improving' WHEN total_rating_delta <= -0.05 THEN 'declining' ELSE 'stable' END AS rating_trend_direction,
          CASE WHEN youtube_video_count = 0 THEN 'no_video' WHEN video_snapshot_date_count < 2 THEN 'single_snapshot' WHEN total_youtube_views_delta > 0 AND avg_daily_youtube_view_growth >= 100 THEN 'surging' WHEN total_youtube_views_delta > 0 THEN 'growing' WHEN coalesce(total_youtube_views_delta, 0) = 0 THEN 'steady' ELSE 'stagnant' END AS views_growth_direction,
          row_number() OVER (PARTITION BY province_id ORDER BY {POP} DESC, total_youtube_views DESC, place_id) AS province_popularity_rank, row_number() OVER (ORDER BY {POP} DESC, total_youtube_views DESC, place_id) AS national_popularity_rank, coalesce(recent_review_momentum_pct, 0) AS mom, {POP} >= 500 OR total_youtube_views >= 500000 AS big FROM j),
    q AS (SELECT *, rating_trend_direction = 'improving' OR views_growth_direction IN ('surging', 'growing') OR mom >= 20 AS up FROM d)
    SELECT * EXCLUDE (mom, big, up, rating_snapshot_count, video_snapshot_date_count), CASE WHEN coverage_status IN ('no_data', 'sparse') OR ({POP} < 10 AND total_youtube_views < 1000) THEN 'Emerging / Low Data' WHEN rating_trend_direction = 'declining' OR coalesce(latest_google_rating, crawled_avg_rating, 5.0) < 3.5 OR (mom <= -30 AND reviews_prev_90d_count >= 5) THEN 'Cooling / At Risk'
           WHEN big AND (up OR reviews_last_90d_count >= 10) THEN 'Leading Hotspot' WHEN big THEN 'Established Destination' WHEN up OR reviews_last_90d_count >= 5 THEN 'Rising Star' ELSE 'Steady Destination' END AS place_development_stage FROM q"""
SCORE, WEIGHT = "coalesce(latest_google_rating, crawled_avg_rating)", "greatest(coalesce(latest_google_review_count, crawled_review_count, 1), 1)"


def totals(prefix: str) -> str:
    return f"""CASE WHEN sum(CASE WHEN {SCORE} IS NOT NULL THEN {WEIGHT} ELSE 0 END) > 0 THEN round(CAST(sum(CAST(round({SCORE} * 100) AS BIGINT) * {WEIGHT}) AS DOUBLE) / sum(CASE WHEN {SCORE} IS NOT NULL THEN {WEIGHT} ELSE 0 END)) / 100 END AS {prefix}_weighted_avg_rating, {mean_of(SCORE)} AS {prefix}_simple_avg_rating, sum(latest_google_review_count) AS gr, sum(crawled_review_count) AS cr,
        {mean_of("net_sentiment_score")} AS {prefix}_net_sentiment_score, sum(youtube_video_count) AS yv, sum(total_youtube_views) AS tv, round(avg(total_youtube_views), 2) AS av, CAST(sum(total_youtube_views_delta) AS BIGINT) AS total_youtube_views_delta"""


TOTALS = "CAST(coalesce(gr, 0) AS BIGINT) AS total_google_review_count, CAST(coalesce(cr, 0) AS BIGINT) AS total_crawled_review_count, CAST(coalesce(yv, 0) AS BIGINT) AS total_youtube_videos_count, CAST(coalesce(tv, 0) AS BIGINT) AS total_youtube_views, coalesce(av, 0) AS avg_views_per_place, total_youtube_views_delta"
REACH = "coalesce(gr, 0) + coalesce(cr, 0) DESC, coalesce(tv, 0) DESC"
STEPS["gold_provinces"] = f"""
    WITH a AS (SELECT province_id, count(*) AS n, count(*) FILTER (crawled_review_count > 0 OR youtube_video_count > 0 OR latest_google_review_count > 0) AS active, count(*) FILTER (is_forecast_eligible) AS ready, count(*) FILTER (place_development_stage = 'Leading Hotspot') AS hot, count(*) FILTER (place_development_stage = 'Rising Star') AS rising, {totals("province")}, {mean_of("avg_daily_youtube_view_growth")} AS province_avg_daily_view_growth FROM gold_profile GROUP BY 1)
    SELECT p.province_id, p.province_name, admin_scope, center_lat, center_lon, min_lat, max_lat, min_lon, max_lon, geojson_url, coalesce(n, 0) AS total_places_count, coalesce(active, 0) AS active_places_count, coalesce(ready, 0) AS forecast_ready_places_count, coalesce(hot, 0) AS leading_hotspot_count, coalesce(rising, 0) AS rising_star_count, province_weighted_avg_rating, province_simple_avg_rating, province_net_sentiment_score, {TOTALS}, province_avg_daily_view_growth,
           v.place_id AS top_place_id_by_views, v.place_name AS top_place_name_by_views, r.place_id AS top_place_id_by_reviews, r.place_name AS top_place_name_by_reviews, row_number() OVER (ORDER BY {REACH}, p.province_id) AS national_tourism_rank
    FROM sil_provinces AS p LEFT JOIN a ON p.province_id = a.province_id LEFT JOIN (SELECT province_id, place_id, place_name FROM {top("gold_profile", "province_id", "total_youtube_views DESC, crawled_review_count DESC, place_id")}) AS v ON p.province_id = v.province_id LEFT JOIN (SELECT province_id, place_id, place_name FROM {top("gold_profile", "province_id", f"{POP} DESC, total_youtube_views DESC, place_id")}) AS r ON p.province_id = r.province_id"""
STEPS["gold_categories"] = f"""
    WITH b AS (SELECT c.category_id, c.place_id AS bridge_id, c.is_primary, p.* FROM sil_place_categories AS c LEFT JOIN gold_profile AS p ON c.place_id = p.place_id), a AS (SELECT category_id, count(DISTINCT bridge_id) AS n, count(DISTINCT bridge_id) FILTER (is_primary) AS prim, count(DISTINCT province_id) AS provs, {totals("category")} FROM b GROUP BY 1)
    SELECT t.category_id, t.category_group, t.category_name, t.subcategory_name, t.name_vi, t.name_en, coalesce(n, 0) AS total_places_count, coalesce(prim, 0) AS primary_places_count, coalesce(provs, 0) AS provinces_covered_count, category_weighted_avg_rating, category_simple_avg_rating, category_net_sentiment_score, {TOTALS}, k.place_id AS top_place_id, k.place_name AS top_place_name, row_number() OVER (ORDER BY {REACH}, t.category_id) AS category_popularity_rank
    FROM sil_taxonomy AS t LEFT JOIN a ON t.category_id = a.category_id LEFT JOIN (SELECT category_id, place_id, place_name FROM {top("b", "category_id", f"{POP} DESC, total_youtube_views DESC, place_id", "place_id IS NOT NULL")}) AS k ON t.category_id = k.category_id"""


def needs(name: str) -> list[str]:
    """The steps that a step reads, itself last, in order."""
    import re

    found: list[str] = []
    for other in re.findall(r"\b(?:stg|sil|gold)_[a-z_]+\b", STEPS[name]):
        if other in STEPS and other != name:
            found += [n for n in needs(other) if n not in found]
    return [*found, name]


def with_steps(*names: str) -> str:
    """A WITH clause that defines the steps and all that they read."""
    order: list[str] = []
    for name in names:
        order += [n for n in needs(name) if n not in order]
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({STEPS[n]})" for n in order)


def sql_of(name: str, select: str = "*") -> str:
    return f"{with_steps(name)} SELECT {select} FROM {name}"

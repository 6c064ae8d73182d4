"""Raw feeds, shaped like crawled data, from the driver's tables. One SQL text serves Spark and DuckDB alike.

Values carry the faults that the staging and silver steps are about: padded and unpadded ids, null words, offsets,
values out of their domain, quarantined rows, repeated observations, dates in two languages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "embeddings")

#: Shared by all feeds: two crawls.
CRAWLS = "(SELECT 0 AS k UNION ALL SELECT 1 AS k)"

RAW = {
    "provinces": f"""
        SELECT CASE n_nationkey % 3 WHEN 0 THEN concat(n_nationkey, '') WHEN 1 THEN concat(n_nationkey, '.0') ELSE lpad(concat(n_nationkey, ''), 2, '0') END AS province_id,
               CASE WHEN k = 0 THEN concat(' ', n_name) ELSE n_name END AS province_name,
               concat(n_nationkey * 15 - 190, '') AS min_lon, concat(n_nationkey * 15 - 180 - 20 * (CASE WHEN n_nationkey = 7 THEN 1 ELSE 0 END), '') AS max_lon,
               concat(n_nationkey * 8 - 95, '') AS min_lat, concat(n_nationkey * 8 - 89, '.5') AS max_lat,
               concat('geo/', n_nationkey, '.json') AS geojson_url, CASE WHEN n_regionkey = 0 THEN 'None' ELSE r_name END AS admin_scope, 'v1' AS province_set_version,
               concat('2026-01-0', 1 + n_nationkey % 9, 'T03:04:05', CASE n_nationkey % 2 WHEN 0 THEN 'Z' ELSE '+07:00' END) AS fetched_at,
               concat('run', k) AS run_id, concat('2026-0', 1 + k, '-03T00:00:00Z') AS ingested_at_utc, CASE WHEN n_nationkey % 11 = 10 AND k = 1 THEN 'quarantine' WHEN n_nationkey % 2 = 0 THEN 'SUCCESS' END AS record_status,
               concat('2026-0', 1 + k, '-02') AS crawl_date
        FROM {{nation}} AS nation JOIN {{region}} AS region ON n_regionkey = r_regionkey CROSS JOIN {CRAWLS} AS c""",
    "places": f"""
        SELECT concat('OSM_node_', c_custkey) AS place_id, CASE WHEN c_custkey % 97 = 13 THEN 'nan' ELSE c_name END AS place_name, concat(c_name, ' vi') AS name_vi, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name_en,
               CASE c_custkey % 3 WHEN 0 THEN concat(c_nationkey + 1, '') WHEN 1 THEN concat(c_nationkey + 1, '.0') ELSE lpad(concat(c_nationkey + 1, ''), 2, '0') END AS province_id,
               concat('Province ', c_nationkey) AS province_name, 'CURRENT' AS admin_scope,
               concat(CAST(c_custkey % 200 AS INT) - 100, '.25') AS latitude, concat(CAST(c_custkey % 400 AS INT) - 200, '.5') AS longitude,
               'NODE' AS osm_type, concat(c_custkey, '') AS osm_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'museum' WHEN 'MACHINERY' THEN 'hotel' END AS tourism, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'beach' END AS natural_tag,
               CASE c_mktsegment WHEN 'FURNITURE' THEN 'ruins' END AS historic, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'park' END AS leisure,
               'VALID' AS validation_status, CASE WHEN c_acctbal < 0 THEN 'review' ELSE 'Eligible' END AS tourism_status, CASE c_custkey % 5 WHEN 0 THEN 'False' WHEN 1 THEN 'yes' WHEN 2 THEN 'maybe' ELSE '1' END AS crawl_eligible,
               concat('run', k) AS run_id, concat('2026-0', 1 + k, '-03T00:00:00Z') AS ingested_at_utc, CASE WHEN c_custkey % 31 = 5 AND k = 1 THEN 'quarantine' END AS record_status, concat('2026-0', 1 + k, '-02') AS crawl_date
        FROM {{customer}} AS customer CROSS JOIN {CRAWLS} AS c WHERE k = 0 OR c_custkey % 3 <> 0""",
    "taxonomy": f"""
        SELECT p_brand AS category_id, min(p_type) AS category_group, lower(p_brand) AS category_name, concat('sub ', min(p_type)) AS subcategory_name, concat(p_brand, ' vi') AS name_vi, concat(p_brand, ' en') AS name_en,
               concat('run', k) AS run_id, concat('2026-0', 1 + k, '-03T00:00:00Z') AS ingested_at_utc, 'success' AS record_status, concat('2026-0', 1 + k, '-02') AS crawl_date
        FROM {{part}} AS part CROSS JOIN {CRAWLS} AS c GROUP BY p_brand, k""",
    "place_categories": """
        SELECT DISTINCT concat('OSM_node_', o_custkey) AS place_id, p_brand AS category_id, 'group' AS category_group, 'name' AS category_name, 'sub' AS subcategory_name,
               CASE WHEN concat('Brand#', o_custkey % 25) = p_brand THEN 'True' WHEN o_custkey % 2 = 0 THEN 'no' END AS is_primary, 'rule' AS classification_method,
               CASE o_custkey % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'low' ELSE 'sure' END AS classification_confidence,
               'run0' AS run_id, '2026-01-03T00:00:00Z' AS ingested_at_utc, CASE WHEN o_custkey % 41 = 3 THEN 'quarantine' END AS record_status, '2026-01-02' AS crawl_date
        FROM {lineitem} AS lineitem JOIN {orders} AS orders ON l_orderkey = o_orderkey JOIN {part} AS part ON l_partkey = p_partkey""",
    "ratings": """
        SELECT concat('OSM_node_', o_custkey) AS place_id, concat('Place ', o_custkey) AS place_name, concat(o_custkey % 25, '.0') AS province_id, CASE WHEN o_custkey % 2 = 0 THEN 'null' ELSE concat('P', o_custkey % 25) END AS province_name, concat('maps/', o_custkey) AS google_maps_url,
               concat(CAST(((o_orderkey % 56) - (o_orderkey % 56) % 10) / 10 AS INT), '.', (o_orderkey % 56) % 10) AS google_rating, concat(o_orderkey % 1000 - 3, CASE WHEN o_orderkey % 4 = 0 THEN '.0' ELSE '' END) AS google_review_count,
               concat(o_orderkey % 7 - 1, '') AS rating_5_count, concat(o_orderkey % 6, '') AS rating_4_count, concat(o_orderkey % 5, '') AS rating_3_count, CASE WHEN o_orderkey % 9 = 0 THEN 'NaN' ELSE concat(o_orderkey % 4, '') END AS rating_2_count, concat(o_orderkey % 3, '') AS rating_1_count,
               CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE 'success' END AS crawl_status,
               concat(CAST(o_orderdate AS DATE), 'T', lpad(concat(o_orderkey % 24, ''), 2, '0'), ':15:', lpad(concat(o_orderkey % 60, ''), 2, '0'), CASE o_orderkey % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+07:00' ELSE '' END) AS crawled_at,
               'run0' AS run_id, concat('2026-01-01T00:00:00.', lpad(concat(o_orderkey % 1000000, ''), 6, '0'), 'Z') AS ingested_at_utc, CASE WHEN o_orderkey % 50 = 7 THEN 'quarantine' WHEN o_orderkey % 2 = 0 THEN 'success' END AS record_status, '2026-01-02' AS crawl_date
        FROM {orders} AS orders""",
    "videos": """
        SELECT concat('OSM_node_', l_suppkey) AS place_id, concat('Place ', l_suppkey) AS place_name, concat(l_suppkey % 25, '') AS province_id, concat('P', l_suppkey % 25) AS province_name,
               concat('v', l_partkey) AS video_id, concat('video ', l_partkey) AS video_title, concat('ch', l_partkey % 97) AS channel_id, 'channel' AS channel_name, 'q' AS search_query,
               CASE WHEN l_orderkey % 53 = 0 THEN '-5' ELSE concat(CAST(l_quantity * 100 AS INT) + (l_orderkey % 700) * 40, '') END AS views, concat(l_linenumber * 60 - 60, '') AS duration_seconds, l_returnflag AS category,
               concat('watch/', l_partkey) AS video_url, concat(CASE WHEN l_partkey % 41 = 0 THEN 2099 ELSE 1994 + l_partkey % 6 END, '-', lpad(concat(1 + l_partkey % 12, ''), 2, '0'), '-10T00:00:00Z') AS published_at,
               concat(CAST(l_shipdate AS DATE), 'T', lpad(concat(l_linenumber, ''), 2, '0'), ':00:00Z') AS crawled_at,
               'run0' AS run_id, concat('2026-01-01T00:', lpad(concat(l_linenumber, ''), 2, '0'), ':00.', lpad(concat(l_orderkey % 1000000, ''), 6, '0'), 'Z') AS ingested_at_utc, CASE WHEN l_orderkey % 50 = 7 THEN 'quarantine' END AS record_status, '2026-01-02' AS crawl_date
        FROM {lineitem} AS lineitem""",
    "reviews": """
        SELECT concat('r', event_id % 3000) AS review_id, CASE WHEN event_id % 500 = 9 THEN 'test' ELSE concat('OSM_node_', (event_id % 3000) % 150) END AS place_id, concat(event_id % 7, '') AS rating,
               CASE event_id % 4 WHEN 0 THEN 'nan' WHEN 1 THEN concat('good<br/>place  ', event_id) WHEN 2 THEN concat(' fine ', event_id, ' ') END AS review_text,
               CASE event_id % 11 WHEN 0 THEN concat(1 + event_id % 9, ' weeks ago') WHEN 1 THEN 'một tháng trước' WHEN 2 THEN 'Thời gian chỉnh sửa: 2 năm trước' WHEN 3 THEN 'yesterday' WHEN 4 THEN '8 giờ trước' WHEN 5 THEN 'a day ago (edited)' WHEN 6 THEN 'Just now' WHEN 7 THEN '3 tháng trước' WHEN 8 THEN 'last  year' WHEN 9 THEN 'edited 5 months ago' ELSE 'some day' END AS review_date,
               concat(event_id % 13 - 1, '') AS likes_count, CASE WHEN event_id % 2 = 0 THEN 'google_maps' END AS source,
               concat(CAST(ts AS DATE), 'T', lpad(concat(event_id % 24, ''), 2, '0'), ':00:00Z') AS crawled_at,
               'run0' AS run_id, concat('2026-01-01T00:00:00.', lpad(concat(event_id % 1000000, ''), 6, '0'), 'Z') AS ingested_at_utc, CASE WHEN event_id % 60 = 7 THEN 'quarantine' END AS record_status, '2026-01-02' AS crawl_date
        FROM {events} AS events""",
    "comments": """
        SELECT concat('OSM_node_', conv_id % 150) AS place_id, 'Place' AS place_name, concat(conv_id % 25, '') AS province_id, 'P' AS province_name, concat('v', conv_id) AS video_id, 'title' AS video_title,
               CASE WHEN turn % 3 <> 0 THEN concat('c', conv_id, '-', turn) END AS comment_id, role AS author, text AS comment_text, concat(turn - 1, '') AS likes, CASE WHEN turn % 2 = 1 THEN 'true' ELSE 'x' END AS is_reply,
               CASE turn % 4 WHEN 0 THEN '2024-02-30' WHEN 1 THEN '2 tuần trước' WHEN 2 THEN '2024-02-03T04:05:06+07:00' ELSE '2030-01-01T00:00:00Z' END AS created_at,
               concat('2024-03-', lpad(concat(1 + conv_id % 28, ''), 2, '0'), 'T', lpad(concat(turn, ''), 2, '0'), ':00:00Z') AS crawled_at,
               'run0' AS run_id, concat('2026-01-01T00:', lpad(concat(turn, ''), 2, '0'), ':00.', lpad(concat(conv_id % 1000000, ''), 6, '0'), 'Z') AS ingested_at_utc, CASE WHEN conv_id % 60 = 7 THEN 'quarantine' END AS record_status, '2026-01-02' AS crawl_date
        FROM {conversations} AS conversations""",
}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A raw feed as a DataFrame of strings, with the file path of its lineage."""
    text = RAW[feed]
    used = {t: base(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(f"SELECT *, concat('bronze/{feed}/crawl_date=', crawl_date) AS file_path FROM ({text}) AS feed", **used)


def raw_sql(feed: str) -> str:
    """The same for DuckDB."""
    return f"SELECT *, concat('bronze/{feed}/crawl_date=', crawl_date) AS file_path FROM ({RAW[feed].format(**{t: t for t in TABLES})}) AS feed"

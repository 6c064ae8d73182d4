"""Sources, sinks, reference data, ingestion, matching, spatial and streaming operators as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cards, checks, geo, ingest, match, plan, reference, shaping
from ..settings import DEFAULTS
from ..sources import backfill, bronze, sinks
from ..sources.tables import new_path
from ..streaming import streams
from .inputs import base, raw, raw_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}
C = F.col


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def landed(spark, d, feed: str = "ratings", name: str = "bronze") -> str:
    """A raw feed as JSON lines in partitions by its crawl time's year, under a new folder."""
    path = new_path(spark, name)
    rows = raw(spark, d, feed).drop("file_path").withColumn("crawl_date", F.concat(F.substring("crawled_at", 1, 4), F.lit("-01-01")))
    rows.write.partitionBy("crawl_date").json(path)
    return path


YEAR_DAY = "concat(substr(crawled_at, 1, 4), '-01-01')"


# ---- sources and sinks: written and read back ----


@query(f"SELECT place_id, google_rating, {YEAR_DAY} AS crawl_date FROM ({raw_sql('ratings')}) WHERE {YEAR_DAY} >= '1997-01-01'")
def src1_partitioned_jsonl(spark, d):
    return bronze.read_jsonl(spark, landed(spark, d), ["place_id", "google_rating", "absent"], since="1997-01-01").select("place_id", "google_rating", "crawl_date")


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN json_extract_string(props, '$.k') END AS k, '2024-01-01' AS crawl_date FROM events")
def src2_src3_repaired_text_json(spark, d):
    path = new_path(spark, "text-json")
    e = base(spark, d, "events")
    k = F.when(C("event_id") % 3 == 0, "NaN").when(C("event_id") % 3 == 1, "-Infinity").otherwise(F.get_json_object("props", "$.k"))
    e.select(F.concat(F.lit('{"event_id": '), C("event_id"), F.lit(', "k": '), k, F.lit(" }")).alias("value")).write.text(f"{path}/crawl_date=2024-01-01")
    return bronze.read_text_json(spark, path, ["event_id", "k"]).select(C("event_id").cast("bigint").alias("event_id"), "k", "crawl_date")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS segment FROM customer")
def src4_snk6_csv(spark, d):
    path = new_path(spark, "csv")
    rows = base(spark, d, "customer").select(C("c_custkey").alias("id"), C("c_name").alias("name"), F.when(C("c_custkey") % 3 != 0, C("c_mktsegment")).alias("segment"))
    sinks.append_csv(rows, path, ["id", "name", "segment"])
    return bronze.read_csv(spark, path)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation WHERE n_nationkey % 4 <> 0")
def src5_csv_without_bad_rows(spark, d):
    path = new_path(spark, "csv")
    line = F.when(C("n_nationkey") % 4 == 0, F.concat_ws(",", "n_nationkey", "n_name", F.lit("x"), F.lit("y"))).otherwise(F.concat_ws(",", "n_nationkey", "n_name"))
    header = spark.range(1).select(F.lit(0).alias("o"), F.lit("id,name").alias("value"))
    header.unionByName(base(spark, d, "nation").select(F.lit(1).alias("o"), line.alias("value"))).coalesce(1).sortWithinPartitions("o").select("value").write.text(path)  # one small file
    return bronze.read_csv(spark, path, drop_malformed=True)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 1 THEN concat('n', s_nationkey) END AS nation FROM supplier")
def src6_csv_layouts(spark, d):
    path = new_path(spark, "csv")
    base(spark, d, "supplier").select(F.when(C("s_suppkey") % 2 == 0, F.concat_ws(",", "s_suppkey", "s_name")).otherwise(F.concat_ws(",", "s_suppkey", "s_name", F.concat(F.lit("n"), "s_nationkey"))).alias("value")).write.text(path)
    return bronze.read_csv_layouts(spark, path, [["id", "name"], ["id", "name", "nation"]])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, concat(max(year(o_orderdate)) OVER (), '-01-01') AS crawl_date FROM orders QUALIFY year(o_orderdate) = max(year(o_orderdate)) OVER ()")
def src7_newest_partition(spark, d):
    path = new_path(spark, "by-date")
    rows = base(spark, d, "orders").select(C("o_orderkey").cast("string"), F.concat(F.year("o_orderdate"), F.lit("-01-01")).alias("crawl_date"))
    rows.write.partitionBy("crawl_date").json(path)
    return bronze.newest_partition(spark, path, ["o_orderkey"]).drop("file_path")


REVIEW_OK = "review_id IS NOT NULL AND place_id IS NOT NULL AND TRY_CAST(rating AS DOUBLE) BETWEEN 1 AND 5 AND TRY_CAST(likes_count AS DOUBLE) >= 0"


def review_rows(spark, d) -> DataFrame:
    return raw(spark, d, "reviews").select("review_id", "place_id", "rating", "likes_count", C("crawled_at").alias("crawled_at_utc"))


def pinned():
    return F.lit("2026-02-01 00:00:00").cast("timestamp_ntz")


@query(f"SELECT review_id, rating, CASE WHEN {REVIEW_OK} THEN 'success' ELSE 'quarantine' END AS record_status, substr(crawled_at, 1, 10) AS crawl_date FROM ({raw_sql('reviews')})")
def snk1_ing2_ing4_land(spark, d):
    root = new_path(spark, "landing")
    sinks.land(review_rows(spark, d), root, "google_maps/reviews", "run-1", pinned())
    return bronze.read_landed(spark, root, "google_maps/reviews", fields := ["review_id", "rating", "record_status"]).unionByName(bronze.read_landed(spark, root, "google_maps/reviews", fields, quarantine=True)).drop("file_path")


@query("SELECT s_suppkey, s_name FROM supplier")
def snk2_snk3_snk4_tables(spark, d):
    path, s = new_path(spark, "table"), base(spark, d, "supplier")
    sinks.write_new(s.select("s_suppkey"), f"{path}-new")
    sinks.replace_table(s.select("s_suppkey"), path)
    sinks.replace_table(s.select("s_suppkey", "s_name"), path)
    sinks.verify_table(s, path)
    return spark.read.parquet(path)


@query("SELECT n_nationkey, '2026-02-02' AS crawl_date FROM nation WHERE n_nationkey > 3")
def snk5_sync(spark, d):
    path, t = new_path(spark, "synced"), base(spark, d, "nation").select("n_nationkey")
    sinks.sync_dataset(t.withColumn("crawl_date", F.lit("2026-02-01")), path)
    sinks.sync_dataset(t.where("n_nationkey > 3").withColumn("crawl_date", F.lit("2026-02-02")), path)
    return bronze.read_jsonl(spark, path, ["n_nationkey"]).select(C("n_nationkey").cast("int").alias("n_nationkey"), "crawl_date")


# ---- reference data ----

CANDIDATES = """SELECT c_custkey AS row_no, CASE c_mktsegment WHEN 'BUILDING' THEN 'node' ELSE 'way' END AS osm_type, CASE WHEN c_custkey % 17 <> 0 THEN c_custkey % 900 END AS osm_id,
    CASE WHEN c_custkey % 19 = 0 THEN ' ' WHEN c_custkey % 23 = 0 THEN concat('Block ', c_custkey % 10) WHEN c_custkey % 7 = 3 THEN concat(' pLACE ', c_custkey % 20, ' ') ELSE concat('Place ', c_custkey % 20) END AS place_name, c_nationkey AS province_id,
    CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 200 - 100 AS DOUBLE) END AS latitude, CAST(c_custkey % 400 - 200 AS DOUBLE) AS longitude,
    CASE c_custkey % 6 WHEN 0 THEN 'museum' WHEN 1 THEN 'attraction' WHEN 2 THEN 'artwork' END AS tourism, CASE c_custkey % 5 WHEN 0 THEN 'peak' WHEN 1 THEN 'beach' END AS natural_tag, CASE c_custkey % 7 WHEN 0 THEN 'castle' END AS historic, CASE c_custkey % 4 WHEN 0 THEN 'park' END AS leisure,
    CASE c_custkey % 8 WHEN 0 THEN '{"shop":"gift"}' WHEN 1 THEN '{"wikidata":"Q1","office":""}' WHEN 2 THEN '{broken' WHEN 3 THEN '{"amenity":"copyshop"}' WHEN 4 THEN '{"natural":"cape"}' WHEN 5 THEN replace('{^shop^:^gift^}', '^', chr(39)) WHEN 6 THEN '{"wikidata":"Q1"} junk' ELSE 'NaN' END AS tags_json FROM {customer} AS customer"""


def candidates(spark, d) -> DataFrame:
    text = CANDIDATES.replace("{broken", "{{broken").replace("{\"", "{{\"").replace("\"}", "\"}}").replace("{^", "{{^").replace("^}", "^}}")
    return spark.sql(text, customer=base(spark, d, "customer")).withColumnRenamed("natural_tag", "natural")


CAND = "(" + CANDIDATES.replace("{customer}", "customer").replace("AS natural_tag", 'AS "natural"') + ")"
BASIC = f"""(SELECT *, CASE WHEN abs(longitude) > 180 THEN 'invalid_longitude' WHEN abs(latitude) > 90 THEN 'invalid_latitude' WHEN latitude IS NULL OR longitude IS NULL THEN 'missing_coordinates' WHEN trim(place_name) = '' THEN 'missing_name' WHEN osm_id IS NULL THEN 'missing_osm_id' ELSE '' END AS r1 FROM {CAND})"""
REPEATS = f"(SELECT *, CASE WHEN r1 = '' AND row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY row_no) > 1 THEN 'duplicate_osm_object' ELSE r1 END AS r2 FROM {BASIC})"
NAMES = f"(SELECT *, r2 = '' AND regexp_matches(trim(place_name), '(?i)^((group|block|section|area|zone)\\s+[a-z0-9]+|[a-h][0-9]+)$') AS odd FROM {REPEATS})"


@query(f"SELECT row_no, CASE WHEN r1 = '' THEN 'valid' ELSE 'invalid' END AS validation_status, r1 AS validation_reason FROM {BASIC}")
def ref1_validate_basic(spark, d):
    return reference.validate_basic(candidates(spark, d)).select(C("row_no"), "validation_status", "validation_reason")


@query(f"SELECT row_no, CASE WHEN r2 = '' THEN 'valid' ELSE 'invalid' END AS validation_status, r2 AS validation_reason FROM {REPEATS}")
def ref2_repeated_objects(spark, d):
    return reference.reject_repeats(reference.validate_basic(candidates(spark, d)), "row_no").select("row_no", "validation_status", "validation_reason")


@query(f"SELECT row_no, CASE WHEN odd THEN 'review' WHEN r2 = '' THEN 'valid' ELSE 'invalid' END AS validation_status, CASE WHEN odd THEN 'suspicious_name' ELSE r2 END AS validation_reason FROM {NAMES}")
def ref3_suspicious_names(spark, d):
    rows = reference.suspect_names(reference.reject_repeats(reference.validate_basic(candidates(spark, d)), "row_no"))
    return rows.select("row_no", "validation_status", "validation_reason")


@query(f"""SELECT row_no, CASE WHEN odd OR twin THEN 'review' WHEN r2 = '' THEN 'valid' ELSE 'invalid' END AS validation_status, CASE WHEN twin THEN 'duplicate_name' WHEN odd THEN 'suspicious_name' ELSE r2 END AS validation_reason
    FROM (SELECT *, r2 = '' AND NOT odd AND count(*) OVER (PARTITION BY province_id, trim(lower(place_name))) > 1 AND trim(place_name) <> '' AS twin FROM {NAMES})""")
def ref4_namesakes(spark, d):
    rows = reference.suspect_namesakes(reference.suspect_names(reference.reject_repeats(reference.validate_basic(candidates(spark, d)), "row_no")))
    return rows.select("row_no", "validation_status", "validation_reason")


def eligibility_rows(spark, d) -> DataFrame:
    c = candidates(spark, d)
    return c.select("row_no", reference.eligibility(C("tags_json"), {k: C(k) for k in reference.TAGS}).alias("e")).select("row_no", "e.tourism_status", "e.tourism_reason", "e.tourism_evidence", "e.tourism_confidence")


ELIGIBLE = f"""WITH t AS (SELECT *, c_8 IN (2, 5, 6) AS bad, c_8 IN (0, 3) AS shop, CASE WHEN c_8 = 4 THEN 'cape' ELSE "natural" END AS nat FROM (SELECT *, row_no % 8 AS c_8 FROM {CAND})),
    u AS (SELECT *, CASE WHEN tourism = 'museum' THEN 'tourism=museum' WHEN nat = 'beach' THEN 'natural=beach' WHEN historic = 'castle' THEN 'historic=castle' END AS direct, CASE WHEN leisure = 'park' THEN 'leisure=park' WHEN nat IN ('cape', 'peak') THEN 'natural=' || nat WHEN tourism IN ('artwork', 'attraction') THEN 'tourism=' || tourism END AS cond FROM t)
    SELECT row_no, CASE WHEN bad THEN 'review' WHEN shop AND tourism IS DISTINCT FROM 'museum' THEN 'rejected' WHEN direct IS NOT NULL THEN 'eligible' WHEN cond IS NOT NULL AND c_8 = 1 THEN 'eligible' WHEN cond IS NOT NULL THEN 'review' ELSE 'rejected' END AS tourism_status,
           CASE WHEN bad THEN 'malformed_tags_json' WHEN shop AND tourism IS DISTINCT FROM 'museum' THEN 'non_destination_business' WHEN direct IS NOT NULL THEN 'strong_tourism_tag' WHEN cond IS NOT NULL AND c_8 = 1 THEN 'conditional_tag_with_independent_evidence' WHEN cond IS NOT NULL THEN 'conditional_tag_needs_evidence' ELSE 'no_supported_tourism_signal' END AS tourism_reason,
           CASE WHEN bad THEN 'tags_json' WHEN shop AND tourism IS DISTINCT FROM 'museum' THEN CASE c_8 WHEN 0 THEN 'shop' ELSE 'amenity' END WHEN direct IS NOT NULL THEN direct WHEN cond IS NOT NULL AND c_8 = 1 THEN cond || ';wikidata' WHEN cond IS NOT NULL THEN cond ELSE '' END AS tourism_evidence,
           CASE WHEN bad THEN 'low' WHEN (shop AND tourism IS DISTINCT FROM 'museum') OR direct IS NOT NULL THEN 'high' WHEN cond IS NOT NULL AND c_8 = 1 THEN 'medium' WHEN cond IS NOT NULL THEN 'low' ELSE 'high' END AS tourism_confidence FROM u"""


@query(ELIGIBLE)
def ref6_eligibility(spark, d):
    return eligibility_rows(spark, d)


@query(f"""SELECT validation_status, tourism_status, tourism_reason, validation_status = 'valid' AND tourism_status = 'eligible' AS crawl_eligible, count(*) AS n
    FROM (SELECT row_no, CASE WHEN r1 = '' THEN 'valid' ELSE 'invalid' END AS validation_status FROM {BASIC}) JOIN ({ELIGIBLE}) USING (row_no) GROUP BY ALL""")
def ref7_ref11_crawl_eligible_report(spark, d):
    rows = reference.validate_basic(candidates(spark, d)).join(eligibility_rows(spark, d), "row_no").withColumn("crawl_eligible", reference.crawl_eligible())
    return rows.groupBy("validation_status", "tourism_status", "tourism_reason", "crawl_eligible").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH v AS (SELECT row_no, list_filter([{{'p': 0, 's': CASE tourism WHEN 'museum' THEN 'museum' WHEN 'artwork' THEN 'gallery' END}}, {{'p': 1, 's': CASE "natural" WHEN 'peak' THEN 'mountain' WHEN 'beach' THEN 'beach' END}}, {{'p': 2, 's': CASE historic WHEN 'castle' THEN 'monument' END}}, {{'p': 3, 's': CASE leisure WHEN 'park' THEN 'public_park' END}}], lambda x: x.s IS NOT NULL) AS found FROM {CAND}),
    e AS (SELECT row_no, UNNEST(CASE WHEN len(found) = 0 THEN [{{'p': 0, 's': 'general_attraction'}}] ELSE found END) AS x FROM v),
    k(subcategory_name, category_id, category_group, category_name) AS (VALUES ('mountain', 'CAT001', 'natural', 'landscape'), ('beach', 'CAT004', 'natural', 'coastal'), ('monument', 'CAT006', 'heritage', 'historical'), ('museum', 'CAT011', 'culture', 'museum'), ('gallery', 'CAT012', 'culture', 'arts'), ('public_park', 'CAT013', 'recreation', 'park'), ('general_attraction', 'CAT018', 'other', 'attraction'))
    SELECT row_no, category_id, category_group, category_name, subcategory_name, x.p = min(x.p) OVER (PARTITION BY row_no) AS is_primary FROM e JOIN k ON x.s = subcategory_name""")
def ref8_map2_classify(spark, d):
    return reference.classify(candidates(spark, d), "row_no")


@query("""SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS current_province_id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN 'kept' END, s_name) AS legacy_province_id, coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'kept too' END, s_address) AS legacy_province_name
    FROM customer LEFT JOIN (SELECT s_nationkey, s_name, concat('old ', s_suppkey) AS s_address FROM supplier) ON c_nationkey = s_nationkey""")
def ref10_legacy_fill(spark, d):
    m = base(spark, d, "supplier").select(C("s_nationkey").cast("string").alias("current_province_id"), C("s_name").alias("legacy_province_id"), F.concat(F.lit("old "), "s_suppkey").alias("legacy_province_name"))
    c = base(spark, d, "customer").select("c_custkey", C("c_nationkey").cast("string").alias("province_id"), F.when(C("c_custkey") % 2 == 0, "kept").alias("legacy_province_id"), F.when(C("c_custkey") % 3 == 0, "kept too").alias("legacy_province_name"))
    return reference.enrich_admin(c, m).select("c_custkey", "current_province_id", "legacy_province_id", "legacy_province_name")


def ruled_places(spark, d) -> DataFrame:
    """Candidates with both statuses, some without a province's name."""
    rows = reference.validate_basic(candidates(spark, d)).join(eligibility_rows(spark, d), "row_no")
    return rows.withColumn("province_name", F.when(C("province_id") % 3 != 0, F.concat(F.lit("P"), "province_id")))


RULED = f"(SELECT row_no, province_id, CASE WHEN province_id % 3 <> 0 THEN concat('P', province_id) END AS province_name, CASE WHEN r1 = '' THEN 'valid' ELSE 'invalid' END AS validation_status, tourism_status, tourism_reason FROM {BASIC} JOIN ({ELIGIBLE}) USING (row_no))"


@query(f"SELECT row_no, validation_status, tourism_status FROM {RULED} WHERE tourism_status IN ('review', 'rejected') OR validation_status <> 'valid'")
def ref11_review_queue(spark, d):
    return reference.review_queue(ruled_places(spark, d)).select("row_no", "validation_status", "tourism_status")


@query(f"SELECT province_id, province_name, tourism_status, tourism_reason, count(*) AS place_count FROM {RULED} GROUP BY ALL")
def ref11_eligibility_report(spark, d):
    return reference.eligibility_report(ruled_places(spark, d))


@query("""WITH e AS (SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'relation' END AS kind, CAST(p_size AS DOUBLE) AS lat, CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 4 < 3 THEN p_name END AS name, CASE WHEN p_partkey % 5 < 2 THEN p_type END AS vi, CASE WHEN p_partkey % 7 < 3 THEN p_brand END AS en FROM part)
    SELECT k AS osm_id, kind AS osm_type, concat('OSM_', kind, '_', k) AS place_id, coalesce(nullif(name, ''), vi, en) AS place_name, vi AS name_vi, en AS name_en, CASE WHEN k % 2 = 0 THEN 'museum' END AS tourism, CASE WHEN kind = 'node' THEN lat WHEN k % 11 <> 0 THEN lat + 1 END AS latitude, CASE WHEN kind = 'node' THEN 1.0 WHEN k % 11 <> 0 THEN 2.0 END AS longitude,
        CASE WHEN k % 6 = 0 THEN 'own' WHEN k % 6 < 3 THEN 'contact' END AS website, concat('Q', k) AS wikidata, json_object('name', name, 'name:vi', vi, 'name:en', en, 'tourism', CASE WHEN k % 2 = 0 THEN 'museum' END, 'website', CASE WHEN k % 6 = 0 THEN 'own' END, 'contact:website', CASE WHEN k % 6 < 3 THEN 'contact' END, 'wikidata', concat('Q', k)) ->> '$.name' AS name_in_json, 'OpenStreetMap' AS source, 'core' AS discovery_scope, 'run-1' AS pipeline_run_id, '2026-02-01 00:00:00' AS crawled_at_utc
    FROM e WHERE coalesce(nullif(name, ''), vi, en) IS NOT NULL""")
def ref12_ref14_elements(spark, d):
    k, lat = C("p_partkey"), C("p_size").cast("double")
    kind = F.when(k % 3 == 0, "node").when(k % 3 == 1, "way").otherwise("relation")
    tags = {"name": F.when(k % 4 == 0, "").when(k % 4 < 3, C("p_name")), "name:vi": F.when(k % 5 < 2, C("p_type")), "name:en": F.when(k % 7 < 3, C("p_brand")), "tourism": F.when(k % 2 == 0, "museum"), "website": F.when(k % 6 == 0, "own"), "contact:website": F.when(k % 6 < 3, "contact"), "wikidata": F.concat(F.lit("Q"), k)}
    center = F.when(k % 11 != 0, F.struct((lat + 1).alias("lat"), F.lit(2.0).alias("lon")))  # nodes have one too, which does not count
    own = F.struct(kind.alias("type"), k.alias("id"), lat.alias("lat"), F.lit(1.0).alias("lon"), center.alias("center"), F.struct(*[v.alias(n) for n, v in tags.items()]).alias("tags"))
    rows = reference.elements(base(spark, d, "part").select(F.to_json(own).alias("element")), "run-1", pinned(), "core")
    return rows.select("osm_id", "osm_type", reference.stable_id(C("osm_type"), C("osm_id")).alias("place_id"), "place_name", "name_vi", "name_en", "tourism", "latitude", "longitude", "website", "wikidata", F.get_json_object("tags_json", "$.name").alias("name_in_json"), "source", "discovery_scope", "pipeline_run_id", "crawled_at_utc")


@query("""SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN concat('f', n_nationkey) WHEN n_nationkey % 3 = 0 THEN concat('pc', n_nationkey) WHEN n_nationkey % 5 = 0 THEN concat('c', n_nationkey) END AS province_id, CASE WHEN n_nationkey % 3 = 1 THEN n_name WHEN n_nationkey % 4 < 2 THEN concat('P ', n_name) ELSE concat('F ', n_name) END AS province_name,
    CASE WHEN n_nationkey % 4 = 0 THEN CAST(n_nationkey AS DOUBLE) WHEN n_nationkey % 4 < 3 THEN -1.0 END AS min_lon, CASE WHEN n_nationkey % 4 = 0 THEN 3.5 WHEN n_nationkey % 4 < 3 THEN 9.0 END AS max_lat FROM nation WHERE n_nationkey % 7 <> 6""")
def ref13_province_features(spark, d):
    k, name = C("n_nationkey"), C("n_name")
    props = F.struct(F.lit("x").alias("province_id"), F.when(k % 3 == 0, F.concat(F.lit("pc"), k)).alias("province_code"), F.when(k % 5 == 0, F.concat(F.lit("c"), k)).alias("code"), F.when(k % 3 == 1, name).when(k % 3 == 0, "").alias("name"), F.when(k % 4 < 2, F.concat(F.lit("P "), name)).alias("province_name"), F.concat(F.lit("F "), name).alias("full_name"))
    box = lambda *v: F.array(*[x.cast("double") if isinstance(x, F.Column) else F.lit(float(x)) for x in v])
    feature = F.struct(F.when(k % 2 == 0, F.concat(F.lit("f"), k)).alias("id"), F.when(k % 4 == 0, box(k, 1, 2, 3.5)).when(k % 4 == 1, F.array().cast("array<double>")).alias("bbox"), props.alias("properties"))
    other = F.struct(F.lit("second").alias("id"), box(0, 0, 0, 0).alias("bbox"), props.alias("properties"))
    collection = F.struct(F.when(k % 4 < 3, box(-1, 8, 10, 9)).alias("bbox"), F.when(k % 7 == 6, F.array().cast(f"array<{base(spark, d, 'nation').select(feature.alias('f')).schema['f'].dataType.simpleString()}>")).otherwise(F.array(feature, other)).alias("features"))
    return reference.province_features(base(spark, d, "nation").select(k.alias("k"), F.to_json(collection).alias("collection"))).select("k", "province_id", "province_name", "min_lon", "max_lat")


@query(f"""SELECT tag, value, count(*) AS n FROM (UNPIVOT (SELECT tourism, "natural", historic, leisure FROM {CAND}) ON COLUMNS(*) INTO NAME tag VALUE value) GROUP BY ALL""")
def agg18_tag_report(spark, d):
    return reference.tag_report(candidates(spark, d))


CROSS_CHECK = "(lower(elig) IN ('true', '1', 'yes')) IS DISTINCT FROM (ts = 'eligible' AND vs = 'valid')"


@query(f"""WITH p AS (SELECT row_no AS place_id, place_name, CAST(province_id AS VARCHAR) AS province_id, latitude, longitude, r1, tourism_status AS ts, CASE WHEN r1 = '' THEN 'valid' ELSE 'invalid' END AS vs, CASE WHEN row_no % 29 = 0 THEN 'maybe' WHEN r1 = '' AND tourism_status = 'eligible' THEN 'True' ELSE 'false' END AS elig FROM {BASIC} JOIN ({ELIGIBLE}) USING (row_no))
    SELECT 'provinces' AS stage, 'unique:province_id' AS "check", (SELECT count(*) FROM (SELECT province_id FROM ({raw_sql('provinces')}) GROUP BY 1 HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'provinces', 'not_empty', 0 UNION ALL SELECT 'provinces', 'order:min_lat', 0
    UNION ALL SELECT 'provinces', 'order:min_lon', (SELECT count(*) FROM ({raw_sql('provinces')}) WHERE CAST(min_lon AS DOUBLE) > CAST(max_lon AS DOUBLE))
    UNION ALL SELECT 'provinces', UNNEST(['number:min_lon', 'number:min_lat', 'number:max_lon', 'number:max_lat']), 0
    UNION ALL SELECT 'candidates', 'not_empty', 0 UNION ALL SELECT 'candidates', 'unique:osm_type,osm_id', (SELECT count(*) FROM (SELECT osm_type, osm_id FROM {CAND} GROUP BY ALL HAVING count(*) > 1))
    UNION ALL SELECT 'validated', 'column:spatial_status', 1
    UNION ALL SELECT 'places', 'not_empty', 0 UNION ALL SELECT 'places', 'unique:place_id', 0
    UNION ALL SELECT 'places', 'filled:place_name', (SELECT count(*) FROM p WHERE trim(place_name) = '')
    UNION ALL SELECT 'places', UNNEST(['filled:place_id', 'filled:province_id', 'filled:validation_status', 'filled:tourism_status', 'filled:tourism_reason', 'filled:crawl_eligible', 'filled:tourism_rule_version', 'values:validation_status', 'values:tourism_status']), 0
    UNION ALL SELECT 'places', 'values:crawl_eligible', (SELECT count(*) FROM p WHERE elig = 'maybe')
    UNION ALL SELECT 'places', 'rule:crawl_eligible_as_statuses', (SELECT count(*) FROM p WHERE {CROSS_CHECK})
    UNION ALL SELECT 'places', 'range:latitude', (SELECT count(*) FROM p WHERE latitude IS NULL OR abs(latitude) > 90) UNION ALL SELECT 'places', 'range:longitude', (SELECT count(*) FROM p WHERE longitude IS NULL OR abs(longitude) > 180)""")
def ref15_stage_gates(spark, d):
    found = candidates(spark, d)
    checked = reference.validate_basic(found)
    ruled = found.select("row_no", reference.eligibility(C("tags_json"), {k: C(k) for k in reference.TAGS}).alias("e")).select("row_no", "e.tourism_status", "e.tourism_reason", "e.tourism_rule_version")
    places = checked.join(ruled, "row_no").withColumnRenamed("row_no", "place_id")
    places = places.withColumn("crawl_eligible", F.when(C("place_id") % 29 == 0, "maybe").when(reference.crawl_eligible(), "True").otherwise("false"))
    stages = {"provinces": raw(spark, d, "provinces"), "candidates": found, "validated": checked, "places": places}
    out = None
    for stage, df in stages.items():
        row = checks.gate_report(df, stage).select(F.lit(stage).alias("stage"), "check", "violations")
        out = row if out is None else out.unionByName(row)
    return out


# ---- spatial ----


def squares(spark, d) -> DataFrame:
    """A square of 10 by 10 degrees a nation, on a grid."""
    x, y = (C("n_nationkey") % 5) * 10.0 - 25, F.floor(C("n_nationkey") / 5) * 10.0 - 25
    pt = lambda a, b: F.struct((x + a).cast("double").alias("x"), (y + b).cast("double").alias("y"))
    return geo.edges(base(spark, d, "nation").select(C("n_nationkey").alias("polygon_id"), F.array(pt(0, 0), pt(10, 0), pt(10, 10), pt(0, 10)).alias("points")))


def spots(spark, d) -> DataFrame:
    """Vectors' first two numbers as integer degrees over 4, some of them on borders, some outside."""
    at = lambda k: F.rint(C("embedding")[k].cast("double") * 400) / 4.0
    return base(spark, d, "embeddings").select(C("vec_id").alias("point_id"), at(0).alias("x"), at(1).alias("y"))


SPOTS = "(SELECT vec_id AS point_id, round_even(CAST(embedding[1] AS DOUBLE) * 400, 0) / 4.0 AS x, round_even(CAST(embedding[2] AS DOUBLE) * 400, 0) / 4.0 AS y FROM embeddings)"
SQUARES = "(SELECT n_nationkey AS polygon_id, (n_nationkey % 5) * 10.0 - 25 AS x0, (n_nationkey // 5) * 10.0 - 25 AS y0 FROM nation)"


@query(f"SELECT point_id, min(polygon_id) AS polygon_id FROM {SPOTS} JOIN {SQUARES} ON x BETWEEN x0 AND x0 + 10 AND y BETWEEN y0 AND y0 + 10 GROUP BY 1")
def jn14_point_in_polygon(spark, d):
    return geo.contained(spots(spark, d), squares(spark, d))


MX, MY = "6378137.0 * radians({})", "6378137.0 * ln(tan(pi() / 4 + radians({}) / 2))"


NEAREST = f"""SELECT point_id, arg_min(polygon_id, (dist, polygon_id)) AS polygon_id, round(min(dist) / 1000, 3) AS km FROM (SELECT point_id, polygon_id,
    CASE WHEN x BETWEEN x0 AND x0 + 10 AND y BETWEEN y0 AND y0 + 10 THEN least({MX.format("x - x0")}, {MX.format("x0 + 10 - x")}, {MY.format("y")} - {MY.format("y0")}, {MY.format("y0 + 10")} - {MY.format("y")})
    ELSE sqrt(pow({MX.format("greatest(x0 - x, 0, x - x0 - 10)")}, 2) + pow(greatest({MY.format("y0")} - {MY.format("y")}, 0, {MY.format("y")} - {MY.format("y0 + 10")}), 2)) END AS dist FROM {SPOTS}, {SQUARES} WHERE abs(x) > 25 OR abs(y) > 25) GROUP BY 1"""


@query(NEAREST)
def jn15_nearest_polygon(spark, d):
    out = geo.nearest(spots(spark, d).where("abs(x) > 25 OR abs(y) > 25"), squares(spark, d))
    return out.select("point_id", "polygon_id", F.round(C("distance_m") / 1000, 3).alias("km"))


@query(f"""WITH i AS (SELECT point_id, min(polygon_id) AS inside FROM {SPOTS} JOIN {SQUARES} ON x BETWEEN x0 AND x0 + 10 AND y BETWEEN y0 AND y0 + 10 GROUP BY 1), f AS (SELECT point_id, polygon_id AS near, km FROM ({NEAREST}))
    SELECT vec_id AS place_id, CASE WHEN inside IS NOT NULL THEN 'inside' WHEN km <= 1 THEN 'near_boundary' ELSE 'outside' END AS spatial_status, CAST(CASE WHEN inside IS NOT NULL THEN inside WHEN km <= 1 THEN near END AS INTEGER) AS province_id,
           CASE WHEN inside IS NOT NULL THEN 'valid' WHEN km <= 1 THEN 'review' ELSE 'invalid' END AS validation_status FROM embeddings LEFT JOIN i ON i.point_id = vec_id LEFT JOIN f ON f.point_id = vec_id""")
def ref5_spatial_conformance(spark, d):
    places = spots(spark, d).select(C("point_id").alias("place_id"), C("x").alias("longitude"), C("y").alias("latitude"), F.lit("valid").alias("validation_status"))
    return geo.conform_to_polygons(places, squares(spark, d), DEFAULTS.boundary_tolerance_m).select("place_id", "spatial_status", C("province_id").cast("int").alias("province_id"), "validation_status")


# ---- ingestion ----


@query(f"SELECT review_id, rating, array_to_string(list_filter([CASE WHEN place_id IS NULL THEN 'missing:place_id' END, CASE WHEN TRY_CAST(rating AS DOUBLE) NOT BETWEEN 1 AND 5 THEN 'range:rating' END, CASE WHEN TRY_CAST(likes_count AS DOUBLE) < 0 THEN 'negative:likes_count' END], lambda e: e IS NOT NULL), ',') AS errors FROM ({raw_sql('reviews')})")
def ing1_row_errors(spark, d):
    rows = review_rows(spark, d)
    return rows.select("review_id", "rating", F.array_join(ingest.row_errors(rows, ingest.DATASETS["google_maps/reviews"]), ",").alias("errors"))


@query(f"""SELECT id, 'google_maps' AS source, coalesce(nullif(video_id, ''), nullif(review_id, ''), nullif(place_id, ''), '') AS source_id, coalesce(nullif(url, ''), nullif(google_maps_url, ''), '') AS source_url, CASE WHEN substr(review_id, -1) = '3' THEN '2026-02-01' ELSE substr(crawled_at_utc, 1, 10) END AS crawl_date, pipeline_version, crawler_version, CAST(1 AS INT) AS attempt,
    CASE WHEN len(e) > 0 THEN concat('["', array_to_string(e, '", "'), '"]') END AS quality_errors FROM (SELECT *, list_filter([CASE WHEN review_id = '' THEN 'missing:review_id' END, CASE WHEN coalesce(place_id, '') = '' THEN 'missing:place_id' END, CASE WHEN substr(review_id, -1) = '3' THEN 'missing:crawled_at_utc' END, CASE WHEN TRY_CAST(rating AS DOUBLE) NOT BETWEEN 1 AND 5 THEN 'range:rating' END, CASE WHEN TRY_CAST(likes_count AS DOUBLE) < 0 THEN 'negative:likes_count' END], lambda x: x IS NOT NULL) AS e
    FROM (SELECT review_id AS id, CASE WHEN substr(review_id, -1) = '7' THEN '' ELSE review_id END AS review_id, place_id, rating, likes_count, crawled_at AS crawled_at_utc, '' AS video_id, CASE WHEN substr(review_id, -1) = '1' THEN concat('u/', review_id) ELSE '' END AS url, CASE WHEN substr(review_id, -1) = '2' THEN concat('maps/', review_id) END AS google_maps_url, '1.0' AS pipeline_version, 'adapter-2' AS crawler_version FROM ({raw_sql('reviews')})))""")
def ing3_dt14_stamp(spark, d):
    last = lambda k: C("review_id").endswith(k)
    rows = review_rows(spark, d).withColumns({"id": C("review_id"), "video_id": F.lit(""), "url": F.when(last("1"), F.concat(F.lit("u/"), "review_id")).otherwise(""), "google_maps_url": F.when(last("2"), F.concat(F.lit("maps/"), "review_id")), "crawled_at_utc": F.when(~last("3"), C("crawled_at_utc"))})
    rows = rows.withColumn("review_id", F.when(last("7"), "").otherwise(C("review_id")))
    out = ingest.stamped(rows, "google_maps/reviews", "run-1", pinned(), crawler_version="adapter-2")
    return out.select("id", "source", "source_id", "source_url", "crawl_date", "pipeline_version", "crawler_version", "attempt", "quality_errors")


@query("""WITH r AS (SELECT event_id, CASE WHEN event_id % 10 = 3 THEN '' ELSE concat(CAST(ts AS DATE), 'T00:00:00Z') END AS t, event_id % 6 = 0 AS bad FROM events)
    SELECT 'google_maps/reviews' AS dataset, concat('r', event_id) AS id, CASE WHEN t = '' THEN '2026-08-30T00:00:00.000000' ELSE t END AS crawled_at, CASE WHEN bad THEN 'quarantine' ELSE 'success' END AS record_status, CASE WHEN t = '' THEN '2026-08-30' ELSE substr(t, 1, 10) END AS crawl_date, 'historical-google_maps_reviews' AS run_id FROM r
    UNION ALL SELECT 'google_maps/errors', concat('p', event_id), CASE WHEN event_id % 10 = 3 THEN NULL ELSE t END, CASE WHEN t = '' THEN 'quarantine' ELSE 'success' END, CASE WHEN t = '' THEN '2026-02-01' ELSE substr(t, 1, 10) END, 'historical-google_maps_errors' FROM r""")
def ing5_backfill(spark, d):
    folder, root = new_path(spark, "historical"), new_path(spark, "backfilled")
    t = F.when(C("event_id") % 10 == 3, "").otherwise(F.concat(C("ts").cast("date").cast("string"), F.lit("T00:00:00Z")))
    e = base(spark, d, "events").select("event_id", t.alias("t"))
    reviews = e.select(F.concat(F.lit("r"), "event_id").alias("review_id"), F.lit("p").alias("place_id"), F.when(C("event_id") % 6 == 0, "9").otherwise("3").alias("rating"), C("t").alias("crawled_at"))
    sinks.append_csv(reviews, f"{folder}/google_maps_reviews.csv", reviews.columns)
    errors = e.select(F.concat(F.lit("p"), "event_id").alias("place_id"), F.lit("e").alias("error_type"), C("t").alias("failed_at"))
    sinks.append_csv(errors, f"{folder}/google_maps_errors.csv", errors.columns)
    for _ in range(2):  # the second run finds all files landed
        backfill.backfill(spark, folder, root, pinned())
    out = None
    for dataset, key, at in (("google_maps/reviews", "review_id", "crawled_at_utc"), ("google_maps/errors", "place_id", "failed_at")):
        for quarantine in (False, True):
            rows = bronze.read_landed(spark, root, dataset, [key, at, "record_status", "run_id"], quarantine)
            part = rows.select(F.lit(dataset).alias("dataset"), C(key).alias("id"), F.nullif(at, F.lit("")).alias("crawled_at"), "record_status", "crawl_date", "run_id")
            out = part if out is None else out.unionByName(part)
    return out


@query(f"SELECT review_id, rating FROM ({raw_sql('reviews')}) WHERE rating IN ('1', '2', '3', '4', '5') AND TRY_CAST(likes_count AS INT) >= 0 AND substr(review_id, -1) = '4'")
def ing6_rescue(spark, d):
    rows = review_rows(spark, d).withColumns({"spare": C("crawled_at_utc"), "crawled_at_utc": F.when(~C("review_id").endswith("4"), C("crawled_at_utc")).otherwise(F.lit(" "))})
    _, bad = ingest.split(ingest.stamped(rows, "google_maps/reviews", "run-1", pinned()))
    good, _ = ingest.rescue(bad, "google_maps/reviews", "crawled_at_utc", "spare", "run-2", pinned())
    return good.select("review_id", "rating")


def log(spark, d) -> DataFrame:
    return base(spark, d, "events").select(C("user_id").alias("item"), C("ts").alias("at"), C("event_id").alias("seq"), F.when(C("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"))


LOG = "(SELECT user_id AS item, ts AS \"at\", event_id AS seq, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM events)"


@query(f"SELECT item, arg_max(status, (\"at\", seq)) AS status, max(\"at\") AS \"at\" FROM {LOG} GROUP BY 1")
def ing7_agg20_latest_status(spark, d):
    return ingest.latest_status(log(spark, d), "item")


@query(f"SELECT item, max(\"at\") FILTER (status = 'SUCCESS') AS \"at\" FROM {LOG} GROUP BY 1")
def agg19_latest_success(spark, d):
    return ingest.latest_success(log(spark, d), "item")


RUN_LOG = """(SELECT user_id AS run_id, ts AS "at", CASE event_id % 9 WHEN 0 THEN 'Success' WHEN 1 THEN 'failed' WHEN 2 THEN 'skipped' WHEN 3 THEN 'QUARANTINE' WHEN 4 THEN 'retry' WHEN 5 THEN 'empty' WHEN 6 THEN 'reviews_found' ELSE 'success' END AS status FROM events WHERE user_id % 5 <> 0 OR event_id % 9 = 6)"""


@query(f"""SELECT run_id, n[1] AS success, n[2] AS failed, n[3] AS skipped, n[4] AS quarantine, n[5] AS retry, n[6] AS empty, CAST(list_sum(n) AS BIGINT) AS total, CASE WHEN list_sum(n) > 0 THEN n[1] / list_sum(n) ELSE 1.0 END AS success_rate, CASE WHEN n[2] > 0 THEN 'failed' ELSE 'success' END AS run_status, round(us / 1e6, 3) AS duration_seconds
    FROM (SELECT run_id, [count(*) FILTER (lower(status) = s) FOR s IN ['success', 'failed', 'skipped', 'quarantine', 'retry', 'empty']] AS n, epoch_us(max("at")) - epoch_us(min("at")) AS us FROM {RUN_LOG} GROUP BY 1)""".replace("[count(*) FILTER (lower(status) = s) FOR s IN ['success', 'failed', 'skipped', 'quarantine', 'retry', 'empty']]", "[" + ", ".join(f"count(*) FILTER (lower(status) = '{x}')" for x in ingest.RUN_STATUSES) + "]"))
def agg21_run_metrics(spark, d):
    k = C("event_id") % 9
    status = F.when(k == 0, "Success").when(k == 1, "failed").when(k == 2, "skipped").when(k == 3, "QUARANTINE").when(k == 4, "retry").when(k == 5, "empty").when(k == 6, "reviews_found").otherwise("success")
    rows = base(spark, d, "events").where("user_id % 5 <> 0 OR event_id % 9 = 6")  # a fifth of the runs has no status that counts
    return ingest.run_metrics(rows.select(C("user_id").alias("run_id"), C("ts").alias("at"), status.alias("status")))


# The plan: customers are places, parts are videos of the supplier's place; a history, data and checkpoints tell what was done.
def history(spark, d) -> DataFrame:
    status = F.when(C("o_orderstatus") == "F", "success").when(C("o_orderstatus") == "O", "FAILED").otherwise("SUCCESS ")
    return base(spark, d, "orders").select(C("o_custkey").alias("item_id"), C("o_orderdate").alias("at"), C("o_orderkey").alias("seq"), status.alias("status"))


def checkpoints(spark, d) -> DataFrame:
    """Events as checkpoints of parts and places; their times lie years back like the orders'."""
    status = F.when(C("event_type") == "error", "FAILED").when(C("event_type") == "view", "empty").when(C("event_type") == "click", " success ").otherwise("SUCCESS")
    return base(spark, d, "events").select(C("user_id").alias("item_id"), (C("ts") - F.expr("interval 8400 days")).alias("at"), C("event_id").alias("seq"), status.alias("status"))


def landed_data(spark, d) -> DataFrame:
    return base(spark, d, "lineitem").select(C("l_suppkey").alias("item_id"), F.when(C("l_linenumber") != 3, C("l_shipdate")).alias("at"))


HISTORY = "(SELECT o_custkey AS item_id, o_orderdate AS t, o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'FAILED' ELSE 'SUCCESS ' END AS status FROM orders)"
CHECKPOINTS = "(SELECT user_id AS item_id, ts - INTERVAL 8400 DAY AS t, event_id AS seq, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'empty' WHEN 'click' THEN ' success ' ELSE 'SUCCESS' END AS status FROM events)"
LAST_CHECK = f"(SELECT item_id, arg_max(t, seq) AS t, arg_max(status, seq) AS status FROM {CHECKPOINTS} GROUP BY 1)"
SEEN = f"""(SELECT item_id, max(t) AS "at" FROM (SELECT item_id, t FROM {HISTORY} WHERE upper(status) = 'SUCCESS' UNION ALL SELECT l_suppkey, l_shipdate FROM lineitem WHERE l_linenumber <> 3 UNION ALL SELECT item_id, t FROM {LAST_CHECK} WHERE upper(status) IN ('SUCCESS', 'EMPTY')) GROUP BY 1)"""
SUCCESSFUL = f"(SELECT item_id FROM (SELECT item_id, arg_max(status, seq) AS status FROM {HISTORY} GROUP BY 1 UNION ALL SELECT item_id, status FROM {LAST_CHECK} WHERE item_id NOT IN (SELECT item_id FROM {HISTORY})) WHERE upper(trim(status)) = 'SUCCESS')"


def seen(spark, d) -> DataFrame:
    return ingest.latest_seen("item_id", history(spark, d), landed_data(spark, d), checkpoints(spark, d))


@query(f'SELECT item_id, "at" FROM {SEEN}')
def ing8_recency(spark, d):
    return seen(spark, d)


@query(f"SELECT item_id FROM {SUCCESSFUL}")
def ing8_successful_items(spark, d):
    return ingest.successful_items("item_id", history(spark, d), checkpoints(spark, d))


NOW, DAYS = "2001-08-10 00:00:00", {"ratings": 100, "reviews": 400, "videos": 1500, "comments": 900}


def planned(spark, d, **options) -> plan.Plan:
    request = plan.Request(F.lit(NOW).cast("timestamp_ntz"), DAYS, **options)
    places = base(spark, d, "customer").select(C("c_custkey").alias("item_id"))
    videos = base(spark, d, "lineitem").select(C("l_partkey").alias("item_id"), C("l_suppkey").alias("place_id")).where("place_id <= 40")
    terms = base(spark, d, "customer").select(C("c_custkey").alias("item_id"), F.when(C("c_mktsegment") == "BUILDING", "Museum|x").when(C("c_mktsegment") == "MACHINERY", "old beach").alias("terms"))
    at = seen(spark, d)
    return plan.work_plan(request, places, dict.fromkeys(DAYS, at), videos, ingest.successful_items("item_id", history(spark, d), checkpoints(spark, d)), terms)


def fresh_sql(days: int) -> str:
    return f"""("at" IS NOT NULL AND "at" > TIMESTAMP '{NOW}' - INTERVAL {days} DAY AND "at" <= TIMESTAMP '{NOW}')"""


ITEMS = " UNION ALL ".join(
    f"""SELECT '{name}' AS dataset, c_custkey AS item_id, "at" AS last_at, false AS successful, NOT {fresh_sql(days)} AS would_run, CAST({"CASE WHEN NOT " + fresh_sql(days) + " THEN CASE c_mktsegment WHEN 'BUILDING' THEN 100 WHEN 'MACHINERY' THEN 30 ELSE 15 END END" if name == "reviews" else "NULL"} AS INT) AS max_reviews FROM customer LEFT JOIN {SEEN} ON c_custkey = item_id"""
    for name, days in DAYS.items() if name != "comments"
) + f""" UNION ALL SELECT 'comments', k, "at", k IN {SUCCESSFUL}, NOT (k IN {SUCCESSFUL}) AND NOT {fresh_sql(DAYS["comments"])}, CAST(NULL AS INT) FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_suppkey <= 40 AND l_suppkey IN (SELECT c_custkey FROM customer)) LEFT JOIN {SEEN} ON k = item_id"""


@query(ITEMS)
def ing9_work_plan(spark, d):
    return planned(spark, d).items


def plan_sql(dry: bool, datasets: tuple[str, ...]) -> str:
    """The summary of the plan, for a run or a dry run."""
    names = ", ".join(f"('{k}', '{plan.OPERATIONS[k]}', {DAYS[k]})" for k in datasets)
    return f"""SELECT '{"dry" if dry else "run"}' AS kind, dataset, operation, items, due_items, new_videos AS include_new_videos, due_items > 0 OR new_videos AS would_run, (due_items > 0 OR new_videos) AND {not dry} AS should_run,
        CASE WHEN (due_items > 0 OR new_videos) AND {dry} THEN 'dry_run' WHEN due_items > 0 THEN 'stale_or_missing_items' WHEN dataset = 'comments' AND items = 0 THEN 'no_videos_in_scope' WHEN dataset = 'comments' AND done = items THEN 'all_items_successful' ELSE 'all_items_fresh' END AS reason, CAST(days AS INT) AS freshness_days
        FROM (SELECT a.*, coalesce(n, 0) AS items, coalesce(m, 0) AS due_items, coalesce(o, 0) AS done, dataset = 'comments' AND {not dry} AND {'videos' in datasets} AND (SELECT bool_or(would_run) FROM ({ITEMS}) WHERE dataset = 'videos') AS new_videos
        FROM (VALUES {names}) a(dataset, operation, days) LEFT JOIN (SELECT dataset, count(*) AS n, count(*) FILTER (would_run) AS m, count(*) FILTER (successful) AS o FROM ({ITEMS}) GROUP BY 1) USING (dataset))"""


@query(f"{plan_sql(True, tuple(DAYS))} UNION ALL {plan_sql(False, tuple(DAYS))} UNION ALL {plan_sql(False, ('ratings', 'comments'))}")
def ing9_plan_summary(spark, d):
    out = None
    for kind, options in (("dry", {"dry_run": True}), ("run", {}), ("run", {"datasets": ("ratings", "comments")})):
        part = planned(spark, d, **options).summary.select(F.lit(kind).alias("kind"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN 100 WHEN 1 THEN 100 WHEN 2 THEN 30 ELSE 15 END AS BIGINT) AS lim FROM part")
def ing10_tiered_limit(spark, d):
    terms = F.when(C("p_partkey") % 4 == 0, "Historical|x").when(C("p_partkey") % 4 == 1, "general_attraction|beach").when(C("p_partkey") % 4 == 2, "sandy beach").otherwise(C("p_brand"))
    return base(spark, d, "part").select("p_partkey", ingest.review_limit(terms).cast("bigint").alias("lim"))


def row_number_of(k: int, table: str, *columns: str) -> str:
    return f"SELECT CAST('0x' || substr(md5(concat_ws('|', '{k}', {', '.join(f'coalesce(CAST({c} AS VARCHAR), chr(126))' for c in columns)})), 1, 13) AS BIGINT) AS h FROM {table}"


@query(f"SELECT sha256(concat(coalesce(sum(h), 0), '/', count(*))) AS version FROM ({row_number_of(0, 'customer', 'c_custkey', 'c_name', 'c_mktsegment')} UNION ALL {row_number_of(1, 'nation', 'n_nationkey', 'n_name')} UNION ALL {row_number_of(2, 'lineitem', 'l_orderkey', 'l_linenumber', 'l_returnflag')})")
def ing11_reference_version(spark, d):
    tables = {"customer": ("c_custkey", "c_name", "c_mktsegment"), "nation": ("n_nationkey", "n_name"), "lineitem": ("l_orderkey", "l_linenumber", "l_returnflag")}
    return ingest.reference_version(*[base(spark, d, t).select(*columns) for t, columns in tables.items()])


@query("SELECT l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 7 = 0) GROUP BY 1")
def ing12_new_keys(spark, d):
    li = base(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_returnflag", "l_suppkey")
    return shaping.new_keys(li, li.where("l_returnflag = 'R' AND l_suppkey % 7 = 0"), ["l_partkey"], [C("l_orderkey")]).select("l_partkey", "l_orderkey")


@query("""SELECT s_suppkey, 6 + 3 + 1 + 4 AS n, concat('"', s_name, '" "P', s_nationkey, '" du lịch') AS first_query, concat('"', s_name, ' alias" "Vietnam"') AS last_query FROM supplier""")
def ing13_search_queries(spark, d):
    s = base(spark, d, "supplier")
    q = match.queries(C("s_name"), F.concat(F.lit("P"), "s_nationkey"), F.array(F.concat("s_name", F.lit(" alias"))), F.array(F.lit("Vietnam")), F.array(F.lit("museum")))
    return s.select("s_suppkey", q.alias("q")).select("s_suppkey", F.size("q").alias("n"), F.get("q", F.lit(0)).alias("first_query"), F.element_at("q", -1).alias("last_query"))


@query(None)
def ing14_resolution_score(spark, d):
    c = base(spark, d, "conversations").select("conv_id", "turn", C("text").alias("title"), F.lit("travel").alias("description"), F.when(C("turn") % 3 == 0, "Music").otherwise("Travel").alias("category"), (C("conv_id") % 25).alias("k"))
    p = base(spark, d, "nation").select(C("n_nationkey").alias("k"), F.when(C("n_nationkey") % 2 == 0, "the").otherwise("que la").alias("place_name"), C("n_name").alias("province_name"), F.lit("ha|in").alias("aliases"), F.lit("travel").alias("query_context"), F.lit("the|de").alias("context_keywords"), F.lit("museum|travel").alias("category_terms"), F.lit("idiot").alias("negative_keywords"))
    return match.resolve(c.join(p, "k")).select("conv_id", "turn", "resolution_score", "resolution_status", "resolution_reason")


def stored_pages(spark, d) -> DataFrame:
    """The pages with cards behind them, which the page's number decides: nested, repeated, without an id, with the owner's answer."""
    n = C("page_id").cast("string")
    k = C("page_id") % 5
    part = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    stars = F.when(k == 0, part('<i role="img" aria-label="', (C("page_id") % 3).cast("string"), ' of 5"></i><span class="kvMYJc x" aria-label="', (1 + k).cast("string"), ',0 stars"></span>'))
    stars = stars.when(k == 1, part("<div><b role=img aria-label='Rated ", (1 + C("page_id") % 4).cast("string"), "'></b></div>")).when(k == 2, F.lit('<span class="kvMYJc"></span><i role="img" aria-label="3"></i>')).otherwise(F.lit(""))
    answer = F.when(C("page_id") % 2 == 0, part('<div class="CDe7pd"><div><span class="wiI7pd">thanks ', n, "</span></div></div>")).otherwise(F.lit(""))
    body = part('<div><span class="MyEned"><span class="a wiI7pd">good<br>place <div>no. ', n, "</div></span></span>")
    likes = F.when(C("page_id") % 3 != 0, part('<span class="pkWtMe">1.', F.lpad((C("page_id") % 1000).cast("string"), 3, "0"), " likes</span>")).otherwise(F.lit(""))
    inner = part('<div data-review-id="in', n, '"><span class="rsqaWe">a week ago</span><span class="wiI7pd"> inner </span></div>')
    card = part('<div class="jftiEf"><div data-review-id="out', n, '">', stars, answer, body, '<p>more</p><span class="rsqaWe">\n 2  days ago</span>', likes, inner, "</div></div></div>")
    again = part('<div data-review-id="out', n, '"><span class="wiI7pd">again</span></div><div data-review-id=""><span class="wiI7pd">none</span></div><div data-review-id="&nbsp; "><span class="wiI7pd">blank ', n, "</span></div>")
    return base(spark, d, "pages").select(C("page_id").alias("place_id"), F.concat("html", card, again).alias("html"))


@query("""SELECT page_id AS place_id, concat('out', page_id) AS review_id, CAST(CASE page_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 + page_id % 4 END AS BIGINT) AS rating, concat('good place no. ', page_id) AS review_text, '2 days ago' AS review_date, CAST(CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1000 + page_id % 1000 END AS BIGINT) AS likes_count FROM pages
    UNION ALL SELECT page_id, concat('in', page_id), NULL, 'inner', 'a week ago', 0 FROM pages
    UNION ALL SELECT page_id, sha1(concat(page_id, '|blank ', page_id)), NULL, concat('blank ', page_id), NULL, 0 FROM pages""")
def ing15_cards(spark, d):
    return cards.cards(stored_pages(spark, d))


@query(f"SELECT item, arg_max(status, (\"at\", seq)) AS status FROM {LOG} GROUP BY 1")
def ing16_upsert_status(spark, d):
    rows = log(spark, d)
    stored = rows.where("seq % 2 = 0").groupBy("item").agg(F.max_by(F.struct("at", "seq", "status"), F.struct("at", "seq")).alias("s")).select("item", "s.*")
    return ingest.latest_status(stored.unionByName(rows.where("seq % 2 = 1")), "item").select("item", "status")


# ---- streams, run to their end over the stored tables ----


@query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN 'success' ELSE 'quarantine' END AS record_status FROM events")
def ss1_ss5_streaming_ingest(spark, d):
    return streams.ingest_to_end(spark, d)


@query("SELECT count(DISTINCT (user_id, event_type)) AS n FROM events")
def ss2_streaming_dedup(spark, d):
    return streams.distinct_to_end(spark, d)


@query(f"SELECT item, arg_max(status, (\"at\", seq)) AS status FROM {LOG} GROUP BY 1")
def ss3_streaming_status(spark, d):
    return streams.status_to_end(spark, d)


@query("SELECT DISTINCT user_id, event_type FROM events")
def ss2_dedup_within_watermark(spark, d):
    return streams.recent_distinct_to_end(spark, d)


@query("SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY ALL")
def ss4_streaming_daily_counts(spark, d):
    return streams.daily_to_end(spark, d)


@query("SELECT o_orderstatus AS \"by\", CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders WHERE date_trunc('month', o_orderdate) + INTERVAL 1 MONTH <= (SELECT max(o_orderdate) FROM orders) - INTERVAL 1 DAY GROUP BY ALL")
def ss4_streaming_monthly_counts(spark, d):
    return streams.monthly_to_end(spark, d)

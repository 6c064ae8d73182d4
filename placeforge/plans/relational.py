"""Filters, joins, aggregates, windows, sorts and set operations as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cast, text, times
from ..operators import checks, scan, scope, shaping
from . import oracle
from .inputs import base, raw, raw_sql
from .models import Lakehouse
from .staging import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
C = F.col


def query(sql: str | None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def n() -> Column:
    return F.count(F.lit(1))


# ---- projections and filters ----


@query(f"SELECT place_id, bronze_run_id, bronze_ingested_at_utc, bronze_record_status, bronze_crawl_date, bronze_file_path FROM ({oracle.staged('ratings')})")
def prj2_lineage(spark, d):
    return stage("ratings", raw(spark, d, "ratings")).select("place_id", "bronze_run_id", "bronze_ingested_at_utc", "bronze_record_status", "bronze_crawl_date", "bronze_file_path")


@query(f"SELECT place_id, crawled_at_utc FROM ({oracle.staged('ratings')}) WHERE place_id IS NOT NULL AND crawled_at_utc IS NOT NULL AND coalesce(bronze_record_status, 'success') = 'success'")
def flt1_live_rows(spark, d):
    return shaping.live(stage("ratings", raw(spark, d, "ratings")), "place_id", "crawled_at_utc").select("place_id", "crawled_at_utc")


@query(f"SELECT review_id, place_id FROM ({raw_sql('reviews')}) WHERE upper(place_id) <> 'TEST'")
def flt2_no_test_rows(spark, d):
    return raw(spark, d, "reviews").where(F.upper("place_id") != "TEST").select("review_id", "place_id")


@query(f"SELECT video_id, author FROM ({raw_sql('comments')}) WHERE comment_id IS NOT NULL OR nullif(author, 'system') IS NOT NULL")
def flt3_either_present(spark, d):
    return raw(spark, d, "comments").where(C("comment_id").isNotNull() | F.nullif(C("author"), F.lit("system")).isNotNull()).select("video_id", "author")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click')")
def flt4_in_list(spark, d):
    return base(spark, d, "events").where(C("event_type").isin("view", "click")).select("event_id", "event_type")


@query(oracle.sql_of("sil_provinces", "province_id, min_lon, max_lon, min_lat, max_lat, center_lat, center_lon"))
def flt6_box_check(spark, d):
    return Lakehouse(spark, d).provinces.select("province_id", "min_lon", "max_lon", "min_lat", "max_lat", "center_lat", "center_lon")


@query(oracle.sql_of("sil_videos", "place_id, video_id, published_at_utc"))
def flt7_not_in_future(spark, d):
    return Lakehouse(spark, d).videos.select("place_id", "video_id", "published_at_utc")


def tagged_places(house: Lakehouse) -> DataFrame:
    return house.places.withColumnsRenamed({f"osm_{t}_tag": t for t in scope.CORE})


CORE_SQL = " OR ".join(f"osm_{t}_tag IN ({', '.join(repr(v) for v in values)})" for t, values in scope.CORE.items())
SCOPE_SQL = f"SELECT place_id, place_name, province_id FROM sil_places WHERE validation_status = 'valid' AND crawl_eligible AND ({CORE_SQL})"


@query(oracle.with_steps("sil_places", "sil_place_categories") + f" {SCOPE_SQL} AND (lower(province_name) IN ('nation_3', 'nation_7', 'nation_11', 'nation_19') OR province_id IN ('04', '12')) AND place_id IN (SELECT place_id FROM sil_place_categories WHERE category_name IN ('brand#12', 'brand 12'))")
def flt8_scope(spark, d):
    house = Lakehouse(spark, d, store=True)
    terms = house.place_categories.select("place_id", C("category_name").alias("term"))
    found = scope.in_scope(tagged_places(house), ["Nation 3", "NÀTION-7", "nation_11", " Nation 19 ", "04", "12"], category="Bránd 12", categories=terms)
    return found.select("place_id", "place_name", "province_id")


@query(oracle.with_steps("sil_places") + f" {SCOPE_SQL} AND osm_natural_tag = 'beach' UNION ALL SELECT place_id, place_name, province_id FROM sil_places WHERE validation_status = 'valid' AND crawl_eligible AND place_id IN ('OSM_node_1', 'OSM_node_4')")
def flt8_scope_by_tag_and_id(spark, d):
    places = tagged_places(Lakehouse(spark, d, store=True))
    found = scope.in_scope(places, category="BEACH").unionByName(scope.in_scope(places, place_ids=scope.words_given({"place_ids": [" OSM_node_1", "OSM_node_4", "OSM_node_1"]}, "place_id", "place_ids")))
    return found.select("place_id", "place_name", "province_id")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey < 5")
def flt9_required_ids(spark, d):
    wanted = base(spark, d, "supplier").where("s_nationkey < 5").select("s_suppkey", C("s_nationkey").alias("n_nationkey"))
    shaping.require_ids(wanted.select("n_nationkey"), base(spark, d, "nation"), "n_nationkey")
    return wanted.select("s_suppkey")


@query("SELECT o_orderkey, c_custkey IS NOT NULL AS in_dim FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey")
def flt10_indicator(spark, d):
    dim = base(spark, d, "customer").where("c_acctbal > 0")
    return base(spark, d, "orders").join(dim, C("o_custkey") == C("c_custkey"), "left").select("o_orderkey", C("c_custkey").isNotNull().alias("in_dim"))


# ---- joins ----


@query(oracle.sql_of("sil_ratings", "rating_snapshot_id, place_id, place_name, province_id, province_name, is_place_in_dim"))
def jn1_conforming_left_join(spark, d):
    return Lakehouse(spark, d).ratings.select("rating_snapshot_id", "place_id", "place_name", "province_id", "province_name", "is_place_in_dim")


@query(oracle.sql_of("sil_reviews", "review_id, place_name, province_id, province_name"))
def jn2_fallback_key_join(spark, d):
    return Lakehouse(spark, d).reviews.select("review_id", "place_name", "province_id", "province_name")


@query("SELECT o_custkey, o_orderkey, n_orders FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) JOIN (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1) ON o_custkey = k WHERE rn = 1")
def jn3_row_with_group_stats(spark, d):
    o = base(spark, d, "orders")
    top = shaping.first_by(o, ["o_custkey"], [C("o_orderdate").desc(), C("o_orderkey")])
    return top.join(o.groupBy("o_custkey").agg(n().alias("n_orders")), "o_custkey").select("o_custkey", "o_orderkey", "n_orders")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest, arg_min(o_orderkey, (o_orderpriority, o_orderdate, o_orderkey)) AS best, count(*) AS n FROM orders GROUP BY 1")
def jn4_picks_in_one_pass(spark, d):
    return base(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("newest"), F.min_by("o_orderkey", F.struct("o_orderpriority", "o_orderdate", "o_orderkey")).alias("best"), n().alias("n"))


@query("SELECT o_orderkey, o_orderdate = (SELECT max(o_orderdate) FROM orders) AS is_last FROM orders")
def jn5_scalar_cross_join(spark, d):
    o = base(spark, d, "orders")
    last = o.agg(F.max("o_orderdate").alias("last"))
    return o.crossJoin(F.broadcast(last)).select("o_orderkey", (C("o_orderdate") == C("last")).alias("is_last"))


@query("SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(n_events, 0) AS n_events, s_name FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON c_custkey = o_custkey LEFT JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1) ON c_custkey = user_id LEFT JOIN supplier ON c_custkey = s_suppkey")
def jn6_star_on_a_spine(spark, d):
    o = base(spark, d, "orders").groupBy(C("o_custkey").alias("c_custkey")).agg(n().alias("n_orders"))
    e = base(spark, d, "events").groupBy(C("user_id").alias("c_custkey")).agg(n().alias("n_events"))
    s = base(spark, d, "supplier").select(C("s_suppkey").alias("c_custkey"), "s_name")
    out = reduce(lambda a, b: a.join(b, "c_custkey", "left"), (o, e, s), base(spark, d, "customer").select("c_custkey"))
    return out.na.fill(0, ["n_orders", "n_events"])


@query("SELECT l.l_orderkey, l.l_partkey, qty, o_custkey FROM (SELECT l_orderkey, l_partkey, l_suppkey, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL) AS l LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey, l_orderkey % 7 AS o_custkey FROM lineitem WHERE l_returnflag = 'R') AS r ON l.l_orderkey = r.l_orderkey AND l.l_suppkey = r.l_suppkey")
def jn7_composite_key_join(spark, d):
    li = base(spark, d, "lineitem")
    a = li.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    b = li.where("l_returnflag = 'R'").select("l_orderkey", "l_suppkey", (C("l_orderkey") % 7).alias("o_custkey")).distinct()
    return a.join(b, ["l_orderkey", "l_suppkey"], "left").select("l_orderkey", "l_partkey", "qty", "o_custkey")


@query("""WITH l AS (SELECT DISTINCT o_custkey AS k, CAST(o_orderdate AS DATE) AS a FROM orders), r AS (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS b, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL)
    SELECT l.k, a, arg_min(r.b, (CASE WHEN r.b <= a THEN 0 ELSE 100000 END) + abs(date_diff('day', r.b, a))) AS b, arg_min(q, (CASE WHEN r.b <= a THEN 0 ELSE 100000 END) + abs(date_diff('day', r.b, a))) AS q FROM l LEFT JOIN r ON l.k = r.k GROUP BY ALL""")
def jn8_asof_nearest(spark, d):
    left = base(spark, d, "orders").select(C("o_custkey").alias("k"), C("o_orderdate").cast("date").alias("a")).distinct()
    right = base(spark, d, "lineitem").groupBy(C("l_suppkey").alias("k"), C("l_shipdate").cast("date").alias("b")).agg(F.sum("l_quantity").cast("bigint").alias("q"))
    return shaping.nearest_asof(left, right, "k", "a", "b", ["q"])


@query("SELECT p_brand, o_custkey, qty FROM (SELECT p_brand, o_custkey, qty, row_number() OVER (PARTITION BY p_brand ORDER BY qty DESC, o_custkey) AS rn FROM (SELECT p_brand, o_custkey, sum(l_quantity) AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)) WHERE rn = 1")
def jn9_top_of_bridge(spark, d):
    rows = base(spark, d, "lineitem").join(base(spark, d, "orders"), C("l_orderkey") == C("o_orderkey")).join(base(spark, d, "part"), C("l_partkey") == C("p_partkey"))
    return shaping.first_by(rows.groupBy("p_brand", "o_custkey").agg(F.sum("l_quantity").alias("qty")), ["p_brand"], [C("qty").desc(), C("o_custkey")])


@query("SELECT p_brand, count(DISTINCT l_suppkey) AS suppliers, count(*) AS n, count(*) FILTER (s_acctbal > 0) AS rich FROM part LEFT JOIN lineitem ON p_partkey = l_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey < 12) ON l_suppkey = s_suppkey GROUP BY 1")
def jn10_left_join_then_aggregate(spark, d):
    s = base(spark, d, "supplier").where("s_nationkey < 12")
    rows = base(spark, d, "part").join(base(spark, d, "lineitem"), C("p_partkey") == C("l_partkey"), "left").join(s, C("l_suppkey") == C("s_suppkey"), "left")
    return rows.groupBy("p_brand").agg(F.countDistinct("l_suppkey").alias("suppliers"), n().alias("n"), F.count_if(C("s_acctbal") > 0).alias("rich"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def jn11_anti_join(spark, d):
    return base(spark, d, "customer").join(base(spark, d, "events"), C("c_custkey") == C("user_id"), "left_anti").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase') AND o_orderkey NOT IN (SELECT event_id FROM events WHERE event_type = 'error')")
def jn12_key_set_filters(spark, d):
    e = base(spark, d, "events")
    out = base(spark, d, "orders").join(e.where("event_type = 'purchase'"), C("o_custkey") == C("user_id"), "left_semi")
    return out.join(e.where("event_type = 'error'"), C("o_orderkey") == C("event_id"), "left_anti").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, s_suppkey, coalesce(nullif(l_returnflag, 'N'), s_name) AS flag FROM lineitem LEFT JOIN supplier ON l_partkey % 200 = s_suppkey")
def jn13_fill_from_mapping(spark, d):
    return base(spark, d, "lineitem").join(base(spark, d, "supplier"), C("l_partkey") % 200 == C("s_suppkey"), "left").select("l_orderkey", "l_linenumber", "s_suppkey", F.coalesce(F.nullif(C("l_returnflag"), F.lit("N")), C("s_name")).alias("flag"))


@query("SELECT o_custkey, array_to_string(list_sort(list(DISTINCT p_brand)), '|') AS brands FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1")
def jn16_term_lists(spark, d):
    rows = base(spark, d, "lineitem").join(base(spark, d, "orders"), C("l_orderkey") == C("o_orderkey")).join(base(spark, d, "part"), C("l_partkey") == C("p_partkey"), "left")
    return rows.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), "|").alias("brands"))


@query("SELECT (SELECT count(*) FROM orders) AS row_count, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS compare_count")
def jn17_reconciliation(spark, d):
    return checks.row_counts(base(spark, d, "orders"), base(spark, d, "lineitem"), ["l_orderkey"])


# ---- aggregates ----


@query("SELECT o_custkey, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1")
def agg1_lifecycle(spark, d):
    out = shaping.lifecycle(base(spark, d, "orders"), "o_custkey", "o_orderdate")
    return out.toDF("o_custkey", "first_day", "last_day", "days")


@query("SELECT max(l_shipdate) AS last_day FROM lineitem")
def agg2_scalar_max(spark, d):
    return base(spark, d, "lineitem").agg(F.max("l_shipdate").alias("last_day"))


@query("SELECT max(d) AS as_of FROM (SELECT max(CAST(l_shipdate AS DATE)) AS d FROM lineitem UNION ALL SELECT max(CAST(o_orderdate AS DATE)) FROM orders UNION ALL SELECT max(CAST(ts AS DATE)) FROM events)")
def agg3_max_of_maxima(spark, d):
    parts = [base(spark, d, t).agg(F.max(C(c).cast("date")).alias("d")) for t, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts"))]
    return reduce(DataFrame.unionByName, parts).agg(F.max("d").alias("as_of"))


@query("SELECT user_id, event_type, count(*) AS observation_count, min(ts) AS first_crawled_at_utc FROM events GROUP BY ALL")
def agg4_observations(spark, d):
    return shaping.observations(base(spark, d, "events").withColumnRenamed("ts", "crawled_at_utc"), ["user_id", "event_type"])


@query("SELECT l_returnflag, count(DISTINCT l_partkey) FILTER (l_discount > 0.05) AS parts FROM lineitem GROUP BY 1")
def agg5_distinct_filter(spark, d):
    return base(spark, d, "lineitem").groupBy("l_returnflag").agg(F.countDistinct(F.when(C("l_discount") > 0.05, C("l_partkey"))).alias("parts"))


@query("SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_totalprice > 100000) AS large FROM orders GROUP BY 1")
def agg6_count_filter(spark, d):
    return base(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(C("o_orderstatus") == "F").alias("done"), F.count_if(C("o_totalprice") > 100000).alias("large"))


@query("SELECT l_suppkey, CAST(sum(l_quantity) FILTER (l_returnflag = 'R') AS BIGINT) AS back, round(avg(l_quantity) FILTER (l_linenumber > 2), 4) AS mean FROM lineitem GROUP BY 1")
def agg7_sum_avg_filter(spark, d):
    return base(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum(F.when(C("l_returnflag") == "R", C("l_quantity"))).cast("bigint").alias("back"), cast.rounded(F.avg(F.when(C("l_linenumber") > 2, C("l_quantity"))), 4).alias("mean"))


@query("SELECT c_nationkey, count(*) AS n, count(nullif(c_mktsegment, 'BUILDING')) AS others FROM customer GROUP BY 1")
def agg8_count_column(spark, d):
    return base(spark, d, "customer").groupBy("c_nationkey").agg(n().alias("n"), F.count(F.nullif(C("c_mktsegment"), F.lit("BUILDING"))).alias("others"))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_shipdate) AS days FROM lineitem GROUP BY 1")
def agg9_two_distincts(spark, d):
    return base(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_shipdate").alias("days"))


@query("SELECT o_orderpriority, round(avg(o_orderkey % 100), 2) AS mean, CAST(coalesce(sum(nullif(o_orderkey % 3, 0)), 0) AS BIGINT) AS total, max(o_orderstatus) AS any_status FROM orders GROUP BY 1")
def agg10_agg11_rounded_and_any(spark, d):
    return base(spark, d, "orders").groupBy("o_orderpriority").agg(cast.rounded(F.avg(C("o_orderkey") % 100), 2).alias("mean"), F.coalesce(F.sum(F.nullif(C("o_orderkey") % 3, F.lit(0))), F.lit(0)).alias("total"), F.max("o_orderstatus").alias("any_status"))


@query("SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY ALL")
def agg12_monthly_rollup(spark, d):
    return base(spark, d, "orders").groupBy("o_custkey", times.month_of(C("o_orderdate")).alias("month")).agg(n().alias("n"))


@query("SELECT c_nationkey, round(sum(r * w) / sum(CASE WHEN r IS NOT NULL THEN w END), 2) AS mean FROM (SELECT c_nationkey, nullif(c_custkey % 6, 0) AS r, greatest(coalesce(nullif(c_custkey % 40, 7), 1), 1) AS w FROM customer) GROUP BY 1")
def agg13_weighted_average(spark, d):
    r, w = F.nullif(C("c_custkey") % 6, F.lit(0)), F.greatest(F.coalesce(F.nullif(C("c_custkey") % 40, F.lit(7)), F.lit(1)), F.lit(1))
    return base(spark, d, "customer").groupBy("c_nationkey").agg(shaping.weighted_average(r, w).alias("mean"))


@query("SELECT user_id, round((count(*) FILTER (event_type = 'purchase') - count(*) FILTER (event_type = 'error')) * 100.0 / nullif(count(*), 0), 2) AS net FROM events GROUP BY 1")
def agg14_net_sentiment(spark, d):
    return base(spark, d, "events").groupBy("user_id").agg(cast.ratio_pct(F.count_if(C("event_type") == "purchase") - F.count_if(C("event_type") == "error"), n()).alias("net"))


@query("SELECT o_custkey, count(*) FILTER (o_orderdate > a - INTERVAL 90 DAY) AS recent, count(*) FILTER (o_orderdate > a - INTERVAL 180 DAY AND o_orderdate <= a - INTERVAL 90 DAY) AS before_ FROM orders, (SELECT max(o_orderdate) AS a FROM orders) GROUP BY 1")
def agg15_relative_windows(spark, d):
    o = base(spark, d, "orders")
    day, a = C("o_orderdate").cast("date"), C("a").cast("date")
    rows = o.crossJoin(F.broadcast(o.agg(F.max("o_orderdate").alias("a"))))
    return rows.groupBy("o_custkey").agg(F.count_if(day > F.date_sub(a, 90)).alias("recent"), F.count_if((day > F.date_sub(a, 180)) & (day <= F.date_sub(a, 90))).alias("before_"))


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def agg16_distinct(spark, d):
    return base(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("SELECT l_orderkey, l_suppkey, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def agg17_repeated_keys(spark, d):
    return checks.unique_combination(base(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("SELECT nullif(c_mktsegment, 'BUILDING') AS segment, c_custkey % 3 AS status, count(*) AS n FROM customer GROUP BY ALL")
def agg18_null_keeping_counts(spark, d):
    return base(spark, d, "customer").groupBy(F.nullif(C("c_mktsegment"), F.lit("BUILDING")).alias("segment"), (C("c_custkey") % 3).alias("status")).agg(n().alias("n"))


@query("SELECT count(*) AS total, count(DISTINCT video_id) AS videos, count(DISTINCT place_id) AS places, count(*) FILTER (bronze_record_status IS DISTINCT FROM 'quarantine') AS accepted, count(*) FILTER (bronze_record_status = 'quarantine') AS quarantined FROM (" + oracle.staged("comments") + ")")
def agg22_audit(spark, d):
    from ..operators import ingest

    return ingest.audit(stage("comments", raw(spark, d, "comments")))


@query("SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lines, (SELECT count(*) FROM events) AS events")
def agg23_side_by_side(spark, d):
    rows = [base(spark, d, t).agg(n().alias(a)) for t, a in (("orders", "orders"), ("lineitem", "lines"), ("events", "events"))]
    return reduce(DataFrame.crossJoin, rows)


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '|') AS kinds FROM events GROUP BY 1")
def agg24_joined_strings(spark, d):
    return base(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.array_distinct(F.collect_list("event_type"))), "|").alias("kinds"))


# ---- windows ----

LATEST_ORDER = "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1"


@query(LATEST_ORDER)
def win1_dedup_by_key(spark, d):
    return shaping.first_by(base(spark, d, "orders"), ["o_custkey"], [C("o_orderdate").desc(), C("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT o_custkey, o_orderkey AS best FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def win2_best_observation(spark, d):
    rank = F.when(C("o_orderstatus") == "F", 1).when(C("o_orderstatus") == "O", 2).otherwise(3)
    return base(spark, d, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct(rank.alias("r"), "o_orderdate", "o_orderkey")).alias("best"))


@query("SELECT k, name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, name) AS rn FROM (SELECT c_custkey AS k, c_name AS name, 2 AS p FROM customer UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier)) WHERE rn = 1")
def win3_prioritised_sources(spark, d):
    both = base(spark, d, "customer").select(C("c_custkey").alias("k"), C("c_name").alias("name"), F.lit(2).alias("p")).unionByName(base(spark, d, "supplier").select(C("s_suppkey").alias("k"), C("s_name").alias("name"), F.lit(1).alias("p")))
    return shaping.first_by(both, ["k"], [C("p"), C("name")]).select("k", "name")


@query("""SELECT place, day, views, row_number() OVER w AS snapshot_seq_num, lag(day) OVER w AS prev_day, date_diff('day', lag(day) OVER w, day) AS days_since_prev_snapshot, lag(views) OVER w AS prev_views,
    CASE WHEN date_diff('day', lag(day) OVER w, day) > 0 THEN round((views - lag(views) OVER w) * 1.0 / date_diff('day', lag(day) OVER w, day), 2) END AS velocity
    FROM (SELECT l_suppkey AS place, CAST(l_shipdate AS DATE) AS day, CAST(sum(l_quantity) AS BIGINT) AS views FROM lineitem GROUP BY ALL) WINDOW w AS (PARTITION BY place ORDER BY day)""")
def win4_to_7_series(spark, d):
    daily = base(spark, d, "lineitem").groupBy(C("l_suppkey").alias("place"), C("l_shipdate").cast("date").alias("day")).agg(F.sum("l_quantity").cast("bigint").alias("views"))
    out = shaping.series(daily, ["place"], "day", ["views"])
    return out.withColumn("velocity", shaping.velocity(C("views") - C("prev_views"), C("days_since_prev_snapshot")))


HOT = "(SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k, l_orderkey AS id, l_linenumber AS line, CAST(l_shipdate AS DATE) AS day, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) END AS v FROM lineitem)"


def hot_rows(spark, d):
    """Every row of lineitem, a third of them under one key; every other value is null."""
    k, v = F.when(C("l_orderkey") % 3 == 0, F.lit(0)).otherwise(C("l_suppkey")).alias("k"), F.when(C("l_linenumber") % 2 == 0, C("l_quantity").cast("bigint")).alias("v")
    return base(spark, d, "lineitem").select(k, C("l_orderkey").alias("id"), C("l_linenumber").alias("line"), C("l_shipdate").cast("date").alias("day"), v)


@query(f"""SELECT k, id, line, row_number() OVER w AS number, lag(day) OVER w AS prev_day, lag(v) OVER w AS prev_v, coalesce(last_value(v IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS near FROM {HOT}
    WINDOW w AS (PARTITION BY k ORDER BY day, id, line)""")
def win5_hot_key_in_ranges(spark, d):
    order, most = [*[C(c).asc_nulls_last() for c in ("day", "id", "line")], C("v").asc()], 400  # v: rows that the SQL leaves tied get one order in all runs
    rows = scan.followed(hot_rows(spark, d), ["k"], order, "number", ["day", "v"], most)
    return scan.filled(rows, ["k"], order, "v", "near", most).select("k", "id", "line", "number", "prev_day", "prev_v", "near")


@query("""SELECT k, m, n, CAST(sum(n) OVER (PARTITION BY k ORDER BY m ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total, round(avg(n) OVER (PARTITION BY k ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS rolling, n - lag(n) OVER (PARTITION BY k ORDER BY m) AS change,
    round((n - lag(n) OVER (PARTITION BY k ORDER BY m)) * 100.0 / lag(n) OVER (PARTITION BY k ORDER BY m), 2) AS pct FROM (SELECT o_custkey % 50 AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY ALL)""")
def win8_to_10_running(spark, d):
    m = base(spark, d, "orders").groupBy((C("o_custkey") % 50).alias("k"), times.month_of(C("o_orderdate")).alias("m")).agg(n().alias("n"))
    w = Window.partitionBy("k").orderBy("m")
    change = C("n") - F.lag("n").over(w)
    return m.withColumns({"total": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)), "rolling": cast.rounded(F.avg("n").over(w.rowsBetween(-2, 0)), 2), "change": change, "pct": cast.ratio_pct(change, F.lag("n").over(w))})


@query("SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price FROM orders GROUP BY 1")
def win11_first_and_latest(spark, d):
    order = F.struct("o_orderdate", "o_orderkey")
    return base(spark, d, "orders").groupBy("o_custkey").agg(F.min_by("o_totalprice", order).alias("first_price"), F.max_by("o_totalprice", order).alias("last_price"))


@query(oracle.with_steps("sil_place_categories") + " SELECT place_id, primary_category_id, primary_category_group, primary_category_name FROM " + oracle.PRIMARY)
def win12_primary_category(spark, d):
    from .gold import primary_category

    return primary_category(Lakehouse(spark, d).place_categories)


@query("SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment DESC, c_acctbal DESC, c_custkey) AS rank FROM customer")
def win13_partitioned_rank(spark, d):
    w = Window.partitionBy("c_nationkey").orderBy(C("c_mktsegment").desc(), C("c_acctbal").desc(), C("c_custkey"))
    return base(spark, d, "customer").select("c_custkey", F.row_number().over(w).cast("bigint").alias("rank"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def win14_global_rank(spark, d):
    return shaping.global_rank(base(spark, d, "orders").select("o_orderkey", "o_totalprice"), [C("o_totalprice").desc(), C("o_orderkey")]).select("o_orderkey", "rank")


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey) > 1 AS again, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 AS shared FROM lineitem")
def win15_repeat_flags(spark, d):
    w = Window.partitionBy("l_orderkey", "l_suppkey")
    return base(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.row_number().over(w.orderBy("l_linenumber", "l_partkey")) > 1).alias("again"), (n().over(w) > 1).alias("shared"))


# ---- sorts and sets ----


@query("SELECT l_suppkey, l_partkey, qty FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY qty DESC, l_partkey) AS rn FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL)) WHERE rn = 1")
def ord1_top_of_group(spark, d):
    return shaping.first_by(base(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty")), ["l_suppkey"], [C("qty").desc(), C("l_partkey")])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def ord2_head_of_work_list(spark, d):
    return base(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(C("o_totalprice").desc(), "o_orderkey").limit(50)


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 1 + o_custkey % 3")
def ord3_cap_by_column(spark, d):
    rows = base(spark, d, "orders").withColumn("cap", 1 + C("o_custkey") % 3)
    return shaping.per_key_limit(rows, ["o_custkey"], [C("o_orderdate"), C("o_orderkey")], "cap").select("o_custkey", "o_orderkey")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_mktsegment")
def ord4_sorted_report(spark, d):
    return base(spark, d, "customer").groupBy("c_mktsegment").agg(n().alias("n")).orderBy(C("n").desc(), "c_mktsegment")


@query("SELECT user_id AS k, CAST(date_trunc('month', ts) AS DATE) AS m FROM events UNION SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders UNION SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem")
def set1_union_distinct(spark, d):
    parts = [base(spark, d, t).select(C(k).alias("k"), times.month_of(C(c)).alias("m")) for t, k, c in (("events", "user_id", "ts"), ("orders", "o_custkey", "o_orderdate"), ("lineitem", "l_suppkey", "l_shipdate"))]
    return reduce(DataFrame.unionByName, parts).distinct()


@query("SELECT c_custkey AS k, c_name AS name, 'customer' AS tag FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier")
def set2_tagged_union(spark, d):
    return base(spark, d, "customer").select(C("c_custkey").alias("k"), C("c_name").alias("name"), F.lit("customer").alias("tag")).unionByName(base(spark, d, "supplier").select(C("s_suppkey").alias("k"), C("s_name").alias("name"), F.lit("supplier").alias("tag")))


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM (SELECT o_custkey, o_orderkey FROM orders UNION ALL SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def set4_concat_without_repeats(spark, d):
    o = base(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return shaping.first_by(o.union(o.where("o_orderstatus = 'F'")), ["o_custkey"], [C("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT o_custkey FROM orders EXCEPT SELECT user_id FROM events")
def set5_difference(spark, d):
    return base(spark, d, "orders").select("o_custkey").distinct().join(base(spark, d, "events").select(C("user_id").alias("o_custkey")), "o_custkey", "left_anti")


# ---- segments and dates ----


@query(oracle.sql_of("sil_coverage", "place_id, coverage_status, is_forecast_eligible"))
def cnd1_coverage_status(spark, d):
    return Lakehouse(spark, d, store=True).coverage.select("place_id", "coverage_status", "is_forecast_eligible")


@query(oracle.sql_of("gold_profile", "place_id, rating_trend_direction, views_growth_direction, place_development_stage"))
def cnd2_to_cnd4_segments(spark, d):
    return Lakehouse(spark, d, store=True).profile.select("place_id", "rating_trend_direction", "views_growth_direction", "place_development_stage")


@query("SELECT CAST(range AS DATE) AS month FROM range(DATE '1995-01-01', (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) + 1, INTERVAL 1 MONTH) WHERE CAST(range AS DATE) NOT IN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders WHERE o_custkey % 200 = 1)")
def dt12_dq10_missing_months(spark, d):
    o = base(spark, d, "orders")
    spine = o.agg(F.max(C("o_orderdate").cast("date")).alias("last")).select(F.explode(F.sequence(F.lit("1995-01-01").cast("date"), C("last"), F.expr("interval 1 month"))).alias("month"))
    return checks.missing_months(o.where("o_custkey % 200 = 1").select(times.month_of(C("o_orderdate")).alias("m")), "m", spine)


@query(oracle.sql_of("sil_comments", "place_id, comment_key, comment_created_at_utc, comment_created_at_precision"))
def dt13_exact_else_relative(spark, d):
    return Lakehouse(spark, d).comments.select("place_id", "comment_key", "comment_created_at_utc", "comment_created_at_precision")


# ---- data quality ----


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.08 OR l_discount < 0.01")
def dq1_accepted_range(spark, d):
    return checks.accepted_range(base(spark, d, "lineitem"), "l_discount", 0.01, 0.08).select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def dq2_not_negative(spark, d):
    return checks.not_negative(base(spark, d, "customer"), "c_acctbal").select("c_custkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_extendedprice >= nullif(l_quantity, 1) * 1000)")
def dq3_expression_is_true(spark, d):
    return checks.expression_is_true(base(spark, d, "lineitem"), C("l_extendedprice") >= F.nullif(C("l_quantity"), F.lit(1.0)) * 1000).select("l_orderkey", "l_linenumber")


@query("SELECT o_custkey, o_orderdate, count(*) AS n_records FROM orders GROUP BY ALL HAVING count(*) > 1")
def dq4_unique_combination(spark, d):
    return checks.unique_combination(base(spark, d, "orders"), ["o_custkey", "o_orderdate"])


@query("SELECT * FROM (SELECT (SELECT count(*) FROM orders) AS row_count, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS compare_count) WHERE row_count <> compare_count")
def dq5_equal_row_count(spark, d):
    return checks.equal_row_count(base(spark, d, "orders"), base(spark, d, "lineitem"), ["l_orderkey"])


@query("SELECT row_count, compare_count, row_count / compare_count AS ratio FROM (SELECT (SELECT count(*) FROM lineitem) AS row_count, (SELECT count(*) FROM orders) AS compare_count) WHERE row_count / compare_count > 3")
def dq6_row_count_ratio(spark, d):
    return checks.row_count_ratio(base(spark, d, "lineitem"), base(spark, d, "orders"), 1.0, 3.0)


@query("""SELECT 'not_null' AS "check", 'error' AS severity, count(*) AS violations FROM orders WHERE o_custkey IS NULL UNION ALL SELECT 'values', 'warn', count(*) FROM (SELECT event_type FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1)
    UNION ALL SELECT 'relationships', 'error', count(*) FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events) UNION ALL SELECT 'unique', 'error', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def dq7_dq12_report(spark, d):
    o, e = base(spark, d, "orders"), base(spark, d, "events")
    return checks.report({
        "not_null": ("error", checks.not_null(o, "o_custkey")), "values": ("warn", checks.accepted_values(e, "event_type", ["view", "click"])),
        "relationships": ("error", checks.relationships(o, "o_custkey", e, "user_id")), "unique": ("error", checks.unique_combination(o, ["o_orderkey"])),
    })


COMPARED = ' SELECT "check", CAST(l AS BIGINT) AS left_value, CAST(r AS BIGINT) AS right_value, l IS DISTINCT FROM r AS differs FROM c'


def compared(pairs: dict[str, tuple[str, str]]) -> str:
    """The SQL of named pairs of scalar queries."""
    return ", c AS (" + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", ({a}) AS l, ({b}) AS r" for k, (a, b) in pairs.items()) + ")" + COMPARED


COVERED = {"reviews": ("review_count", "sil_reviews"), "video_snapshots": ("video_snapshot_count", "sil_video_snapshots"), "comments": ("comment_count", "sil_comments"), "rating_snapshots": ("rating_snapshot_count", "sil_ratings")}


@query(
    oracle.with_steps("sil_coverage")
    + compared({k: (f"SELECT coalesce(sum({c}), 0) FROM sil_coverage", f"SELECT count(*) FROM {t} WHERE is_place_in_dim") for k, (c, t) in COVERED.items()} | {"videos": ("SELECT coalesce(sum(video_count), 0) FROM sil_coverage", "SELECT count(DISTINCT (place_id, video_id)) FROM sil_videos WHERE is_place_in_dim")})
)
def dq8_coverage_reconciles(spark, d):
    h = Lakehouse(spark, d, store=True)
    total = lambda c: h.coverage.agg(F.coalesce(F.sum(c), F.lit(0)))
    # a row a place: its snapshots, and its videos, which are unique
    counted = shaping.conform(h.video_days.groupBy("place_id").agg(n().alias("days"), F.count("newest").alias("videos")), h.places).where("is_place_in_dim")
    known = lambda c: counted.agg(F.coalesce(F.sum(c), F.lit(0)))
    facts = {k: df.where("is_place_in_dim").agg(n()) for k, df in {"reviews": h.reviews, "comments": h.comments, "rating_snapshots": h.ratings}.items()}
    facts["video_snapshots"] = known("days")
    pairs = {k: (total(c), facts[k]) for k, (c, _) in COVERED.items()}
    return checks.reconcile(pairs | {"videos": (total("video_count"), known("videos"))}, every=True)


@query(
    oracle.with_steps("gold_profile", "gold_provinces", "gold_categories", "gold_videos", "sil_coverage", "sil_taxonomy")
    + compared({
        "place_360_row_count": ("SELECT count(*) FROM gold_profile", "SELECT count(*) FROM sil_places"),
        "province_summary_row_count": ("SELECT count(*) FROM gold_provinces", "SELECT count(*) FROM sil_provinces"),
        "category_summary_row_count": ("SELECT count(*) FROM gold_categories", "SELECT count(*) FROM sil_taxonomy"),
        "video_performance_row_count": ("SELECT count(*) FROM gold_videos", "SELECT count(*) FROM sil_videos"),
        "province_places_sum_matches_place_360": ("SELECT coalesce(sum(total_places_count), 0) FROM gold_provinces", "SELECT count(*) FROM gold_profile"),
        "place_360_reviews_matches_coverage": ("SELECT coalesce(sum(crawled_review_count), 0) FROM gold_profile", "SELECT coalesce(sum(review_count), 0) FROM sil_coverage"),
        "place_360_videos_matches_coverage": ("SELECT coalesce(sum(youtube_video_count), 0) FROM gold_profile", "SELECT coalesce(sum(video_count), 0) FROM sil_coverage"),
    })
)
def dq9_set3_gold_reconciles(spark, d):
    h = Lakehouse(spark, d, store=True)
    rows = lambda df: df.agg(n())
    total = lambda df, c: df.agg(F.coalesce(F.sum(c), F.lit(0)))
    return checks.reconcile({
        "place_360_row_count": (rows(h.profile), rows(h.places)), "province_summary_row_count": (rows(h.province_summary), rows(h.provinces)),
        "category_summary_row_count": (rows(h.category_summary), rows(h.taxonomy)), "video_performance_row_count": (rows(h.video_performance), total(h.video_reach, "video_count")),  # what the profile has counted of the same videos: their days are not written for it
        "province_places_sum_matches_place_360": (total(h.province_summary, "total_places_count"), rows(h.profile)),
        "place_360_reviews_matches_coverage": (total(h.profile, "crawled_review_count"), total(h.coverage, "review_count")),
        "place_360_videos_matches_coverage": (total(h.profile, "youtube_video_count"), total(h.coverage, "video_count")),
    }, every=True)


@query("SELECT before, after, after / nullif(before, 0) AS ratio FROM (SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS before, (SELECT count(DISTINCT user_id) FROM events) AS after) WHERE after / before < 0.95")
def dq11_key_coverage(spark, d):
    return checks.key_coverage(base(spark, d, "orders").select(C("o_custkey").alias("k")), base(spark, d, "events").select(C("user_id").alias("k")), ["k"], 0.95)

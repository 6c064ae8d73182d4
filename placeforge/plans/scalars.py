"""Scalar functions as queries: one projection each over a raw feed or a base table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cast, text, times
from ..operators import ingest
from . import oracle as o
from .inputs import RAW, base, raw, raw_sql

C = F.col


@dataclass(frozen=True)
class Scalar:
    """Columns by name over ``source``: as Spark columns (made when called) and as DuckDB SQL."""

    source: str
    spark: Callable[[], dict[str, Column]]
    sql: dict[str, str]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = raw(spark, sf_dir, self.source) if self.source in RAW else base(spark, sf_dir, self.source)
        return df.select(*[c.alias(n) for n, c in self.spark().items()])

    def text(self) -> str:
        source = f"({raw_sql(self.source)})" if self.source in RAW else self.source
        return f"SELECT {', '.join(f'{v} AS {k}' for k, v in self.sql.items())} FROM {source} AS t"


SAID, UNIT = o.said_of("review_date"), o.unit_of(o.said_of("review_date"))
CRAWL_DAY = "CAST(substr(crawled_at, 1, 10) AS DATE)"


def said() -> Column:
    return times.relative_text(C("review_date"))


def crawl_day() -> Column:
    return F.substring("crawled_at", 1, 10).cast("date")


SCALARS = {
    "str1_clean_null": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": text.clean_null(C("review_text"))}, {"review_id": "review_id", "v": o.null_of("review_text")}),
    "str2_clean_text": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": text.clean_text(C("review_text"))}, {"review_id": "review_id", "v": o.free_of("review_text")}),
    "str3_province_code": Scalar("places", lambda: {"place_id": C("place_id"), "v": cast.province_code(C("province_id"))}, {"place_id": "place_id", "v": o.province_of("province_id")}),
    "str4_basic_text": Scalar("customer", lambda: {"u": F.upper("c_name"), "l": F.lower("c_mktsegment"), "p": F.lpad(C("c_nationkey").cast("string"), 2, "0"), "n": F.nullif(C("c_mktsegment"), F.lit("BUILDING")), "c": F.coalesce(F.nullif(C("c_mktsegment"), F.lit("BUILDING")), C("c_name"))}, {"u": "upper(c_name)", "l": "lower(c_mktsegment)", "p": "lpad(CAST(c_nationkey AS VARCHAR), 2, '0')", "n": "nullif(c_mktsegment, 'BUILDING')", "c": "coalesce(nullif(c_mktsegment, 'BUILDING'), c_name)"}),
    "str5_row_id": Scalar("places", lambda: {"v": text.row_id(C("place_id"), C("tourism"), C("crawl_date"))}, {"v": "place_id || '|' || tourism || '|' || crawl_date"}),
    "str6_surrogate_key": Scalar("conversations", lambda: {"conv_id": C("conv_id"), "v": text.surrogate_key(C("conv_id").cast("string"), F.nullif(C("role"), F.lit("system")), C("text"))}, {"conv_id": "conv_id", "v": "'sk_' || md5(concat_ws('||', CAST(conv_id AS VARCHAR), nullif(role, 'system'), text))"}),
    "str7_regexp_replace": Scalar("documents", lambda: {"doc_id": C("doc_id"), "v": F.md5(F.regexp_replace("text", "(?i)(th)([a-z]+)", "$2$1"))}, {"doc_id": "doc_id", "v": r"md5(regexp_replace(text, '(th)([a-z]+)', '\2\1', 'gi'))"}),
    "str8_regexp_match": Scalar("events", lambda: {"event_id": C("event_id"), "part": C("props").rlike('"k": 1'), "whole": C("props").rlike(r'^(?:\{"k": [0-9]{2}\})\z')}, {"event_id": "event_id", "part": """regexp_matches(props, '"k": 1')""", "whole": r"""regexp_full_match(props, '\{"k": [0-9]{2}\}')"""}),
    "str9_regexp_extract": Scalar("events", lambda: {"event_id": C("event_id"), "v": F.regexp_extract("props", r'"k": ([0-9]+)', 1)}, {"event_id": "event_id", "v": """regexp_extract(props, '"k": ([0-9]+)', 1)"""}),
    "str10_split_lines": Scalar("documents", lambda: {"doc_id": C("doc_id"), "n": F.size(F.split("text", "\n", -1)).cast("bigint"), "first": F.split("text", "\n", -1)[0]}, {"doc_id": "doc_id", "n": "len(string_split(text, chr(10)))", "first": "string_split(text, chr(10))[1]"}),
    "str11_nfc": Scalar("documents", lambda: {"doc_id": C("doc_id"), "v": F.md5(text.nfc(F.replace(C("text"), F.lit("é"), F.lit("é"))))}, {"doc_id": "doc_id", "v": "md5(nfc_normalize(replace(text, 'é', 'e' || chr(769))))"}),
    "str12_accent_key": Scalar("documents", lambda: {"doc_id": C("doc_id"), "v": F.md5(text.accent_key(C("text")))}, {"doc_id": "doc_id", "v": "md5(trim(regexp_replace(replace(strip_accents(lower(text)), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g')))"}),
    "str13_search_text": Scalar("conversations", lambda: {"conv_id": C("conv_id"), "turn": C("turn"), "v": text.search_text(C("text"))}, {"conv_id": "conv_id", "turn": "turn", "v": r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))"}),
    "str14_first_number": Scalar("orders", lambda: {"o_orderkey": C("o_orderkey"), "v": text.first_number(F.concat(F.lit("by "), F.when(C("o_orderkey") % 5 != 0, F.concat(C("o_orderkey").cast("string"), F.lit(".0"), C("o_custkey").cast("string"))), F.lit(" likes")))}, {"o_orderkey": "o_orderkey", "v": "CASE WHEN o_orderkey % 5 <> 0 THEN CAST(concat(o_orderkey, '0', o_custkey) AS BIGINT) END"}),
    "str15_star_counts": Scalar("orders", lambda: {"o_orderkey": C("o_orderkey"), **{f"s{k}": text.star_counts(F.array(F.concat(F.lit("5 sao, 1."), F.lpad((C("o_orderkey") % 1000).cast("string"), 3, "0"), F.lit(" bài đánh giá")), F.concat(F.lit("3 stars, "), (C("o_custkey") % 90).cast("string")), F.lit("none")))[k] for k in (5, 3, 1)}}, {"o_orderkey": "o_orderkey", "s5": "1000 + o_orderkey % 1000", "s3": "o_custkey % 90", "s1": "CAST(NULL AS BIGINT)"}),
    "str16_similarity": Scalar("part", lambda: {"p_partkey": C("p_partkey"), "ratio": F.round(text.similarity(C("p_name"), F.lower("p_type")), 6), "same": text.names_match(C("p_name"), F.lit("small ring"))}, {}),
    "str17_collapse": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": text.collapse(C("review_text"))}, {"review_id": "review_id", "v": r"nullif(trim(regexp_replace(review_text, '\s+', ' ', 'g')), '')"}),
    "dt1_utc_timestamp": Scalar("ratings", lambda: {"place_id": C("place_id"), "v": times.utc_timestamp(C("crawled_at"))}, {"place_id": "place_id", "v": o.time_of("crawled_at")}),
    "dt2_relative_text": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": said()}, {"review_id": "review_id", "v": SAID}),
    "dt3_relative_unit": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": times.relative_unit(said())}, {"review_id": "review_id", "v": UNIT}),
    "dt4_relative_quantity": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": times.relative_quantity(said())}, {"review_id": "review_id", "v": f"coalesce(TRY_CAST(nullif(regexp_extract({SAID}, '^([0-9]+) ', 1), '') AS INTEGER), 1)"}),
    "dt5_relative_date": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": times.relative_date(times.relative_unit(said()), times.relative_quantity(said()), crawl_day())}, {"review_id": "review_id", "v": o.back_of(UNIT, SAID, CRAWL_DAY)}),
    "dt6_relative_precision": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": times.relative_precision(times.relative_unit(said()))}, {"review_id": "review_id", "v": o.precision_of(UNIT)}),
    "dt7_precision_rank": Scalar("reviews", lambda: {"review_id": C("review_id"), "v": times.precision_rank(times.relative_precision(times.relative_unit(said()))).cast("bigint")}, {"review_id": "review_id", "v": f"CAST(coalesce(list_position(['day', 'week', 'month', 'year'], {o.precision_of(UNIT)}), 5) AS BIGINT)"}),
    "dt8_month_of": Scalar("orders", lambda: {"o_orderkey": C("o_orderkey"), "d": C("o_orderdate").cast("date"), "m": times.month_of(C("o_orderdate"))}, {"o_orderkey": "o_orderkey", "d": "CAST(o_orderdate AS DATE)", "m": "CAST(date_trunc('month', o_orderdate) AS DATE)"}),
    "dt9_year_quarter": Scalar("orders", lambda: {"o_orderkey": C("o_orderkey"), "y": F.year("o_orderdate").cast("bigint"), "q": F.quarter("o_orderdate").cast("bigint")}, {"o_orderkey": "o_orderkey", "y": "year(o_orderdate)", "q": "quarter(o_orderdate)"}),
    "dt10_date_differences": Scalar("lineitem", lambda: {"l_orderkey": C("l_orderkey"), "days": times.days_between(F.lit("1995-01-31").cast("date"), C("l_shipdate")), "months": times.months_between(F.lit("1995-01-31").cast("date"), C("l_shipdate"))}, {"l_orderkey": "l_orderkey", "days": "date_diff('day', DATE '1995-01-31', CAST(l_shipdate AS DATE))", "months": "date_diff('month', DATE '1995-01-31', CAST(l_shipdate AS DATE))"}),
    "dt11_intervals": Scalar("orders", lambda: {"o_orderkey": C("o_orderkey"), "before": F.date_sub(C("o_orderdate").cast("date"), 90), "after": C("o_orderdate") + F.expr("INTERVAL '1' DAY")}, {"o_orderkey": "o_orderkey", "before": "CAST(o_orderdate AS DATE) - 90", "after": "o_orderdate + INTERVAL 1 DAY"}),
    "dt15_freshness": Scalar("events", lambda: {"event_id": C("event_id"), "planner": times.is_fresh(C("ts"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), 7), "checkpoint": times.is_fresh(C("ts"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), 7, True)}, {"event_id": "event_id", "planner": "ts <= TIMESTAMP '2024-01-20' AND ts > TIMESTAMP '2024-01-13'", "checkpoint": "ts > TIMESTAMP '2024-01-13'"}),
    "mth1_safe_casts": Scalar("ratings", lambda: {"place_id": C("place_id"), "d": cast.to_double(C("google_rating")), "i": cast.to_int(C("google_rating")), "n": cast.to_int(C("google_review_count"))}, {"place_id": "place_id", "d": o.number_of("google_rating"), "i": f"TRY_CAST({o.number_of('google_rating')} AS BIGINT)", "n": f"TRY_CAST({o.number_of('google_review_count')} AS BIGINT)"}),
    "mth2_to_bool": Scalar("places", lambda: {"place_id": C("place_id"), "v": cast.to_bool(C("crawl_eligible"))}, {"place_id": "place_id", "v": o.bool_of("crawl_eligible")}),
    "mth3_guarded_ratio": Scalar("events", lambda: {"event_id": C("event_id"), "pct": cast.ratio_pct(C("user_id") % 7, C("event_id") % 4), "far": F.abs((C("user_id") - 75).cast("bigint"))}, {"event_id": "event_id", "pct": o.pct("user_id % 7", "event_id % 4"), "far": "abs(user_id - 75)"}),
    "mth4_least_greatest": Scalar("part", lambda: {"p_partkey": C("p_partkey"), "lo": F.least(F.nullif(C("p_size"), F.lit(7)), F.lit(20)), "hi": F.greatest(F.nullif(C("p_size"), F.lit(7)), F.lit(20))}, {"p_partkey": "p_partkey", "lo": "least(nullif(p_size, 7), 20)", "hi": "greatest(nullif(p_size, 7), 20)"}),
    "mth5_sum_of_columns": Scalar("orders", lambda: {"o_orderkey": C("o_orderkey"), "v": F.coalesce(F.nullif(C("o_orderkey") % 5, F.lit(0)), F.lit(0)) + F.coalesce(F.nullif(C("o_custkey") % 3, F.lit(1)), F.lit(0))}, {"o_orderkey": "o_orderkey", "v": "coalesce(nullif(o_orderkey % 5, 0), 0) + coalesce(nullif(o_custkey % 3, 1), 0)"}),
    "mth6_shares": Scalar("orders", lambda: {"o_orderkey": C("o_orderkey"), **{f"p{k}": cast.ratio_pct(C("o_orderkey") % (k + 2), C("o_custkey") % 8 * 2) for k in range(5)}}, {"o_orderkey": "o_orderkey", **{f"p{k}": o.pct(f"o_orderkey % {k + 2}", "o_custkey % 8 * 2") for k in range(5)}}),
    "mth7_clamp": Scalar("embeddings", lambda: {"vec_id": C("vec_id"), "v": cast.clamp(C("embedding")[0].cast("double") * 4)}, {"vec_id": "vec_id", "v": "greatest(0.0, least(1.0, CAST(embedding[1] AS DOUBLE) * 4))"}),
    "cnd6_error_class": Scalar("documents", lambda: {"doc_id": C("doc_id"), "status": ingest.error_status(C("text"), C("source"))}, {"doc_id": "doc_id", "status": o.error_status_of("text", "source")}),
    "arr2_ordered_distinct": Scalar("part", lambda: {"p_partkey": C("p_partkey"), "v": F.array_join(F.array_distinct(F.split(F.concat_ws(" ", "p_name", "p_name"), " ")), "|")}, {"p_partkey": "p_partkey", "v": "CASE WHEN split_part(p_name, ' ', 1) = split_part(p_name, ' ', 2) OR NOT contains(p_name, ' ') THEN split_part(p_name, ' ', 1) ELSE split_part(p_name, ' ', 1) || '|' || split_part(p_name, ' ', 2) END"}),
    "arr3_terms_found": Scalar("documents", lambda: {"doc_id": C("doc_id"), "n": text.terms_found(F.lower("text"), text.terms(F.lit("the| ha |idiot|| que"))).cast("bigint")}, {"doc_id": "doc_id", "n": "CAST(contains(lower(text), 'the') AS BIGINT) + CAST(contains(lower(text), 'ha') AS BIGINT) + CAST(contains(lower(text), 'idiot') AS BIGINT) + CAST(contains(lower(text), 'que') AS BIGINT)"}),
    "arr4_word_overlap": Scalar("documents", lambda: {"doc_id": C("doc_id"), "v": F.arrays_overlap(F.split("text", " "), F.array(F.lit("idiot"), F.lit("pathetic"), F.lit("clown")))}, {"doc_id": "doc_id", "v": "list_has_any(string_split(text, ' '), ['idiot', 'pathetic', 'clown'])"}),
    "jsn1_json_fields": Scalar("events", lambda: {"event_id": C("event_id"), "k": F.from_json("props", "k string")["k"].try_cast("bigint")}, {"event_id": "event_id", "k": "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"}),
    "jsn2_repair": Scalar("events", lambda: {"event_id": C("event_id"), "k": F.from_json(cast.repair_json(F.when(C("event_id") % 3 == 0, F.regexp_replace("props", "[0-9]+", "NaN")).when(C("event_id") % 3 == 1, F.regexp_replace("props", "[0-9]+", "-Infinity")).otherwise(C("props"))), "k string")["k"]}, {"event_id": "event_id", "k": "CASE WHEN event_id % 3 = 2 THEN json_extract_string(props, '$.k') END"}),
    "jsn3_to_json": Scalar("nation", lambda: {"v": F.to_json(F.struct(C("n_nationkey").alias("k"), C("n_name").alias("n")))}, {"v": """concat('{"k":', n_nationkey, ',"n":"', n_name, '"}')"""}),
    "map1_tags": Scalar("places", lambda: {"place_id": C("place_id"), "tags": F.array_join(F.array_sort(F.transform(F.map_entries(cast.tag_map(F.concat(F.lit('{"tourism":" x ","a":""}')), {"tourism": C("tourism"), "natural": C("natural_tag"), "leisure": C("leisure")})[0]), lambda e: F.concat(e["key"], F.lit("="), F.trim(e["value"])))), ",")}, {"place_id": "place_id", "tags": "concat(CASE WHEN leisure IS NOT NULL THEN concat('leisure=', leisure, ',') ELSE '' END, CASE WHEN natural_tag IS NOT NULL THEN concat('natural=', natural_tag, ',') ELSE '' END, 'tourism=x')"}),
    "flt5_domain_to_null": Scalar("ratings", lambda: {"place_id": C("place_id"), "r": cast.in_range(cast.to_double(C("google_rating")), 0, 5), "n": cast.not_negative(cast.to_int(C("google_review_count")))}, {"place_id": "place_id", "r": f"CASE WHEN {o.number_of('google_rating')} BETWEEN 0 AND 5 THEN {o.number_of('google_rating')} END", "n": f"CASE WHEN TRY_CAST({o.number_of('google_review_count')} AS BIGINT) >= 0 THEN TRY_CAST({o.number_of('google_review_count')} AS BIGINT) END"}),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: s.frame for name, s in SCALARS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: s.text() for name, s in SCALARS.items() if s.sql}

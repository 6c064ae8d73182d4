"""Dates and times of raw text: exact ones in UTC, relative ones against a reference day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_null, nfc, trim_spaces

OFFSET = r"[0-9]{2}:[0-9]{2}.*([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)\z"
#: Units of relative dates, in two languages.
TODAY_WORDS = ("hôm nay", "today", "vừa xong", "just now")
YESTERDAY_WORDS = ("hôm qua", "ngày hôm qua", "yesterday")
UNIT_WORDS = {"second": "giây|seconds?", "minute": "phút|minutes?", "hour": "giờ|tiếng|hours?", "day": "ngày|days?", "week": "tuần|weeks?", "month": "tháng|months?", "year": "năm|years?"}
EDIT_PREFIX = "thời gian chỉnh sửa|đã chỉnh sửa|edited"
EDIT_SUFFIX = "đã chỉnh sửa|edited"
PRECISIONS = ("day", "week", "month", "year")


def utc_timestamp(x: Column) -> Column:
    """A timestamp without zone in UTC: with an offset it is shifted, without one it is taken as UTC; null if malformed."""
    return timestamp_of(clean_null(x))


def timestamp_of(v: Column) -> Column:
    """The same of a text that ``clean_null`` has seen."""
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), v.try_cast("timestamp").cast("timestamp_ntz"))
    # most texts with an offset end in hh:mm:ssZ, which need no pattern
    plain_z = (F.substring(v, -1, 1) == "Z") & (F.substring(v, -4, 1) == ":") & (F.substring(v, -7, 1) == ":")
    other = F.when(plain_z | v.rlike(OFFSET), zoned).otherwise(v.try_cast("timestamp_ntz"))
    # a date, a time and Z behind a digit (not a zone such as NZ): the digits are those of UTC as they stand
    utc = F.endswith(v, F.lit("Z")) & (F.substring(v, 5, 1) == "-") & (F.substring(v, 14, 1) == ":") & F.substring(v, -2, 1).between("0", "9")
    return F.when(utc, v.try_cast("timestamp_ntz")).otherwise(other)


def relative_text(x: Column) -> Column:
    """Lower case, composed, blanks collapsed, without marks of editing. Use it once, as a column of its own."""
    v = F.regexp_replace(nfc(F.lower(trim_spaces(x))), r"\s+", " ")
    v = F.regexp_replace(v, rf"^({EDIT_PREFIX}) ?:? ?", "")
    return F.regexp_replace(v, rf" ?\(({EDIT_SUFFIX})\)\z", "")


def relative_unit(t: Column) -> Column:
    """today, second, ... year, or null; of ``relative_text``."""
    out = F.when(t.isin(*TODAY_WORDS), "today").when(t.isin(*YESTERDAY_WORDS), "day")
    for unit, words in UNIT_WORDS.items():
        out = out.when(t.rlike(rf"^(([0-9]+|một|a|an|one) )?({words}) (trước|ago)\z"), unit)
        if unit in ("week", "month", "year"):
            out = out.when(t == f"last {unit}", unit)
    return out


def relative_quantity(t: Column) -> Column:
    return F.when(t.rlike("^[0-9]+ "), F.regexp_extract(t, "^([0-9]+)", 1).try_cast("int")).otherwise(F.lit(1))


def relative_date(unit: Column, n: Column, reference: Column) -> Column:
    """The reference day less n units, as a date; hours before its midnight fall on the day before."""
    start = reference.cast("timestamp_ntz")
    seconds = F.when(unit == "second", n).when(unit == "minute", n * 60).when(unit == "hour", n * 3600)
    back = start - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    day = reference.cast("date")
    return F.when(unit == "today", day).when(unit.isin("second", "minute", "hour"), back.cast("date")).when(unit == "day", F.date_sub(day, n)).when(unit == "week", F.date_sub(day, n * 7)).when(unit == "month", F.add_months(day, -n)).when(unit == "year", F.add_months(day, -12 * n))


def relative_precision(unit: Column) -> Column:
    return F.when(unit.isin("today", "second", "minute", "hour", "day"), "day").when(unit.isin("week", "month", "year"), unit).otherwise("unknown")


def precision_rank(precision: Column) -> Column:
    out = None
    for k, name in enumerate(PRECISIONS, 1):
        out = F.when(precision == name, k) if out is None else out.when(precision == name, k)
    return out.otherwise(5)


def month_of(x: Column) -> Column:
    """The first day of the month, as a date."""
    return F.trunc(x.cast("date"), "MM")


def months_between(first: Column, last: Column) -> Column:
    """Month boundaries passed."""
    return ((F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)).cast("bigint")


def days_between(first: Column, last: Column) -> Column:
    return F.datediff(last.cast("date"), first.cast("date")).cast("bigint")


def month_spine(spark, first: str, last: str):
    """A row for each month from first to last."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("month"))


def is_fresh(at: Column, now: Column, days: int, future_is_fresh: bool = False) -> Column:
    """Within ``days`` before now. The checkpoint rule calls times in the future fresh, the planner's rule does not."""
    age = now.cast("timestamp").cast("double") - at.cast("timestamp").cast("double")
    recent = (age < days * 86400) & F.lit(days > 0)
    return F.coalesce(recent if future_is_fresh else recent & (age >= 0), F.lit(False))

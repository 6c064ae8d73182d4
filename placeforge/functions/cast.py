"""Safe casts of raw text: a value in a bad form is null, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_null

#: What counts as a number: no type suffixes (5d) and no digit groups (1_000).
NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf(inity)?|nan))$"
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")


def double_of(v: Column) -> Column:
    """A number from a cleaned text. Each ``*_of`` takes a text that ``clean_null`` has seen, so that it is cleaned once."""
    return F.when(v.rlike(NUMBER), v.try_cast("double"))


def int_of(v: Column) -> Column:
    """Through a double, rounded half to even."""
    return F.rint(double_of(v)).try_cast("bigint")


def bool_of(v: Column) -> Column:
    word = F.lower(v)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def province_of(v: Column) -> Column:
    """'1' and '1.0' become '01'; other text in upper case."""
    return F.when(v.rlike(r"^[0-9]+(\.0+)?\z"), F.lpad(v.try_cast("double").cast("bigint").cast("string"), 2, "0")).otherwise(F.upper(v))


def to_double(x: Column) -> Column:
    return double_of(clean_null(x))


def to_int(x: Column) -> Column:
    return int_of(clean_null(x))


def to_bool(x: Column) -> Column:
    return bool_of(clean_null(x))


def province_code(x: Column) -> Column:
    return province_of(clean_null(x))


def in_range(x: Column, low: float, high: float) -> Column:
    """The value, or null outside the range."""
    return F.when(x.between(low, high), x)


def not_negative(x: Column) -> Column:
    return F.when(x >= 0, x)


def rounded(x: Column, digits: int = 2) -> Column:
    """Half away from zero on the scaled double, as C rounds; Spark's own round works on the shortest decimal text."""
    scale = F.lit(float(10**digits))
    return F.round(x.cast("double") * scale) / scale


def mean_rounded(x: Column, digits: int = 2, over=None) -> Column:
    """The mean of values that have at most ``digits`` decimals, rounded to as many: an exact sum, one division, one rounding.

    A sum of doubles depends on its order, and so would the rounding of a mean that lies half way. ``over``: a window.
    """
    scale = float(10**digits)
    whole, n = F.sum(F.rint(x.cast("double") * F.lit(scale)).cast("bigint")), F.count(x)
    if over is not None:
        whole, n = whole.over(over), n.over(over)
    return F.when(n > 0, F.round(whole.cast("double") / n) / F.lit(scale))


def ratio_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole rounded; null unless whole is positive."""
    return F.when(whole > 0, rounded(part * F.lit(100.0) / whole, digits))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def repair_json(line: Column) -> Column:
    """The tokens NaN and (-)Infinity as values become null."""
    return F.regexp_replace(line, r":\s*(NaN|-?Infinity)\s*([,}])", ": null$2")


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once a row, however often ``f`` names it: Spark writes a column out wherever it is named."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


#: Texts that count as empty in tags and their columns.
EMPTY_WORDS = ("", "nan", "none", "<na>")


def given(x: Column) -> Column:
    """The trimmed text, null if it is empty or a word for nothing."""
    v = F.trim(x.cast("string"))
    return F.when(~F.lower(v).isin(*EMPTY_WORDS), v)


def json_object(text: Column) -> Column:
    """The members of a JSON object as a map of texts, null for anything else, in strict JSON and with nothing after it.

    The parser stops behind the first value. So the text is read once as the only item of a list and once as the only member
    of an object: what ends one of these early is an error in the other.
    """
    strict = {"allowSingleQuotes": "false"}
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", strict)
    held = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), "map<string,map<string,string>>", strict)
    whole = (F.size(held) == 1) & F.startswith(F.trim(text), F.lit("{"))
    return once(listed, lambda items: F.when((F.size(items) == 1) & whole, F.get(items, F.lit(0))))


def tags_of(tags_json: Column, defaults: dict[str, Column]) -> Column:
    """A struct of ``tags``, those of a JSON object without blank values, over the defaults, and ``malformed``."""
    none = F.expr("map()").cast("map<string,string>")
    pairs = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), given(v).alias("v")) for k, v in defaults.items()]), lambda p: p["v"].isNotNull()) if defaults else None

    def over_defaults(kept: Column) -> Column:
        return kept if pairs is None else F.map_concat(F.map_filter(F.map_from_entries(pairs), lambda k, v: ~F.map_contains_key(kept, k)), kept)

    def both(read: Column) -> Column:
        kept = F.transform_values(F.map_filter(F.coalesce(read["parsed"], none), lambda k, v: v.isNotNull() & (F.trim(v) != "")), lambda k, v: F.trim(v))
        malformed = read["text"].isNotNull() & read["parsed"].isNull()
        return F.struct(once(kept, over_defaults).alias("tags"), malformed.alias("malformed"))

    text = given(tags_json)
    return once(F.struct(text.alias("text"), json_object(text).alias("parsed")), both)


def tag_map(tags_json: Column, defaults: dict[str, Column]) -> tuple[Column, Column]:
    """The tags of a JSON object without blank values, over the defaults; and whether the JSON is malformed."""
    found = tags_of(tags_json, defaults)
    return found["tags"], found["malformed"]

"""Text functions: columns to columns. Only the Unicode forms and the similarity ratio need Python, on Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that mean null.
NULL_WORDS = ("", "nan", "none", "null", "nat")
#: The space separators of Unicode.
SEPARATORS = "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
RATIO = 0.6


def trim_spaces(x: Column) -> Column:
    """Without Unicode space separators at both ends; tabs and line ends stay."""
    s = x.cast("string")
    # in plain ASCII only the blank can be one
    return F.when(F.octet_length(s) == F.length(s), F.trim(s)).otherwise(F.btrim(s, F.lit(SEPARATORS)))


def not_null_word(v: Column) -> Column:
    """A trimmed text, or null for a word that means null; these have four letters at most."""
    return F.when((F.octet_length(v) > 4) | ~F.lower(v).isin(*NULL_WORDS), v)


def clean_null(x: Column) -> Column:
    return not_null_word(trim_spaces(x))


def clean_text(x: Column) -> Column:
    """Line-break tags and runs of white space become one blank; '' and nan become null."""
    v = F.regexp_replace(F.regexp_replace(x.cast("string"), r"(?i)<br\s*/?>", " "), r"\s+", " ")
    v = trim_spaces(v)
    return F.when(~v.isin("", "nan", "NaN"), v)


def collapse(x: Column) -> Column:
    """Runs of white space to one blank; '' to null."""
    return F.nullif(F.trim(F.regexp_replace(x, r"\s+", " ")), F.lit(""))


def first_number(x: Column) -> Column:
    """'1.234 likes' is 1234: the first run of digits, dots and commas, as an integer."""
    return F.nullif(F.regexp_replace(F.regexp_extract(x, r"(\d[\d.,]*)", 1), r"[^0-9]", ""), F.lit("")).try_cast("bigint")


def star_counts(labels: Column) -> Column:
    """A map star -> count from labels such as '5 sao, 1.234 bài đánh giá'; labels without a star are left out."""
    pairs = F.transform(labels, lambda s: F.struct(F.regexp_extract(s, r"([1-5])\s*(?:sao|stars?)", 1).try_cast("int").alias("star"), first_number(F.regexp_replace(s, r"^.*?[1-5]\s*(?:sao|stars?)", "")).alias("n")))
    return F.map_from_entries(F.filter(pairs, lambda p: p["star"].isNotNull()))


def row_id(*parts: Column) -> Column:
    """Parts joined by a bar; null if one is."""
    out = [parts[0]]
    for p in parts[1:]:
        out += [F.lit("|"), p.cast("string")]
    return F.concat(*out)


def surrogate_key(*parts: Column) -> Column:
    return F.concat(F.lit("sk_"), F.md5(F.concat_ws("||", *parts)))


def unicode_form(form: str):
    """A function of columns: the text in NFC, NFD, NFKC or NFKD."""

    def apply(x: Column) -> Column:
        @F.pandas_udf("string")
        def normal(s: pd.Series) -> pd.Series:
            return s.map(lambda v: None if v is None else unicodedata.normalize(form, v))

        return normal(x)

    return apply


def plain_ascii(x: Column) -> Column:
    return F.octet_length(x) == F.length(x)


def nfc(x: Column) -> Column:
    """In plain ASCII the text itself; only other texts go to Python."""
    return F.when(plain_ascii(x), x).otherwise(unicode_form("NFC")(F.when(~plain_ascii(x), x)))


def plain(value: str) -> str:
    """Without marks, đ as d, case folded, runs of other characters than letters and digits as one blank."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    bare = bare.replace("đ", "d").replace("Đ", "D").casefold()
    return re.sub(r"[^a-z0-9]+", " ", bare).strip()


def accent_key(x: Column) -> Column:
    """``plain``, by columns for plain ASCII."""

    @F.pandas_udf("string")
    def key(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else plain(v))

    bare = F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))
    return F.when(plain_ascii(x), bare).otherwise(key(F.when(~plain_ascii(x), x)))


def searchable(value: str | None, strip_accents: bool = False) -> str:
    v = unicodedata.normalize("NFKC", value or "").lower()
    if strip_accents:
        v = "".join(c for c in unicodedata.normalize("NFD", v) if unicodedata.category(c) != "Mn")
    return " ".join(re.sub(r"[^\w\s]", " ", v).split())


def search_text(x: Column, strip_accents: bool = False) -> Column:
    """NFKC, lower case, punctuation as blanks, blanks collapsed; optionally without accents. Null is ''."""

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda v: searchable(v, strip_accents))

    return normal(x)


def search_terms(x: Column) -> Column:
    """The terms of text with bars, each as ``search_text`` has it, without empty ones."""

    @F.pandas_udf("array<string>")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda v: [t for t in map(searchable, (v or "").split("|")) if t])

    return normal(x)


def similarity(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of two texts, as the standard library's SequenceMatcher gives it."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, p or "", q or "").ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return ratio(a, b)


def similar(a: Column, b: Column, ratio: float = RATIO) -> Column:
    """Whether the similarity is at least ``ratio``; null for a null side. Lengths and letters settle most pairs; the rest is compared."""

    @F.pandas_udf("boolean")
    def enough(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        out = []
        for p, q in zip(x, y, strict=True):
            m = SequenceMatcher(None, p, q) if p is not None and q is not None else None
            out.append(None if m is None else m.real_quick_ratio() >= ratio and m.quick_ratio() >= ratio and m.ratio() >= ratio)
        return pd.Series(out, dtype="object")

    return enough(a, b)


def names_match(a: Column, b: Column, ratio: float = RATIO) -> Column:
    """Either name holds the other, or they are similar; an empty side matches all. Only what is still open is compared."""
    p, q = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    held = (p == "") | (q == "") | F.contains(p, q) | F.contains(q, p)
    return held | F.coalesce(similar(F.when(~held, p), F.when(~held, q), ratio), F.lit(False))


def terms(x: Column) -> Column:
    """A list of terms from text with bars: trimmed, without blanks."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"\|"), lambda t: F.trim(t)), lambda t: t != "")


def terms_found(text: Column, wanted: Column) -> Column:
    """How many of the terms the text contains."""
    return F.size(F.filter(wanted, lambda t: F.contains(text, t)))

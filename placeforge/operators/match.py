"""Search queries for places, and how well a found video fits its place."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cast, text

# ---- Fixed values that results depend on ----
INTENTS = ("du lịch", "review du lịch", "kinh nghiệm du lịch", "khám phá", "trải nghiệm", "tham quan")
NEGATIVE_PHRASES = ("official mv", "music video", "phim ca nhạc", "bài hát", "ca sĩ", "liên khúc", "tân cổ", "bolero", "nhạc sống", "nhạc trẻ", "nhạc trữ tình", "hài kịch", "gameshow", "game show", "phim ngắn", "tập full", "official trailer", "teaser trailer", "parody", "dance practice", "remix tik tok", "nhac che", "nhạc chế", "rap việt", "châu khải phong", "karaoke")
NEGATIVE_WORDS = ("karaoke", "remix", "nhạc", "nhac", "lyric", "lyrics", "audio", "mp3", "beat", "cover", "mv", "mashup", "acoustic", "liveshow", "ost", "soundtrack", "album", "single", "casi", "edm", "dj", "parody", "dance", "vpop", "kpop", "hài", "hai", "game", "gaming", "shorts", "tiktok", "reaction")
MUSIC_CATEGORIES = ("music", "âm nhạc", "nhạc", "nhac", "gaming", "entertainment")
MUSIC_WORDS = ("mv", "song", "ca", "hát")
WEIGHTS = {"name": 0.50, "location": 0.20, "category": 0.15, "context": 0.15}
WEAK_MATCH, NEGATIVE = 0.20, 0.45
ACCEPTED, UNCERTAIN = 0.62, 0.40
# ---- End of fixed values ----


def literals(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def queries(name: Column, province: Column, aliases: Column, contexts: Column, categories: Column) -> Column:
    """The search texts of a place in order, each once: intents, intents with terms, terms, names in contexts."""
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    place = F.concat(quoted(name), F.lit(" "), quoted(province))
    wanted = literals(INTENTS)
    with_intents = F.transform(wanted, lambda i: F.concat(place, F.lit(" "), i))
    with_both = F.flatten(F.transform(F.slice(wanted, 1, 3), lambda i: F.transform(F.slice(categories, 1, 2), lambda t: F.concat(place, F.lit(" "), i, F.lit(" "), quoted(t)))))
    with_terms = F.transform(F.slice(categories, 1, 3), lambda t: F.concat(place, F.lit(" "), quoted(t)))
    names, places = F.concat(F.array(name), aliases), F.concat(F.array(province), contexts)
    crossed = F.flatten(F.transform(names, lambda n: F.transform(places, lambda c: F.concat(quoted(n), F.lit(" "), quoted(c)))))
    return F.array_distinct(F.concat(with_intents, with_both, with_terms, crossed))


def share(found_in: Column, wanted: Column) -> Column:
    """The share of the terms that the text holds; 0 without terms."""
    hits = F.size(F.filter(wanted, lambda t: (t != "") & F.contains(found_in, t)))
    return F.least(F.lit(1.0), hits / F.greatest(F.size(wanted), F.lit(1)))


def resolve(pairs: DataFrame) -> DataFrame:
    """Candidate videos beside their places, with resolution_score, _status and _reason.

    Reads title, description, category, place_name, province_name, and lists as text with bars: aliases, query_context,
    context_keywords, category_terms, negative_keywords. Normal forms are made once, as columns.
    """
    plain = ("title", "description", "category", "place_name", "province_name")
    lists = ("aliases", "query_context", "context_keywords", "category_terms", "negative_keywords")
    out = pairs.withColumns({f"_{c}": text.search_text(F.col(c)) for c in plain} | {f"_{c}": text.search_terms(F.col(c)) for c in lists})
    out = out.withColumn("_all", F.concat_ws(" ", "_title", "_description"))
    names = F.filter(F.concat(F.array("_place_name"), F.col("_aliases")), lambda n: n != "")
    out = out.withColumn("_names", names)

    # the best name: one inside the title is 1, else the highest ratio
    inside = F.exists("_names", lambda n: F.contains(F.col("_title"), n))
    ratios = best_ratio(F.when(~inside, F.col("_names")), F.when(~inside, F.col("_title")))
    words = F.split("_all", " ")
    phrase = F.exists(literals(NEGATIVE_PHRASES), lambda p: F.contains(F.col("_all"), p)) | F.exists("_negative_keywords", lambda p: F.contains(F.col("_all"), p))
    negative = phrase | F.arrays_overlap(words, literals(NEGATIVE_WORDS))
    music = F.col("_category").isin(*MUSIC_CATEGORIES) & F.arrays_overlap(words, literals(MUSIC_WORDS))
    out = out.withColumns({
        "name_score": F.when(inside, F.lit(1.0)).otherwise(ratios), "location_score": share(F.col("_all"), F.concat(F.array("_province_name"), F.col("_query_context"))),
        "category_score": share(F.col("_all"), F.col("_category_terms")), "context_score": share(F.col("_all"), F.col("_context_keywords")), "_negative": negative | music,
    })
    score = sum((F.lit(w) * F.col(f"{k}_score") for k, w in WEIGHTS.items()), F.lit(0.0))
    weak = (F.col("name_score") < 1) & (F.col("category_score") == 0) & (F.col("context_score") == 0)
    score = cast.clamp(score - F.when(weak, WEAK_MATCH).otherwise(0.0) - F.when(F.col("_negative"), NEGATIVE).otherwise(0.0))
    out = out.withColumn("resolution_score", score)
    status = F.when((F.col("resolution_score") >= ACCEPTED) & ~F.col("_negative"), "accepted").when(F.col("resolution_score") >= UNCERTAIN, "uncertain").otherwise("rejected")
    reason = F.when(F.col("_negative"), "negative_keyword").otherwise(F.concat_ws(";", *[F.format_string(f"{k}=%.3f", f"{k}_score") for k in ("name", "location", "category", "context")]))
    out = out.withColumns({"resolution_status": status, "resolution_reason": reason, "resolution_score": F.round("resolution_score", 4)})
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def best_ratio(names: Column, title: Column) -> Column:
    @F.pandas_udf("double")
    def best(many: pd.Series, one: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        out = []
        for names_, t in zip(many, one, strict=True):
            highest = 0.0
            for n in names_ if names_ is not None else ():
                m = SequenceMatcher(None, n, t or "")
                if m.real_quick_ratio() > highest and m.quick_ratio() > highest:  # it could be higher
                    highest = max(highest, m.ratio())
            out.append(highest)
        return pd.Series(out, dtype="float64")

    return best(names, title)

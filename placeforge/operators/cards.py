"""Review cards of stored pages, read from the page's tree."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.markup import Element, Selector, tree

# ---- Fixed values: where a card has its fields ----
CARD = Selector(attributes=(("data-review-id", None),))
STARS = Selector("span", "kvMYJc")
OTHER_STARS = Selector(attributes=(("role", "img"), ("aria-label", None)))
TEXT = Selector("span", "wiI7pd")
#: What stands in one of these is the owner's answer.
ANSWER = Selector(cls="CDe7pd")
DATE = Selector("span", "rsqaWe")
LIKES = Selector("span", "pkWtMe")
NO_LIKES = "0"
# ---- End of fixed values ----
FIELDS = ("review_id", "rating", "review_text", "review_date", "likes")


def fields(card: Element) -> tuple[str | None, str, str, str]:
    """Rating (the first digits of its label), text, date and likes of a card, as on the page."""
    stars = STARS.first(card) or OTHER_STARS.first(card)
    digits = re.search(r"[0-9]+", stars.attributes.get("aria-label", "")) if stars else None
    shown = lambda e, default="": (e.text() if e else default).strip()
    body = next((e for e in TEXT.find(card) if not ANSWER.around(e)), None)
    return digits.group() if digits else None, shown(body), shown(DATE.first(card)), shown(LIKES.first(card), NO_LIKES) or NO_LIKES


def cards_of(html: str | None) -> list[tuple[str, str | None, str, str, str]]:
    """The cards of a page in order, the first of each id; an element without a value for its id is none. A card in a card is one too."""
    first: dict[str, Element] = {}
    if html and "data-review-id" in html.lower():
        for e in CARD.find(tree(html)):
            if name := e.attributes["data-review-id"]:
                first.setdefault(name, e)
    return [(name, *fields(e)) for name, e in first.items()]


def cards(pages: DataFrame, html: str = "html", key: str = "place_id", most: int | None = None) -> DataFrame:
    """A row a review: key, review_id, rating, review_text, review_date and likes_count.

    Blanks are collapsed, and what is empty then is null; a blank id becomes the SHA-1 of key and text. Of a review that
    comes more than once the first counts. ``most``: the first so many cards of each page. Pages are read where they
    are; only the cards found are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for k, page in enumerate(batch.column(1)):
                for pos, card in enumerate(cards_of(page.as_py())[:most]):
                    at.append(k)
                    out.append((pos, *card))
            columns = [pa.array([x[n] for x in out], kind) for n, kind in enumerate((pa.int32(), *[pa.string()] * len(FIELDS)))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], ["key", "pos", *FIELDS])

    kind = pages.schema[key].dataType.simpleString()
    found = pages.select(F.col(key).alias("key"), F.col(html)).mapInArrow(run, f"key {kind}, pos int, " + ", ".join(f"{f} string" for f in FIELDS))
    clean = {c: F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit("")) for c in ("review_id", "review_text", "review_date")}  # blanks of any script
    found = found.withColumns(clean | {"rating": text.first_number(F.col("rating")), "likes_count": text.first_number(F.col("likes"))})
    own_id = F.sha1(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit("|"), F.coalesce("review_text", F.lit(""))))
    found = found.withColumn("review_id", F.coalesce("review_id", own_id))
    rest = F.struct("rating", "review_text", "review_date", "likes_count")
    out = found.groupBy("key", "review_id").agg(F.min_by(rest, F.struct(F.col("pos"), F.xxhash64(rest))).alias("c"))
    return out.select(F.col("key").alias(key), "review_id", "c.*")

"""Operator 8, URL filters by a sort-merge range join.

Method. A rule (host, path prefix) gets the key ``reversed host / path``: com.example//en/7. The slash closes the host, so
that com is not the start of community, whatever the path. The URLs that a rule can fit form an interval of keys, those that
begin with its key, so rules nest like brackets. A URL asks once for each suffix of its host: www.example.com/en/7
asks as com.example.www//en/7, com.example//en/7 and com//en/7, since a rule fits subdomains.
Rules and questions are sorted together by key; one sweep keeps the stack of rules that are open at the current key,
and its top is the longest rule that fits the question. The longest answer over a URL's questions wins: most labels in
the host first, then the longer path; equal rules with different verdicts: block wins.

Scale. The sorted order is cut into ranges of keys at bounds from a bounded sample (which only balances the work); a
question goes to its range, a rule to each range that its interval meets. Each URL is judged once, under a number of its own, so
one with a third of all rows is one question. Nothing is broadcast but the bounds, at most RANGES strings.

Cases. Null URLs and URLs without ``://`` have an empty host and path and fit no rule; so do empty hosts. A rule with an
empty path fits its whole host; one with an empty host, or with a slash in it, fits nothing. Without a rule the verdict is DEFAULT. Repeated rows are judged each. Empty tables of either kind work.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, hash_sample, materialize

#: The verdict of a URL that no rule fits.
DEFAULT = "allow"
#: Ranges of keys at most, and keys sampled for each.
RANGES = 512
PER_RANGE = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts after all characters of keys.
LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; '' for null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end. Cut at the first :// before, as a later one may stand in a query."""
    rest = F.regexp_extract(url, r"^(?s:.*?)://((?s:.*))\z", 1)
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, "\\.", -1)), ".")


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and key, rules before questions: each question with the innermost open rule and its key and verdict."""
    stack: list[tuple[str, str, str]] = []
    current = None
    for batch in batches:
        cols = batch.to_pydict()
        ids, best = [], []
        for part, key, rule, verdict, row in zip(cols["part"], cols["key"], cols["rule"], cols["verdict"], cols["row"], strict=True):
            if part != current:
                current, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, verdict))
            elif stack:
                ids.append(row)
                best.append(stack[-1])
        keys, rules, verdicts = zip(*best, strict=True) if best else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(x, pa.string()) for x in (keys, rules, verdicts))], ["row", "rule_key", "rule", "verdict"])


def match_rules(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with url_host, url_path, rule and verdict. ``rules``: host, path, verdict. Columns of these names are replaced."""
    own = ("url_host", "url_path", "rule", "verdict")
    pages = pages.drop(*[c for c in pages.columns if c.lower() in own and c != url])
    row = fresh(pages, "_row")[0]
    # equal URLs have equal verdicts: each (host, path) is judged once
    split = pages.withColumns({"url_host": host_of(F.col(url)), "url_path": path_of(F.col(url))})
    clean = rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("host"), "path", "verdict").where((F.col("host") != "") & F.col("path").isNotNull() & ~F.contains("host", F.lit("/")))
    clean = clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    clean = materialize(clean.select(F.concat(reversed_host(F.col("host")), F.lit("/"), "path").alias("rule_key"), F.concat("host", "path").alias("rule"), "verdict"), "url-rules")
    targets = materialize(split.where(F.col("url_host") != "").select("url_host", "url_path").distinct().withColumn("row", F.monotonically_increasing_id()), "url-targets")
    labels = F.split(F.col("url_host"), "\\.", -1)
    back = F.reverse(labels)
    asked = F.transform(F.sequence(F.lit(1), F.size(back)), lambda k: F.concat(F.array_join(F.slice(back, F.lit(1), k), "."), F.lit("/"), F.col("url_path")))
    questions = targets.select("row", F.explode(asked).alias("key")).withColumn("key", F.concat("key", F.lit("\x00"), F.hex("row")))
    total = targets.agg(F.sum(F.size(F.split("url_host", "\\.", -1)))).first()[0] or 0  # as many questions
    bounds = sorted(r.key for r in hash_sample(questions.select("key"), "key", total, RANGES * PER_RANGE).collect())
    ranges = max(1, min(RANGES, len(bounds) // PER_RANGE))
    cuts = sorted({bounds[i * len(bounds) // ranges] for i in range(1, ranges)})
    at = F.lit(cuts) if cuts else F.array().cast("array<string>")
    part = lambda key: F.size(F.filter(at, lambda b: b <= key))
    asks = questions.select(part(F.col("key")).alias("part"), "key", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"), "row")
    opens = clean.select(F.explode(F.sequence(part(F.col("rule_key")), part(F.concat("rule_key", F.lit(LAST))))).alias("part"), F.col("rule_key").alias("key"), "rule", "verdict", F.lit(None).cast("long").alias("row"))
    merged = asks.unionByName(opens).repartition("part").sortWithinPartitions("part", "key", F.col("rule").isNull())
    found = merged.mapInArrow(sweep, "row long, rule_key string, rule string, verdict string")
    depth = F.size(F.split(F.substring_index("rule_key", "/", 1), "\\.", -1))
    best = found.groupBy("row").agg(F.max(F.struct(depth.alias("depth"), F.length("rule_key").alias("long"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict"))).alias("best"))
    judged = targets.join(best, "row").select(F.col("url_host").alias(row + "h"), F.col("url_path").alias(row + "p"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    out = split.join(judged, (F.col("url_host") == F.col(row + "h")) & (F.col("url_path") == F.col(row + "p")), "left").drop(row + "h", row + "p")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(DEFAULT)))


RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]

ORACLE = """
WITH r(rhost, rpath, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'), ('example.net', '/de/8', 'allow'), ('org', '/es/', 'block')),
p AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM p),
m AS (SELECT page_id, arg_max(rhost || rpath, length(rhost) * 100 + length(rpath)) AS rule, arg_max(v, length(rhost) * 100 + length(rpath)) AS v
      FROM q JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT q.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM q LEFT JOIN m USING (page_id)
"""

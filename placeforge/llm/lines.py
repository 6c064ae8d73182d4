"""Operator 3, line dedup by site-relative frequency, in DataFrame functions only.

Method. A site is a host: here the ``source`` of a document. For each site, the documents that contain a line, divided
by the site's documents, are that line's ratio; a line on more than ``ratio`` of them, and on ``least`` documents or
more, is boilerplate of that site and goes from every document of it. Lines are compared by the MD5 digest of the line
without blanks, tabs and carriage returns at its ends.

Scale. Digests, never texts, are shuffled for the counts, and each document counts its lines once before that, so map
side aggregation holds even where one site has a third of all rows. A site has at most (lines a document / ratio)
boilerplate lines; they are gathered to one row a site. That table is broadcast only if its measured size is small;
else documents and sites join on the site and a salt, the site's row copied to each salt.

Cases. Null text stays null; blank lines always stay; a text that loses all lines becomes ''. Null sources are one site
of their own. On a site of under LEAST / ratio documents every line that two of them have goes, and no other. Repeated rows
count each. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, materialize

#: A line on more than this share of a site's documents is boilerplate, if it is on LEAST documents, that is, repeated at
#: all. The ratio lies in the gap between the shares of the lines of these corpora (README).
RATIO = 0.06
LEAST = 2
#: Boilerplate lines (all sites) up to which the table of sites is broadcast: 16 bytes each.
BROADCAST_LINES = 1_000_000
#: Salts of a site beyond that.
SALTS = 64


def line_key(line: Column) -> Column:
    """16 bytes that stand for a line; null for a blank one."""
    bare = F.trim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """A row a site that has boilerplate: ``site`` and ``dropped``, the sorted keys of its lines."""
    keys = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), line_key), lambda k: k.isNotNull()))
    pages = docs.select(F.col(site).alias("site"), keys.alias("keys"))
    totals = docs.groupBy(F.col(site).alias("site")).agg(F.count(F.lit(1)).alias("pages"))
    counts = pages.select("site", F.explode("keys").alias("key")).groupBy("site", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    both = counts.alias("c").join(totals.alias("t"), F.col("c.site").eqNullSafe(F.col("t.site")))
    common = both.where(F.col("n") > F.col("pages") * F.lit(ratio))
    return common.groupBy("c.site").agg(F.array_sort(F.collect_list("key")).alias("dropped"))


def drop_boilerplate(docs: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO, least: int = LEAST, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with ``text`` cleaned, and n_lines and n_dropped_lines (0 for a null text); columns of these names are replaced."""
    sites = materialize(boilerplate(docs, text, site, ratio, least), "boilerplate")
    size = sites.agg(F.coalesce(F.sum(F.size("dropped") + 1), F.lit(0))).first()[0]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped_lines") and c not in (text, site)])
    s, dropped, salt, lines, kept = fresh(docs, "_site", "_dropped", "_salt", "_lines", "_kept")
    sites = sites.select(F.col("site").alias(s), F.col("dropped").alias(dropped))
    same = F.col(site).eqNullSafe(F.col(s))
    if size <= broadcast_lines:
        out = docs.join(F.broadcast(sites), same, "left")
    else:
        salted = sites.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        mine = F.pmod(F.xxhash64(F.col(text)), F.lit(SALTS)).cast("int")
        theirs = fresh(salted, salt + "d")[0]
        out = docs.withColumn(theirs, mine).join(salted, same & (F.col(theirs) == F.col(salt)), "left").drop(theirs, salt)
    out = out.withColumn(lines, F.split(F.col(text), "\n", -1))
    out = out.withColumn(kept, F.when(F.col(dropped).isNull(), F.col(lines)).otherwise(F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(dropped), line_key(x)), F.lit(False)))))
    n_lines = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    n_dropped = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept)).cast("long")
    out = out.withColumns({"n_lines": n_lines, "n_dropped_lines": n_dropped})
    return out.withColumn(text, F.when(F.col("n_dropped_lines") > 0, F.array_join(kept, "\n")).otherwise(F.col(text))).drop(s, dropped, lines, kept)


ORACLE = f"""
WITH l AS (SELECT doc_id, source, UNNEST(string_split(text, chr(10))) AS line FROM documents),
k AS (SELECT DISTINCT doc_id, source, md5(trim(line, ' ' || chr(9) || chr(13))) AS key FROM l WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
c AS (SELECT source, key, COUNT(*) AS n FROM k GROUP BY ALL),
t AS (SELECT source, COUNT(*) AS pages FROM documents GROUP BY ALL),
b AS (SELECT c.source, key FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= {LEAST} AND n > pages * CAST({RATIO} AS DOUBLE)),
s AS (SELECT source, list(key) AS dropped FROM b GROUP BY ALL),
d AS (SELECT doc_id, d.source, text, string_split(text, chr(10)) AS lines, list_filter(string_split(text, chr(10)), lambda x: NOT coalesce(list_contains(dropped, md5(trim(x, ' ' || chr(9) || chr(13)))), FALSE)) AS kept
      FROM documents d LEFT JOIN s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL WHEN len(lines) = 0 THEN '' ELSE array_to_string(kept, chr(10)) END AS text,
       CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped_lines
FROM d
"""

"""Operator 5, mixing sources to target weights by Poisson replication.

Method. A source with a share t of the target and n rows gets the mean repetition rate t * total / n. Each row draws
its number of copies from a Poisson distribution with that mean: a uniform number hashed from the seed and the row's
key is inverted in the distribution function, so the draw is the same on every run and machine. A mean over LARGEST, where
the inversion leaves the range of doubles, is drawn as the sum of independent draws of equal means up to LARGEST, each
with its own uniform number; a sum of Poisson draws is Poisson distributed. Rows are exploded by their counts, in two
steps so that no array is longer than RUN, and shuffled globally: dealt to partitions by a hash of seed, key and copy, and sorted by it there.
Target shares are given, or else proportional to n ** EXPONENT, which raises rare sources and lowers frequent ones.

Scale. One aggregation by source; its table (a row a source, with the distribution function as an array) is broadcast
only if its measured size is small, else joined on source and a salt. Only rows that stay are shuffled, once.

Cases. Rows with a null source are one source. Null texts are rows like others. The key of a row is its doc_id and its
text, so repeated rows draw alike. A source with target 0, or a mean of 0, gives no rows; given weights need not sum to
1; sources that they don't name get none. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, let, materialize, unit_interval

SEED = 17
#: Default target share of a source: rows ** EXPONENT.
EXPONENT = 0.5
#: Numbers of 8 bytes in the table of sources, distribution functions included, up to which it is broadcast; salts beyond.
BROADCAST_NUMBERS = 4_000_000
SALTS = 64
#: Largest mean of one draw.
LARGEST = 600
#: Copies made by one array.
RUN = 1 << 16


def poisson_steps(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... as an array that ends 12 standard deviations and 20 beyond the mean."""
    last = (mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["cdf"])


def rates(docs: DataFrame, source: str = "source", weights: dict | None = None, exponent: float = EXPONENT) -> DataFrame:
    """A row a source: ``source``, ``rows``, ``mean``, the number of ``draws`` a row and the distribution function ``cdf`` of one."""
    n = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        target = F.pow(F.col("rows").cast("double"), F.lit(exponent))
    else:
        target = F.lit(0.0)
        for k, v in weights.items():
            target = F.when(F.col("source").eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(target)
    n = materialize(n.withColumn("target", target), "mix-sources")
    total = n.agg(F.sum("rows").alias("all_rows"), F.sum("target").alias("all_target")).first()
    mean = F.col("target") / F.lit(float(total.all_target or 1.0)) * F.lit(float(total.all_rows or 0)) / F.col("rows")
    n = n.select("source", "rows", mean.alias("mean")).withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("mean") / LARGEST).cast("int")))
    return n.withColumn("cdf", poisson_steps(F.col("mean") / F.col("draws")))


def mix(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", weights: dict | None = None, exponent: float = EXPONENT, seed: int = SEED, broadcast_numbers: int = BROADCAST_NUMBERS) -> DataFrame:
    """``docs`` replicated and shuffled, with ``copy`` (from 0) and ``mean_rate``; columns of these names are replaced."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("copy", "mean_rate") and c not in (source, doc_id, text)])
    s, cdf, draws, n, run, order, salt, theirs = fresh(docs, "_source", "_cdf", "_draws", "_n", "_run", "_order", "_salt", "_salted")
    table = rates(docs, source, weights, exponent)
    table = materialize(table.select(F.col("source").alias(s), F.col("mean").alias("mean_rate"), F.col("draws").alias(draws), F.col("cdf").alias(cdf)), "mix-rates")
    fits = table.agg(F.coalesce(F.sum(F.size(cdf) + 8), F.lit(0))).first()[0] <= broadcast_numbers
    side = F.broadcast(table) if fits else table
    same = F.col(source).eqNullSafe(F.col(s))
    key = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    if fits:
        out = docs.join(side, same)
    else:
        side = side.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = docs.withColumn(theirs, F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(SALTS)).cast("int")).join(side, same & (F.col(theirs) == F.col(salt))).drop(salt, theirs)
    below = lambda u: F.size(F.filter(cdf, lambda p: p <= u)).cast("long")
    first = let(unit_interval(F.lit(seed), F.col(doc_id), key), below)
    others = F.transform(F.sequence(F.lit(2), F.col(draws)), lambda k: let(unit_interval(F.lit(seed), F.col(doc_id), key, k), below))
    out = out.withColumn(n, F.when(F.col(draws) == 1, first).otherwise(F.aggregate(others, first, lambda acc, x: acc + x)))
    runs = F.floor((F.col(n) - 1) / RUN).cast("int")
    out = out.where(F.col(n) > 0).withColumn(run, F.explode(F.sequence(F.lit(0), runs)))
    start = F.col(run).cast("long") * RUN
    out = out.withColumn("copy", F.explode(F.sequence(start, F.least(F.col(n), start + RUN) - 1))).withColumn("copy", F.col("copy").cast("int"))
    out = out.drop(s, cdf, draws, n, run).withColumn(order, F.xxhash64(F.lit(seed), F.col(doc_id), key, F.col("copy")))
    return out.repartition(F.col(order)).sortWithinPartitions(order).drop(order)


ORACLE = f"""
WITH n AS (SELECT source, COUNT(*) AS rows_, pow(CAST(COUNT(*) AS DOUBLE), {EXPONENT}) AS target FROM documents GROUP BY ALL),
m AS (SELECT source, target / (SELECT SUM(target) FROM n) * CAST((SELECT SUM(rows_) FROM n) AS DOUBLE) / rows_ AS mean FROM n),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(0, 700)),
p AS (SELECT source, mean, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p FROM m, k WHERE k <= mean + 12 * sqrt(mean) + 20),
c AS (SELECT source, mean, k, SUM(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
d AS (SELECT doc_id, source, CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents)
SELECT d.doc_id, d.source, CAST(c.k AS BIGINT) AS copy FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source AND c.cdf <= d.u
"""

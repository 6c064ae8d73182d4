"""Operator 9, quality rules: base rules on words and lines, then a hashed n-gram log-likelihood ratio.

Method. Word n-grams of ORDERS are hashed into a fixed number of buckets. Over all documents the buckets are counted twice, for
the trusted target (documents labelled good and not toxic) and for the whole raw corpus. With additive smoothing the
two counts make two multinomials; a document's score is the mean over its n-grams of the log ratio of the two. Every
document is held against one fixed threshold. Weights are fixed-point integers, so a sum does not depend on its order.
``fit`` counts every row. ``fit_once``, which the query and the pipeline use, counts copies as one text: equal texts share
the weight 1 (trusted if any of them is), and so do near copies, which are texts with two equal of MINS min-hashes over
windows of three words. A text takes the largest of its groups. So a clean text does not lose by its own copies.
DataFrame functions only: the weights are one array (``buckets`` numbers of 4 bytes, a bound that no input moves) in a
scalar subquery, and no row leaves the JVM.

Cases. Null or empty text: no words, base_failed, not kept. A text with no n-gram has the score 0. No
trusted document at all: every score is 0. Repeated rows are judged each. Null doc_id: judged, but never trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BLANKS, fresh, let, materialize, small_side, words_of

#: Hash buckets of the two multinomials, a power of two.
BUCKETS = 1 << 20
#: Orders of the n-grams.
ORDERS = (1, 2)
#: Added to each bucket's count in the raw corpus, and to its count in the target brought to the same size.
SMOOTHING = 10.0
#: A document is kept from this mean log ratio on.
THRESHOLD = -0.3
#: Weights are integers: log ratios times this.
SCALE = 1 << 20
#: Numbers that turn a window's hash into the hashes whose least values are compared to find near copies.
MINS = tuple((6364136223846793005 * k + 1442695040888963407) % (1 << 62) for k in (3, 10, 41, 172, 693, 2784))
#: The weight of one text, shared by its copies.
UNIT = 1 << 30


def ngrams(hashes: Column, n: Column, order: int) -> Column:
    """Hashes of the n-grams of this order, from an array of word hashes of size ``n``: word k counts shifted by k bits."""
    out = hashes
    for k in range(1, order):
        out = F.zip_with(out, F.slice(hashes, F.lit(k + 1), F.greatest(n - k, F.lit(0))), lambda a, b: a.bitwiseXOR(F.shiftleft(b, k)))  # noqa: B023
    return out if order == 1 else F.slice(out, F.lit(1), F.greatest(n - (order - 1), F.lit(0)))


def bucket(gram: Column, buckets: int) -> Column:
    return gram.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")


def hashes_of(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")


def repeated_words(windows: Column) -> Column:
    """How many words stand in a window of three that the text has twice or more, the first one included.

    ``windows`` has a hash for each window. Most texts repeat none, which one hash set tells; the others sort theirs.
    """
    ranked = F.array_sort(F.transform(windows, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    same = lambda s, x, j: F.coalesce(F.get(s, j)["k"] == x["k"], F.lit(False))
    twice = let(ranked, lambda s: F.filter(s, lambda x, j: same(s, x, j + 1) | ((j > 0) & same(s, x, F.greatest(j - 1, F.lit(0))))))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last"))
    covered = F.aggregate(starts, zero, step, lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered).cast("long")


def trusted_ids(labels: DataFrame) -> DataFrame:
    trusted = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return small_side(materialize(trusted.select(F.col("doc_id").alias("_trusted_id")).distinct(), "trusted"))[0]


def all_grams(hashes: Column, orders: tuple[int, ...]) -> Column:
    return F.concat(*[ngrams(hashes, F.size(hashes), k) for k in orders]) if len(orders) > 1 else ngrams(hashes, F.size(hashes), orders[0])


def log_ratios(counts: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """One row with ``weights`` from ``_b``, ``raw`` and ``target``."""
    counts = materialize(counts, "llr-counts")  # a row a bucket
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0.0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0.0)).alias("target")).first()
    # smoothing is in proportion to the two sizes, so that equal shares have the log ratio 0 however small the corpus is
    scale = float(total.raw) / float(total.target) if total.target else 0.0
    ratio = F.log((F.coalesce("target", F.lit(0.0)) * F.lit(scale) + F.lit(smoothing)) / (F.coalesce("raw", F.lit(0.0)) + F.lit(smoothing)))
    weight = F.round(ratio * SCALE).cast("int") if total.target else F.lit(0)
    full = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_b")).join(counts, "_b", "left").select(F.struct("_b", weight.alias("w")).alias("c"))
    # one group of exactly ``buckets`` rows
    return materialize(full.groupBy().agg(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["w"]).alias("weights")), "llr-weights")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row with ``weights``, an array of ``buckets`` integers: SCALE times ln(target share / raw share). Counts every row."""
    words = docs.select(F.col(doc_id).alias("_id"), hashes_of(F.col(text)).alias("_hashes"))
    marked = words.join(trusted_ids(labels), F.col("_id") == F.col("_trusted_id"), "left").select((F.col("_trusted_id").isNotNull()).alias("_target"), "_hashes")
    grams = marked.select("_target", F.explode(all_grams(F.col("_hashes"), orders)).alias("_g")).select("_target", bucket(F.col("_g"), buckets).alias("_b"))
    counts = grams.groupBy("_b").agg(F.count(F.lit(1)).alias("raw"), F.count_if("_target").alias("target"))
    return log_ratios(counts.select("_b", F.col("raw").cast("double"), F.col("target").cast("double")), buckets, smoothing)


def copy_weights(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``_digest``, ``_raw`` and ``_target``: the weights of each row of a text that is trusted or has copies, in 1 / UNIT."""
    least = [f"_m{k}" for k in range(len(MINS))]
    rows = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_digest"), hashes_of(F.col(text)).alias("_hashes"))
    rows = rows.select("_id", "_digest", ngrams(F.col("_hashes"), F.size("_hashes"), 3).alias("_windows"))
    # a text of under three words has no window and is a near copy of none
    rows = rows.select("_id", "_digest", *[F.coalesce(F.array_min(F.transform("_windows", lambda w: w.bitwiseXOR(F.lit(x)))), "_digest").alias(m) for m, x in zip(least, MINS, strict=True)])  # noqa: B023
    rows = rows.join(trusted_ids(labels), F.col("_id") == F.col("_trusted_id"), "left")
    texts = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_rows"), F.max(F.col("_trusted_id").isNotNull()).alias("_good"), *[F.min(m).alias(m) for m in least])
    texts = materialize(texts, "quality-texts")
    pairs = F.array(*[F.xxhash64(F.lit(i), F.lit(j), least[i], least[j]) for j in range(len(MINS)) for i in range(j)])
    keys = texts.select("_digest", "_good", F.explode(pairs).alias("_key"))
    groups = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_good").alias("_n_good")).where("_n > 1")
    groups, _ = small_side(materialize(groups, "quality-copies"))
    sizes = keys.select("_digest", "_key").join(groups, "_key").groupBy("_digest").agg(F.max("_n").alias("_n"), F.max("_n_good").alias("_n_good"))
    weight = lambda n: F.greatest(F.lit(1).cast("long"), F.round(F.lit(float(UNIT)) / F.col("_rows") / F.coalesce(n, F.lit(1))).cast("long"))
    out = texts.join(sizes, "_digest", "left").where((F.col("_rows") > 1) | F.col("_good") | F.col("_n").isNotNull())
    return materialize(out.select("_digest", weight(F.col("_n")).alias("_raw"), F.when(F.col("_good"), weight(F.col("_n_good"))).otherwise(F.lit(0).cast("long")).alias("_target")), "quality-weights")


def fit_once(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, smoothing: float = SMOOTHING) -> DataFrame:
    """Like ``fit``, but the copies and near copies of a text count as one text."""
    side, _ = small_side(copy_weights(docs, labels, text, doc_id))
    rows = docs.select(F.xxhash64(F.col(text)).alias("_of"), F.col(text).alias("_text")).join(side, F.col("_of") == F.col("_digest"), "left")
    rows = rows.select(F.coalesce("_raw", F.lit(UNIT).cast("long")).alias("_raw"), F.coalesce("_target", F.lit(0).cast("long")).alias("_target"), hashes_of(F.col("_text")).alias("_hashes"))
    grams = rows.select("_raw", "_target", F.explode(all_grams(F.col("_hashes"), orders)).alias("_g")).select("_raw", "_target", bucket(F.col("_g"), buckets).alias("_b"))
    counts = grams.groupBy("_b").agg((F.sum("_raw") / F.lit(float(UNIT))).alias("raw"), (F.sum("_target") / F.lit(float(UNIT))).alias("target"))
    return log_ratios(counts, buckets, smoothing)


def judge(docs: DataFrame, model: DataFrame, text: str = "text", buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr_score and kept.

    Columns of ``docs`` with one of these names are replaced.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr_score", "kept"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in own and c.lower() != text.lower()])
    words, hashes, lines, weights, total, windows, grams = fresh(docs, "_words", "_hashes", "_lines", "_weights", "_total", "_windows", "_grams")
    there = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({words: words_of(F.col(text)), lines: F.filter(F.split(there, "\n", -1), lambda x: F.ltrim(x, F.lit(BLANKS)) != "")})
    out = out.withColumns({"n_words": F.size(words).cast("long"), "word_chars": F.length(F.array_join(words, "")).cast("long"), "n_symbols": symbols(there), "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"), hashes: F.transform(words, lambda w: F.xxhash64(w))})
    h, n = F.col(hashes), F.size(hashes)
    out = out.withColumn(windows, ngrams(h, n, 3))
    out = out.withColumn("n_repeat_words", repeated_words(F.col(windows))).drop(windows)
    # read once and by nothing else, the weights are put into the sum by the optimizer, and no row carries a copy of them
    out = out.withColumn(weights, model.scalar())
    summed = let(F.col(weights), lambda w: F.aggregate(all_grams(h, orders), F.lit(0).cast("long"), lambda acc, g: acc + F.get(w, bucket(g, buckets))))
    count = sum((F.greatest(n - (k - 1), F.lit(0)) for k in orders), F.lit(0))
    out = out.withColumns({total: summed, grams: count}).drop(weights)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    score = F.when(F.col(grams) > 0, F.col(total) / SCALE / F.col(grams)).otherwise(F.lit(0.0))
    out = out.withColumns({"base_failed": failed, "llr_score": score})
    # The id makes no difference to the verdict; it keeps filters on the verdict above this projection. Pushed below it, a
    # filter would repeat every expression that the verdict stands on, words inside lambdas included.
    here = F.monotonically_increasing_id() >= 0
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr_score") >= threshold) & here).drop(words, hashes, lines, total, windows, grams)


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    inner = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), F.col("text").alias("text"))
    return judge(inner, fit_once(docs, labels)).where("kept").select("_row.*")

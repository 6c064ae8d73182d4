"""Operator 12, importance resampling towards a target distribution, on hashed n-grams.

Method. The features of a text are its runs of 1 to ``ORDERS`` words, and a feature's bucket is the CRC-32 of its bytes modulo
``BUCKETS``. The checksums are made for all features of a batch at once. A checksum is linear over the bytes: byte b at
distance d from the end of a span gives ``contributions()[d][b]``, whatever else is in the span, and the span's length
gives a constant. So bytes and distances of all spans index one table, and ``bitwise_xor.reduceat`` over the spans does
the rest. A span longer than the table is cut into blocks from its end; each block is summed alone and moved to its
place by the doubling tables of ``shift``. A bucket's gain is the log ratio of its shares in the target and in the
corpus, a document's weight the sum of the gains of its features. Adding Gumbel noise, seeded by the document's id, and
taking the highest scores draws documents without replacement, in proportion to their importance.

Scale. Counts are summed inside each task before the shuffle, at most ``BUCKETS`` rows a task; gains are one bounded array. Texts
are read twice, once to count and once to weigh, with no shuffle of either. Only numbers are sorted, by ranges: the
drawn rows are numbered through the ranges' sizes. Memory is bounded by the bytes gathered at once (``GATHER``), so
one very long text is worked off in parts.

Cases. Null and wordless texts have no features, weight 0, and are not eligible. Null ids are seeded as the empty text.
Repeated rows are counted, weighed and drawn each; among equal scores the smaller doc_id goes first, nulls last, and equal
ids in any order. An empty corpus gives an empty result, an empty target gains from smoothing alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import materialize

#: Hash buckets, the longest run of words, words that an eligible document has, the share drawn (in hundredths), the seed.
BUCKETS, ORDERS, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Bytes from the end of a span that the table covers; longer spans are folded in blocks of as many.
DEPTH = 256
#: Bytes of spans gathered at once, and bytes of text normalised at once.
GATHER, AT_ONCE = 1 << 21, 1 << 20
POLYNOMIAL = 0xEDB88320


@lru_cache(maxsize=1)
def contributions() -> np.ndarray:
    """[d, b]: what byte b gives to the register if d bytes follow it."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    out = np.empty((DEPTH, 256), np.uint32)
    out[0] = step
    for d in range(1, DEPTH):
        out[d] = (out[d - 1] >> 8) ^ step[out[d - 1] & 255]
    return out


@lru_cache(maxsize=1)
def lengths() -> np.ndarray:
    """The checksum of n zero bytes, n to DEPTH: the constant of a span of that length."""
    return np.array([zlib.crc32(bytes(n)) for n in range(DEPTH + 1)], np.uint32)


def through(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    """A linear map of registers, given by its value for each byte at each of the four places."""
    return table[0][register & 255] ^ table[1][register >> 8 & 255] ^ table[2][register >> 16 & 255] ^ table[3][register >> 24]


@lru_cache(maxsize=64)
def shift(power: int) -> np.ndarray:
    """The map that passes a register over 2**power zero bytes."""
    places = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    if power:
        half = shift(power - 1)
        return np.stack([through(half, through(half, x)) for x in places])
    step = contributions()[0]
    return np.stack([(x >> 8) ^ step[x & 255] for x in places])


def passed_over(register: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Registers after as many zero bytes each."""
    for power in range(int(zeros.max(initial=0)).bit_length()):
        register = np.where(zeros >> power & 1, through(shift(power), register), register)
    return register


def summed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The linear part of each span of at least one and at most DEPTH bytes."""
    size = end - start
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int32)
    # position = at + (start - first); distance = end - 1 - position
    position = at + np.repeat((start - first).astype(np.int32), size)
    index = (np.repeat((end - 1).astype(np.int32), size) - position) * 256 + data[position]
    return np.bitwise_xor.reduceat(contributions().reshape(-1)[index], first)


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data`` (bytes); spans are not empty and may overlap."""
    out = np.empty(len(start), np.uint32)
    size = end - start
    short = np.flatnonzero(size <= DEPTH)
    cuts = np.searchsorted(np.cumsum(size[short]), np.arange(1, int(size[short].sum()) // GATHER + 1) * GATHER)
    for part in np.split(short, cuts):
        if len(part):
            out[part] = summed(data, start[part], end[part]) ^ lengths()[size[part]]
    for k in np.flatnonzero(size > DEPTH):
        whole = np.uint32(0)  # blocks of one long span, from its end
        last = np.arange(int(end[k]), int(start[k]), -DEPTH)
        for part in np.split(last, np.arange(GATHER // DEPTH, len(last), GATHER // DEPTH)):
            blocks = summed(data, np.maximum(part - DEPTH, start[k]), part)
            whole ^= np.bitwise_xor.reduce(passed_over(blocks, end[k] - part))
        ones = np.array([0xFFFFFFFF], np.uint32)
        constant = passed_over(ones, size[k : k + 1])[0] ^ np.uint32(0xFFFFFFFF)
        out[k] = whole ^ constant
    return out


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words with one blank after each, in one array of bytes; each word's start and end there, and its text's number."""
    sizes = np.array([len(x) + 1 for x in texts], np.int64)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8).copy()
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    inside = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    before = np.concatenate([[False], inside[:-1]])
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    number = np.repeat(np.arange(len(texts)), sizes)[begins]
    keep = inside | before  # the words, and what follows each
    data[~inside] = 32
    place = np.cumsum(keep) - 1
    return data[keep], place[begins], place[ends], number


def runs(start: np.ndarray, end: np.ndarray, number: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of ``order`` words in a row within one text, and the text's number."""
    last = len(start) - order + 1
    if last <= 0:
        return start[:0], end[:0], number[:0]
    same = number[:last] == number[order - 1 :]
    return start[:last][same], end[order - 1 :][same], number[:last][same]


def features(texts: list[bytes], orders: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and bucket of each feature, order by order."""
    data, start, end, number = words_of(texts)
    for order in range(1, orders + 1):
        low, high, whose = runs(start, end, number, order)
        yield whose, checksums(data, low, high) % np.uint32(buckets)


def groups(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8, AT_ONCE bytes or one text at a time, with the number of the first."""
    held, first, size = [], 0, 0
    for k, x in enumerate(column.cast(pa.large_binary())):
        text = x.as_py() or b""
        if held and size + len(text) > AT_ONCE:
            yield first, held
            held, first, size = [], k, 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def bucket_counts(docs: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n, the features in it, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, held in groups(batch.column(0)):
                for _, found in features(held, orders, buckets):
                    total += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["bucket", "n"])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket and gain of every bucket, from the counts of both sides."""
    sides = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    counts = materialize(sides.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "gain-counts")  # a row a bucket
    total = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    real = lambda c, k: F.col(c).cast("double") + F.lit(float(k))
    ratio = real("t", 1) * real("all_s", buckets) / (real("s", 1) * real("all_t", buckets))
    return counts.crossJoin(F.broadcast(total)).select("bucket", F.floor(F.log(ratio) * 1000.0).alias("gain"))  # one row beside


def weigh(docs: DataFrame, gain: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with n_words, n_features and weight. Columns of ``docs`` with one of these names are replaced."""
    own = ["n_words", "n_features", "weight"]
    kept = docs.drop(*[c for c in docs.columns if c.lower() in own and c.lower() != text.lower()])
    at = [c.lower() for c in kept.columns].index(text.lower())
    by_bucket = np.zeros(buckets, np.int64)
    for row in gain.limit(buckets).collect():  # a row a bucket
        by_bucket[row.bucket] = row.gain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            out = np.zeros((3, n), np.int64)
            for first, held in groups(batch.column(at)):
                here = out[:, first : first + len(held)]
                for order, (whose, found) in enumerate(features(held, orders, buckets)):
                    many = np.bincount(whose, minlength=len(held))
                    here[0] += many if order == 0 else 0
                    here[1] += many
                    if len(whose):  # whole numbers, summed as such
                        sums = np.concatenate([[0], np.cumsum(by_bucket[found])])
                        ends = np.cumsum(many)
                        here[2] += sums[ends] - sums[ends - many]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out)], [*batch.schema.names, *own])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", n_words long, n_features long, weight long"
    return kept.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * standard Gumbel noise), which only the seed and the id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def draw(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, orders: int = ORDERS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (1 is the highest score drawn; null if not drawn) of every row."""
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, text, orders, buckets), bucket_counts(target, target_text, orders, buckets), buckets)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    weighed = weigh(rows, gain, "text", orders, buckets).drop("text")
    scored = weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"), F.monotonically_increasing_id().alias("_row"))
    scored = materialize(scored, "importance-scores")
    eligible = scored.where(F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    # one sort by ranges; a row's number in its range comes from the sorted range itself, so nothing is shuffled again
    sorted_rows = eligible.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    sorted_rows = materialize(sorted_rows, "importance-order")
    sizes = {r["range"]: r.n for r in sorted_rows.groupBy(F.shiftright("_at", 33).alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a range
    before, seen = [], 0
    for k in sorted(sizes):
        before.append((k, seen))
        seen += sizes[k]
    offsets = F.broadcast(spark.createDataFrame(before, "_range long, _before long"))  # a row a range
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = sorted_rows.withColumn("_range", F.shiftright("_at", 33)).join(offsets, "_range").withColumn("rank", number)
    most = percent * seen // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    here = ranked.select(*columns, F.when(F.col("rank") <= most, F.col("rank")).alias("rank"))
    others = scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return here.unionByName(others)


#: The draw in SQL: the checksum of a feature is the XOR of a table's values for its bytes by their distance from the end.
ORACLE = f"""WITH RECURSIVE step AS (
        SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END) AS c FROM range(256) t(b)),
    texts AS (SELECT *, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM (SELECT 0 AS side, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark)),
    grams AS (SELECT side, id, len(w) AS n_words, flatten([list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' ')) FOR n IN range(1, {ORDERS} + 1)]) AS g FROM texts),
    each AS (SELECT side, id, unnest(g) AS g FROM grams),
    names AS (SELECT g, octet_length(encode(g)) AS size FROM each GROUP BY g),
    bytes AS (SELECT g, size, unnest(range(size)) AS pos FROM names),
    table_of AS (SELECT 0 AS d, b, c FROM step UNION ALL SELECT d + 1, t.b, xor(t.c // 256, step.c) FROM table_of t JOIN step ON step.b = t.c % 256 WHERE d < (SELECT max(size) FROM names)),
    zeros AS (SELECT 0 AS n, CAST(4294967295 AS BIGINT) AS r UNION ALL SELECT n + 1, xor(z.r // 256, step.c) FROM zeros z JOIN step ON step.b = z.r % 256 WHERE n < (SELECT max(size) FROM names)),
    crc AS (SELECT g, any_value(size) AS size, bit_xor(c) AS c FROM (SELECT g, size, size - 1 - pos AS d, CAST('0x' || hex(encode(g))[pos * 2 + 1 : pos * 2 + 2] AS INTEGER) AS b FROM bytes) JOIN table_of USING (d, b) GROUP BY g),
    bucket_of AS (SELECT g, xor(c, xor(r, 4294967295)) % {BUCKETS} AS bucket FROM crc JOIN zeros ON n = size),
    counts AS (SELECT b AS bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM range({BUCKETS}) r(b) LEFT JOIN (SELECT side, bucket FROM each JOIN bucket_of USING (g)) ON b = bucket GROUP BY b),
    gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + {BUCKETS}.0::DOUBLE) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + {BUCKETS}.0::DOUBLE)))) AS BIGINT) AS gain FROM counts),
    weights AS (SELECT id, sum(gain) AS weight FROM each JOIN bucket_of USING (g) JOIN gain USING (bucket) WHERE side = 0 GROUP BY id),
    scored AS (SELECT id AS doc_id, n_words, CAST(len(g) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || sha256('{SEED}:' || id)[1:8]) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM grams LEFT JOIN weights USING (id) WHERE side = 0),
    ranked AS (SELECT *, CASE WHEN n_words >= {LEAST_WORDS} THEN row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS n FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank FROM ranked"""

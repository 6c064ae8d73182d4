"""Operator 2, substring dedup by content-defined chunks.

Method. A gear rolling hash over the text's UTF-8 bytes cuts where its low 16 bits, which see the last 16 bytes only, are
small; a cut with another candidate in the LEAST bytes before it is skipped. Both rules are local, so inserting text
moves no cut but those beside it. Where no cut is within NEAR bytes on either side, the places with the least hash of
the NEAR bytes on either side are cuts too, by content again; ties (text with a period) all count, at LEAST bytes from
each other. Chunks are compared by digest: the document with
the least doc_id that has a chunk keeps it, everywhere else it is a repeat. Runs of adjoining repeats with WORDS words
or more are repeated passages (a passage loses some words at its ends, where chunks straddle them).

Scale. First digests are counted with map-side aggregation; then the chunks whose digest has two documents or more are
found by a join on the digest (large partitions are split by Spark), and runs are formed by document. No text is
shuffled but by ``remove``, and there only by document.

Cases. Ids are whole numbers from 0 to NONE, or null; other kinds are refused. Null and empty texts have no chunks. Rows with one doc_id are one document; each text without a doc_id is a
document of its own, numbered from NONE on by its hash, after all others. Repeats inside one document are no repeats across documents and stay. Empty tables work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import fresh, materialize

#: One position in EVERY is a candidate to cut; least bytes of a chunk; bytes that chunks of such text as ``a`` repeated
#: do not pass; bytes on either side that a cut by the least hash sees; words of a passage.
EVERY, LEAST, MOST, NEAR = 20, 8, 256, 32
WORDS = 25
#: Numbers from here on stand for documents without doc_id; doc_ids are below.
NONE = 1 << 62


def gear_table() -> np.ndarray:
    """256 numbers of 16 bits by a rule: the middle bits of a linear congruential sequence."""
    x, out = 88172645463325252, []
    for _ in range(256):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append((x >> 33) & 0xFFFF)
    return np.array(out, dtype=np.uint16)


GEAR = gear_table()


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum of GEAR[byte k back] << k, in 16 bits, so of the last 16 bytes."""
    h = GEAR[data]
    for span in (1, 2, 4, 8):
        older = np.zeros_like(h)
        older[span:] = h[:-span] << np.uint16(span)
        h = h + older
    return h


def least_around(h: np.ndarray) -> np.ndarray:
    """The least hash of the NEAR bytes on either side of each byte."""
    low = np.concatenate([np.full(NEAR, 65535, np.uint16), h, np.full(NEAR, 65535, np.uint16)])
    span = 1
    while 2 * span <= 2 * NEAR + 1:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = 2 * NEAR + 1 - span
    return np.minimum(low[: len(low) - rest], low[rest:])


def cuts(data: np.ndarray) -> np.ndarray:
    """Where chunks of one text end, the last at its end."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    h = gear(data)
    spots = np.flatnonzero(h < np.uint16(65536 // EVERY)) + 1
    spots = spots[(spots >= 16) & (spots < n)]
    spots = spots[np.diff(spots, prepend=-LEAST - 1) > LEAST] if len(spots) else spots
    edges = np.concatenate([[-NEAR], spots, [n + NEAR]])
    if np.diff(edges).max() > 2 * NEAR:
        low = np.flatnonzero(h == least_around(h)) + 1
        low = low[(low >= 16) & (low < n)]
        after = np.searchsorted(edges, low)
        low = low[(edges[after] - low > NEAR) & (low - edges[after - 1] > NEAR)]
        if len(low) > 1 and np.diff(low).min() <= LEAST:
            # in a text with a period, each choice of every k-th tie gives equal chunks
            taken, last = [], -LEAST - 1
            for k in low.tolist():
                if k - last > LEAST:
                    taken.append(k)
                    last = k
            low = np.array(taken, np.int64)
        spots = np.union1d(spots, low)
    return np.append(spots, n)


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, row, digest, start, length and words (word starts) of each chunk."""
    from xxhash import xxh3_64_intdigest

    for batch in batches:
        docs, rows, digests, starts, lengths, words = [], [], [], [], [], []

        def flush() -> pa.RecordBatch:
            made = [pa.array(np.concatenate(x) if x else np.zeros(0), t) for x, t in ((docs, pa.int64()), (rows, pa.int64()), (digests, pa.int64()), (starts, pa.int64()), (lengths, pa.int32()), (words, pa.int32()))]
            for x in (docs, rows, digests, starts, lengths, words):
                x.clear()
            return pa.RecordBatch.from_arrays(made, ["doc", "row", "digest", "start", "length", "words"])

        held = 0
        for doc, row, text in zip(batch.column("doc").to_pylist(), batch.column("row").to_pylist(), batch.column("text"), strict=True):
            raw = (text.as_py() or "").encode()
            data = np.frombuffer(raw, np.uint8)
            ends = cuts(data)
            if not len(ends):
                continue
            begin = np.append(0, ends[:-1])
            space = (data == 32) | ((data >= 9) & (data <= 13))
            word = ~space
            word[1:] &= space[:-1]
            docs.append(np.full(len(ends), doc, np.int64))
            rows.append(np.full(len(ends), row, np.int64))
            digests.append(np.array([xxh3_64_intdigest(raw[a:b]) for a, b in zip(begin.tolist(), ends.tolist(), strict=True)], np.uint64).view(np.int64))
            starts.append(begin)
            lengths.append(ends - begin)
            words.append(np.add.reduceat(word.astype(np.int64), begin))
            held += len(ends)
            if held > 500_000:
                yield flush()
                held = 0
        yield flush()


def number_of(doc_id: Column, text: Column) -> Column:
    """The doc_id, or for a null one a number from NONE on that its text decides."""
    return F.coalesce(doc_id.cast("long"), F.xxhash64(text).bitwiseAND(F.lit(NONE - 1)) + F.lit(NONE))


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    if docs.schema[doc_id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{doc_id} must be a whole number, as the first document of a passage is the least of them")
    rows = docs.select(number_of(F.col(doc_id), F.col(text)).alias("doc"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(chunk_rows, "doc long, row long, digest long, start long, length int, words int")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """A row a repeated passage: doc_id, row (a hash of the text), start and length in bytes, n_words and first_doc_id.

    first_doc_id is the document that keeps most of the passage's chunks, the least of them in a tie.
    """
    every = chunks(docs, doc_id, text)
    shared = every.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where(F.col("first") < F.col("last")).select("digest", "first")
    shared = materialize(shared, "shared-chunks")  # a plain side of the join, whose hot digests Spark can then split
    found = every.join(shared, "digest").where(F.col("doc") != F.col("first")).select("doc", "row", "start", "length", "words", "first")
    found = found.groupBy("doc", "row", "start").agg(F.max("length").alias("length"), F.max("words").alias("words"), F.min("first").alias("first"))  # equal rows
    own = Window.partitionBy("doc", "row").orderBy("start")
    fresh_run = F.coalesce(F.col("start") != F.lag(F.col("start") + F.col("length")).over(own), F.lit(True))
    runs = found.withColumn("begins", fresh_run.cast("int")).withColumn("run", F.sum("begins").over(own))
    spans = runs.groupBy("doc", "row", "run").agg(F.min("start").alias("start"), F.sum("length").alias("length"), F.sum("words").alias("n_words"), F.mode("first", True).alias("first_doc_id"))
    known = lambda c: F.when(F.col(c) < NONE, F.col(c))
    return spans.where(F.col("n_words") >= words).select(known("doc").alias("doc_id"), "row", "start", "length", "n_words", known("first_doc_id").alias("first_doc_id"))


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` without their repeated passages, and the number of bytes removed, ``removed_bytes``."""
    spans = materialize(repeats(docs, doc_id, text, words), "passages")
    row, key, spans_, old, mine, its = fresh(docs, "_row", "_key", "_spans", "_old", "_mine", "_its")
    by = spans.groupBy(F.col("doc_id").alias(key), F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias(spans_))
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "removed_bytes"])
    same = F.col(mine).eqNullSafe(F.col(key)) & (F.col(its) == F.col(row))
    joined = docs.withColumns({mine: F.col(doc_id).cast("long"), its: F.xxhash64(F.col(text))}).join(by, same, "left")

    @F.pandas_udf("struct<text:string,removed:long>")
    def without(texts, spans_of):
        import pandas as pd

        out, removed = [], []
        for value, cuts_ in zip(texts, spans_of, strict=True):
            raw, at, parts = (value or "").encode(), 0, []
            for s in cuts_ if cuts_ is not None else ():
                start, end = s["start"], s["start"] + s["length"]
                while start < end and raw[start] & 0xC0 == 0x80:  # whole characters only
                    start += 1
                while end < len(raw) and end > start and raw[end] & 0xC0 == 0x80:
                    end -= 1
                parts.append(raw[at:start])
                at = end
            parts.append(raw[at:])
            left = b"".join(parts)
            out.append(None if value is None else left.decode())
            removed.append(len(raw) - len(left))
        return pd.DataFrame({"text": out, "removed": removed})

    changed = joined.withColumn(old, without(F.col(text), F.col(spans_)))
    return changed.withColumns({text: F.col(old)["text"], "removed_bytes": F.col(old)["removed"]}).select(*docs.columns, "removed_bytes")

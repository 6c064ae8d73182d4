"""Operator 4, best-fit packing planned on the histogram of lengths.

Method. Texts become token ids and one closing id; longer ones are cut into pieces of the sequence length, the first
piece being the short one. Best-fit decreasing runs over the histogram: for each length from the longest down, the
pieces of that length go, many at a time, to the group of open sequences that they fill best. The plan says for each
run of ranks within a length which sequences and which offset they take; pieces get theirs by joining on their rank.

Scale. The driver sees the histogram, at most one row a length; the plan has at most a few rows a length, whatever the
input (each step uses up a length or a group of sequences, and a group is used at most length / piece times), so it
may be broadcast. Ranks within a length come from counts by (length, salt); a length has as many salts as its pieces
need, and a piece's salt comes from its number, so equal rows are dealt too. Tokens are made once; the pieces' numbers are written to the shared folder before the plan.

Cases. A null or empty text is the closing id alone. Repeated rows are packed each; equal rows are interchangeable.
Empty tables give an empty result. Texts are never cut before tokenizing.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import materialize

MAX_TOKENS = 2048
CLOSING_ID = 0
#: Pieces of one salt of a length, about.
PIECES_A_SALT = 50_000
#: The vocabulary, a file of the tokenizers library.
VOCABULARY = "byte_bpe_50k.json"
#: Where a text can be cut without a change of its ids: at a blank between two characters that are no white space. The
#: pre-tokenizer of the vocabulary has blanks only at the start of a piece, but for runs of white space. The blank
#: belongs to the unit after it, and is left out here.
UNITS = re.compile(r" (?<=[!-~\u00c0-\u024f] )(?=[!-~\u00c0-\u024f])")
#: Units whose ids a worker keeps, and the characters of the longest of them; characters that are coded at once.
KNOWN, LONGEST, AT_ONCE = 1_000_000, 64, 1_000_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=2)
def encoder(path: str):
    """One encoder a Python worker: from texts to their ids as little-endian bytes.

    All ids come from the tokenizers file as it is, special tokens included; units seen before are looked up.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    exact, known = Tokenizer.from_file(path), {}

    def ids_of(units: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in exact.encode_batch_fast(units, add_special_tokens=False)]

    def encode(texts: list[str]) -> list[bytes]:
        units = [UNITS.split(x) for x in texts]
        heads = ids_of([one.pop(0) for one in units])
        every: set[str] = set()
        for one in units:
            every.update(one)
        new = every.difference(known)
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = every
        order = list(new)
        known.update(zip(order, ids_of([" " + u for u in order]), strict=True))
        out = [b"".join([head, *map(known.__getitem__, one)]) for head, one in zip(heads, units, strict=True)]
        for u in order:
            if len(u) > LONGEST:
                del known[u]
        return out

    return encode


def coded(texts: pa.Array, encode) -> Iterator[tuple[int, np.ndarray]]:
    """Number of the row and ids of each text, AT_ONCE characters or one text at a time."""
    held, rows, size = [], [], 0
    for k in range(len(texts) + 1):
        if k == len(texts) or size > AT_ONCE:
            for row, ids in zip(rows, encode(held), strict=True):
                yield row, np.append(np.frombuffer(ids, "<u4"), np.array([CLOSING_ID], "<u4"))
            held, rows, size = [], [], 0
        if k < len(texts):
            held.append(texts[k].as_py() or "")
            rows.append(k)
            size += len(held[-1])


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """Start and length of each piece of n ids: the rest first, then whole pieces."""
    first = n % most or most
    return [(0, first), *((at, most) for at in range(first, n, most))]


def token_pieces(docs: DataFrame, doc_id: str, text: str, most: int, path: str | None, keep_ids: bool) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path or vocabulary_path())
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            keys = batch.column(0).to_pylist()
            for row, ids in coded(batch.column(1), encode):
                for k, (at, n) in enumerate(cut(len(ids), most)):
                    piece = ids[at : at + n]
                    for column, x in zip(out, (keys[row], k, at, n, zlib.crc32(piece.tobytes()), piece.tolist() if keep_ids else None), strict=True):
                        column.append(x)
            kinds = (batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out[: 6 if keep_ids else 5], kinds, strict=False)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if keep_ids else 5])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def best_fit(histogram: dict[int, int], most: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs (length, first rank, pieces, first sequence, offset).

    Piece number r of a run's pieces goes to sequence (first sequence + r).
    """
    plan, sequences = [], 0
    groups: dict[int, list[list[int]]] = {}  # free space: runs [first sequence, how many]
    spaces: list[int] = []  # the free spaces that have groups, sorted

    def put(space: int, first: int, many: int) -> None:
        if space and many:
            if space not in groups:
                groups[space] = []
                insort(spaces, space)
            groups[space].append([first, many])

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect_left(spaces, length)
            if k < len(spaces):
                space = spaces[k]
                first, many = groups[space].pop()
                if not groups[space]:
                    del groups[space], spaces[k]
            else:
                space, first, many = most, sequences, -(-left // (most // length))
                sequences += many
            each = space // length
            full = min(many, left // each)
            for j in range(each if full else 0):
                plan.append((length, rank, full, first, most - space + j * length))
                rank += full
            left -= full * each
            put(space - each * length, first, full)
            rest = many - full
            if rest and left:  # fewer than a sequence of this group holds: one sequence takes them
                take = min(left, each)
                for j in range(take):
                    plan.append((length, rank, 1, first + full, most - space + j * length))
                    rank += 1
                left -= take
                put(space - take * length, first + full, 1)
                full, rest = full + 1, rest - 1
            put(space, first + full, rest)
    return plan


PLAN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("plan_length", "first_rank", "pieces", "first_sequence", "offset")])


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MAX_TOKENS, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece (and ids)."""
    spark = docs.sparkSession
    pieces = token_pieces(docs, doc_id, text, most, vocabulary, keep_ids)
    pieces = materialize(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most a row a length
    salts = spark.createDataFrame([(k, -(-n // PIECES_A_SALT)) for k, n in histogram.items()], "length long, salts long")
    pieces = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("number"), F.col("salts")))
    counts = materialize(pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    plan = spark.createDataFrame(best_fit(histogram, most), PLAN)
    inside = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)  # a row for each PIECES_A_SALT pieces
    at = counts.select("length", "salt", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("at"))
    own = Window.partitionBy("length", "salt").orderBy("number")
    ranked = pieces.withColumn("own", F.row_number().over(own) - 1).join(at, ["length", "salt"]).withColumn("rank", F.col("at") + F.col("own"))
    here = (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("pieces"))
    placed = ranked.join(F.broadcast(plan), here)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset"]
    return placed.select(*columns, *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, at most the sequence length, from ``pack(..., keep_ids=True)``."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))

"""Operator 11, alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

Method. Each text, with a blank before it, is encoded by both tokenizers; a token's end is the byte at which it stops.
The ends of A and of B are two sorted lists. A batch of texts is one pair of lists (each text's ends follow those of the
text before), whose merge is cut along diagonals: the d-th piece starts where the first d * PIECE ends of the merge
stop, which a binary search along the diagonal finds for all pieces at once. So every piece merges as many ends, be it one
long text or many short ones, and pieces need nothing of each other; where a common end straddles a cut, its B half moves
to the piece on the left. A piece emits its overlaps: for each end of the merge, the A and the B token that lie before it, and
whether both stop there. Common ends close groups; a group that runs over a cut is stitched by numbering the groups of a
piece from the sum of the groups before. Tokens whose ranges end together are linked, one link a group. Corpus-wide each
pair of ids counts as often as it is linked.

Scale. Texts are encoded once; ids of units (text between blanks that neither tokenizer merges over) seen before are looked
up. What is stored is a row a document, with its distinct pairs and how often it has them. Pairs are counted with partial sums;
the table of pairs, at most vocabulary A times vocabulary B, is broadcast if its counted rows allow, else joined with the documents'
pairs under a salt, so that a pair which a third of all documents have is SALTS groups.

Cases. Null and empty texts, and texts whose A or B tokens do not spell them out (a character that B rewrites), have no
tokens: counts 0, digest ''. Strings of special tokens in a text are plain text. Repeated rows are aligned and counted
each. Null ids are kept as they are. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize, small_side
from .packing import UNITS, vocabulary_path

#: The vocabularies: A of the tokenizers library, byte-level, and B of sentencepiece.
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Ends that one piece of a merge has.
PIECE = 1 << 16
#: Units whose ids a worker keeps, and the characters of the longest of them; characters that are coded at once.
KNOWN, LONGEST, AT_ONCE = 400_000, 48, 1_000_000
#: Parts of a pair's rows where the table of pairs is too large to broadcast.
SALTS = 64


def printable_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoders:
    """Both tokenizers, the bytes of their tokens, and the ids of units seen before."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte, names = printable_bytes(), [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            names[k] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        spelled = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.spelling = [pa.array(x, pa.binary()) for x in (names, spelled)]
        self.size = [np.array(list(map(len, x)), np.int64) for x in (names, spelled)]
        # an id as text, followed by a comma, or by what closes its side of a group
        self.listed = pa.array([f"{k}{c}".encode() for n, close in ((len(names), "|"), (len(spelled), ";")) for c in (",", close) for k in range(n)], pa.binary())
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def __call__(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The A ids and the B ids of each text with a blank before it, as little-endian bytes."""
        units = [UNITS.split(x) for x in texts]
        every = set().union(*units) if units else set()
        new = [u for u in every if u not in self.known]
        if len(self.known) + len(new) > KNOWN:
            self.known.clear()
            new = list(every)
        a = [array("I", e.ids).tobytes() for e in self.a.encode_batch_fast([" " + u for u in new], add_special_tokens=False)]
        b = [array("I", x).tobytes() for x in self.b.encode(new, num_threads=1)] if new else []
        self.known.update(zip(new, zip(a, b, strict=True), strict=True))
        out = ([], [])
        for one in units:
            ids = [self.known[u] for u in one]
            out[0].append(b"".join([x for x, _ in ids]))
            out[1].append(b"".join([x for _, x in ids]))
        for u in new:
            if len(u) > LONGEST:
                del self.known[u]
        return out


@lru_cache(maxsize=2)
def encoders(a_path: str, b_path: str) -> Encoders:
    """One pair of tokenizers a Python worker."""
    return Encoders(a_path, b_path)


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of the merge of two sorted lists start in each of them; of equal ends A goes first."""
    d = np.arange(0, len(a) + len(b) + work, work)
    d[-1] = len(a) + len(b)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        open_ = low < high
        first = np.zeros(len(d), bool)
        first[open_] = a[mid[open_]] <= b[(d - 1 - mid)[open_]]
        low, high = np.where(open_ & first, mid + 1, low), np.where(open_ & ~first, mid, high)
    i, j = low, d - low
    tie = (i > 0) & (j < len(b))
    tie[tie] = a[i[tie] - 1] == b[j[tie]]
    return i, j + tie  # a common end that the cut runs through goes to the left whole


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps of one piece: A token, B token, and whether both stop at the overlap's end; numbers may be one past the piece."""
    ends = np.concatenate([a, b])
    ends.sort(kind="stable")
    ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])] if len(ends) else ends
    i, j = np.searchsorted(a, ends), np.searchsorted(b, ends)
    stops = lambda x, k: (k < len(x)) & (x[np.minimum(k, len(x) - 1)] == ends) if len(x) else np.zeros(len(ends), bool)
    return i, j, stops(a, i) & stops(b, j)


def links(a: np.ndarray, b: np.ndarray, work: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of A and of B that close each group, from the sorted ends of both, piece by piece."""
    i, j = diagonals(a, b, work)
    last_a, last_b = [], []
    for k in range(len(i) - 1):
        at_a, at_b, both = overlaps(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        last_a.append(i[k] + at_a[both])
        last_b.append(j[k] + at_b[both])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *last_a]), np.concatenate([none, *last_b])


def taken(table: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Offsets, and the joined bytes, of the entries with these numbers."""
    found = table.take(pa.array(ids))
    offsets, data = found.buffers()[1:]
    return np.frombuffer(offsets, np.int32, len(ids) + 1, found.offset * 4), memoryview(data).cast("B") if data else memoryview(b"")


class Aligned:
    """The alignment of a few texts: ids of both sides, where each text's tokens and groups start, and the tokens that close groups."""

    def __init__(self, texts: list[str], encode: Encoders, work: int = PIECE):
        wanted = [(" " + x).encode() if x else b"" for x in texts]
        sides = encode([x or "" for x in texts]) if texts else ([], [])
        good = np.array([bool(x) for x in texts], bool)
        for side, table in zip(sides, encode.spelling, strict=True):
            ids = [np.frombuffer(x, "<u4") if x else np.zeros(0, "<u4") for x in side]
            at, data = taken(table, np.concatenate(ids) if ids else np.zeros(0, "<u4"))
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            good &= np.array([data[at[starts[k]] : at[starts[k + 1]]] == w for k, w in enumerate(wanted)], bool)
        self.ids, self.starts, ends = [], [], []
        shift = np.concatenate([[0], np.cumsum(np.where(good, [len(x) for x in wanted], 0))]).astype(np.int64)
        for side, size in zip(sides, encode.size, strict=True):
            ids = [np.frombuffer(x, "<u4") if ok else np.zeros(0, "<u4") for x, ok in zip(side, good, strict=True)]
            self.ids.append(np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64))
            self.starts.append(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64))
            ends.append(np.cumsum(size[self.ids[-1]]))
        self.ends, self.bytes_before = ends, shift
        self.last = links(*ends, work)
        # the first group of each text: its tokens start where a group ends
        self.first_group = np.searchsorted(self.last[0], self.starts[0])

    def closes(self, side: int) -> np.ndarray:
        out = np.zeros(len(self.ids[side]), bool)
        out[self.last[side]] = True
        return out

    def digests(self, encode: Encoders) -> list[str]:
        """SHA-256 of each text's groups written out, '' without tokens."""
        n_a, n_b = (len(x) for x in encode.size)
        ends = [self.closes(0), self.closes(1)]
        group = [np.cumsum(e) - e for e in ends]  # the group of each token
        many = [np.bincount(g, minlength=len(self.last[0])) for g in group]
        before = [np.cumsum(m) - m for m in many]
        order = np.empty(len(self.ids[0]) + len(self.ids[1]), np.int64)
        # A tokens of a group stand before its B tokens
        order[np.arange(len(self.ids[0])) + before[1][group[0]]] = self.ids[0] + n_a * ends[0]
        order[np.arange(len(self.ids[1])) + before[0][group[1]] + many[0][group[1]]] = 2 * n_a + self.ids[1] + n_b * ends[1]
        at, data = taken(encode.listed, order)
        cuts = at[self.starts[0] + self.starts[1]]
        return [hashlib.sha256(data[low : high - 1]).hexdigest() if high > low else "" for low, high in zip(cuts[:-1], cuts[1:], strict=True)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked id pairs of each text (A id times 2**32 plus B id), how often it has each, and where each text's start."""
        linked = self.ids[0][self.last[0]] << 32 | self.ids[1][self.last[1]]
        text = np.repeat(np.arange(len(self.first_group) - 1), np.diff(self.first_group))
        order = np.lexsort((linked, text))
        linked, text = linked[order], text[order]
        new = np.concatenate([[True], (linked[1:] != linked[:-1]) | (text[1:] != text[:-1])]) if len(linked) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        return linked[at], np.diff(np.append(at, len(linked))), np.searchsorted(text[at], np.arange(len(self.first_group)))


def blocks(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts, AT_ONCE characters or one text at a time, with the number of the first."""
    held, first, size = [], 0, 0
    for k, x in enumerate(column):
        text = x.as_py()
        if held and size + len(text or "") > AT_ONCE:
            yield first, held
            held, first, size = [], k, 0
        held.append(text)
        size += len(text or "")
    if held:
        yield first, held


def paths(a_file: str, b_file: str) -> tuple[str, str]:
    return tuple(x if os.path.isabs(x) else vocabulary_path(x) for x in (a_file, b_file))


def aligned(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", a_file: str = A_FILE, b_file: str = B_FILE, work: int = PIECE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, and the distinct linked pairs with how often the document has each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoders(*paths(a_file, b_file))
        for batch in batches:
            for first, held in blocks(batch.column(1)):
                x = Aligned(held, encode, work)
                pair, times, starts = x.pairs()
                counts = [pa.array(np.diff(k)) for k in (*x.starts, x.first_group)]
                lists = [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(v)) for v in (pair, times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(held)), *counts, pa.array(x.digests(encode)), *lists], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>")


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", a_file: str = A_FILE, b_file: str = B_FILE, work: int = PIECE) -> DataFrame:
    """A row a group: doc_id, group (from 0), its bytes start and length in the text with its blank, a_ids and b_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoders(*paths(a_file, b_file))
        for batch in batches:
            for first, held in blocks(batch.column(1)):
                x = Aligned(held, encode, work)
                of = np.repeat(np.arange(len(held)), np.diff(x.first_group))
                ends = x.ends[0][x.last[0]]
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                keys = batch.column(0).slice(first, len(held)).take(pa.array(of))
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last + 1]).astype(np.int32)), pa.array(ids)) for last, ids in zip(x.last, x.ids, strict=True)]
                numbers = [np.arange(len(of)) - x.first_group[of], starts - x.bytes_before[of], ends - starts]
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, numbers), *lists], ["doc_id", "group", "start", "length", "a_ids", "b_ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, group long, start long, length long, a_ids array<long>, b_ids array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, n (links that hold it, corpus-wide) and best (no other pair with its B id has more), from ``aligned``."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = materialize(each.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b_id.alias("_b")).agg(F.max("n").alias("_most"))  # at most a row a token of B
    return materialize(counts.join(most, b_id == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "pair-best")


def align(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", a_file: str = A_FILE, b_file: str = B_FILE, work: int = PIECE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    rows = materialize(aligned(docs, text, doc_id, a_file, b_file, work).withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts, small = small_side(pair_counts(rows))
    each = rows.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("_row", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("times"))
    if small:
        found = each.join(counts, "pair")
    else:
        salted = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
        found = each.withColumn("_salt", F.pmod("_row", F.lit(SALTS)).cast("int")).join(salted, ["pair", "_salt"])
    sums = found.groupBy("_row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = rows.drop("pairs", "times").join(sums, "_row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", zero("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")

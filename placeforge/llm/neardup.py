"""Operator 10, near-duplicates by BagMinHash on multisets of word shingles.

Method. A text is the multiset of its runs of SHINGLE words (a shorter text: of all its words). Each (shingle, level)
has Poisson processes seeded by its hash alone; level j covers the weights from 2**(j-1) to 2**j with the rate of that
width, and a multiplicity that ends inside a level thins its points by their position there. Each point falls to a
random one of SIZE slots, and a slot keeps its earliest point: two texts agree in a slot with the probability of their
weighted Jaccard similarity. Points are drawn in order of time up to a horizon that fills all slots almost surely and
is doubled where it doesn't, so long texts cost little more than short ones. Slots are cut into BANDS; texts that share
a band are candidates; candidates are verified on their multisets, exactly but for 32-bit fingerprints of shingles.

Classes are the connected components of verified links of THRESHOLD or more. Equal word sequences are one node from the
start, so copies cost one row each. In each bucket all members are first compared with one centre, the member whose
buckets are the largest; what that links is merged. The members of a centre that are then still in different classes
are not compared pair by pair. Each is written as its difference from the kernel, the shingles that most of the centre's
members have. Of two members x and y the overlap follows from the sizes of their differences and the number of shingles
that the two differences share; for a similarity of THRESHOLD that number must be g(x) + g(y) at least, g being a number
of each member alone (``differences``). Where the sum is 0 or less, the two are linked, and so is each of them to the
member with the least g: one link a member says as much as all pairs. Else the two share a shingle of their
differences, and one among the rarest of them (a prefix as long as g allows); those pairs are joined on that shingle
and compared. Members that differ from the kernel by edits of their own, however many, share none and meet nobody.
No step loses a link between members of a bucket.

Scale. Texts are read twice and never shuffled in full: signatures are made where the text is, and multisets only of
nodes that have candidates. Hot buckets cost a row a member, and a row a shingle where they are of several classes.
Labels are merged by contracting the graph of links; every step is written to the shared folder, and nothing is
collected but counts.

Cases. Null texts and texts without words are one class. A null doc_id takes part; class_id is the least doc_id of the
class, null only if it has none. Repeated rows are one class. Nodes are 64-bit hashes of the word sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fresh, materialize, small_side, words_of

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 8
SIZE = BANDS * ROWS
#: Members of a centre that one copy of its kernel serves, in the join of the two; slack of comparisons of fractions.
PER_KERNEL = 5_000
SLACK = 1e-6

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x + U(0x9E3779B97F4A7C15)).astype(U)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1], from the upper bits."""
    return ((x >> U(11)).astype(np.float64) + 1.0) / float(1 << 53)


def bags(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, shingle and multiplicity, sorted by document and shingle, of documents given as ranges of word hashes."""
    n = ends - starts
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    end = np.repeat(ends, n)
    valid = (at + width <= end) | (at == np.repeat(starts, n))
    at, end, doc = at[valid], end[valid], doc[valid]
    value = np.zeros(len(at), U)
    for k in range(width):
        inside = at + k < end
        word = np.where(inside, hashes[np.minimum(at + k, len(hashes) - 1)], U(0)) if len(hashes) else value
        value = mix(value ^ word)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], value[first], np.diff(np.append(first, len(value)))


def signatures(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, docs: int, size: int = SIZE) -> np.ndarray:
    """BagMinHash: (docs, size) point times as 64-bit patterns; a document without items has zeros."""
    best = np.full((docs, size), np.inf)
    total = np.bincount(doc, weight, docs)
    horizon = np.divide(size * (np.log(size) + 3), total, out=np.zeros(docs), where=total > 0)
    todo = total > 0
    while todo.any():
        use = todo[doc]
        d, x, w, level = doc[use], item[use], weight[use], 0
        while len(d):
            low, rate = (0, 1.0) if level == 0 else (1 << (level - 1), float(1 << (level - 1)))
            seed, time = mix(x ^ mix(np.full(len(x), level, U))), np.zeros(len(x))
            pd, pw, ps = d, w, seed
            while len(pd):
                ps = mix(ps)
                time = time - np.log(uniform(ps)) / rate
                alive = time < horizon[pd]
                pd, pw, ps, time = pd[alive], pw[alive], ps[alive], time[alive]
                hit = mix(ps ^ U(0xA5A5A5A5A5A5A5A5))
                inside = low + rate * uniform(mix(hit)) <= pw if level > 1 else slice(None)
                slot = (hit % U(size)).astype(np.int64)
                np.minimum.at(best.reshape(-1), (pd * size + slot)[inside], time[inside])
            level += 1
            more = w > (1 << (level - 1))
            d, x, w = d[more], x[more], w[more]
        todo &= np.isinf(best).any(axis=1)
        horizon = np.where(todo, horizon * 2, horizon)
    best[total == 0] = 0
    return best.view(U)


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signature.shape[1] // bands
    parts = signature.reshape(len(signature), bands, rows)
    out = mix(np.broadcast_to(np.arange(bands, dtype=U), parts.shape[:2]))
    for k in range(rows):
        out = mix(out ^ parts[:, :, k])
    return out.view(np.int64)


def ranges_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat values as unsigned numbers, and starts and ends, of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False).view(U), offsets[:-1], offsets[1:]


def slices(column: pa.Array, most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a list column with about ``most`` values each, for bounded memory."""
    offsets = column.offsets.to_numpy()
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, len(column))
        at = min(to, len(column))


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("hashes")
        for a, b in slices(words):
            values, starts, ends = ranges_of(words[a:b])
            doc, item, weight = bags(values, starts, ends)
            signature = signatures(doc, item, weight, b - a)
            bands = band_hashes(signature)
            total = np.bincount(doc, weight, b - a).astype(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * BANDS, pa.array(bands.reshape(-1)))
            rest = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*(rest.column(c) for c in ("doc_id", "row", "node")), pa.array(total), lists], ["doc_id", "row", "node", "weight", "bands"])


def multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and bag: a 32-bit number for each (shingle, which occurrence), so that sets of them overlap like the multisets."""
    for batch in batches:
        words = batch.column("hashes")
        for a, b in slices(words):
            values, starts, ends = ranges_of(words[a:b])
            doc, item, weight = bags(values, starts, ends)
            nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            keys = (mix(np.repeat(item, weight) ^ mix(nth.astype(U))) >> U(32)).astype(np.uint32).view(np.int32)
            counts = np.bincount(doc, weight, b - a).astype(np.int64)
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.array(keys))
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(a, b - a), lists], ["node", "bag"])


def hashed_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, row (a hash of the text), hashes of the words, node (a hash of their sequence)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("row"), F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("hashes"))
    return rows.withColumn("node", F.xxhash64("hashes", F.size("hashes")))


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """node and label (the least node of its component) for the nodes of the links (a, b), by contraction.

    ``labels``: those of earlier links, which are kept and merged further.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = both(links).select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    if labels is not None:
        nodes = labels.unionByName(nodes.join(labels.select("node"), "node", "left_anti"))
    nodes = materialize(nodes, "labels")
    edges = links.select("a", "b") if labels is None else relabelled(links, labels, "node", "label")
    edges = materialize(edges.distinct(), "edges")
    while not edges.isEmpty():
        parent = materialize(both(edges).where("b < a").groupBy(F.col("a").alias("child")).agg(F.min("b").alias("parent")), "parents")
        while True:  # follow parents to the root; their depth halves each time
            up = parent.select(F.col("child").alias("c2"), F.col("parent").alias("p2"))
            further = parent.join(up, F.col("parent") == F.col("c2"), "left")
            further = materialize(further.select("child", F.coalesce("p2", "parent").alias("parent"), F.col("p2").isNotNull().alias("moved")), "parents")
            parent = further.select("child", "parent")
            if further.where("moved").isEmpty():
                break
        nodes = materialize(nodes.join(parent, F.col("label") == F.col("child"), "left").select("node", F.coalesce("parent", "label").alias("label")), "labels")
        edges = materialize(relabelled(edges, parent, "child", "parent").distinct(), "edges")
    return nodes


def relabelled(edges: DataFrame, names: DataFrame, old: str, new: str) -> DataFrame:
    """Edges between the new names of their ends (an end without one keeps its own), without loops."""
    left, right = names.select(F.col(old).alias("oa"), F.col(new).alias("na")), names.select(F.col(old).alias("ob"), F.col(new).alias("nb"))
    out = edges.join(left, F.col("a") == F.col("oa"), "left").join(right, F.col("b") == F.col("ob"), "left")
    return out.select(F.coalesce("na", "a").alias("a"), F.coalesce("nb", "b").alias("b")).where("a <> b")


def distances(pairs: DataFrame, bags_: DataFrame) -> DataFrame:
    """The pairs (a, b) with d, the weighted Jaccard distance of their multisets."""
    left, right = bags_.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), bags_.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", (F.lit(1.0) - common / (F.size("bag_a") + F.size("bag_b") - common)).alias("d"))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def several(members: DataFrame) -> DataFrame:
    """Of each centre with members of several labels: the number of members, the least ``g`` with its label, the least ``g`` of the other labels."""
    low = members.groupBy("centre").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("g", "label", "node")).alias("low"))
    low = materialize(low, "least")
    other = members.join(low, "centre").where(F.col("label") != F.col("low.label")).groupBy("centre").agg(F.min("g").alias("other_g"))
    return materialize(low.join(other, "centre"), "several")


def differences(members: DataFrame, bags_: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """centre, node, label, g and diff of the members (centre, node, label) of centres with several labels; and the shared shingles.

    With t = threshold / (1 + threshold), a kernel of k shingles, and a member that lacks r of them and has a others:
    g = (1 - t) r + t a - (1 - 2 t) k / 2. Two members have the similarity ``threshold`` if and only if their diffs, the
    shingles lacked or added, share g + g' shingles or more.
    """
    t = threshold / (1 + threshold)
    mixed = materialize(several(members.withColumn("g", F.lit(0.0))).select("centre", "m"), "mixed")
    members = materialize(members.join(mixed, "centre").join(bags_, "node"), "apart")
    counts = members.select("centre", "m", F.explode("bag").alias("shingle")).groupBy("centre", "shingle").agg(F.count(F.lit(1)).alias("n"), F.first("m").alias("m")).where("n > 1")
    counts = materialize(counts, "apart-shingles")
    kernels = counts.where("2 * n > m").groupBy("centre").agg(F.collect_list("shingle").alias("kernel"), F.first("m").alias("m"))  # at most twice a mean bag
    copies = lambda m: F.ceil(m / PER_KERNEL).cast("int")
    kernels = kernels.select("centre", "kernel", F.explode(F.sequence(F.lit(0), copies(F.col("m")) - 1)).alias("salt"))
    both = members.withColumn("salt", F.pmod(F.hash("node"), copies(F.col("m")))).join(kernels, ["centre", "salt"], "left").withColumn("kernel", F.coalesce("kernel", F.array().cast("array<int>")))
    added, lacked, k = F.array_except("bag", "kernel"), F.array_except("kernel", "bag"), F.size("kernel")
    both = both.select("centre", "node", "label", added.alias("added"), lacked.alias("lacked"), k.alias("k"))
    g = (1 - t) * F.size("lacked") + t * F.size("added") - (1 - 2 * t) / 2 * F.col("k")
    diffs = both.select("centre", "node", "label", g.alias("g"), F.concat("added", "lacked").alias("diff"))
    rarity = F.when(2 * F.col("n") > F.col("m"), F.col("m") - F.col("n")).otherwise(F.col("n"))
    return materialize(diffs, "diffs"), counts.select("centre", "shingle", rarity.alias("rarity")).where("rarity > 1")


def open_pairs(diffs: DataFrame, counts: DataFrame) -> DataFrame:
    """The pairs (a, b) of one centre and two labels that can reach the threshold: all that do are among them."""
    lows = several(diffs)
    other = F.when(F.col("label") == F.col("low.label"), F.col("other_g")).otherwise(F.col("low.g"))
    need = F.greatest(F.lit(1), F.ceil(F.col("g") + other - SLACK).cast("int"))
    able = diffs.join(lows, "centre").select("centre", "node", "label", "g", need.alias("need"), "diff").where(F.size("diff") >= F.col("need"))
    spread = able.select("centre", "node", "label", "g", "need", F.explode("diff").alias("shingle")).join(counts, ["centre", "shingle"])
    rare = spread.groupBy("centre", "node", "label", "g", "need").agg(F.array_sort(F.collect_list(F.struct("rarity", "shingle"))).alias("diff"))
    rare = rare.where(F.size("diff") >= F.col("need")).withColumn("size", F.size("diff"))
    prefix = rare.select("centre", "node", "label", "g", "size", F.posexplode(F.slice("diff", F.lit(1), F.col("size") - F.col("need") + 1)).alias("at", "s"))
    prefix = materialize(prefix.select("centre", "node", "label", "g", F.col("s.shingle").alias("shingle"), (F.col("size") - F.col("at")).alias("rest")), "prefixes")
    x, y = (prefix.select("centre", "shingle", F.col("node").alias(v), F.col("label").alias("l" + v), F.col("g").alias("g" + v), F.col("rest").alias("r" + v)) for v in "ab")
    here = (x["centre"] == y["centre"]) & (x["shingle"] == y["shingle"]) & (F.col("la") < F.col("lb")) & (F.col("ga") + F.col("gb") <= F.least("ra", "rb") + SLACK)
    return materialize(ordered(x.join(y, here)), "open-pairs")


def relabel(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with ``label``: that of ``labels``, or else the node itself."""
    return members.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, row (a hash of the text) and class_id of every row of ``docs``."""
    signed = materialize(hashed_words(docs, doc_id, text).mapInArrow(sign, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, row long, node long, weight long, bands array<long>"), "signatures")
    reps = materialize(signed.where("weight > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("weight").alias("weight"), F.first("bands").alias("bands")), "nodes")
    spread = reps.select("node", "weight", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = materialize(spread.join(shared, "bucket"), "members")
    popular = members.groupBy("node").agg(F.sum("members").alias("popular"))
    involved = materialize(popular.join(reps.select("node", "doc_id"), "node"), "involved")
    side, _ = small_side(involved.select(F.col("node").alias("n"), F.col("doc_id").alias("d")))
    chosen = hashed_words(docs, doc_id, text).join(side, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    bags_ = chosen.mapInArrow(multisets, "node long, bag array<int>").groupBy("node").agg(F.first("bag").alias("bag"))
    bags_ = materialize(bags_.select("node", F.array_distinct("bag").alias("bag")), "bags")
    far = F.lit(1 - threshold + 1e-9)
    # every member against its bucket's centre
    members = members.drop("members").join(involved.select("node", "popular"), "node")
    centre = members.groupBy("bucket").agg(F.max_by(F.struct(F.col("node").alias("centre"), F.col("weight").alias("wb")), F.struct("popular", "node")).alias("c"))
    members = materialize(members.join(centre.select("bucket", "c.*"), "bucket").where("node <> centre").select("centre", "node", "weight", "wb").distinct(), "stars")
    like = F.least("weight", "wb") >= F.lit(threshold) * F.greatest("weight", "wb")
    stars = distances(ordered(members.where(like).select(F.col("node").alias("a"), F.col("centre").alias("b"))), bags_)
    labels = components(materialize(stars.where(F.col("d") <= far), "links"))
    # the members of a centre that are still apart: those near its kernel against the nearest, then those with shared differences
    diffs, counts = differences(relabel(members.select("centre", "node"), labels), bags_, threshold)
    near = diffs.join(several(diffs), "centre").where((F.col("g") + F.col("low.g") <= SLACK) & (F.col("label") != F.col("low.label")))
    found = distances(ordered(near.select(F.col("node").alias("a"), F.col("low.node").alias("b"))), bags_).where(F.col("d") <= far)
    labels = components(materialize(found, "links"), labels)
    found = distances(open_pairs(relabel(diffs, labels), counts), bags_).where(F.col("d") <= far)
    labels = components(materialize(found, "links"), labels)
    rows = signed.select("doc_id", "row", "node")
    rows = rows.join(labels, "node", "left").select("doc_id", "row", F.coalesce("label", "node").alias("node"))
    least = rows.groupBy("node").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "node").select("doc_id", "row", "class_id", F.col("node").alias("class_node"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with the least doc_id, then text hash; columns as given."""
    found = classes(docs, doc_id, text, threshold)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("d"), F.col("row").alias("r")))
    kept = found.groupBy("class_node").agg(best.alias("best")).select("best.d", "best.r")
    kept = materialize(kept, "kept")
    side, _ = small_side(kept)
    row = fresh(docs, "_row")[0]
    left = docs.withColumn(row, F.xxhash64(F.col(text)))
    out = left.join(side, F.col(doc_id).eqNullSafe(F.col("d")) & (F.col(row) == F.col("r")), "left_semi")
    repeated = found.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():  # rows that repeat both doc_id and text
        out = out.dropDuplicates([doc_id, row])
    return out.drop(row)

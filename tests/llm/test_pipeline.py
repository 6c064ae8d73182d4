"""The corpus pipeline's stages in order: each one's rows, and run()'s, against plain Python on small tables."""

import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import odd_documents, words
from test_matching import brute_classes, near_copies
from test_native import brute_copies, brute_lines

import corpus_pipeline
from placeforge.llm import lines, packing, quality

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def signed(x):
    x %= 1 << 64
    return x - (1 << 64) if x >= 1 << 63 else x


def digest(text):
    return 42 if text is None else signed(xxhash.xxh64(text.encode(), seed=42).intdigest())


def grams(text, order):
    h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words(text)]
    out = []
    for k in range(len(h) - order + 1):
        gram = 0
        for j in range(order):
            gram ^= h[k + j] << j
        out.append(gram % (1 << 64))
    return out


def half_up(x):
    return int(math.floor(abs(x) + 0.5)) * (1 if x >= 0 else -1)


def brute_keep(rows, trusted):
    """The rows that the quality rules keep; copies and near copies count as one text in the model."""
    texts = {}
    for doc_id, text, *_ in rows:
        n, good = texts.get(text, (0, False))
        texts[text] = n + 1, good or doc_id in trusted
    keys, groups = {}, defaultdict(lambda: [0, 0])
    for text, (_, good) in texts.items():
        windows = grams(text, 3)
        least = [min((signed(w ^ x) for w in windows), default=digest(text)) for x in quality.MINS]
        keys[text] = [(i, j, least[i], least[j]) for j in range(len(least)) for i in range(j)]
        for key in keys[text]:
            groups[key][0] += 1
            groups[key][1] += good
    raw, target = Counter(), Counter()
    for doc_id, text, *_ in rows:
        n, good = texts[text]
        shared = [groups[k] for k in keys[text] if groups[k][0] > 1]
        own = max(1, half_up(quality.UNIT / n / max((g[0] for g in shared), default=1)))
        mine = max(1, half_up(quality.UNIT / n / max((g[1] for g in shared), default=1))) if good else 0
        for g in (g for o in quality.ORDERS for g in grams(text, o)):
            raw[g % quality.BUCKETS] += own
            target[g % quality.BUCKETS] += mine
    n_raw, n_target = sum(raw.values()), sum(target.values())
    weight = lambda b: half_up(math.log((target[b] / quality.UNIT * (n_raw / n_target) + quality.SMOOTHING) / (raw[b] / quality.UNIT + quality.SMOOTHING)) * quality.SCALE)
    kept = []
    for row in rows:
        w = words(row[1])
        seen = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + d for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for d in range(3)}
        own = [g % quality.BUCKETS for o in quality.ORDERS for g in grams(row[1], o)]
        if len(w) >= 50 and 100 * len(covered) <= 50 * len(w) and sum(map(weight, own)) / quality.SCALE / len(own) >= quality.THRESHOLD:
            kept.append(row)
    return kept


def brute_drop(rows):
    """The rows without boilerplate lines, with their numbers of characters."""
    numbered = [(k, *r[1:]) for k, r in enumerate(rows)]
    cleaned = {k: text for k, text, *_ in brute_lines(numbered, lines.RATIO, lines.LEAST)}
    return [(r[0], cleaned[k], r[2], r[3], None if cleaned[k] is None else len(cleaned[k])) for k, r in enumerate(rows)]


def brute_one_each(rows):
    """The row with the least doc_id, then digest, of each class of near-duplicates."""
    numbered = [(k, r[1]) for k, r in enumerate(rows)]
    best = {}
    for k, group in brute_classes(numbered):
        order = (rows[k][0] is None, rows[k][0] or 0, digest(rows[k][1]))
        if group not in best or order < best[group][0]:
            best[group] = order, rows[k]
    return [row for _, row in best.values()]


def brute_pieces(rows):
    """doc_id, piece, start, length and checksum of the ids of every piece."""
    from tokenizers import Tokenizer

    exact, out = Tokenizer.from_file(packing.vocabulary_path()), []
    for doc_id, text, *_ in rows:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % packing.MAX_TOKENS or packing.MAX_TOKENS
        cuts = [0, *range(first, len(ids) + 1, packing.MAX_TOKENS)]
        out += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return sorted(out, key=repr)


def counted(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def fixture():
    rows = [(r[0], r[1] if r[1] is None or k % 4 else f"Read more on this site\n{r[1]}", *r[2:5]) for k, r in enumerate(near_copies())]
    return [r for r in rows if r[0] != 102], (1001, 1100, 1203, 1301, 7, 22)


def test_each_stage_and_run_match_plain_python(spark, tmp_path):
    rows, trusted = fixture()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in trusted] + [(5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    n = Counter()

    def mixed(given):
        n.clear()
        n.update(r[3] for r in given)
        share = {s: math.sqrt(k) for s, k in n.items()}
        means = {s: share[s] / sum(share.values()) * len(given) / n[s] for s in n}
        copies = Counter()
        for (doc_id, source, _), m in brute_copies(given, means).items():
            copies[doc_id, source] += m
        return [r for r in given for _ in range(copies[r[0], r[3]])]

    plain = [lambda r: brute_keep(r, set(trusted)), brute_drop, brute_one_each, mixed]
    docs = spark.createDataFrame(rows, SCHEMA)
    for (name, stage), brute in zip(corpus_pipeline.STAGES, plain, strict=False):
        before = len(rows)
        rows = brute(rows)
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS
        assert counted(docs) == Counter(rows), name
        assert name == "line dedup" or len(rows) != before  # each decision takes effect
        docs = spark.createDataFrame(rows, SCHEMA)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    expected = brute_pieces(rows)
    for df in (packed, corpus_pipeline.run(spark, str(tmp_path))):
        found = df.collect()
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=repr) == expected
        full = defaultdict(list)
        for r in found:
            full[r.sequence_id].append((r.offset, r.length))
        for parts in full.values():
            parts.sort()
            assert [a for a, _ in parts] == list(np.cumsum([0, *(b for _, b in parts)])[:-1]) and sum(parts[-1]) <= packing.MAX_TOKENS


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
def test_stages_take_effect_on_the_drivers_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == COLUMNS
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2]


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    clashing = SCHEMA + ", _words string, shard int, kept string, copy int, row string, bucket string"
    for rows, schema in ((odd_documents(), clashing), ([], SCHEMA), ([r[:5] for r in odd_documents()], SCHEMA)):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()

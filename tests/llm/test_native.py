"""Quality rules, line dedup and mixing against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
import xxhash
from helpers import DOCS, empty, frame, odd_documents, words
from pyspark.sql import functions as F

from placeforge.llm import lines, mixing, quality


def brute_quality(rows, trusted):
    def grams(w):
        h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in w]
        every = [h[i + k] << k for o in quality.ORDERS for i in range(len(h) - o + 1) for k in range(o)]
        at, out = 0, []
        for o in quality.ORDERS:
            for _ in range(len(h) - o + 1):
                gram = 0
                for part in every[at : at + o]:
                    gram ^= part
                out.append(gram % quality.BUCKETS)
                at += o
        return out

    raw, target = Counter(), Counter()
    for doc_id, text, *_ in rows:
        for g in grams(words(text)):
            raw[g] += 1
            target[g] += doc_id in trusted
    n_raw, n_target = sum(raw.values()), sum(target.values())
    weight = lambda b: round(math.log((target[b] * (n_raw / n_target) + quality.SMOOTHING) / (raw[b] + quality.SMOOTHING)) * quality.SCALE)
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
        filled = [x for x in (text or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        own = grams(w)
        score = sum(map(weight, own)) / quality.SCALE / len(own) if own and trusted else 0.0
        out.append((doc_id, len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(filled) - len(set(filled)), len(covered), failed, not failed and score >= quality.THRESHOLD, round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("trusted", [(1, 4, 7, 22), ()])
def test_quality_rules_match_brute_force(spark, trusted):
    rows = odd_documents()
    rows[9] = (9, "a # b|c a # b|c " + rows[9][1] + "\n" + rows[9][1] + "\ndup\n\ndup\n \x0b", *rows[9][2:])
    labels = spark.createDataFrame([(k, 1, 0) for k in trusted] + [(3, 0, 0), (5, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = quality.judge(docs, quality.fit(docs, labels))
    assert set(docs.columns) <= set(got.columns)
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, round(r.llr_score, 6)) for r in got.collect()]
    assert sorted(found, key=repr) == brute_quality(rows, set(trusted))
    kept = quality.filter_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r[7] for r in found)


def test_quality_of_higher_orders_and_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.filter_quality(empty(spark), labels).count() == 0
    docs = frame(spark)
    some = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge(docs, quality.fit(docs, some, orders=(1, 2, 3)), orders=(1, 2, 3)).where("n_words >= 50").collect()
    assert max(rows, key=lambda r: r.llr_score).doc_id == 1


def brute_lines(rows, ratio, least):
    pages, on = Counter(), defaultdict(Counter)
    key = lambda x: x.strip(" \t\r")
    for _, text, _, source, *_ in rows:
        pages[source] += 1
        on[source].update({key(x) for x in (text or "").split("\n") if key(x)})
    out = []
    for doc_id, text, _, source, *_ in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        all_ = text.split("\n")
        kept = [x for x in all_ if not (key(x) and on[source][key(x)] >= least and on[source][key(x)] > ratio * pages[source])]
        out.append((doc_id, "\n".join(kept), len(all_), len(all_) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [lines.BROADCAST_LINES, -1])
def test_line_dedup_matches_brute_force_on_both_joins(spark, broadcast):
    rows = odd_documents()
    got = lines.drop_boilerplate(frame(spark, rows), broadcast_lines=broadcast)
    assert set(got.columns) == {*(c.split()[0] for c in DOCS.split(", ")), "n_lines", "n_dropped_lines"}
    found = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped_lines) for r in got.collect()), key=repr)
    assert found == brute_lines(rows, lines.RATIO, lines.LEAST)
    assert any(r[3] for r in found)
    assert lines.drop_boilerplate(empty(spark)).count() == 0


def brute_copies(rows, means):
    out = Counter()
    for doc_id, text, _, source, *_ in rows:
        key = f"{mixing.SEED}:{'~' if doc_id is None else doc_id}:{hashlib.md5((text or '').encode()).hexdigest()}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / (1 << 52)
        p, k, cdf, mean = math.exp(-means[source]), 0, math.exp(-means[source]), means[source]
        while cdf <= u:
            k += 1
            p *= mean / k
            cdf += p
        for c in range(k):
            out[(doc_id, source, c)] += 1
    return out


@pytest.mark.parametrize("weights", [None, {"s0": 3.0, "s2": 1.0}])
def test_mixing_matches_brute_force(spark, weights):
    rows = odd_documents()
    n = Counter(r[3] for r in rows)
    share = {s: math.sqrt(k) for s, k in n.items()} if weights is None else {s: weights.get(s, 0.0) for s in n}
    means = {s: share[s] / sum(share.values()) * len(rows) / n[s] for s in n}
    got = mixing.mix(frame(spark, rows), weights=weights)
    assert Counter((r.doc_id, r.source, r["copy"]) for r in got.collect()) == brute_copies(rows, means)
    assert mixing.mix(empty(spark)).count() == 0


def test_mixing_reaches_target_shares_and_shuffles(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    rows = mixing.mix(docs, weights={"big": 1.0, "s1": 1.0}).collect()
    n = Counter(r.source for r in rows)
    assert set(n) == {"big", "s1"} and abs(n["big"] - 10000) < 500 and abs(n["s1"] - 10000) < 500
    ids = [r.doc_id for r in rows]
    assert sum(a < b for a, b in zip(ids, ids[1:], strict=False)) < 0.6 * len(ids)

"""Operator 12: checksums against zlib, the draw against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from placeforge.llm import resampling

from helpers import empty, frame, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def buckets(text):
    return [zlib.crc32(g.encode()) % 10000 for g in features(text)[1]]


def expected(docs, target, percent=5):
    s, t = (Counter(b for r in rows for b in buckets(r[1])) for rows in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10000.0) / ((s[b] + 1.0) * (all_t + 10000.0))))
    out = []
    for r in docs:
        n_words, grams = features(r[1])
        weight = sum(gain(b) for b in buckets(r[1]))
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    eligible = sorted((x for x in out if x[5] >= 20), key=lambda x: (-x[3], x[0] is None, x[0]))
    for k, x in enumerate(eligible[: percent * len(eligible) // 100], 1):
        x[4] = k
    return sorted((tuple(x[:5]) for x in out), key=repr)


def drawn(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def long_rows():
    r = random.Random(4)
    odd = odd_documents()
    odd += [(300, "x" * 700 + " Ünï " + "é" * 500 + " " + "q" * 256 + " " + "z" * 257, None, None, None, *odd[0][5:])]
    odd += [(400 + k, " ".join(r.choice(["Alpha", "béta", "g4mma", "δ", "x-y", "omega_3"]) for _ in range(30)), None, None, None, *odd[0][5:]) for k in range(80)]
    return odd + [odd[-1], odd[-1]]


def test_draw_against_plain_python(spark):
    rows, target = long_rows(), [(1, "Alpha béta alpha"), (2, None), (3, "δ g4mma"), (None, "δ g4mma")]
    side = spark.createDataFrame(target, "item_id long, text string")
    for percent in (5, 60):
        assert drawn(resampling.draw(frame(spark, rows), side, percent=percent)) == expected(rows, target, percent)


def test_empty_sides(spark):
    side = spark.createDataFrame([], "item_id long, text string")
    assert drawn(resampling.draw(frame(spark), side)) == expected(odd_documents(), [])
    assert resampling.draw(empty(spark), side).collect() == []


def test_checksums_of_any_length(monkeypatch):
    r = np.random.default_rng(1)
    data = r.integers(0, 256, 20000).astype(np.uint8)
    start = r.integers(0, 9000, 300)
    size = np.concatenate([r.integers(1, 40, 200), r.integers(250, 262, 50), r.integers(500, 11000, 50)])
    wanted = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(start, size, strict=True)]
    for gather in (1 << 10, 1 << 21):
        monkeypatch.setattr(resampling, "GATHER", gather)
        assert resampling.checksums(data, start, start + size).tolist() == wanted


def test_all_counts_are_kept_apart_by_text(monkeypatch):
    monkeypatch.setattr(resampling, "AT_ONCE", 50)
    texts = [(r[1] or "").encode() for r in odd_documents()]
    found = Counter()
    for whose, b in resampling.features(texts, 3, 10000):
        found.update(zip(whose.tolist(), b.tolist(), strict=True))
    assert found == Counter((k, b) for k, r in enumerate(odd_documents()) for b in buckets(r[1]))

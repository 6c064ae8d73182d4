"""Operator 13: the noisy-or against plain Python, accuracy on held-out labels, and odd cases."""

import math
import os
import random

import pytest

from placeforge.llm import toxicity

from helpers import EXTRA, empty, frame, odd_documents

DATA = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400, seed=2):
    """Clean prose, and documents in which one sentence has words of two bad stems."""
    r = random.Random(seed)
    plain = ["river", "stone", "walks", "green", "house", "often", "under", "light", "quiet", "seven"]
    rows, labels = [], []
    for k in range(n):
        parts = [" ".join(r.choice(plain) for _ in range(r.randint(3, 12))) for _ in range(r.randint(1, 9))]
        bad = k % 5 == 2
        if bad:
            parts.insert(r.randint(0, len(parts)), f"quiet blargh{r.choice(['ed', 'ing', 'er', 'ish', 'en'])} house zorkle{r.choice('abcde')}n")
        rows.append((k, ". ".join(parts).capitalize() + ".", "en", "s", 1, *EXTRA))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_learns_and_locates(spark):
    rows, labels = corpus()
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(docs, marks)
    got = {r.doc_id: r for r in toxicity.score(docs, model).withColumn("held", toxicity.held_out(toxicity.F.col("doc_id"))).collect()}
    held = [k for k in got if got[k].held]
    assert 40 < len(held) < 120 and all(got[k].predicted == labels[k][2] for k in held)
    found = toxicity.locate(docs, model).collect()
    assert {r.doc_id for r in found} == {k for k in got if got[k].predicted}
    assert all("blargh" in r.sentence.lower() and rows[r.doc_id][1][r.start : r.start + r.length] == r.sentence for r in found)


def test_score_is_the_noisy_or_of_sentences(spark):
    rows, labels = corpus()
    odd = odd_documents() + [(500, "Quiet blarghed. Blarghed house! zorklean\nblarghing", None, None, None, *EXTRA)]
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, LABELS))
    weights = {r.stem: r.weight for r in model.collect()}
    bias = weights.pop("")
    assert bias < 0 and weights and min(weights.values()) > 0
    scored = toxicity.score(frame(spark, odd), model)
    assert [c for c in frame(spark, odd).columns if c not in scored.columns] == []
    got = sorted(((r.doc_id, r.text, round(r.score, 9), r.predicted) for r in scored.collect()), key=repr)
    wanted = []
    for row in odd:
        none = 1.0
        for m in toxicity.SENTENCE.finditer(row[1] or ""):
            words = toxicity.WORD.findall(m.group().lower())
            if words:
                none *= 1 - 1 / (1 + math.exp(-bias - sum(weights.get(s, 0.0) for w in words for s in toxicity.stems(w))))
        wanted.append((row[0], row[1], round(1 - none, 9), int(1 - none >= 0.5)))
    assert got == sorted(wanted, key=repr)


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus()
    flipped = spark.createDataFrame([(k, q, 1 - t if __import__("zlib").crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in labels], LABELS)
    models = [sorted(map(tuple, toxicity.fit(frame(spark, rows), x).collect())) for x in (flipped, spark.createDataFrame(labels, LABELS))]
    assert models[0] == models[1]


def test_odd_cases(spark):
    none = spark.createDataFrame([], LABELS)
    one_kind = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 1, 1), (3, None, None)], LABELS)
    for marks in (none, one_kind):
        scored = toxicity.score(frame(spark), toxicity.fit(frame(spark), marks)).collect()
        assert len(scored) == len(odd_documents()) and {(r.score, r.predicted) for r in scored} == {(0.0, 0)}
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), none)).collect() == []
    assert toxicity.locate(empty(spark), toxicity.fit(empty(spark), none)).collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
def test_accuracy_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    held = scored.join(labels, "doc_id").where(toxicity.held_out(toxicity.F.col("doc_id"))).select("toxic", "predicted").collect()
    toxic, clean = ([r.predicted for r in held if r.toxic == k] for k in (1, 0))
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)

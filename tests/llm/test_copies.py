"""The quality model does not turn against texts that have copies."""

import random

import pytest
from helpers import DOCS, EXTRA, frame, odd_documents

from placeforge.llm import quality


def clean_and_copies(edits, copies=200, n=120):
    """Texts of one vocabulary, half of them labelled, and copies of an unlabelled one, with ``edits`` words changed in each."""
    r = random.Random(4)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st", "l", "m")]
    say = lambda k: [r.choice(vocabulary) for _ in range(k)]
    rows = [(k, " ".join(say(150)), "en", "s", 1, *EXTRA) for k in range(n)]
    base = say(200)
    for k in range(copies):
        text = list(base)
        for _ in range(edits):
            text[r.randrange(len(text))] = r.choice(vocabulary)
        rows.append((1000 + k, " ".join(text), "en", "s", 1, *EXTRA))
    return rows


@pytest.mark.parametrize("edits", [0, 4])
def test_clean_groups_of_copies_are_kept(spark, edits):
    docs = frame(spark, clean_and_copies(edits))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    kept = quality.filter_quality(docs, labels)
    assert kept.where("doc_id >= 1000").count() == 200 and kept.columns == docs.columns


def test_copies_share_one_weight_and_their_label(spark):
    rows = [r for r in odd_documents() if r[0] is not None and r[0] < 60]
    more = rows + [(200 + k, rows[5][1], *rows[5][2:]) for k in range(30)]
    labels = spark.createDataFrame([(k, 1, 0) for k in (1, 203, 22)], "doc_id long, quality int, toxic int")
    alone = spark.createDataFrame([(k, 1, 0) for k in (1, 5, 22)], "doc_id long, quality int, toxic int")
    got = quality.fit_once(spark.createDataFrame(more, DOCS), labels).first()["weights"]
    expected = quality.fit(spark.createDataFrame(rows, DOCS), alone).first()["weights"]
    assert max(abs(a - b) for a, b in zip(got, expected, strict=True)) <= 2

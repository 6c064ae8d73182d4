"""Mixing with mean repetition rates over the range of one draw."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from placeforge.llm import mixing


def draws_of(doc_id, text, mean):
    """The number of copies by plain Python."""
    parts = max(1, math.ceil(mean / 600))
    total = 0
    for k in range(1, parts + 1):
        key = f"{mixing.SEED}:{doc_id}:{hashlib.md5(text.encode()).hexdigest()}" + f":{k}" * (k > 1)
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / (1 << 52)
        n, p = 0, math.exp(-mean / parts)
        cdf = p
        while cdf <= u:
            n += 1
            p *= mean / parts / n
            cdf += p
        total += n
    return total


@pytest.mark.parametrize("run", [mixing.RUN, 100])
def test_means_over_600_are_drawn_exactly(spark, monkeypatch, run):
    monkeypatch.setattr(mixing, "RUN", run)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.when(F.col("id") < 3, "rare").otherwise("big").alias("source"))
    got = mixing.mix(docs, weights={"rare": 0.8, "big": 0.2}).where("source = 'rare'").groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("d"), F.max("copy").alias("last")).collect()
    assert {r.doc_id: (r.n, r.d, r["last"] + 1) for r in got} == {k: (draws_of(k, str(k), 800.0),) * 3 for k in range(3)}


def test_sums_of_draws_have_mean_and_variance_of_poisson(spark):
    docs = spark.range(400_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.when(F.col("id") < 300, "rare").otherwise("big").alias("source"))
    rows = mixing.mix(docs, weights={"rare": 1.0, "big": 0.0}).groupBy("doc_id").count().collect()
    n = Counter({r.doc_id: r["count"] for r in rows})
    mean = sum(n.values()) / 300
    assert len(n) == 300 and abs(mean - 4000 / 3) < 5 * math.sqrt(4000 / 3 / 300)
    assert 0.7 < sum((x - mean) ** 2 for x in n.values()) / 299 / (4000 / 3) < 1.4

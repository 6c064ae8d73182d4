"""Fixtures in code: small documents with every odd case, and brute-force versions of the shared rules."""

import random
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _words string, shard int, kept string, copy int, row string, bucket string"


def words(text):
    return SPACE.findall(text or "")


EXTRA = ("x", 7, "y", 9, "z", "b")


def odd_documents(n=60, seed=1):
    """Nulls in every column, empty and blank and long texts, ties, repeated rows, clashing extra columns."""
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "bcdfgklmnp" for b in ("a", "e", "io", "ura", "é")]
    rows = []
    for k in range(n):
        lines = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 40))) for _ in range(r.randint(1, 6))]
        if k % 3 == 0:
            lines.insert(0, "Share this page with friends")
        rows.append((k, "\n".join(lines), "en", f"s{k % 3}", 1))
    rows += [(None, None, None, None, None), (100, "", "en", None, 0), (101, " \t\n ", None, "s1", 0), (102, "one", "en", "s1", 3), (102, "one", "en", "s1", 3), (103, rows[5][1], "fr", "s2", 1), (104, "word " * 6000, "en", "s0", 1), (None, rows[7][1], "en", "s0", 1)]
    return [(*row, *EXTRA) for row in rows]


def frame(spark, rows=None, schema=DOCS):
    return spark.createDataFrame(odd_documents() if rows is None else rows, schema)


def empty(spark):
    return spark.createDataFrame([], DOCS)

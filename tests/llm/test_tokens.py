"""Operator 11 against plain Python: whole texts encoded by the libraries themselves, ends compared one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from placeforge.llm import alignment

from helpers import EXTRA, empty, frame, odd_documents

pytest.importorskip("public_tokenizers")
ALPHABET = ["a", "B", "the", "ß", "é", "中", "▁", " ", "  ", "\n", "\t", "\r\n", " ", "<|endoftext|>", "<s>", "<0x41>", "don't", "12", "!!", "🙂", "́", "﻿", "\x00", "word", " x", "　"]


@pytest.fixture(scope="module")
def libraries():
    return alignment.encoders(*alignment.paths(alignment.A_FILE, alignment.B_FILE))


def tokens(encode, text):
    """(id, bytes) lists of both sides, empty if either does not spell the text out."""
    if not text:
        return [], []
    byte = alignment.printable_bytes()
    a = encode.a.encode(" " + text, add_special_tokens=False)
    a = [(k, bytes(byte[c] for c in t)) for k, t in zip(a.ids, a.tokens, strict=True)]
    b = [(k, bytes([int(p[3:5], 16)]) if encode.b.is_byte(k) else p.replace("▁", " ").encode()) for k in encode.b.encode(text) for p in [encode.b.id_to_piece(k)]]
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def plain(encode, texts):
    """Per text: n_a, n_b, digest, linked pairs; by walking both lists."""
    out = []
    for text in texts:
        a, b = tokens(encode, text)
        i = j = at_a = at_b = 0
        groups, pairs, open_a, open_b = [], [], [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                open_a.append(a[i][0])
                at_a += len(a[i][1])
                i += 1
            else:
                open_b.append(b[j][0])
                at_b += len(b[j][1])
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, open_a)) + "|" + ",".join(map(str, open_b)))
                pairs.append((open_a[-1], open_b[-1]))
                open_a, open_b = [], []
        out.append((len(a), len(b), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", pairs, groups))
    return out


def expected(encode, rows):
    found = plain(encode, [r[1] for r in rows])
    counts = Counter(p for x in found for p in x[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(((r[0], x[0], x[1], len(x[4]), len(x[3]), sum(counts[p] == most[p[1]] for p in x[3]), sum(counts[p] for p in x[3]), x[2]) for r, x in zip(rows, found, strict=True)), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_plain_python(spark, libraries):
    r = random.Random(3)
    rows = odd_documents() + [(200 + k, "".join(r.choice(ALPHABET) for _ in range(r.randint(1, 60))), None, None, None, *EXTRA) for k in range(300)]
    got = alignment.align(frame(spark, rows), work=37)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(got) == expected(libraries, rows)


def test_salted_way_is_the_same(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "small_side", lambda df: (df, False))
    assert rows_of(alignment.align(frame(spark))) == expected(libraries, odd_documents())


def test_empty_table(spark):
    assert alignment.align(empty(spark)).collect() == [] and alignment.groups(empty(spark)).collect() == []


def test_groups_spell_the_text(spark, libraries):
    rows = odd_documents()
    found = {}
    for g in sorted(alignment.groups(frame(spark), work=50).where("doc_id IS NOT NULL AND doc_id <> 102").collect(), key=lambda g: (g.doc_id, g.group)):
        found.setdefault(g.doc_id, []).append(g)
    for row, x in zip(rows, plain(libraries, [r[1] for r in rows]), strict=True):
        if row[0] in found:
            assert [",".join(map(str, g.a_ids)) + "|" + ",".join(map(str, g.b_ids)) for g in found[row[0]]] == x[4]
            assert [g.start for g in found[row[0]]] == [sum(h.length for h in found[row[0]][:k]) for k in range(len(found[row[0]]))]
            assert sum(g.length for g in found[row[0]]) == len((" " + row[1]).encode())


def test_units_are_encoded_as_whole_texts(libraries):
    r = random.Random(5)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(1, 30))) for _ in range(3000)]
    a, b = libraries(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in b] == libraries.b.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in a] == [e.ids for e in libraries.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("work", [1, 2, 3, 10, 1000])
def test_pieces_are_equal_and_miss_nothing(work):
    r = np.random.default_rng(work)
    for _ in range(50):
        a, b = (np.unique(r.integers(1, 60, r.integers(0, 40))) for _ in range(2))
        i, j = alignment.diagonals(a, b, work)
        assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
        assert (np.abs(np.diff(i) + np.diff(j) - work)[:-1] <= 1).all()
        last_a, last_b = alignment.links(a, b, work)
        assert a[last_a].tolist() == b[last_b].tolist() == np.intersect1d(a, b).tolist()

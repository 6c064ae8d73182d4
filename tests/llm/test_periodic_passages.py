"""Passages of few distinct words are found wherever they stand."""

import random

import numpy as np
import pytest

from placeforge.llm import chunks


def shared_words(a, b):
    """The most words in adjoining chunks of ``b`` whose bytes are chunks of ``a``."""
    parts = []
    for text in (a, b):
        raw = text.encode()
        ends = chunks.cuts(np.frombuffer(raw, np.uint8)).tolist()
        parts.append([raw[x:y] for x, y in zip([0, *ends[:-1]], ends, strict=True)])
    held, run, most = set(parts[0]), b"", 0
    for part in parts[1]:
        run = run + part if part in held else b""
        most = max(most, len(run.split()))
    return most


@pytest.mark.parametrize("words", [1, 2, 6])
def test_a_repeated_sentence_is_found_after_any_beginning(words):
    r = random.Random(words)
    vocabulary = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st", "lo", "mi")]
    say = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    for _ in range(60):
        passage = " ".join([say(words)] * (120 // words))
        a, b = (f"{say(r.randint(5, 60))} {passage} {say(r.randint(5, 60))}" for _ in range(2))
        assert shared_words(a, b) >= chunks.WORDS

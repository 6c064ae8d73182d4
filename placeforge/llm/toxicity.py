"""Operator 13, toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

Method. A document is a bag of sentences (runs without full stops, marks and line ends). A sentence's probability is
the logistic function of a bias and the summed weights of its words; a word counts by itself and by its beginnings of
``PREFIXES`` letters, so that unseen forms of a known stem count. A bag's probability is the noisy-or of its sentences,
1 - prod(1 - p). Bias and weights maximise the likelihood of the documents' labels under that bag probability, by
proximal gradient steps with an L1 penalty and without negative weights: a word can only add to the suspicion, so clean
sentences cannot outvote an offending one. ``locate`` gives the sentences that make a document toxic.

Scale. The fit sees a bounded sample of labelled rows: at most ``SAMPLE`` rows of each label, those of the least hash of
their id, of at most ``SAMPLE_CHARS`` characters (each row weighs as many rows of its label as it stands for). It runs in
one task, over at most 2 * SAMPLE * SAMPLE_CHARS characters. The model is a table of stems with a weight above 0, at most
``STEMS`` rows. All documents are scored whole, in one pass without a shuffle.

Cases. Null, empty and wordless texts have the score of a bag without sentences, 0. Null ids and ids without a label are
scored as any other. A label of null does not count; an id that is labelled both ways counts as toxic. Without labels of both kinds
every score is 0. Repeated rows are scored each. Ids need not be numbers. ``locate`` gives no row for a clean document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fresh, hash_sample, materialize

#: Rows of each label that the fit may see, and the longest text among them.
SAMPLE, SAMPLE_CHARS = 4_000, 20_000
#: Lengths of the beginnings of a word that count beside the word itself.
PREFIXES = (4, 5, 6, 7, 8)
#: The largest model.
STEMS = 100_000
#: How many rows a toxic row counts as: their share is small, and without it the fit would rather miss than accuse.
BALANCE = 4.0
#: Weights of the L1 and L2 penalties, steps, and the first step's size.
PENALTY, RIDGE, STEPS, RATE = 2e-4, 1e-4, 400, 0.5
#: The bias that a fit starts from.
START = -4.0
#: Words whose sum of weights a worker keeps.
KNOWN = 500_000

SENTENCE = re.compile(r"[^.!?\n\r…。]+")
WORD = re.compile(r"[^\W_]+")
MODEL = "stem string, weight double"
#: The row of the model that holds the bias.
BIAS = ""


def held_out(doc_id):
    """Rows whose labels nothing is learned from: the checksum of the id as text is a multiple of 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def stems(word: str) -> list[str]:
    """What a word counts by: itself, in angle brackets, and its beginnings."""
    return [f"<{word}>", *(word[:k] for k in PREFIXES if k <= len(word))]


def learn(texts: list[str], toxic: np.ndarray, share: np.ndarray) -> dict[str, float]:
    """Stems and their weights, and the bias under BIAS, from whole texts, their labels, and how many rows each stands for."""
    vocabulary: dict[str, int] = {}
    tokens: list[np.ndarray] = []
    sentence_of: list[np.ndarray] = []
    document_of: list[int] = []
    for k, text in enumerate(texts):
        for m in SENTENCE.finditer(text):
            words = WORD.findall(m.group().lower())
            if words:
                tokens.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int32, len(words)))
                sentence_of.append(np.full(len(words), len(document_of), np.int32))
                document_of.append(k)
    if not document_of or toxic.all() or not toxic.any():
        return {}
    token, sentence, document = np.concatenate(tokens), np.concatenate(sentence_of), np.array(document_of)

    names: dict[str, int] = {}
    word_stems = [[names.setdefault(s, len(names)) for s in stems(w)] for w in vocabulary]
    of_word = np.repeat(np.arange(len(word_stems)), [len(x) for x in word_stems])
    stem = np.fromiter((s for x in word_stems for s in x), np.int64, len(of_word))

    # a stem without a positive association has weight 0 in the end: only those more frequent among toxic documents stay
    start = np.concatenate([[0], np.cumsum([len(x) for x in word_stems])])
    pairs: list[np.ndarray] = []
    doc_of_token = document[sentence]
    for k in range(len(texts)):
        low, high = np.searchsorted(doc_of_token, [k, k + 1])
        words = np.unique(token[low:high])
        found = np.unique(np.concatenate([stem[start[w] : start[w + 1]] for w in words])) if len(words) else np.zeros(0, np.int64)
        pairs.append(found)
    in_toxic, in_clean = np.zeros(len(names)), np.zeros(len(names))
    seen_toxic = np.zeros(len(names))
    for k, found in enumerate(pairs):
        (in_toxic if toxic[k] else in_clean)[found] += share[k]
        if toxic[k]:
            seen_toxic[found] += 1
    n_toxic, n_clean = share[toxic].sum(), share[~toxic].sum()
    odds = np.log((in_toxic + 0.5) / (n_toxic + 1)) - np.log((in_clean + 0.5) / (n_clean + 1))
    chosen = np.flatnonzero((seen_toxic >= 2) & (odds > 0.5))
    if len(chosen) > STEMS:
        chosen = np.sort(chosen[np.argsort(-odds[chosen], kind="stable")[:STEMS]])
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))

    # (sentence, stem) of the chosen stems, each occurrence counted
    keep = place[stem] >= 0
    of_word, stem = of_word[keep], place[stem[keep]]
    counts = np.bincount(of_word, minlength=len(vocabulary))
    first = np.concatenate([[0], np.cumsum(counts)])
    many = counts[token]
    row = np.repeat(sentence, many)
    column = stem[np.repeat(first[token] - np.cumsum(many) + many, many) + np.arange(many.sum())]

    weights, bias = np.zeros(len(chosen)), START
    share = np.where(toxic, BALANCE, 1.0) * share
    share = share / share.sum()
    n_sentences, squares, bias_squares = len(document), np.full(len(chosen), 1e-12), 1e-12
    for _ in range(STEPS):
        z = bias + np.bincount(row, weights=weights[column], minlength=n_sentences)
        p = 1 / (1 + np.exp(-z))
        none = np.exp(-np.bincount(document, weights=np.logaddexp(0, z), minlength=len(texts)))  # no sentence offends
        pull = np.where(toxic, -none / np.maximum(1 - none, 1e-9), 1.0) * share
        slope = pull[document] * p
        gradient, bias_gradient = np.bincount(column, weights=slope[row], minlength=len(chosen)), slope.sum()
        squares += gradient * gradient
        bias_squares += bias_gradient * bias_gradient
        rate = RATE / np.sqrt(squares)
        weights = np.maximum(0.0, weights - rate * (gradient + PENALTY + RIDGE * weights))
        bias = min(-1.0, bias - RATE / math.sqrt(bias_squares) * bias_gradient)
    names_of = list(names)
    return {names_of[c]: float(w) for c, w in zip(chosen, weights, strict=True) if w > 0} | {BIAS: float(bias)}


def sample(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """text, toxic and share of at most ``rows`` labelled rows of each label that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(doc_id).isNotNull()).where(~held_out(F.col(doc_id)))
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col("toxic") > 0).alias("toxic"))
    sizes_of = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    parts = [hash_sample(known.where(F.col("toxic") == flag), "_id", sizes_of.get(flag, 0), rows) for flag in (False, True)]
    ids = materialize(parts[0].unionByName(parts[1]), "toxicity-ids")  # at most 2 * rows ids
    sizes = F.broadcast(known.groupBy("toxic").agg(F.count(F.lit(1)).alias("_all")))  # two rows
    own = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text")).where(F.length("text") <= chars)
    found = own.join(F.broadcast(ids), F.col("_doc") == F.col("_id")).select("_id", "toxic", "text")
    # an id may stand for many rows: the first of them by their text
    found = materialize(found.groupBy("_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample")
    taken = F.broadcast(found.groupBy("toxic").agg(F.count(F.lit(1)).alias("_taken")))  # two rows
    return found.join(sizes, "toxic").join(taken, "toxic").select("text", F.col("toxic").cast("int").alias("toxic"), (F.col("_all") / F.col("_taken")).alias("share"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """The model, stem and weight, from the labels that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic, share = [], [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic += batch.column(1).to_pylist()
            share += batch.column(2).to_pylist()
        order = sorted(range(len(texts)), key=lambda k: (texts[k], toxic[k]))  # sums do not depend on how rows arrive
        model = learn([texts[k] for k in order], np.array([toxic[k] > 0 for k in order], bool), np.array([share[k] for k in order], float))
        yield pa.RecordBatch.from_arrays([pa.array(list(model), pa.string()), pa.array(list(model.values()), pa.float64())], ["stem", "weight"])

    return materialize(sample(docs, labels, text, doc_id, rows, chars).coalesce(1).mapInArrow(run, MODEL), "toxicity-model")


class Weights(dict):
    """The summed weight of a word by its stems, found once a word."""

    def __init__(self, model: dict[str, float]):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= KNOWN:
            self.clear()
        total = self[word] = sum(map(self.model.get, stems(word), [0.0] * (len(PREFIXES) + 1)))
        return total


def sentences(text: str, weights: Weights, bias: float) -> Iterator[tuple[int, int, float, float]]:
    """Start, length, probability and its logit of each sentence that has a word."""
    for m in SENTENCE.finditer(text):
        words = WORD.findall(m.group().lower())
        if words:
            z = bias + sum(map(weights.__getitem__, words))
            yield m.start(), m.end() - m.start(), 1 / (1 + math.exp(-z)) if z > -700 else 0.0, z


def model_of(model: DataFrame) -> tuple[dict[str, float], float | None]:
    """Weights by stem, at most STEMS, and the bias; no bias in an empty model."""
    rows = {r.stem: r.weight for r in model.limit(STEMS + 1).collect()}
    return rows, rows.pop(BIAS, None)


def score(docs: DataFrame, model: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with score (noisy-or), predicted, n_sentences, and the start and length of its worst sentence (null if none has a word).

    Columns of ``docs`` with one of these names are replaced.
    """
    own = ["score", "predicted", "n_sentences", "worst_start", "worst_length"]
    stem_weights, bias = model_of(model)
    kept = docs.drop(*[c for c in docs.columns if c.lower() in own and c.lower() != text.lower()])
    key, words = fresh(kept, "_row", "_text")
    kinds = [pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    at = kept.columns.index(next(c for c in kept.columns if c.lower() == text.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(stem_weights)
        for batch in batches:
            out: list[list] = [[] for _ in own]
            for x in batch.column(at):
                n, none, worst = 0, 0.0, (None, None, -math.inf)
                for start, length, _, z in sentences(x.as_py() or "", weights, bias) if bias is not None else ():
                    n += 1
                    none += math.log1p(math.exp(z)) if z < 30 else z
                    if z > worst[2]:
                        worst = (start, length, z)
                p = -math.expm1(-none)
                for column, v in zip(out, (p, int(p >= 0.5), n, *worst[:2]), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out, kinds)], [*batch.schema.names, *own])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", score double, predicted int, n_sentences long, worst_start long, worst_length long"
    return kept.mapInArrow(run, schema)


def locate(docs: DataFrame, model: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = 0.5) -> DataFrame:
    """doc_id, start, length, probability and sentence of every sentence of at least this probability."""
    stem_weights, bias = model_of(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(stem_weights)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, x in zip(batch.column(0), batch.column(1), strict=True):
                whole = x.as_py() or ""
                for start, length, p, _ in sentences(whole, weights, bias) if bias is not None else ():
                    if p >= least:
                        for column, v in zip(out, (key.as_py(), start, length, p, whole[start : start + length]), strict=True):
                            column.append(v)
            kinds = (batch.schema.types[0], pa.int64(), pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["doc_id", "start", "length", "probability", "sentence"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, start long, length long, probability double, sentence string")

"""Resolution of whole titles, against plain Python."""

from difflib import SequenceMatcher

from placeforge.operators import match
from placeforge.plans import ingestion

PLACE = {"place_name": "old harbour", "province_name": "hanoi", "aliases": "red gate", "query_context": "travel", "context_keywords": "boats|market", "category_terms": "museum|travel", "negative_keywords": "idiot"}
FILL = "plain words that say little about it " * 12


def brute(title, category="Travel"):
    """Score, status and reason of lower-case ASCII texts, by the rules of match.resolve."""
    names, both = [PLACE["place_name"], *PLACE["aliases"].split("|")], f"{title} travel"
    share = lambda terms: min(1.0, sum(t in both for t in terms) / len(terms))
    name = max(1.0 if n in title else SequenceMatcher(None, n, title).ratio() for n in names)
    parts = {"name": name, "location": share([PLACE["province_name"], PLACE["query_context"]]), "category": share(PLACE["category_terms"].split("|")), "context": share(PLACE["context_keywords"].split("|"))}
    words = set(both.split())
    negative = any(p in both for p in (*match.NEGATIVE_PHRASES, PLACE["negative_keywords"])) or bool(words & set(match.NEGATIVE_WORDS))
    score = sum(match.WEIGHTS[k] * v for k, v in parts.items())
    score -= match.WEAK_MATCH * (name < 1 and not parts["category"] and not parts["context"]) + match.NEGATIVE * negative
    score = max(0.0, min(1.0, score))
    status = "accepted" if score >= match.ACCEPTED and not negative else "uncertain" if score >= match.UNCERTAIN else "rejected"
    return round(score, 4), status, "negative_keyword" if negative else ";".join(f"{k}={v:.3f}" for k, v in parts.items())


def test_names_terms_and_negative_words_count_wherever_they_stand(spark, monkeypatch):
    titles = [FILL + tail for tail in ("old harbour", "the red gate in hanoi", "boats and a museum", "karaoke", "idiot", "nothing")] + ["old harbour", "short one"]
    titles = [" ".join(t.split()) for t in titles]
    rows = [(k, 1, t) for k, t in enumerate(titles)]
    tables = {"conversations": spark.createDataFrame(rows, "conv_id long, turn int, text string"), "nation": spark.createDataFrame([(k, "hanoi") for k in range(8)], "n_nationkey long, n_name string")}
    monkeypatch.setattr(ingestion, "base", lambda spark, d, name: tables[name])
    monkeypatch.setattr(match, "resolve", lambda pairs, resolve=match.resolve: resolve(pairs.drop(*PLACE).selectExpr("*", *[f"'{v}' AS {k}" for k, v in PLACE.items()])))
    got = {r.conv_id: (r.resolution_score, r.resolution_status, r.resolution_reason) for r in ingestion.ing14_resolution_score(spark, "").collect()}
    assert got == {k: brute(t) for k, t in enumerate(titles)}

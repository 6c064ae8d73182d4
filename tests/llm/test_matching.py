"""Near-duplicates, passages, URL rules and extraction against brute force and planted cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import EXTRA, empty, frame, odd_documents, words

from placeforge.llm import chunks, neardup, urls, wrapper


def bag(text, k=neardup.SHINGLE):
    w = words(text)
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def brute_classes(rows):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [bag(t) for _, t, *_ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if words(rows[i][1]) == words(rows[j][1]) or (bags[i] and bags[j] and similarity(bags[i], bags[j]) >= neardup.THRESHOLD):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[root(i)].append(row[0])
    return sorted((d, min((x for x in g if x is not None), default=None)) for g in groups.values() for d in g if d is not None)


def near_copies(seed=3):
    """Chains and stars of edits around bases, beside odd documents."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    rows = list(odd_documents())
    extra = rows[0][5:]
    for base in range(8):
        text = [r.choice(vocabulary) for _ in range(r.randint(60, 400))]
        chain = list(text)
        for step in range(12):
            kind = text[:] if base % 2 else chain
            for _ in range(max(1, len(kind) // 120)):
                kind[r.randrange(len(kind))] = r.choice(vocabulary)
            rows.append((1000 + 100 * base + step, " ".join(kind), "en", "s0", 1, *extra))
        rows.append((1000 + 100 * base + 50, " ".join(text), "en", "s0", 1, *extra))
    return rows


def test_classes_match_brute_force(spark):
    rows = near_copies()
    got = neardup.classes(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.class_id) for r in got if r.doc_id is not None) == brute_classes(rows)


def just_apart(seed, n=150):
    """One large group about the threshold: a text, a variant of it, and copies of each with few or many edits, some shared."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    first = [r.choice(vocabulary) for _ in range(150)]
    bases = [first, first[:120] + [r.choice(vocabulary) for _ in range(30)]]
    shared = [(r.randrange(150), r.choice(vocabulary)) for _ in range(12)]
    rows = []
    for k in range(n):
        copy = list(bases[k % 5 == 0])
        for _ in range(r.choice((1, 2, 3, 4, 5, 6, 9))):
            at, word = r.choice(shared) if r.random() < 0.4 else (r.randrange(150), r.choice(vocabulary))
            copy[at] = word
        rows.append((k, " ".join(copy), "en", "s0", 1, *EXTRA))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_link_is_lost_in_a_large_group_of_texts_just_apart(spark, seed):
    rows = just_apart(seed)
    expected = brute_classes(rows)
    assert 3 < len({c for _, c in expected}) < 100
    got = neardup.classes(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == expected


def test_one_document_of_each_class_stays(spark):
    rows = near_copies()
    docs = frame(spark, rows)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    classes = brute_classes(rows)
    assert len(ids) == len(set(ids)) and set(ids) == {c for _, c in classes}
    assert neardup.keep_one(empty(spark)).count() == 0


def test_signatures_estimate_weighted_jaccard_without_bias():
    r = np.random.default_rng(5)
    items = neardup.mix(np.arange(400, dtype=np.uint64))
    errors = []
    for _ in range(30):
        a, b = r.integers(0, 9, 400), r.integers(0, 9, 400)
        b = np.where(r.random(400) < 0.7, a, b)
        doc = np.repeat([0, 1], 400)
        weight = np.concatenate([a, b])
        s = neardup.signatures(doc[weight > 0], np.concatenate([items, items])[weight > 0], weight[weight > 0], 2, 512)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.04


def passage_documents():
    r = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "", "lé")]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    extra = EXTRA
    passages = [say(60) for _ in range(12)]
    rows = [(k, f"{say(r.randint(5, 300))} {passages[k % 12]} {say(r.randint(5, 300))}", "en", "s", 1, *extra) for k in range(48)]
    rows += [(100 + k, say(200), "en", "s", 1, *extra) for k in range(40)]
    rows += [(200, None, "en", "s", 1, *extra), (201, "", "en", "s", 1, *extra), (202, "la " * 3000, "en", "s", 1, *extra), (None, f"x {passages[0]} y", "en", "s", 1, *extra), (rows[3][0], rows[3][1], "en", "s", 1, *extra)]
    return rows, passages


def test_repeated_passages_are_found_and_clean_documents_left(spark):
    rows, passages = passage_documents()
    text = {r[0]: r[1] for r in rows}
    got = chunks.repeats(frame(spark, rows)).collect()
    hit = {r.doc_id for r in got} | {r.first_doc_id for r in got}
    assert set(range(48)) <= hit and not {d for d in hit if d is not None and d >= 100}
    assert None in {r.doc_id for r in got}
    for r in got:
        if r.doc_id is not None:
            part = text[r.doc_id].encode()[r.start : r.start + r.length]
            assert part in text[r.first_doc_id].encode() and part.decode(errors="ignore").strip() in passages[r.doc_id % 12] + " "
    kept = {r.doc_id: r for r in chunks.remove(frame(spark, rows)).collect() if r.doc_id != 3}
    assert all(kept[k].text == text[k] for k in [*range(12), *range(100, 140), 200, 201, 202] if k != 3)
    assert all(len(kept[k].text) < len(text[k]) - 100 for k in range(12, 48) if k % 12 != 3)
    assert chunks.repeats(empty(spark)).count() == 0 and chunks.remove(empty(spark)).count() == 0


def plain_cuts(data):
    """The rules for cuts, byte by byte."""
    n, h = len(data), []
    for k in range(n):
        h.append(sum(int(chunks.GEAR[data[k - j]]) << j for j in range(16) if k >= j) % 65536)
    near, least = chunks.NEAR, chunks.LEAST
    candidates = [k + 1 for k in range(n) if h[k] < 65536 // chunks.EVERY and 16 <= k + 1 < n]
    spots = [c for i, c in enumerate(candidates) if i == 0 or c - candidates[i - 1] > least]
    edges = [-near, *spots, n + near]
    if max(b - a for a, b in zip(edges, edges[1:], strict=False)) > 2 * near:
        low = [k + 1 for k in range(n) if 16 <= k + 1 < n and h[k] == min(h[max(0, k - near) : k + near + 1])]
        low = [c for c in low if not any(c - near <= e < c + near or e == c + near for e in edges)]
        taken, last = [], -least - 1
        for c in low:
            if c - last > least or not any(b - a <= least for a, b in zip(low, low[1:], strict=False)):
                taken.append(c)
                last = c
        spots = sorted({*spots, *taken})
    return [*spots, n] if n else []


def test_repeated_passages_match_brute_force(spark):
    rows, _ = passage_documents()
    parts = {}
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        ends = plain_cuts(raw)
        number = doc_id if doc_id is not None else 1 << 62
        parts[number] = [(a, raw[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
    holders = defaultdict(set)
    for number, own in parts.items():
        for _, piece in own:
            holders[piece].add(number)
    expected = []
    for number, own in parts.items():
        run = []
        for at, piece in [*own, (None, b"")]:
            if at is not None and min(holders[piece]) != number:
                run.append((at, piece))
                continue
            if run:
                text = b"".join(p for _, p in run)
                whole = parts[number]
                starts = sum(sum(1 for k in range(len(p)) if p[k] not in b" \t\n\x0b\x0c\r" and (k == 0 or p[k - 1] in b" \t\n\x0b\x0c\r") and not (k == 0 and a and whole_byte(whole, a - 1) not in b" \t\n\x0b\x0c\r")) for a, p in run)
                if starts >= chunks.WORDS:
                    expected.append((number if number < 1 << 62 else None, run[0][0], len(text), starts))
            run = []
    got = [(r.doc_id, r.start, r.length, r.n_words) for r in chunks.repeats(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr) and len(got) > 30


def whole_byte(parts, at):
    """The byte of a text at a place, from its pieces."""
    for start, piece in parts:
        if start <= at < start + len(piece):
            return piece[at - start]
    raise IndexError(at)


def test_texts_without_ids_are_documents_of_their_own(spark):
    rows, passages = passage_documents()
    two = [(None, f"{a} {passages[0]} {b}", *rows[0][2:]) for a, b in (("one", "end"), ("two", "stop"))]
    got = chunks.repeats(frame(spark, two)).collect()
    assert len(got) == 1 and got[0].doc_id is None and got[0].first_doc_id is None and got[0].n_words > 40
    assert sorted(len(r.text) for r in chunks.remove(frame(spark, two)).collect())[0] < 60


def test_cuts_resist_insertions():
    r = np.random.default_rng(1)
    data = r.integers(97, 123, 5000, dtype=np.uint8)
    moved = np.concatenate([np.frombuffer(b"inserted", np.uint8), data])
    a, b = set(chunks.cuts(data).tolist()), {x - 8 for x in chunks.cuts(moved).tolist()}
    assert len(a - b) <= 3 and 20 < 5000 / len(a) < 50
    assert np.diff(chunks.cuts(np.full(3000, 97, np.uint8))).max(initial=0) <= chunks.MOST


def brute_verdict(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:] if rest[cut : cut + 1] == "/" else ""
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fit = [(h.count(".") + 1, len(h) + len(p), h, p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2] + best[3], best[4] if best else urls.DEFAULT


def test_url_rules_match_brute_force(spark):
    r = random.Random(2)
    labels, parts = ["a", "b", "ab", "com", "net", "ex-1"], ["", "/", "/a", "/ab", "/ab/", "/ab/c", "/b%20", "/é"]
    rules = list({(".".join(r.choices(labels, k=r.randint(1, 3))), r.choice(parts)): r.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    pages = [(k, f"{r.choice(['http', 'https'])}://{r.choice(['', 'WWW.', 'x.'])}{'.'.join(r.choices(labels, k=r.randint(1, 4)))}{r.choice(parts)}{r.choice(['', 'c', '/q'])}{r.choice(['', '?a=://b/', '#top'])}") for k in range(800)]
    pages += [(None, None), (900, ""), (901, "no scheme.com/en"), (902, "http://"), (903, "http:///ab"), (904, "http://a.com")] + [(905, pages[0][1])] * 3
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = urls.match_rules(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    found = sorted(((r.page_id, r.url, r.url_host, r.url_path, r.rule, r.verdict) for r in got.collect()), key=repr)
    assert found == sorted(((k, u, *brute_verdict(u, rules)) for k, u in pages), key=repr)
    whole = spark.createDataFrame([("com", "", "block"), ("", "/", "block"), ("a/b", "", "block"), (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    near = spark.createDataFrame([(1, "http://x.community/z"), (2, "http://x.com"), (3, "http://com/z"), (4, "http://a/b"), (5, "http://telecom/")], "page_id long, url string")
    assert {r.page_id: (r.rule, r.verdict) for r in urls.match_rules(near, whole).collect()} == {1: (None, "allow"), 2: ("com", "block"), 3: ("com", "block"), 4: (None, "allow"), 5: (None, "allow")}
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urls.match_rules(df, none).collect()} == {"allow"} and urls.match_rules(df.limit(0), none).count() == 0


SITE = """<!DOCTYPE html><html><head><title>t{k}</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
<div class="top-bar"><a href="/">Home</a> <a href="/x">News {k}</a></div><div id="cookie-notice">We use cookies. Accept</div>
<div class="wrap"><div class="col-a"><h2>Story {k}</h2><p>First   paragraph {k} &amp; more&nbsp;words<br>on two lines, {body}</p><p>Second <b>paragraph</b> {k}: {body}.</p><ul><li>point {k}<li>other {k}</ul><p>Sign up for our daily letter today and never miss a story again</p></div>
<div class="rail"><a href="/1">Link one</a><a href="/2">Link two {k}</a></div></div>
<form action="/s"><input name=q><button>Go</button></form><section class="comments"><article class="comment"><p>Reader {k} says no</p></article></section><footer>&copy; site</footer>"""


def body(k):
    return " ".join(f"word{k}x{j}" for j in range(30))


@pytest.mark.parametrize("alone", [False, True])
def test_extraction_without_semantic_tags(spark, alone):
    n = 1 if alone else 7
    pages = [(k, f"http://site.example/{k}", SITE.format(k=k, body=body(k))) for k in range(n)]
    for r in wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect():
        k, b = r.page_id, body(r.page_id)
        expected = [f"Story {k}", f"First paragraph {k} & more words on two lines, {b}", f"Second paragraph {k}: {b}.", f"point {k}", f"other {k}"]
        letter = ["Sign up for our daily letter today and never miss a story again"] if alone else []
        assert r.text == "\n\n".join(expected + letter) and r.n_chars == len(r.text)


def test_extraction_of_articles_copies_and_broken_pages(spark):
    article = '<html><body><nav><ul><li><a href="/a">a</a></ul></nav><div class="ad">Buy</div><article><h1>T &lt;1&gt;</h1><p><b>Lead<br><p>Body text here</p><aside>More</aside></article><footer>&copy;</footer></body>'
    pages = [(1, "http://h.example/1", article), (2, "http://h.example/2", article), (3, "http://h.example/3", article), (4, None, None), (5, "x", ""), (6, "http://h2.example/", "<p>only <b>text"), (7, "http://h2.example/", "<div " * 3), (8, "http://h2.example/", "plain text &eacute;"), (9, "http://h2.example/", "<div>" * 3000 + "deep")]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == got[2] == got[3] == "T <1>\n\nLead\n\nBody text here"
    assert (got[4], got[5], got[6], got[7], got[8], got[9]) == ("", "", "only text", "", "plain text é", "deep")


def test_hosts_larger_than_a_block_are_split(spark):
    pages = [(k, f"http://big.example/{k}", SITE.format(k=k, body=body(k))) for k in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = wrapper.extract(df, block=8).collect()
    assert len(got) == 40 and all(f"Story {r.page_id}" in r.text and "cookies" not in r.text and "Reader" not in r.text for r in got)

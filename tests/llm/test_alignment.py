"""Extraction goes by the alignment: tree matching against brute force, roots from varying slots, odd shapes of pages."""

import random
import time
from functools import lru_cache

import pytest

from placeforge.llm import wrapper


def random_tree(r, n):
    nodes = [wrapper.Node("div", r.choice("ab"), None)]
    for _ in range(n - 1):
        up = r.choice(nodes)
        node = wrapper.Node("div", r.choice("abc"), up)
        up.add(node)
        nodes.append(node)
    return nodes[0]


def brute_matching(a, b):
    """The most pairs of equal labels that keep order and ancestors, roots paired, by trying all choices of children."""

    @lru_cache(None)
    def forest(p, q):
        if not p or not q:
            return 0
        best = max(forest(p[1:], q), forest(p, q[1:]))
        if p[0].label == q[0].label:
            best = max(best, 1 + forest(tuple(p[0].els), tuple(q[0].els)) + forest(p[1:], q[1:]))
        return best

    return 1 + forest(tuple(a.els), tuple(b.els))


@pytest.mark.parametrize("seed", range(60))
def test_alignment_is_a_best_simple_tree_matching(seed):
    r = random.Random(seed)
    a, b = random_tree(r, r.randint(1, 25)), random_tree(r, r.randint(1, 25))
    shapes = {}
    wrapper.prepare(a, shapes)
    wrapper.prepare(b, shapes)
    pairs = wrapper.align(a, b)
    assert len(pairs) == brute_matching(a, b)
    partner = dict(pairs)
    assert len(set(partner.values())) == len(partner)
    for x, y in pairs[1:]:
        assert x.label == y.label and partner[x.up] is y.up
    for x in partner:
        places = [partner[x].els.index(partner[k]) for k in x.els if k in partner]
        assert places == sorted(places)


def say(r, n):
    return " ".join(r.choice("ba de fi go hu la me ni".split()) + str(r.randrange(50)) for _ in range(n))


def plain_pages(n=9):
    """No semantic tags, no telling names: constant blocks around and within, one varying part with most of the text."""
    r = random.Random(7)
    legal, offer = say(r, 60), say(r, 25)
    page = "<div class=q><div class=x1>{legal}</div><div class=x2><div class=x3><h2>{title}</h2><p>{one}</p><div class=x4>{offer}</div><p>{two}</p></div></div><div class=x5>{small}</div></div>"
    rows = [{"title": say(r, 4), "one": say(r, 60), "two": say(r, 80), "small": say(r, 3)} for _ in range(n)]
    return [page.format(legal=legal, offer=offer, **k) for k in rows], ["\n\n".join((k["title"], k["one"], k["two"])) for k in rows]


def test_alignment_decides_where_names_do_not():
    pages, expected = plain_pages()
    aligned, alone = [wrapper.parse(p) for p in pages], [wrapper.parse(p) for p in pages]
    wrapper.mark_template(aligned)
    assert [wrapper.text_of(t) for t in aligned] == expected
    assert all(wrapper.text_of(t) != e for t, e in zip(alone, expected, strict=True))
    for t in aligned:  # the root is the varying slots' node, beside constant and small parts
        assert t.content.label == "div.x3" and any(k.template for k in t.els[0].els)


def test_a_page_with_another_layout_goes_by_itself():
    pages, expected = plain_pages()
    trees = [wrapper.parse(p) for p in [*pages, "<section class=z><p>Another layout</p><p>of one page</p></section>"]]
    wrapper.mark_template(trees)
    assert [wrapper.text_of(t) for t in trees] == [*expected, "Another layout\n\nof one page"]


def nested(n, k):
    return "<div>" * n + f"text {k}" + "</div>" * n


def unlike(n, k):
    r = random.Random(k)
    return "".join(f"<div class=c{r.randrange(400)}><p>w{k} {j}</p></div>" for j in range(n))


@pytest.mark.parametrize(
    "make",
    [
        lambda k: nested(20_000, k),
        lambda k: "<b>" * 20_000 + "<p>x</p>" * 2_000 + str(k),
        lambda k: "<article>" * 5_000 + f"text {k}",
        lambda k: f"<i>{k}</b></u></x>" * 20_000,
        lambda k: unlike(5_000, k),
        lambda k: "".join(f"<div><div>{unlike(3, k + j)}</div></div>" for j in range(300)),
    ],
)
def test_deep_and_wide_pages_take_a_second_at_most(make):
    pages = [make(k) for k in range(4)]
    began = time.process_time()
    trees = [wrapper.parse(p) for p in pages]
    wrapper.mark_template(trees)
    texts = [wrapper.text_of(t) for t in trees]
    assert time.process_time() - began < 1.5 * len(pages)
    assert all(texts) and len(set(texts)) == 4

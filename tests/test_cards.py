"""Review cards against a plain reading of random trees, and odd pages."""

import hashlib
import random
import re

from placeforge.functions.markup import tree
from placeforge.operators import cards

KINDS = [("span", 'class="wiI7pd"'), ("span", 'class="x rsqaWe y"'), ("span", "class='pkWtMe'"), ("div", 'class="CDe7pd"'), ("span", 'class="kvMYJc" aria-label="4 of 5"'), ("i", 'role="img" aria-label="Rated 2,5"'), ("div", ""), ("p", "class=wiI7pd"), ("b", 'role="button" aria-label="9"'), ("span", 'class="kvMYJc"')]


def grow(r, depth=0):
    """A node: (tag, attributes as text, children); a child may be text."""
    tag, attributes = r.choice(KINDS)
    if r.random() < 0.3:
        tag, attributes = "div", f'data-review-id="{r.choice(["a", "b", "c", "", " ", "d"])}"'
    children = [r.choice(["one", " two\n", "1.234", "&lt;x&gt;", "7 likes"]) if r.random() < 0.4 else grow(r, depth + 1) for _ in range(r.randint(0, 4))] if depth < 5 else ["leaf"]
    if tag == "p":
        children = [c for c in children if isinstance(c, str)]  # a paragraph holds no block
    return tag, attributes, children


def html(node):
    return node if isinstance(node, str) else f"<{node[0]} {node[1]}>{''.join(map(html, node[2]))}</{node[0]}>"


def walk(node, above=()):
    """(tag, attributes, node, the nodes above) in order."""
    for child in node[2]:
        if not isinstance(child, str):
            yield child, (*above, node)
            yield from walk(child, (*above, node))


def attribute(node, name):
    m = re.search(rf"\b{name}=(?:\"([^\"]*)\"|'([^']*)'|([^ ]+))", node[1])
    return None if m is None else next(g for g in m.groups() if g is not None)


def has_class(node, name):
    return name in (attribute(node, "class") or "").split()


def seen(node):
    if isinstance(node, str):
        return node.replace("&lt;", "<").replace("&gt;", ">")
    inner = "".join(map(seen, node[2]))
    return f"\n{inner}\n" if node[0] in ("div", "p") else inner


def clean(value):
    return re.sub(r"\s+", " ", value).strip() or None


def number(value):
    m = re.search(r"\d[\d.,]*", value or "")
    return int(re.sub(r"\D", "", m.group())) if m else None


def expected(place, root):
    first = {}
    for node, above in walk(root):
        if attribute(node, "data-review-id"):
            first.setdefault(attribute(node, "data-review-id"), (node, above))
    out = {}
    for name, (card, above) in first.items():
        inside = list(walk(card, above))
        pick = lambda f, inside=inside: next((n for n, up in inside if f(n, up)), None)
        stars = pick(lambda n, _: n[0] == "span" and has_class(n, "kvMYJc")) or pick(lambda n, _: attribute(n, "role") == "img" and attribute(n, "aria-label") is not None)
        label = re.search(r"\d+", (attribute(stars, "aria-label") or "") if stars else "")
        text = pick(lambda n, up: n[0] == "span" and has_class(n, "wiI7pd") and not any(has_class(x, "CDe7pd") for x in up))
        date, likes = (pick(lambda n, _, c=c: n[0] == "span" and has_class(n, c)) for c in ("rsqaWe", "pkWtMe"))
        text = clean(seen(text)) if text else None
        key = clean(name) or hashlib.sha1(f"{place}|{text or ''}".encode()).hexdigest()
        out.setdefault((place, key), (int(label.group()) if label else None, text, clean(seen(date)) if date else None, number(seen(likes).strip() or "0") if likes else 0))
    return out


def read(spark, pages, **options):
    df = spark.createDataFrame(pages, "place_id string, html string, key int, pos string")
    return {(r.place_id, r.review_id): (r.rating, r.review_text, r.review_date, r.likes_count) for r in cards.cards(df, **options).collect()}


def test_nested_cards_against_a_plain_reading(spark):
    r = random.Random(8)
    roots = [("div", "", [grow(r) for _ in range(6)]) for _ in range(300)]
    wanted = {}
    for k, root in enumerate(roots):
        wanted |= expected(f"p{k}", root)
    assert len(wanted) > 500
    assert read(spark, [(f"p{k}", html(root), 1, "x") for k, root in enumerate(roots)]) == wanted


def test_odd_pages(spark):
    card = '<div data-review-id="{}"><span class="wiI7pd">t</span></div>'
    pages = [("a", None, None, None), ("b", "", None, None), ("c", "no cards <b", None, None), (None, card.format("x"), 1, None), ("d", card.format("x") * 3 + card.format("y") + card.format("z"), 1, None), ("d", card.format("x"), 1, None)]
    assert read(spark, pages, most=2) == {(None, "x"): (None, "t", None, 0), ("d", "x"): (None, "t", None, 0), ("d", "y"): (None, "t", None, 0)}
    deep = "<div>" * 20000 + card.format("deep") + "</div>" * 20000
    assert read(spark, [("e", deep, 1, "")]) == {("e", "deep"): (None, "t", None, 0)}
    assert read(spark, []) == {}


def test_tree_follows_the_rules_of_the_language():
    root = tree("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>x<p>y</div><script>var a = '<b>';</script><br/>z<img src=a alt=b>&eacute;")
    assert [e.tag for e in root.descendants()] == ["ul", "li", "li", "ul", "li", "li", "p", "p", "script", "br", "img"]
    assert root.text().split() == ["a", "b", "c", "d", "x", "y", "zé"]

"""Operator 1, HTML extraction by wrapper induction.

Method. Pages of one host are grouped in blocks of about BLOCK pages. In a block every page's DOM tree is aligned with a
pivot page's by simple tree matching (the most pairs of equal labels that keep order and ancestors). Aligned nodes whose
text is the same on most pages are template; nodes whose text varies, and nodes without partner, are slots. The content
root is found on the pivot from the text of slots, pooled over the partners of each node: from the top, the way goes
down into a child that holds MAJOR of that text while nothing beside it is a heading, running text or MINOR of it. Each
page takes its partner of that node. Tags and roles mark page furniture that varies from page to page as content does,
which no alignment can tell; an article or main element breaks the tie where the way could not go on but it does; pages that
have no partner, and blocks of fewer than TEMPLATE_PAGES different pages, go by names and link density. Below the root
the furniture is left out, and of a root that is no article or main element the template too, but for headings of what varies.
Class names and ids count only outside articles, and only if they name furniture and nothing else. The rest is
the text: white space in a block becomes one blank, blocks are joined by two newlines. If the template would take all of
the root (pages that are copies), it is not used there.

Scale. One shuffle by (host, block). The number of blocks follows the host's page count, so a host with a third of all
pages is many blocks, and every page is aligned in its own; a task holds one block. Pages are dealt to blocks by a hash of
their place in the input, so rows that are equal, or without id and URL, are dealt like others, and each block of a large host has as many pages as an alignment needs. Only hosts of more than a block are in the table
of counts, which is broadcast only if small. Reading a page is linear in its length, whatever its depth; two child lists
are matched exactly while their product is within EFFORT, summed over two trees, and beyond that by their equal
subtrees and in order of labels, in n log n: such pages are aligned, but not by the most pairs.

Cases. Null or empty html: text ''. Null URLs and URLs without host are one host. A page alone on its host has no
partner and goes by names and density. Broken or cut markup is read as far as it goes. Repeated rows are read each.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize, small_side
from .urls import host_of

#: Pages aligned with one pivot; aligned nodes are template from this many pages and this share of equal texts on.
BLOCK = 48
TEMPLATE_PAGES, TEMPLATE_SHARE = 3, 0.9
#: Share of the slots' text below a node that one child must hold for the root to be there, and share of another child
#: from which on it is content too.
MAJOR, MINOR = 0.8, 0.1
#: Pairs of children that two trees may compare exactly.
EFFORT = 20_000

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Blocks that hold blocks; headings.
CONTAINERS = frozenset("html body div main section article center table tbody tr td header".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag closes: the nearest of these, unless one of the bounds comes first.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
FURNITURE = frozenset("nav footer aside form button select input dialog menu head script style noscript template iframe svg object audio video canvas map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class names and ids that mark page furniture, and words that may stand beside them: social-links is furniture,
#: social-history is not.
MARKS = frozenset("""
ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored
cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup
menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars side aside rail widget widgets
related recommended recommendations share sharing social follow footer foot header masthead topbar bottombar
comment comments disqus reply replies respond discussion form search login pagination pager toolbar copyright legal skip hidden
""".split())
BESIDE = frozenset("top bottom left right bar box block list section area container wrapper wrap inner outer content site page global main item items link links panel unit slot group row col column primary secondary js is has the".split())
WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "label", "kids", "els", "up", "noise", "marked", "shape", "size", "own", "template", "link", "content")

    def __init__(self, tag: str, label: str, up: Node | None, noise: bool = False, marked: bool = False) -> None:
        self.tag, self.label, self.up, self.noise, self.marked = tag, label, up, noise, marked
        self.kids: list = []
        self.els: list[Node] = []
        self.shape, self.size, self.own, self.template, self.content = 0, 1, None, False, None

    def add(self, kid: Node) -> None:
        self.kids.append(kid)
        self.els.append(kid)


def names_furniture(name: str) -> bool:
    """Whether a class name or id has a word for furniture and no word for anything else."""
    words = WORD.findall(re.sub(r"([a-z])(?=[A-Z])", r"\1 ", name).lower())
    return any(w in MARKS for w in words) and all(w in MARKS or w in BESIDE for w in words)


def marks_of(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """The node's label, whether its tag or role is furniture, whether its names mark it so, and whether it is the main part."""
    if not attributes or attributes.isspace():
        return tag, tag in FURNITURE, False, tag == "main"
    values = {}
    for m in ATTRIBUTE.finditer(attributes):
        values.setdefault(m[1].lower(), m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or "")
    role, names = values.get("role", "").lower(), f"{values.get('class', '')} {values.get('id', '')}".split()
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "").lower()
    main = tag == "main" or role == "main" or values.get("itemprop", "").lower() == "articlebody"
    marked = tag not in ("body", "html", "main") and not main and any(map(names_furniture, names))
    return f"{tag}.{' '.join(sorted(values.get('class', '').split()))}", tag in FURNITURE or role in ROLES or hidden, marked, main


class Open:
    """The open elements, outermost first, and where those of each tag, and of blocks, are among them."""

    def __init__(self, root: Node) -> None:
        self.nodes, self.tags = [root], ["html"]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.articles: list[Node] = []
        self.cleared = 0  # so many of them hold an article

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def last(self, tags) -> int:
        """The place of the innermost open element of one of these tags, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def push(self, tag: str, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.tags.append(tag)
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCKS:
            self.blocks.append(at)
        if node.tag in ("article", "main"):
            self.articles.append(node)

    def close(self, to: int) -> None:
        """Close the elements from this place on."""
        while len(self.nodes) > to:
            node, tag = self.nodes.pop(), self.tags.pop()
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
            if node.tag in ("article", "main"):
                self.articles.pop()
        self.cleared = min(self.cleared, to)


def parse(source: str) -> Node:
    """The DOM tree as far as it can be read: elements, and text pieces as they stand."""
    root = Node("html", "html", None)
    at, end, now = 0, len(source), Open(root)
    while at < end:
        m = TOKEN.search(source, at)
        text = source[at : m.start() if m else end]
        if not m and (cut := re.search(r"<[/a-zA-Z!][^>]*\Z", text)):
            text = text[: cut.start()]  # a tag that the page's end cuts off
        if text:
            now.top.kids.append(text)
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            place = now.last((tag,))
            if place and (tag in BLOCKS or not now.blocks or now.blocks[-1] < place):  # an inline end tag closes no block
                now.close(place)
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCKS and now.blocks and now.tags[now.blocks[-1]] == "p":
            now.close(now.blocks[-1])
        if tag in CLOSES:
            closes, bounds = map(now.last, CLOSES[tag])
            if closes > bounds:
                now.close(closes)
        label, noise, marked, main = marks_of(tag, attributes)
        if tag == "header":
            noise = all(k.noise or k.marked for k in now.articles)  # a header of the page, not of an article
        marked = marked and (tag == "article" or all(k.noise or k.marked for k in now.articles))  # names count outside articles
        node = Node("main" if main else tag, label, now.top, noise, marked)
        if not noise and not marked and node.tag in ("article", "main"):  # what holds an article is no furniture, whatever it is called
            for holder in now.nodes[max(1, now.cleared) :]:
                holder.noise, holder.marked = holder.noise and holder.tag in FURNITURE, False
            now.cleared = len(now.nodes)
        now.top.add(node)
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(source, at)
            at = over.end() if over else end
        elif tag not in VOID and (not attributes.endswith("/") or tag in BLOCKS):
            now.push(tag, node)
    return root


def in_order(root: Node) -> list[Node]:
    """All nodes, each before those below it."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += n.els
    return order


def prepare(root: Node, shapes: dict) -> int:
    """Number the shapes of all subtrees (equal shapes, equal numbers), count their nodes, and give each block its own text."""
    order = in_order(root)
    for n in reversed(order):
        n.shape = shapes.setdefault((n.label, tuple(k.shape for k in n.els)), len(shapes) + 1)
        n.size = 1 + sum(k.size for k in n.els)
    # a block's own text has its inline elements' and not its inner blocks'
    pieces: dict[int, list[str]] = {}
    stack: list[tuple] = [(root, root)]
    while stack:
        item, block = stack.pop()
        if isinstance(item, str):
            pieces[id(block)].append(item)
            continue
        if item.tag in BLOCKS:
            if item is not root:
                pieces[id(block)].append(" ")
            block = item
            pieces[id(block)] = []
        stack += [(k, block) for k in reversed(item.kids)]
    for n in order:
        if n.tag in BLOCKS:
            n.own = " ".join("".join(pieces[id(n)]).split())
    return root.size


def ends(p: list[Node], q: list[Node]) -> tuple[int, int]:
    """How many children the two lists have alike at the start, and then at the end. A best match pairs these."""
    lo, most = 0, min(len(p), len(q))
    while lo < most and p[lo].shape == q[lo].shape:
        lo += 1
    hi = 0
    while hi < most - lo and p[-1 - hi].shape == q[-1 - hi].shape:
        hi += 1
    return lo, hi


def table(p: list[Node], q: list[Node], memo: dict) -> list[list[int]]:
    """Pairs in the best match of the children from i and from j on, from the known matches of any two of them."""
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i in range(len(p) - 1, -1, -1):
        row, below, x = best[i], best[i + 1], p[i]
        for j in range(len(q) - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], below[j + 1] + memo[x.shape, q[j].shape] if x.label == q[j].label else 0)
    return best


def match_below(pairs: list[tuple[Node, Node]], memo: dict, left: list[int]) -> None:
    """Put into ``memo`` how many pairs the best match of each two nodes of one label has, by their shapes."""
    stack = list(pairs)
    while stack:
        x, y = stack[-1]
        key = (x.shape, y.shape)
        if key in memo or x.shape == y.shape:
            memo.setdefault(key, x.size)
            stack.pop()
            continue
        lo, hi = ends(x.els, y.els)
        known = 1 + sum(k.size for k in x.els[:lo]) + sum(k.size for k in x.els[len(x.els) - hi :])
        p, q = x.els[lo : len(x.els) - hi], y.els[lo : len(y.els) - hi]
        if not p or not q or len(p) * len(q) > left[0]:  # beyond the effort: what is alike at the ends, and the labels
            memo[key] = known + (sum((Counter(k.label for k in p) & Counter(k.label for k in q)).values()) if p and q else 0)
            continue
        open_ = [(a, b) for a in p for b in q if a.label == b.label and (a.shape, b.shape) not in memo]
        left[0] -= len(p) * len(q)
        if open_:
            stack += open_
        else:
            memo[key] = known + table(p, q, memo)[0][0]


def best_pairs(p: list[Node], q: list[Node], memo: dict, left: list[int]) -> list[tuple[Node, Node]]:
    """The pairs of two child lists that simple tree matching takes."""
    lo, hi = ends(p, q)
    pairs = [*zip(p[:lo], q[:lo], strict=True), *zip(p[len(p) - hi :], q[len(q) - hi :], strict=True)]
    p, q = p[lo : len(p) - hi], q[lo : len(q) - hi]
    if not p or not q:
        return pairs
    if len(p) * len(q) > left[0]:
        return pairs + far_pairs(p, q)
    left[0] -= len(p) * len(q)
    match_below([(a, b) for a in p for b in q if a.label == b.label], memo, left)
    best, i, j = table(p, q, memo), 0, 0
    while i < len(p) and j < len(q):
        if p[i].label == q[j].label and best[i][j] == best[i + 1][j + 1] + memo[p[i].shape, q[j].shape]:
            pairs.append((p[i], q[j]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return pairs


def far_pairs(p: list[Node], q: list[Node]) -> list[tuple[Node, Node]]:
    """Pairs of two long child lists in order: subtrees that each list has once, the longest row of them; between these by label."""
    one, two = Counter(k.shape for k in p), Counter(k.shape for k in q)
    place = {k.shape: j for j, k in enumerate(q) if two[k.shape] == 1}
    tails: list[int] = []  # the longest increasing row: its least ends, and each one's predecessor
    rows: list[tuple[int, int, int]] = []
    held: list[int] = []
    for i, k in enumerate(p):
        if one[k.shape] == 1 and k.shape in place:
            j = place[k.shape]
            at = bisect_left(tails, j)
            rows.append((i, j, held[at - 1] if at else -1))
            tails[at : at + 1] = [j]
            held[at : at + 1] = [len(rows) - 1]
    anchors, seek = [(len(p), len(q))], held[-1] if held else -1
    while seek >= 0:
        anchors.append(rows[seek][:2])
        seek = rows[seek][2]
    pairs, i, j = [], 0, 0
    for end_i, end_j in reversed(anchors):
        spots: dict[str, list[int]] = {}
        for k in range(j, end_j):
            spots.setdefault(q[k].label, []).append(k)
        for k in range(i, end_i):
            there = spots.get(p[k].label, [])
            at = bisect_left(there, j)
            if at < len(there):
                pairs.append((p[k], q[there[at]]))
                j = there[at] + 1
        if end_i < len(p):
            pairs.append((p[end_i], q[end_j]))
        i, j = end_i + 1, end_j + 1
    return pairs


def align(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching of two nodes with one label: the pairs of nodes."""
    out, stack, memo, left = [], [(a, b)], {}, [EFFORT]
    while stack:
        x, y = stack.pop()
        out.append((x, y))
        stack += best_pairs(x.els, y.els, memo, left)
    return out


def mark_template(trees: list[Node]) -> None:
    """Mark the nodes whose own text the pages of a block share, and each page's content root. Needs TEMPLATE_PAGES different trees."""
    if len(trees) < TEMPLATE_PAGES:
        return
    shapes: dict = {}
    sizes = [prepare(t, shapes) for t in trees]
    pivot = trees[sorted(range(len(trees)), key=lambda k: (sizes[k], k))[len(trees) // 2]]
    partners: dict[int, list[Node]] = {}
    for tree in trees:
        for x, y in align(pivot, tree):
            partners.setdefault(id(x), []).append(y)
            y.content = x  # for now: its partner
    for nodes in partners.values():
        if nodes[0].tag not in BLOCKS:  # words inside a block that varies belong to it
            continue
        if len(nodes) < max(TEMPLATE_PAGES, TEMPLATE_SHARE * len(trees)):
            continue
        text, n = Counter(k.own for k in nodes).most_common(1)[0]
        if text and n >= TEMPLATE_SHARE * len(nodes):
            for k in nodes:
                k.template = k.own == text
    for tree in trees:
        for n in in_order(tree):
            for x, following in zip(n.els, n.els[1:], strict=False):
                if x.template and x.tag in HEADINGS and following.own and not following.template and following.tag in ("p", "ul", "ol", "table", "pre", "blockquote", "dl"):
                    x.template = False  # the heading of what varies
    pooled: dict[int, tuple[int, int]] = {}
    for tree in trees:
        for n, (text, links) in weigh(tree).items():
            if n.content is not None:
                before = pooled.get(id(n.content), (0, 0))
                pooled[id(n.content)] = before[0] + text, before[1] + links
    root = slot_root(pivot, pooled, partners)
    for tree in trees:
        tree.content = None
    for node in partners[id(root)] if root is not None else ():
        top = node
        while top.up is not None:
            top = top.up
        top.content = node


def slot_root(pivot: Node, pooled: dict[int, tuple[int, int]], partners: dict[int, list[Node]]) -> Node | None:
    """The lowest node of the pivot that holds the content, by the text in slots of all partners; None if slots have no text."""
    prose = lambda n: pooled.get(id(n), (0, 0))[0] - 2 * pooled.get(id(n), (0, 0))[1]
    if prose(pivot) <= 0:
        return None
    named = named_root(pivot, lambda n: pooled.get(id(n), (0, 0))[0] > 0)
    ways = set()
    while named is not None:
        ways.add(id(named))
        named = named.up
    node = pivot
    while True:
        there = [k for k in node.els if prose(k) > 0]
        most = max(there, key=prose, default=None)
        beside = [k for k in there if k is not most]
        loose = any(not k.template and any(isinstance(t, str) and not t.isspace() for t in k.kids) for k in partners[id(node)])
        running = loose or any(k.tag not in CONTAINERS or prose(k) >= MINOR * prose(node) or any(d.tag in HEADINGS for d in in_order(k)) for k in beside)
        if most is not None and most.tag in CONTAINERS and prose(most) >= MAJOR * prose(node) and not running:
            node = most
            continue
        # a tie: names go on where they can
        named_way = [k for k in there if id(k) in ways]
        if not named_way:
            return node
        node = named_way[0]


def named_root(tree: Node, has_text) -> Node | None:
    """The lowest node that holds all article and main elements with text that are no furniture."""
    named, stack = [], [tree]
    while stack:
        n = stack.pop()
        if n.noise or n.marked:
            continue
        if n.tag in ("article", "main") and has_text(n):
            named.append(n)
        stack += reversed(n.els)
    return common(named) if named else None


def weigh(node: Node) -> dict[Node, tuple[int, int]]:
    """Characters of slot text outside furniture, and of them in links, below every node."""
    weights: dict[Node, tuple[int, int]] = {}
    order, stack = [], [(node, False)]
    while stack:
        n, link = stack.pop()
        n.link = link or n.tag == "a"
        order.append(n)
        for k in n.els:
            k.template = k.template if k.tag in BLOCKS else n.template
            if not k.noise and not k.marked:
                stack.append((k, n.link))
    for n in reversed(order):
        own = 0 if n.template else sum(len(k.strip()) for k in n.kids if isinstance(k, str))
        text, links = own, own if n.link else 0
        for k in n.els:
            if k in weights:
                text, links = text + weights[k][0], links + weights[k][1]
        weights[n] = text, links
    return weights


def content_root(tree: Node) -> Node:
    """The root that the alignment found, or else by names, or else the lowest node with all text outside furniture."""
    if tree.content is not None:
        return tree.content
    weights = weigh(tree)
    prose = lambda n: weights[n][0] - 2 * weights[n][1] if n in weights else -1
    named = named_root(tree, lambda n: weights[n][0] > 0)
    if named is not None:
        return named
    root = tree
    while True:
        inner = [k for k in root.els if k in weights and k.tag in BLOCKS]
        held = [k for k in inner if prose(k) > 0]
        beside = prose(root) - sum(map(prose, inner))
        if len(held) != 1 or beside > 0 or held[0].tag in ("p", "li", "pre", "blockquote", "table", "ul", "ol"):
            return root
        root = held[0]


def common(nodes: list[Node]) -> Node:
    """The lowest node that holds all of these."""
    path, seek = [], nodes[0]
    while seek is not None:
        path.append(seek)
        seek = seek.up
    place, seen, lowest = {n: k for k, n in enumerate(path)}, set(), 0
    for n in nodes[1:]:
        while n not in place and n not in seen:
            seen.add(n)
            n = n.up
        lowest = max(lowest, place.get(n, 0))
    return path[lowest]


def blocks_of(root: Node, by_template: bool, density: bool) -> list[str]:
    """The text blocks below a root in page order. density: leave out blocks that are mostly links, but for those of articles."""
    blocks: list[str] = []
    parts: list[str] = []
    links = [0]

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text and not (density and links[0] > 0.6 * len(text)):
            blocks.append(text)
        parts.clear()
        links[0] = 0

    # an explicit stack of (node, next child), since pages may nest deeply
    stack = [[root, 0, False, root.tag == "article"]]
    while stack:
        frame = stack[-1]
        node, k, link, article = frame
        if k == len(node.kids):
            stack.pop()
            if node.tag in BLOCKS:
                flush()
            continue
        frame[1] += 1
        kid = node.kids[k]
        if isinstance(kid, str):
            if not (by_template and node.template):
                parts.append(kid)
                links[0] += len(kid.strip()) if link and not article else 0
        elif kid.tag == "br":
            parts.append(" ")
        elif not kid.noise and not kid.marked and kid.tag not in RAW:
            if kid.tag in BLOCKS:
                flush()
            stack.append([kid, 0, link or kid.tag == "a", article or kid.tag == "article"])
    flush()
    return blocks


def text_of(tree: Node) -> str:
    root = content_root(tree)
    named = root.tag in ("article", "main")
    whole = blocks_of(root, False, not named)
    if named:  # the page says that all of it is content
        return "\n\n".join(whole)
    pruned = blocks_of(root, True, True)
    return "\n\n".join(pruned or whole)


def extract_block(pages: pa.Table) -> pa.Table:
    """The pages of one block, aligned with each other."""
    order = sorted(range(len(pages)), key=lambda k: (str(pages["page_id"][k]), str(pages["url"][k])))
    sources = [pages["html"][k].as_py() or "" for k in order]
    trees = [parse(s) for s in sources]
    different = {}
    for s, t in zip(sources, trees, strict=True):
        different.setdefault(s, t)  # copies of a page say nothing about its template
    mark_template(list(different.values()))
    done = {s: text_of(t) for s, t in different.items()}
    texts = [done[s] for s in sources]
    return pa.table({"page_id": pages["page_id"].take(order), "url": pages["url"].take(order), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", block: int = BLOCK) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    large = materialize(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(F.col("host").alias("large"), F.ceil(F.col("n") / block).alias("blocks")), "large-hosts")
    side, _ = small_side(large, 200_000)
    dealt = rows.join(side, F.col("host") == F.col("large"), "left")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("blocks", F.lit(1))))
    kind = pages.schema[page_id].dataType.simpleString()
    out = f"page_id {kind}, url string, text string, n_chars long"
    return dealt.select("page_id", "url", "html", "host", "block").groupBy("host", "block").applyInArrow(extract_block, out)

"""A small reader of HTML: a tree of elements with their attributes and text, and searches in it by tag, class and attribute."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

# ---- Fixed values of the HTML standard ----
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that end an open one of the same kind beside them, up to the element that holds the list.
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select", "datalist"), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "p": ("div", "section", "article", "td", "li", "body")}
#: Elements whose text stands on a line of its own.
BLOCKS = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset(("script", "style", "template", "noscript"))
# ---- End of fixed values ----


@dataclass(eq=False)
class Element:
    """``parts``: texts and elements in order; ``order``: its place among all elements of the page."""

    tag: str
    attributes: dict[str, str]
    parent: Element | None
    order: int
    parts: list[str | Element] = field(default_factory=list)

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def descendants(self) -> Iterator[Element]:
        """In the order of the page, without recursion: pages may be nested deeply."""
        stack = [p for p in reversed(self.parts) if isinstance(p, Element)]
        while stack:
            e = stack.pop()
            yield e
            stack += [p for p in reversed(e.parts) if isinstance(p, Element)]

    def ancestors(self) -> Iterator[Element]:
        e = self.parent
        while e is not None:
            yield e
            e = e.parent

    def text(self) -> str:
        """What a reader sees of it: blocks and line breaks on lines of their own, without scripts and styles."""
        out: list[str] = []
        stack: list[str | Element] = [self]
        while stack:
            p = stack.pop()
            if isinstance(p, str):
                out.append(p)
            elif p.tag == "br":
                out.append("\n")
            elif p.tag not in HIDDEN:
                edge = ["\n"] if p.tag in BLOCKS else []
                stack += [*edge, *reversed(p.parts), *edge]
        return "".join(out)


@dataclass(frozen=True)
class Selector:
    """An element of this tag (any if empty) with this class and these attributes; a value of None asks for the attribute alone."""

    tag: str = ""
    cls: str = ""
    attributes: tuple[tuple[str, str | None], ...] = ()

    def fits(self, e: Element) -> bool:
        own = e.attributes
        return (not self.tag or e.tag == self.tag) and (not self.cls or self.cls in e.classes) and all(k in own and (v is None or own[k] == v) for k, v in self.attributes)

    def find(self, root: Element) -> Iterator[Element]:
        return (e for e in root.descendants() if self.fits(e))

    def first(self, root: Element) -> Element | None:
        return next(self.find(root), None)

    def around(self, e: Element) -> bool:
        """Whether the element or one that it stands in fits."""
        return self.fits(e) or any(map(self.fits, e.ancestors()))


class Reader(HTMLParser):
    """Builds the tree. End tags without a start are skipped; what is open at the end of the page is closed there."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {}, None, 0)
        self.open, self.count = [self.root], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SIBLINGS:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag == tag:
                    del self.open[k:]
                    break
                if self.open[k].tag in SIBLINGS[tag]:
                    break
        self.count += 1
        own: dict[str, str] = {}
        for k, v in attrs:
            own.setdefault(k, v or "")  # of a repeated attribute the first counts
        e = Element(tag, own, self.open[-1], self.count)
        self.open[-1].parts.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash of <div/> means nothing

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def tree(html: str | None) -> Element:
    """The root, without a tag, of the page's elements."""
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    return reader.root

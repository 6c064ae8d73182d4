"""Extraction keeps what stands beside the largest part of the content."""

import pytest

from placeforge.llm import wrapper

PAGE = '<html><body><div class="nav"><a href="/">Home</a></div>{main}<div class="footer">&copy; site</div></body></html>'


def text(k, n):
    return " ".join(f"w{k}x{j}" for j in range(n))


@pytest.mark.parametrize(
    ("main", "expected"),
    [
        ('<div class="content"><h1>Title {k}</h1><div class="text"><p>{a}</p><p>{b}</p></div></div>', ["Title {k}", "{a}", "{b}"]),
        ('<div class="page"><div class="intro"><p>{b}</p></div><div class="body"><p>{a}</p><p>{a}</p></div></div>', ["{b}", "{a}", "{a}"]),
        ("<main><h1>Head {k}</h1><article><p>{a}</p></article></main>", ["Head {k}", "{a}"]),
        ("<div><article><p>{a}</p></article><article><p>{b}</p></article></div>", ["{a}", "{b}"]),
    ],
)
@pytest.mark.parametrize("n", [1, 6])
def test_all_content_is_kept(main, expected, n):
    pages = [PAGE.format(main=main.format(k=k, a=text(k, 90), b=text(k + 100, 30))) for k in range(n)]
    trees = [wrapper.parse(p) for p in pages]
    wrapper.mark_template(trees)
    for k, tree in enumerate(trees):
        assert wrapper.text_of(tree) == "\n\n".join(e.format(k=k, a=text(k, 90), b=text(k + 100, 30)) for e in expected)

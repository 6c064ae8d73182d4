"""Extraction end to end: sites built from known articles, and the given pages without any telling name."""

import html
import os
import random
import re

import pytest

from placeforge.llm import wrapper

PAGES = "/root/testdata/sf0.01/pages.parquet"
SCHEMA = "page_id long, url string, html string"


def say(r, n):
    return " ".join(r.choice("ba de fi go hu la me ni".split()) + str(r.randrange(900)) for _ in range(n))


def article(r):
    """Markup of an article's blocks and their texts."""
    blocks, texts = [f"<h1>{(t := say(r, 4))}</h1>"], [t]
    for _ in range(r.randint(4, 9)):
        kind, words = r.choice("pppulqst"), say(r, r.randint(12, 40))
        if kind == "p":
            a, b = say(r, 3), say(r, 20)
            blocks.append(f"<p class='{r.choice(['', 'notice', 'lead', 'comment-free'])}'>\n {words} &amp; <b>{a}</b><br>{html.escape('<' + b + '>')}  </p>")
            texts.append(f"{words} & {a} <{b}>")
        elif kind in "ul":
            items = [say(r, r.randint(5, 15)) for _ in range(3)]
            blocks.append("<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>")
            texts += items
        elif kind == "q":
            blocks.append(f"<blockquote><p>{words}</p></blockquote>")
            texts.append(words)
        elif kind == "s":
            blocks.append(f"<h2>Summary</h2><section class='social-history'><p>{words}</p></section>")
            texts += ["Summary", words]
        else:
            blocks.append(f"<fieldset><p>{words}</p></fieldset>")
            texts.append(words)
    return "".join(blocks), "\n\n".join(texts)


def page(r, body, tag):
    nav = "".join(f'<li><a href="/{k}">{say(r, 2)}</a></li>' for k in range(6))
    return (
        f"<!DOCTYPE html><html><head><title>{say(r, 3)}</title><style>p{{}}</style></head><body><nav><ul>{nav}</ul></nav><div class='ad-banner'><p>{say(r, 9)}</p></div>"
        f"<div class='wrap'><{tag} class='story'>{body}</{tag}><aside><p>{say(r, 12)}</p></aside></div><div id='cookie-notice'>We use cookies</div>"
        f"<section class='comments'><article class='comment'><p>{say(r, 15)}</p></article></section><form><input name=q><button>Go</button></form><footer><p>{say(r, 8)}</p></footer><script>var x = '<p>';</script></body></html>"
    )


@pytest.mark.parametrize("tag", ["article", "main"])
def test_articles_come_out_as_they_were_put_in(spark, tag):
    r = random.Random(tag)
    rows, wanted = [], {}
    for k in range(60):
        body, text = article(r)
        rows.append((k, f"http://{'big' if k % 3 else f'h{k % 4}'}.example/{k}", page(r, body, tag)))
        wanted[k] = text
    rows += [(None, None, rows[0][2])] * 9
    got = wrapper.extract(spark.createDataFrame(rows, SCHEMA), block=8).collect()
    assert len(got) == 69 and [x.text for x in got if x.page_id is None] == [wanted[0]] * 9
    assert {x.page_id: x.text for x in got if x.page_id is not None} == wanted
    assert wrapper.extract(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.skipif(not os.path.exists(PAGES), reason="the driver's tables are not here")
def test_alignment_finds_the_text_of_the_given_pages_without_names():
    """All tags that tell something become div, and classes, ids and roles go; hosts of three or more pages."""
    import pyarrow.parquet as pq

    plain = lambda s: re.sub(r"<(/?)(article|main|nav|footer|aside|header|section)\b", r"<\1div", re.sub(r"\s(class|id|role|itemprop|aria-[a-z]+)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", s))
    hosts: dict[str, list[str]] = {}
    for url, source in zip(*(pq.read_table(PAGES, columns=[c])[c].to_pylist() for c in ("url", "html")), strict=True):
        hosts.setdefault((url or "").split("/")[2] if "://" in (url or "") else "", []).append(source or "")
    same = total = 0
    for sources in hosts.values():
        if len(set(sources)) >= 3:
            both = []
            for change in (lambda s: s, plain):
                trees = {s: wrapper.parse(change(s)) for s in sources}
                wrapper.mark_template(list(trees.values()))
                both.append([wrapper.text_of(trees[s]) for s in sources])
            same += sum(a == b for a, b in zip(*both, strict=True))
            total += len(sources)
    print(f"{same} of {total} texts are the same without names")
    assert total > 150 and same >= 0.95 * total

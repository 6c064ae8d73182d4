"""The rules of op8 word for word, and what they say of one page each."""

from placeforge.llm import urls

CONTRACT = {("com", "/en/"): "block", ("example.com", "/en/7"): "allow", ("net", "/de/"): "allow", ("example.net", "/de/8"): "block", ("org", "/es/"): "block"}


def test_rules_and_verdicts_are_those_of_the_contract(spark):
    assert {(h, p): v for h, p, v in urls.RULES} == CONTRACT
    pages = [(1, "http://a.com/en/1"), (2, "http://www.example.com/en/71"), (3, "http://x.net/de/1"), (4, "http://EXAMPLE.net/de/8?q"), (5, "http://x.org/es/"), (6, "http://x.net/fr/")]
    got = urls.match_rules(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(urls.RULES, "host string, path string, verdict string"))
    assert {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "allow"}

"""Main text of pages without marks, with stray quotes, copies and several articles."""

import pytest

from logwarden.llm import html_extract


def texts(spark, pages):
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    found = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in found}


def frame(body):
    return f"<html><body><div class=top>Site name</div>{body}<div class=low>All rights kept</div></body></html>"


def test_text_beside_the_main_part_stays(spark):
    pages = [("http://a/x", frame(f"<div class=content><p>Intro {i} words</p><section><p>Long text {i} "
                                  + "more " * 20 + f"</p><p>End {i}</p></section></div>")) for i in range(6)]
    for i, text in texts(spark, pages).items():
        assert text == f"Intro {i} words\n\nLong text {i} " + ("more " * 20).strip() + f"\n\nEnd {i}"


def test_copies_of_a_page_make_no_template(spark):
    article = "<p>The same story</p><p>told four times</p>"
    pages = [("http://b/x", frame(f"<div class=content><p>Day {i}</p>{article if i < 4 else f'<p>Other {i}</p><p>News {i}</p>'}</div>"
                                  if i >= 4 else f"<div class=content><p>Day 1</p>{article}</div>")) for i in range(7)]
    found = texts(spark, pages)
    assert all(found[i] == "Day 1\n\nThe same story\n\ntold four times" for i in range(4))
    assert found[5] == "Day 5\n\nOther 5\n\nNews 5"


def test_paragraphs_stay_beside_longer_lists(spark):
    pages = [("http://c/x", frame(f"<div class=content><p>Para {i}</p><ul><li>Item {i} " + "long " * 30
                                  + f"</li><li>Next {i}</li></ul></div>")) for i in range(5)]
    for i, text in texts(spark, pages).items():
        assert text.startswith(f"Para {i}\n\nItem {i}") and text.endswith(f"Next {i}")


@pytest.mark.parametrize("tag", ["p title=it's", "p title=\"a > b\"", "p title='x \"y > z'", "p data-a=b'c\"d", "p title = \"q\""])
def test_quotes_in_tags(spark, tag):
    assert texts(spark, [("http://d/x", f"<article><{tag}>One</p><p>it's two</p></article>")])[0] == "One\n\nit's two"


def test_articles_beside_each_other(spark):
    part = lambda n: f"<article class=post><p>{'word ' * n}</p></article>"
    found = texts(spark, [("http://e/1", part(50) + part(40)), ("http://e/2", part(50) + "<article class=teaser><p>Read on</p></article>"),
                          ("http://e/3", part(50) + part(2))])
    assert len(found[0].split()) == 90 and len(found[1].split()) == 50 and len(found[2].split()) == 50


def test_region():
    assert html_extract.region([("body/div.a/section", 90), ("body/div.a", 10)]) == "body/div.a"
    assert html_extract.region([("body/div.a/section", 99), ("body/div.b", 1)]) == "body/div.a/section"
    assert html_extract.region([("body/div.a", 50), ("body/div.b", 50)]) == "body"
    assert html_extract.region([]) == ""


def test_alignment_against_brute_force():
    """An aligned wrapper accepts both token streams it was made of."""
    import itertools

    streams = [list(s) for n in range(1, 5) for s in itertools.product("ab", repeat=n)]
    for one, two in itertools.product(streams, repeat=2):
        wrapper = html_extract.align(list(one), list(two))
        assert accepts(wrapper, one) and accepts(wrapper, two), (one, two, wrapper)


def accepts(wrapper, page):
    """Every way to leave out optional parts."""
    reached = {0}
    for node in wrapper:
        optional = isinstance(node, tuple) and node[0] == "?"
        want = node[1][0] if optional else node
        steps = {i + 1 for i in reached if i < len(page) and page[i] == want}
        reached = steps | (reached if optional else set())
    return len(page) in reached

"""Operator 8 on pages whose classes, unclosed tags or nesting must not cost the article."""
import time

import pytest

from parley.llm import html

BODY = "Several words of the article that stand in a paragraph of their own. " * 5
TEXT = " ".join((BODY * 1).split())
NOTES = "<p>" + "A reader says much more than the article does. " * 40 + "</p>"


CASES = [
    (f'<div id="page" class="site has-sidebar"><div class="content"><h1>Title</h1><p>{BODY}</p></div></div>', f"Title {TEXT}"),
    (f'<div class="entry no-comments"><p>{BODY}</p></div>', TEXT),
    (f'<section class="story share-enabled"><p>{BODY}</p></section>', TEXT),
    (f'<div class="layout sidebar-left"><div class=post><h1>Title</h1><p>{BODY}</p></div></div>', f"Title {TEXT}"),
    (f'<article><header><h1>Title</h1></header><p>{BODY}</p></article>', f"Title {TEXT}"),
    (f'<nav><ul><li><a href=/>Home</a><li><a href=/b>About</a></ul><article><h1>Title</h1><p>{BODY}</p></article>', f"Title {TEXT}"),
    (f'<form id=aspnetForm><nav><a href=/>Menu</a></nav><div><h1>Title</h1><p>{BODY}</p></div><div class=comments>{NOTES}</div></form>', f"Title {TEXT}"),
    (f'<div class="w-1/2 p-1.5"><h1>Title</h1><p>{BODY}</p></div>', f"Title {TEXT}"),
    # what the names are for
    (f'<div class=post><p>Short.</p></div><div class=comments>{NOTES}</div>', "Short."),
    (f'<div class=post><h1>Title</h1><p>Short.</p></div><ol class=commentlist><li><article class=comment>{NOTES}</article></ol>', "Title Short."),
    (f'<div class=cookie-notice><p>{BODY}</p></div>', ""),
    (f'<footer><p>{BODY}</p></footer>', ""),
    (f'<div class=post><h1>Title</h1><p>{BODY} <span class=ad>Buy</span></p></div><aside><h1>More</h1>{NOTES}</aside>', f"Title {TEXT}"),
    (f'<article><div hidden>{NOTES}</div><p>{BODY}</p></article>', TEXT),
]
SHELL = "<html><body><header><h1>Site</h1></header>{}</body></html>"


@pytest.mark.parametrize(("page", "want"), CASES)
def test_wrappers(page, want):
    path, _ = html.best_container(html.parse(page))
    for given in (page, SHELL.format(page)):
        assert html.extract(given, None) == want
    assert html.extract(page, path) == want


def test_wrappers_by_host(spark):
    rows = [(2 * i + k, f"http://{i}.org/{k}", given) for i, (page, _) in enumerate(CASES) for k, given in enumerate((page, page))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract_pages(pages).collect()}
    assert got == {2 * i + k: want for i, (_, want) in enumerate(CASES) for k in (0, 1)}


def test_deep_nesting_is_linear():
    def seconds(page):
        start = time.perf_counter()
        path, _ = html.best_container(html.parse(page))
        html.extract(page, path)
        return time.perf_counter() - start
    for unit in ("<div>t", "<div class=a><p>x</section></b>", "<div class=sidebar>t", "<ul><li>t"):
        assert seconds(unit * 8_000) < 4
        assert seconds(unit * 24_000) < 12
    assert html.extract("<div>t" * 8_000, None) == " ".join("t" * 8_000)

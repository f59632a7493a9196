"""What the deduced slots take and leave, whatever the number of pages and the names."""

from __future__ import annotations

import pytest

from marketbars.llm import html_extract
from marketbars.llm.html_pages import Run, read

# Each {0} is the number of the page. No element of the first is named after what it is.
TEMPLATES = {
    "unnamed": (
        '<div class="x1"><span>Site motto here</span><a href="/">Home</a></div><div class="x2">'
        "<h2>Head {0}</h2><p>Own text {0}</p><p>Printed on every page</p></div>"
        '<div class="x3">All rights reserved</div>',
        "Head {0}\n\nOwn text {0}\n\nPrinted on every page",
    ),
    "sidebar article": (
        '<aside class="related"><article><h3>Other {0}</h3></article></aside>'
        '<div class="post"><h1>Head {0}</h1><p>Real body {0}</p></div>',
        "Head {0}\n\nReal body {0}",
    ),
    "comment articles": (
        "<article><h1>Head {0}</h1><p>Body {0}</p></article>"
        '<section id="comments"><article class="comment"><p>Reader {0}</p></article></section>'
        '<article class="comment-body"><p>Another reader {0}</p></article>',
        "Head {0}\n\nBody {0}",
    ),
    "promoted article": (
        '<div class="sidebar"><article>promo {0}</article></div>'
        '<div class="text"><p>Real body {0} of some words</p></div>',
        "Real body {0} of some words",
    ),
    "names inside": (
        '<article><header><h1>Headline {0}</h1><nav>menu</nav></header><p class="header-lead">Lead</p>'
        '<p class="alert-box-text">Alert {0}</p><div class="social-history">Past {0}</div>'
        '<div class="social-share">Share {0}</div><div class="ad-300">Buy {0}</div>'
        '<p style="color:red; display: none">unseen</p><footer>by {0}</footer></article>',
        "Headline {0}\n\nLead\n\nAlert {0}\n\nPast {0}",
    ),
    "few named teasers": (
        '<div class="x1"><p>Long body {0} of rather many words, more than the teasers have</p></div>'
        '<div class="x2"><article>Next {0}</article></div>',
        "Long body {0} of rather many words, more than the teasers have\n\nNext {0}",
    ),
    "unclosed menu": (
        '<nav><ul><li><a href="/">Home</a><article><p>Body {0}</p></article><nav>more</nav>',
        "Body {0}",
    ),
    "unclosed box": (
        '<div class="wrap"><div class="ad">Buy<article><p>Body {0}</p></article></div>',
        "Body {0}",
    ),
}


@pytest.fixture(scope="module")
def found(spark):
    """(template, pages of its host, page) -> text."""
    pages, numbers = [], {}
    for name, (body, _) in TEMPLATES.items():
        for n in (1, 2, 19, 20, 500):
            for k in range(n):
                numbers[len(numbers)] = name, n, k
                url = f"http://{name.replace(' ', '-')}-{n}.org/{k}"
                pages.append((len(pages), url, f"<html><body>{body.format(k)}</body></html>"))
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {numbers[r.page_id]: r.text for r in html_extract.main_texts(frame).collect()}


@pytest.mark.parametrize("name", TEMPLATES)
@pytest.mark.parametrize("n", [1, 2, 19, 20, 500])
def test_the_number_of_pages_does_not_matter(found, name, n):
    if n == 1 and name == "unnamed":
        pytest.skip("a page alone on its host does not tell what its template is")
    expected = TEMPLATES[name][1]
    for k in range(n):
        assert found[name, n, k] == expected.format(k)


def test_a_page_alone_without_names_keeps_all(found):
    assert found["unnamed", 1, 0].startswith("Site motto hereHome\n\nHead 0\n\nOwn text 0")


def test_names_of_hidden_and_surrounding_parts():
    def texts(body):
        return [e.text for e in read(body) if isinstance(e, Run) and not e.holder.aside]

    assert texts('<p style="visibility:hidden">a</p><p style="display:nonesuch">b</p>') == ["b"]
    assert texts('<p style="display:block">a</p><div class="header-lead">b</div>') == ["a"]
    assert texts('<main><div class="related-posts">a</div><div class="page-comments">b</div></main>') == ["b"]
    assert texts("<article class='post category-ad'>a</article><article class='ad'>b</article>") == ["a"]

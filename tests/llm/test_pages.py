"""Main text of hand-made pages."""

import re

import pytest

from starloom.llm.pages import main_text
from starloom.llm.queries import op10_html_text

LONG = "A sentence of the article that has a good many words, as sentences of articles do, and goes on."
PAGES = [
    ("", ""),
    ("   ", ""),
    ("plain text without any markup at all", "plain text without any markup at all"),
    ("<html><body><script>var t = '</p>';</script></body></html>", ""),
    ("<article><h1>Title</h1><p><b>One<br><p>Two &amp; three&nbsp;four</p><p>5 &lt; 6</article><footer>foot</footer>", "Title One Two & three four 5 < 6"),
    (f"<nav><ul><li><a href='/x'>Menu</a></li></ul></nav><div class='ad'>{LONG}</div><article><p>{LONG}</p><p>Short.</p></article><aside>{LONG}</aside>", f"{LONG} Short."),
    (f"<body><div id=menu><a href=a>One</a> <a href=b>Two</a></div><p>{LONG}</p><p>{LONG}</p><div class='comment-list'><p>{LONG}</p></div></body>", f"{LONG} {LONG}"),
    (f"<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{LONG}</p></main><form><p>{LONG}</p><input></form>", f"Title {LONG}"),
    (f"<article><p>{LONG}</p><div class='comments'><article><p>Reader</p></article></div><p>Last.</p></article>", f"{LONG} Last."),
    (f"<div>{LONG}</div><!-- <p>not seen</p> --><div hidden>not seen</div><p>{LONG}", f"{LONG} {LONG}"),
    ("<article><p>open <b>bold <i>both</p><p>next &copy; &#233;&#x20AC;</p>", "open bold both next © é€"),
    ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
    ("<article>" + "<p>x</p>" * 5000 + "</article>", " ".join(["x"] * 5000)),
    ("<p>" * 3000 + "deep", "deep"),
    ("<article><style>p{}</style><p>one</p><script>x()</script><p>two</p><noscript>no</noscript></article", "one two"),
]


@pytest.mark.parametrize(("page", "expected"), PAGES)
def test_main_text(page, expected):
    assert main_text(page) == expected


def test_given_pages_keep_the_article(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    import html

    for row in op10_html_text(spark, folder).collect():
        article = pages[row["page_id"]].split("<article>")[1].split("</article>")[0]
        expected = " ".join(html.unescape(re.sub(r"</?[a-z][^>]*>", " ", article)).split())
        assert row["text"] == expected
        assert row["n_chars"] == len(row["text"])


BODY = "".join(f"<p>{LONG}</p><p>{i}.</p>" for i in range(6))
BODY_TEXT = " ".join(f"{LONG} {i}." for i in range(6))


@pytest.mark.parametrize(("page", "expected"), [
    (f"<article><p>Read more.</p></article><div>{BODY}</div>", BODY_TEXT),
    (f"<main></main><div>{BODY}</div>", BODY_TEXT),
    (f"<main><article><p>A card.</p></article><article><p>Another card.</p></article></main><div>{BODY}</div>", BODY_TEXT),
    (f"<article><p>A card.</p></article><article>{BODY}</article><article><p>Another card.</p></article>", BODY_TEXT),
    (f"<main><h1>Title</h1><article>{BODY}</article></main>", f"Title {BODY_TEXT}"),
    (f"<article><p>{LONG}</p></article><article><p>Card.</p></article><article><p>{LONG}</p></article><article><p>{LONG}</p></article>", f"{LONG} {LONG} {LONG}"),
    ("<article><h1><a href=a>Title</a></h1><p>One.</p><p>Two.</p><ul>" + "<li><a href=b>Link</a></li>" * 5 + "</ul><p>Three.</p></article>", "Title One. Two. Three."),
    (f"<article>{BODY}</article><div><p>{LONG}</p></div>", f"{BODY_TEXT} {LONG}"),
    (f"<article>{BODY}</article><div><p>Printed in 2020</p></div>", BODY_TEXT),
    ("<article>" + "<p><a href=a>Link</a></p>" * 4 + "</article>", "Link Link Link Link"),
])
def test_an_article_is_a_weight_among_all_lines(page, expected):
    assert main_text(page) == expected


@pytest.mark.parametrize(("page", "expected"), [
    (f"<div class='has-sidebar'><article>{BODY}</article></div>", BODY_TEXT),
    (f"<div class='site no-sidebar'><div>{BODY}</div></div>", BODY_TEXT),
    (f"<article><div class='entry-header'><h1>Title</h1></div>{BODY}</article>", f"Title {BODY_TEXT}"),
    (f"<article><div class=header><h1>Title</h1></div>{BODY}<section id='related-work'><p>Others.</p></section></article>", f"Title {BODY_TEXT} Others."),
    (f"<div style='overflow:hidden' title='a hidden place' data-class='ad'>{BODY}</div>", BODY_TEXT),
    (f"<div class='sidebar'><div>{BODY}</div><div class='comments'><p>{LONG}</p></div></div>", BODY_TEXT),
    (f"<div class='widget'><main><article>{BODY}</article></main></div><p hidden>not seen</p>", BODY_TEXT),
    (f"<form id=f><nav><a href=a>Menu</a></nav><div>{BODY}</div><footer>{LONG}</footer></form>", BODY_TEXT),
    (f"<article>{BODY}</article><div id='comments' class='comments-area'><article class='comment-body'><p>{LONG}</p></article></div>", BODY_TEXT),
    (f"<div>{BODY}</div><div class='site_footer'><p>{LONG}</p></div><div aria-hidden='true'><p>{LONG}</p></div>", BODY_TEXT),
])
def test_marked_elements_are_dropped_by_whole_tokens_and_size(page, expected):
    assert main_text(page) == expected

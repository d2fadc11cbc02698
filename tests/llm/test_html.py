import html
import re

import numpy as np
import pytest

from clearledger.llm.html import PIECE, content_lines, extract, main_text, page_lines, smoothed
from clearledger.llm.queries import REGISTRY

NAV = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
LONG = "A sentence that goes on for a while, with enough words to stand out among the lines of the page."


def page(body):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var t="</p>";</script></head><body>{NAV}{body}<footer>&copy; x</footer></body></html>'


def test_article_only():
    body = f"<header>Site</header><article><h1>Title</h1><p>{LONG}<p>Short.<p><b>Open<br>tags</article><aside>{LONG}</aside>"
    assert main_text(page(body)).split("\n") == ["Title", LONG, "Short.", "Open tags"]


@pytest.mark.parametrize(
    "apart",
    [
        f'<div class="ad">{LONG}</div>', f'<div class="cookie-notice"><p>{LONG}</p></div>', f"<form><p>{LONG}</p><input></form>",
        f'<section id="comments"><p>{LONG}</p><p>{LONG}</p></section>', f'<div role="navigation">{LONG}</div>', f"<noscript>{LONG}</noscript>",
        f'<div style="display: none">{LONG}</div>', f"<p hidden>{LONG}</p>", f"<!-- {LONG} -->", f'<div class="relatedPosts">{LONG}</div>',
    ],
)
def test_what_is_set_apart_goes(apart):
    assert main_text(page(f"<article><p>{LONG}</p>{apart}<p>End.</p></article>")) == f"{LONG}\nEnd."
    assert main_text(page(f"{apart}<main><p>{LONG}</p><p>End.</p></main>{apart}")) == f"{LONG}\nEnd."


def test_words_that_only_contain_such_words_stay():
    assert main_text(page(f'<div class="header-less-badge shadow"><p>{LONG}</p></div>')) == ""
    assert main_text(page(f'<div class="badge shadowed commentary"><p>{LONG}</p></div>')) == LONG


def test_without_article_the_region_with_the_text():
    links = "".join(f"<li><a href=/{i}>Some link text {i}</a>" for i in range(30))
    body = f"<div><ul>{links}</ul></div><div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p><p>Yes.</p></div><div>tiny</div>"
    assert main_text(page(body)).split("\n") == ["Head", LONG, LONG, "Yes."]


def test_references_white_space_and_inline_elements():
    body = "<article><p>a &amp; b&nbsp;\n\t c &lt;d&gt; &#233;&#x4e2d; &copy &bogus;<i>x</i>y <b> z</b>w<br>v</p></article>"
    assert main_text(body) == "a & b c <d> é中 © &bogus;xy zw v"


def test_inline_text_set_apart():
    assert main_text(f'<article><p>Before <span class="ad">buy</span> after</p><p><span class=ad>x</span>{LONG}</p></article>') == f"Before after\n{LONG}"


@pytest.mark.parametrize("broken", ["<article><p>a<div>b</p></article>", "</div></p><article>a<p>b", "<article>a<p>b</b></i></section>", "<![foo[x]]><article>a<div/>b", "<article>a<p>b<!-- open", "<article>a<p>b<tag"])
def test_broken_markup(broken):
    assert main_text(broken).split("\n")[:2] == ["a", "b"]


def test_long_pages_are_fed_in_pieces():
    words = [f"word{i}&amp;" for i in range(3 * PIECE // 10)]
    text = f"<article><p>{' '.join(words)}</p><p>end</p></article>"
    assert len(text) > 2 * PIECE
    assert main_text(text) == " ".join(words).replace("&amp;", "&") + "\nend"


def test_smoothing_and_threshold():
    flat = smoothed(np.full(7, 4.0))
    assert np.allclose(flat, 4.0)
    spike = smoothed(np.array([0, 0, 0, 9.0, 0, 0, 0]))
    assert spike.argmax() == 3 and np.allclose(spike, spike[::-1]) and spike[2] > spike[1] > 0
    assert content_lines([]) == []
    assert [x.words for x in page_lines("<p>a b</p>c")] == [["a", "b"], ["c"]]


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, "u", ""), (None, None, "<p>no id</p>"), (4, "u", "plain text"), (4, "u", "plain text"), (5, None, "<p>" + "x" * 200_000), (6, "u", "\n \t")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = [tuple(r) for r in extract(df).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, "u", "", 0), (2, "u", "", 0), (None, None, "no id", 5), (4, "u", "plain text", 10), (4, "u", "plain text", 10), (5, None, "x" * 200_000, 200_000), (6, "u", "", 0)],
        key=str,
    )
    assert extract(df.limit(0)).count() == 0


def test_query_equals_the_article_cut_out(spark, sf_dir):
    """The given pages hold one article each, of headings and paragraphs."""

    def cut(text):
        inner = text[text.index("<article>") + 9 : text.index("</article>")].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner))
        return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)

    want = {r.page_id: (r.url, cut(r.html)) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = REGISTRY["op13_text_to_tag_extraction"](spark, sf_dir).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)

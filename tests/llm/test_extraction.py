import html
import re

import pytest

from skytally.llm.extraction import blocks, extract, main_text, second_pass
from skytally.llm.queries import op3_html_extraction
from tests.conftest import SF_DIR

LONG = (
    "This is the text that a reader of the page came for, and it goes on for some time about the things that"
    " were said by those who had been there. It has more than one sentence, as it should, and it is not a list."
)
LONGER = "What happened after that is told in the second part of the story, which was not as long as the first but"
LONGER += " had all of the names in it that the reader would have been waiting for, and then some more of them."


def text(page):
    return main_text(page)[0]


CASES = {
    "article": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        f"<header><h1>Site</h1></header><article><h1>Head</h1><p>{LONG}<p>Sh.</article>"
        f"<aside><p>{LONGER}</p></aside><footer>&copy; x</footer></body></html>",
        f"Head {LONG} Sh.",
    ),
    "comments, notices and forms by name": (
        f"<main><div id='cookie-notice'>{LONGER}</div><p>{LONG}</p><form><label>Mail</label><input></form>"
        f"<div class='ad-slot'>{LONGER}</div><section class='userComments'><article>{LONGER}</article></section></main>",
        LONG,
    ),
    "form around the page": (f"<form id=f><nav>a</nav><article>{LONG}</article></form>", LONG),
    "no article": (
        f"<div><a href=1>One</a> <a href=2>Two</a></div><div>Short start</div><div>{LONG}</div><p>Ok.</p><p>{LONGER}</p>"
        "<div><a href=1>One</a> | <a href=2>Two</a></div><div>Imprint</div>",
        f"{LONG} Ok. {LONGER}",
    ),
    "broken": (
        f"<article><p title=\"a > b\">a &amp; b &#233;&nbsp;&lt;i&gt;<b>bo<i>ld</b></i> x<br>y<!-- no --> z<script>if(a</p>)</script>"
        f"<p>{LONG}<div>rest <unknown>of</unknown> it",
        f"a & b é <i>bold x y z {LONG} rest of it",
    ),
    "hidden": (f"<article><p>{LONG}</p><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", f"{LONG} yes"),
    "menu in the article": (f"<article><p>{LONG}</p><ul><li><a>a</a> <a>b</a></li></ul><p>see <a>this</a></p></article>", f"{LONG} see this"),
    "ad paragraph": (f"<article><p class=ad>no<p>{LONG}</article>", LONG),
    "only short": ("<p>Just this.</p>", "Just this."),
    "plain": ("a < b and c > d", "a < b and c > d"),
    "unclosed comment": (f"<article><p>{LONG}</p><!-- x", LONG),
    "unclosed quote": (f"<article><p>{LONG}</p><p class=\"x>y</p></article>", f"{LONG} y"),
    "empty": ("", ""), "tags only": ("<div></div>", ""), "null": (None, ""),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, expected = CASES[name]
    assert text(page) == expected


def test_open_blocks_take_the_nearest_label():
    none = None
    assert second_pass([none, True, none, none, False, none]) == [True, True, True, False, False, False]
    assert second_pass([True, none, False]) == [True, True, False]
    assert second_pass([none, none]) == [True, True] and second_pass([]) == []


def test_long_pages_take_linear_time():
    page = "<article>" + "<p>word word</p>" * 20_000 + "<" * 20_000 + "<p class='" * 2_000
    assert len(blocks(page)) >= 20_000


def test_edges(spark):
    rows = [(i, "u", page, 1, "x") for i, (page, _) in enumerate(CASES.values())] * 2 + [(None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int, doc string").repartition(3)
    found = extract(pages).collect()
    assert len(found) == len(rows) and found[0].page.asDict().keys() == {"page_id", "url", "text", "doc"}
    expected = [e for _, e in CASES.values()]
    assert all(r.text == expected[r.page.page_id] for r in found if r.page.page_id is not None)
    assert extract(pages.limit(0)).count() == 0


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect()
    rows = {r.page_id: r for r in op3_html_extraction(spark, SF_DIR).collect()}
    assert len(rows) == len(pages)
    for page_id, page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        inner = re.sub(r"</?(?:p|br|h1)>", " ", article)
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())
        assert rows[page_id].text == expected and rows[page_id].n_chars == len(expected)


MENU = "<div><a href=1>One</a> <a href=2>Two</a></div>"
MIDDLE = [
    "It was the first time that they had been there, and it was not at all what they wanted.",
    "The second one was about as long as the first, but it had more to say on all of this.",
]
POLISH = [
    "Wczoraj wieczorem nad jeziorem zebrali się mieszkańcy okolicznych wsi, żeby wspólnie obejrzeć pokaz.",
    "Organizatorzy zapowiadają kolejne spotkania, ponieważ zainteresowanie przerosło wszelkie oczekiwania.",
]
RUSSIAN = "Вчера вечером у озера собрались жители окрестных деревень, чтобы вместе посмотреть представление."


@pytest.mark.parametrize("paragraphs", [MIDDLE, POLISH, [RUSSIAN], ["One short line.", "And more."]])
def test_pages_without_long_blocks(paragraphs):
    page = MENU + "".join(f"<p>{p}</p>" for p in paragraphs) + MENU + "<footer>Imprint</footer>"
    assert text(page) == " ".join(paragraphs)


def test_other_script_beside_english():
    assert text(f"{MENU}<p>{LONG}</p>{MENU}<p>{RUSSIAN}</p>{MENU}") == f"{LONG} {RUSSIAN}"


def test_body_beside_an_article_element():
    body = f"<div>{LONG}</div><div>{LONGER}</div>"
    teaser = "<article><a href=1>Read this</a> too</article>"
    assert text(f"{MENU}{body}{teaser}") == text(f"{teaser}{MENU}{body}") == f"{LONG} {LONGER}"


def test_headline_and_lead_before_the_article():
    page = f"{MENU}<h1>Head</h1><p>{MIDDLE[0]}</p><article><p>{LONG}</p><p>Short.</p></article><p>{MIDDLE[1]}</p>"
    assert text(page) == f"Head {MIDDLE[0]} {LONG} Short."


def test_formulas_and_fallback_text():
    page = (
        f"<article><p>{LONG}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold, <object data=a>as drawn</object>"
        " <canvas>here</canvas> <svg width=1><text>A</text></svg> <noscript>or there</noscript>.</p>"
        "<select><option>no</select><template>no</template><textarea>no</textarea><math><mi>y</mi><p>End.</p></article>"
    )
    assert text(page) == f"{LONG} Let x=2 hold, as drawn here A or there. y End."


def test_unclosed_containers_leave_the_rest():
    for name in ("math", "svg", "object", "canvas", "noscript"):
        assert text(f"<article><p>a <{name}>b</p><p>{LONG}</p></article>") == f"a b {LONG}"
    assert text(f"<article><div><select><option>no</div><p>{LONG}</p></article>") == LONG

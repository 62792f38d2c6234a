import html
import html.parser
import random
import time

import pytest

from orderflow.llm.html_text import extract_main_text, main_text, smoothed, text_nodes

LONG = "This is a long sentence of the article, with commas, and an end. " * 4
MORE = "Another paragraph, which also says something; it goes on. " * 4


def norm(text):
    return " ".join(text.split())


PAGES = {
    "article": (
        f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><a href='/'>Home</a></nav>"
        f"<div class=ad>Buy {MORE}</div><article><h1>Title</h1><p><b>{LONG}<br><p>x &amp; y &#233; {MORE}</article><footer>&copy; z</footer>",
        ["Title", LONG, "x & y é " + MORE],
    ),
    "no article": (
        f"<body><div id=header>Site name</div><ul class='menu'><li><a href=1>One</a><li><a href=2>Two</a></ul><div class=story><p>{LONG}</p>"
        f"<p>{MORE}</p></div><div class='sidebar'>{LONG}</div><div class=cookie-notice>{LONG}</div><form>{LONG}<input></form>"
        f"<section id=comments><p>{LONG}</p></section>",
        [LONG, MORE],
    ),
    "main": (f"<main><header>h</header><p>{LONG}</p><aside>{LONG}</aside><ul><li>short</li></ul><ul><li><a href=1>only links</a></ul></main>", [LONG, "short"]),
    "inline": (f"<article><p>a<b>b</b> <i>c</i>\n\t d<!-- no --><span hidden>no</span></p>{LONG}</article>", ["ab c d", LONG]),
    "layout words": (f"<body class=has-sidebar><div class='content with-sidebar'><p>{LONG}</p><p>{MORE}</p></div>", [LONG, MORE]),
    "unclosed": (f"<article><div><p>{LONG}<div>{MORE}", [LONG, MORE]),
    "stray quotes": (f"<article><p title=it's>{LONG}</p><p x=a\"b y='>'>{MORE}</p><p \">{LONG}</p><p z = \"a>b\">{MORE}</p></article>", [LONG, MORE, LONG, MORE]),
    "linked blocks": (
        f"<article><header><h1>Title</h1></header><h2><a href=1>A heading</a></h2><p>{LONG}</p><p><a href=2>A whole paragraph.</a></p><p>{MORE}</p>"
        "<p><a href=3>one</a></p><p><a href=4>two</a></p><ul><li><a href=5>three</a></ul></article>",
        ["Title", "A heading", LONG, "A whole paragraph.", MORE],
    ),
    "names inside": (
        f"<article><section id=discussion><p>{LONG}</p></section><div class='legal tags side-by-side notice'><p>{MORE}</p></div>"
        f"<div class=related>{LONG}</div><div id=comments>{LONG}</div><div class='share'>{MORE}</div></article>",
        [LONG, MORE],
    ),
    "teaser": (f"<main><p>Welcome.</p></main><div class=story><p>{LONG}</p><p>{MORE}</p></div>", ["Welcome.", LONG, MORE]),
    "quoted": (f"<article title='a > b'><p data-x=\"</p>\">{LONG}</p></article>", [LONG]),
}


@pytest.mark.parametrize("name", PAGES)
def test_blocks(name):
    page, blocks = PAGES[name]
    assert main_text(page) == "\n\n".join(norm(html.unescape(x)) for x in blocks)


@pytest.mark.parametrize("page", [None, "", " \n", "<p></p>", "<", "<a", "</p>", "<script>x", "<!--", "<![CDATA[", "&amp", "<nav>x</nav>"])
def test_odd_pages_do_not_fail(page):
    assert isinstance(main_text(page), str)


def test_link_lists_have_no_weight():
    page = "".join(f"<p><a href={k}>A fairly long link text, number {k}.</a></p>" for k in range(20)) + f"<div>{LONG}</div><div>{MORE}</div>"
    assert main_text(page) == f"{norm(LONG)}\n\n{norm(MORE)}"


def test_long_page():
    page = "<article>" + "<p>" + (LONG + "</p><p>") * 5_000 + "</article>"
    assert main_text(page).count("\n\n") == 4_999


@pytest.mark.parametrize("piece", ["<b>", "<div>", "<li>", "<p><i>", "<b>x<div>", "</b>", "<a class=x><p>", "<ul><li>"])
def test_time_grows_with_the_page(piece):
    def seconds(count):
        page = f"<article>{piece * count}{LONG}"
        best = 9.0
        for _ in range(3):
            began = time.perf_counter()
            main_text(page)
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(40_000) < 12 * seconds(5_000) + 0.2


class Reader(html.parser.HTMLParser):
    """Texts outside of tags by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found = []

    def handle_data(self, data):
        self.found.append(data)


def test_attributes_as_another_parser_reads_them():
    rnd = random.Random(4)
    values = ["it's", '"a>b"', "'a>b'", '"it\'s"', "x", "a/b", '""', "''", '"<p>"', "'&gt;'", "a=b", "1.5", "é"]
    for _ in range(3000):
        given = "".join(f" {rnd.choice('abxyz')}{rnd.choice(['=', ' = ', '= '])}{rnd.choice(values)}" for _ in range(rnd.randrange(4)))
        page = f"<div{given}>one<b{given}>two</b> three</div><p{given} hidden2>four</p>"
        reader = Reader()
        reader.feed(page)
        reader.close()
        assert "".join(x.text for x in text_nodes(page)) == "".join(reader.found) == "onetwo threefour", page


def test_paths_and_smoothing():
    paths = [x.path for x in text_nodes("<div class='a b'><p>x<b>y</b></p><p>z</div><div class=a><p>u</div><div><p>v")]
    assert paths == [paths[0], paths[1], paths[0], paths[0], paths[4]] and len(set(paths)) == 3
    assert smoothed([0.0, 3.0, 0.0]).tolist() == [1.5, 1.0, 1.5]


def test_query(spark):
    rows = [(k, None, p) for k, (p, _) in enumerate(PAGES.values())] + [(None, "u", None), (1, "u", ""), (1, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = extract_main_text(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert extract_main_text(pages.limit(0)).columns == ["page_id", "url", "text", "n_chars"]

import pytest

from vesseltrack.llm.html_main import extract, main_text

CASES = [
    (None, ""), ("", ""), ("plain text only", "plain text only"), ("<!-- <p>no</p>", ""), ("<script>var t='</p>';", ""),
    ("<p>one<p>two", "one\n\ntwo"),
    ("a < b &amp; c &gt; d <i>x</i>", "a < b & c > d x"),
    ("<article><h1>T</h1><p>a\n\t b&nbsp;c<br>d</p><ul><li>one<li>two</ul></article>", "T\n\na b c d\n\none\n\ntwo"),
    ("<nav><a href=x>Menu, of, links</a></nav><div class='ad'>buy, now</div><article><p>text</p></article>"
     "<footer>&copy; me</footer>", "text"),
    ("<div id=sidebar><p>side, side, side, side</p></div><div><p>Short.</p><p>And, more text here</p></div>"
     "<div class='reader comments'><p>first, second, third, fourth, fifth</p></div>", "Short.\n\nAnd, more text here"),
    ("<body><div class='cookie-notice'><p>We, use, cookies</p></div><div><h2>Head</h2><div><p>long text, with commas, yes</p></div>"
     "<p>tail</p></div></body>", "Head\n\nlong text, with commas, yes\n\ntail"),
    ("<div><a href=1>link, one</a> <a href=2>link, two</a> <a href=3>link, three</a></div><div><p>the text, really</p></div>",
     "the text, really"),
    ("<header><p>site, name</p></header><main><header><h1>Title</h1></header><p>body</p><form><p>name:</p></form></main>", "Title\n\nbody"),
    ("<article><p><b>bold never closed<p>next</p></article><footer>x</footer>", "bold never closed\n\nnext"),
    ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</table></article>", "a b\n\nc"),
    ("<article><p title=\"a > b\">ok</p><p hidden>no</p><p style='display: none'>no</p></article>", "ok"),
    ("<article><p>cut off <a href='x", "cut off"),
    ("<ARTICLE><P>Upper</P><STYLE>p{}</STYLE></ARTICLE>", "Upper"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert main_text(page) == text


LINKS = "<div>\n      <a href=1>one, two</a>\n      <a href=2>three, four</a>\n</div>"
LONG = ["a long paragraph, " * 40 + str(i) for i in range(10)]
BODY = "".join(f"<p>{p}</p>" for p in LONG)


@pytest.mark.parametrize("page,before,after", [
    (f"<body><div><div>{BODY}</div><div>A short end.</div></div></body>", [], ["A short end."]),
    (f"<body><section>Lead.</section><section>{BODY}</section><section><h2>End</h2><p>Short.</p></section></body>", ["Lead."], ["End", "Short."]),
    (f"<body><div>Own text <a href=x>with</a> a link in it.<div>{BODY}</div>and behind it</div></body>", ["Own text with a link in it."], ["and behind it"]),
    (f"<body><div>Far up.</div>{LINKS}<div><div><div>{BODY}</div></div>inner</div>outer{LINKS}</body>", ["Far up."], ["inner", "outer"]),
    (f"<body><div><a href=1>Home</a> | <a href=2>All pages</a><div>{BODY}</div><a href=3>Next page</a></div></body>", [], []),
    (f"<body><div>{BODY}</div><div class='comments'><p>no, no</p></div><div><p>Short.</p></div></body>", [], ["Short."]),
])
def test_pages_of_divs_and_sections_lose_nothing(page, before, after):
    assert main_text(page).split("\n\n") == before + LONG + after


@pytest.mark.parametrize("page,expected", [
    (f"<div class='content no-sidebar'>{BODY}</div>", LONG),
    (f"<div class='site has-sidebar'><article>{BODY}</article></div>", LONG),
    (f"<div class='sidebar'><main>{BODY}</main></div>", LONG),  # a name never removes what holds the main element
    (f"<div class='widget'>{BODY}</div><div>Tail.</div>", LONG + ["Tail."]),  # nor nearly all of the text
    (f"<div class='elementor-widget elementor-widget-text-editor'>{BODY}</div>", LONG),
    (f"<article><div class='article-banner'><h1>Head</h1></div><div class='social-science'><p>On science.</p></div>{BODY}</article>",
     ["Head", "On science."] + LONG),
    (f"<article>{BODY}<div class='related-posts'><p>Read this, too</p></div><div id='userComments'><p>I, me, mine</p></div>"
     "<div class='share-buttons bottom'>Share</div><div class='ad-slot-2'>Buy</div></article>", LONG),
    (f"<article>{BODY}<article class='comment'><p>First, first</p></article></article>", LONG),
    (f"<article>{BODY}</article><section class='comments'><article><p>{LONG[0]}</p></article></section>", LONG),
    (f"<main><article>{BODY}</article><article><p>A second one.</p></article><article><a href=1>Teaser</a></article></main>", LONG + ["A second one."]),
    (f"<article><p>First, short.</p></article><article>{BODY}</article><aside><article><p>Aside.</p></article></aside>", ["First, short."] + LONG),
    (f"<article class='comment-free'>{BODY}</article>", LONG),
    ("<div class='comments'><p>only, comments</p></div>", ["only, comments"]),  # the page is nothing else
])
def test_names_of_blocks(page, expected):
    assert main_text(page).split("\n\n") == expected


def plain_article(page):
    """Texts of headings and paragraphs of the articles by the standard library's parser."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.depth, self.out, self.open = 0, [], None

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            if self.depth and tag in ("p", "h1", "h2", "li"):
                self.flush()
                self.open = []
            elif tag == "br" and self.open is not None:
                self.open.append(" ")

        def handle_endtag(self, tag):
            self.depth -= tag == "article"
            if tag in ("p", "h1", "h2", "li", "article"):
                self.flush()

        def flush(self):
            if self.open is not None:
                self.out.append(" ".join("".join(self.open).split()))
            self.open = None

        def handle_data(self, data):
            if self.open is not None:
                self.open.append(data)

    reader = Reader()
    reader.feed(page)
    return "\n\n".join(x for x in reader.out if x)


def test_given_pages_against_the_library_parser(spark):
    for sf in ("sf0.001", "sf0.01"):
        pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
        texts = {r.page_id: r.text for r in extract(pages).collect()}
        assert texts == {r.page_id: plain_article(r.html) for r in pages.collect()}


def test_no_recursion_and_no_cap():
    deep = "<div>" * 5000 + "<p>deep, text</p>" + "</div>" * 5000
    assert main_text(deep) == "deep, text"
    many = "<article>" + "".join(f"<p>paragraph {i}, here</p>" for i in range(3000)) + "</article>"
    assert main_text(many).count("\n\n") == 2999


def test_frame(spark):
    from pyspark.sql import functions as F
    rows = [(i, f"http://x/{i}", p) for i, (p, _) in enumerate(CASES)] * 2 + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        want = "" if r.page_id is None else CASES[r.page_id][1]
        assert (r.text, r.n_chars) == (want, len(want))
    assert extract(pages.limit(0)).count() == 0


def test_whole_articles_of_the_given_pages(spark):
    """Every paragraph of the article comes, in order, and nothing from around it."""
    import re
    from html import unescape
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert texts[r.page_id] == "\n\n".join(p for p in parts if p)

import html
import re

import duckdb

from riverloom.llm import blocks, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text int"
LONG = "This is the sort of text that people write when they have something to say about it all."

PAGE = f"""<!DOCTYPE html><html><head><title>Not this</title><style>p{{}}</style><script>if (a < b) "</p>"</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on the site and it is for you to say if that is all right with you.</div>
<div id="content"><article class="post"><header><h1>Short title</h1></header>
<p>{LONG} &amp; caf&eacute;&nbsp;&#8212; done</p><p>Yes.</p><div class="ad">{LONG}</div>
<ul><li><a href="/x">Other story with a long name to read, for all the people of the world</a></li></ul>
<p>Some <a href="/l">link</a> in
   the middle<br>of a line</p><aside>{LONG}</aside><p hidden>{LONG}</p>
<form><label>Your name</label><input name="n"><button>Send</button></form></article>
<section id="comments"><article class="comment"><p>{LONG}</p></article></section></div>
<div class="sidebar"><p>{LONG}</p></div><footer>&copy; {LONG}</footer></body></html>"""


def test_article_page():
    assert blocks.main_text(PAGE).split("\n") == [
        "Short title", f"{LONG} & café — done", "Yes.", "Some link in the middle of a line",
    ]


def test_page_without_article():
    nav = "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(9))
    page = f"<body><ul>{nav}</ul><p>Title</p><p>{LONG}</p><p>Short</p><p>{LONG}</p><div><a>More</a></div><p>Bye</p></body>"
    assert blocks.main_text(page) == "\n".join(["Title", LONG, "Short", LONG])


def test_broken_pages():
    assert blocks.main_text(None) == blocks.main_text("") == blocks.main_text("<p></p><br>") == ""
    assert blocks.main_text("<article><p>One<p>Two &am") == "One\nTwo &am"
    assert blocks.main_text("<article><p>One</p><p") == "One"
    assert blocks.main_text("<article><p>One</artic") == "One"
    assert blocks.main_text("<article><p>One</p><script>var x='<p>no") == "One"
    assert blocks.main_text("<article><p>One <!-- no <p>no") == "One"
    assert blocks.main_text('<article><p class="x>y">a < b</p><p title="open>One</p>').startswith("a < b")
    assert blocks.main_text("<ARTICLE><P>1 &lt;b&gt;</P></ARTICLE>") == "1 <b>"
    assert len(blocks.main_text("<article>" + "<p>word</p>" * 20_000).split("\n")) == 20_000
    assert blocks.main_text("<article>" + '<a "' * 5000) is not None


def test_rows(spark):
    rows = [(1, "u", None, 1), (None, None, "<main><p>x</p></main>", 1), (1, "u", None, 1)]
    got = blocks.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, [type(got[0])(page_id=1, url="u", text="")] * 2 + [type(got[0])(page_id=None, url=None, text="x")]))
    assert blocks.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages(spark):
    """Against the article element, cut by hand."""
    rows = duckdb.execute(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in queries.QUERIES["op7_block_rules"](spark, SF).collect()}
    assert len(got) == len(rows)
    for page_id, page in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1] if "<article>" in page else ""
        inner = re.sub(r"<[a-zA-Z/][^>]*\Z|<\Z", "", inner)
        parts = re.split(r"</?(?:p|h1|li|ul)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
        assert got[page_id].text == "\n".join(x for x in lines if x)
        assert got[page_id].n_chars == len(got[page_id].text)


def test_names_of_layouts():
    """Names of elements around the article, or of its head, take nothing from it."""
    inner = f"<article><h1>Title</h1><p>{LONG}</p></article><section id='comments'><article><p>{LONG} no</p></article></section>"
    for name in ("has-sidebar", "no-sidebar", "content-comments-enabled", "page-header-fixed", "sidebar", "widget related", "menu-open"):
        assert blocks.main_text(f"<body><div class='{name}'>{inner}</div></body>") == f"Title\n{LONG}", name
    assert blocks.main_text(f"<div class='sidebar'><article><p>{LONG} card</p></article></div>{inner}") == f"Title\n{LONG}"
    assert blocks.main_text(f"<nav><article><p>{LONG}</p></article></nav>") == ""
    head = f"<article><div class='article-header'><h1>Title</h1></div><p>{LONG}</p></article>"
    assert blocks.main_text(head) == f"Title\n{LONG}"
    assert blocks.main_text(f"<div class='with-sidebar'><p>{LONG}</p><div class='sidebar'><p>{LONG} no</p></div></div>") == LONG


def test_linked_paragraphs_of_an_article():
    page = f"<article><h2><a href='/'>Linked title</a></h2><p><a href='/a'>{LONG}</a></p><p>{LONG}</p><ul><li><a href='/b'>Elsewhere</a></li></ul></article>"
    assert blocks.main_text(page) == f"Linked title\n{LONG}\n{LONG}"


def test_unmatched_tags_take_linear_time():
    import time

    def seconds(n):
        start = time.process_time()
        blocks.main_text("<article><p>One" + "<div>" * n + "</span>" * n)
        return time.process_time() - start

    seconds(1000)
    assert seconds(40_000) < 8 * max(seconds(10_000), 0.05)

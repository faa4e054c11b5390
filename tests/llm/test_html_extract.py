import re

import pytest

from claimlens.llm import html_extract
from claimlens.llm.html_extract import Reader

SHELL = """<!doctype html><html><head><title>no</title><style>p{a:"</p>"}</style><script>var t="</script>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/a>menu</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id=sidebar>side</div>
%s<section class="comments"><p>reader says</p></section><form><p>form</p></form><footer>&copy; foot</footer>"""
CASES = [
    ("<article><h1>T &amp; U</h1><p>one\n  two&nbsp;three<p>four <b>fi</b>ve</article>", "T & U\none two three\nfour five"),
    ("<article><p><b>bold.<br><p>next</p><ul><li>a<li>b <a href='x'>link</a></ul></article>", "bold.\nnext\na\nb link"),
    ("<article><p>x < y &lt; z</p><!-- no > --><p title=\"a>b\">q</p><div class='ad'>buy</div><p>r<script>1<p>2</script>s</p></article>", "x < y < z\nq\nrs"),
    ("<main><p>it's <a>don't</a> so much text here</p><p hidden>h</p><p style='display: none'>n</p></main>", "it's don't so much text here"),
    ("<article><p>open to the end &#233;", "open to the end é"),
    ("<article><table><tr><td>c1<td>c2<tr><td>c3</table></article>", "c1\nc2\nc3"),
]


@pytest.mark.parametrize(("inner", "want"), CASES)
def test_article_alone(inner, want):
    page = Reader(SHELL % inner if "open to" not in inner else "<body>" + inner)
    assert page.text_of(page.best([])) == want


def test_empty_and_broken():
    for source in ("", "   ", "<p", "<!--", "<script>", "</div></p>", "<article></article>"):
        page = Reader(source)
        assert page.text_of(page.best([])) == ""
    assert Reader("plain text").text_of(None) == "plain text"
    long = "<article>" + "<p>word</p>" * 20000 + "</article>"
    page = Reader(long)
    assert page.text_of(page.best([])) == "\n".join(["word"] * 20000)


def text(source):
    page = html_extract.read_page(source)
    return page.text_of(page.best([]))


@pytest.mark.parametrize("odd", ["<svg class='i'/>", "<math />", "<canvas>", "<video src=x>", "<svg><path d='M0 0'/></svg>", "<object><p>no</p></object>", "<canvas><canvas>"])
def test_embedded_elements_end_where_they_end(odd):
    assert text(f"<body><article><p>before</p>{odd}<p>after</p><p>the end</p></article>") == "before\nafter\nthe end"


def test_article_in_two_containers():
    one, two = "first part of it " * 30, "second part of it " * 12
    assert text(f"<body><div class=page><div class=lead><p>{one}</p></div><div class=more><p>{two}</p></div></div><div class=x>y</div>") == f"{one.strip()}\n{two.strip()}"
    assert text(f"<body><div class=page><div class=lead><p>{one * 4}</p></div><div class=more><p>{two}</p></div></div>") == (one * 4).strip()


@pytest.mark.parametrize("shell", ["<div class='layout right-sidebar'>%s</div>", "<form action=x>%s</form>", "<div class=search-page><form>%s</form></div>"])
def test_layout_that_looks_like_an_aside(shell):
    inner = "<nav>menu</nav><div class=post><p>the article itself</p><p>and more of it</p></div><div class=comments><p>short</p></div>"
    assert text("<body>" + shell % inner) == "the article itself\nand more of it"
    assert text("<body><p>kept</p>" + shell % inner) == "kept"  # only where nothing else is left


@pytest.mark.parametrize("source", [
    "<b>" * 8000 + "word" + "</i>" * 8000, "<i><div>" + "<b>" * 8000 + "word" + "</i>" * 8000, "<div>" * 8000 + "word" + "</div>" * 8000, "<div>word" * 8000,
    "<pre>word" * 8000, "<p><b>word" * 8000, "<canvas>word" * 8000, "<ul><li>word" * 8000, "<form>word" * 2000,
])
def test_long_and_deep_pages_take_time_by_length(source):
    import time
    import tracemalloc

    start = time.process_time()
    assert "word" in text(source)
    assert time.process_time() - start < 3
    tracemalloc.start()
    html_extract.read_page(source)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6


def test_host_outvotes_a_page(spark):
    """One page's longest container is a block that its host's other pages show to be none of the article."""
    usual = "<body><div class='post p%d'><p>" + "article words here " * 20 + "</p></div><div class=extra><p>short</p></div>"
    odd = "<body><div class='post p9'><p>small article</p></div><div class=extra><p>" + "unrelated filler " * 60 + "</p></div>"
    rows = [(k, f"https://Host.example:80/{k}", usual % k, "t") for k in range(6)] + [(6, "//user@host.example/x?y", odd, None), (7, None, odd, "t"), (None, "bad url", None, "t"), (9, "http://host.example", "", "t"), (9, "http://host.example", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    out = {}
    got = html_extract.extract(pages)
    assert got.columns == [*pages.columns, "text"] and got.count() == 11
    for r in got.collect():
        out[r.page_id] = r.text
    assert out[0] == ("article words here " * 20).strip() and out[6] == "small article"
    assert out[7] == ("unrelated filler " * 60).strip()
    assert out[None] == out[9] == ""
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_query_equals_plain_reading(spark, small_dir):
    """The tables' pages hold one article each; read it with a few plain replacements instead."""
    import html

    for r in spark.read.parquet(f"{small_dir}/pages.parquet").join(html_extract.op1_main_text(spark, small_dir), ["page_id", "url"]).collect():
        inner = re.search(r"<article[^>]*>(.*?)(</article>|\Z)", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1|br|article)\b[^>]*>", inner[1] if inner else "")
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in parts]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)

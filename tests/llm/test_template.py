import html
import re
import time

import pytest

from vaultline.llm import template as T
from vaultline.llm.common import table

from ..conftest import SF_SMALL


def text(source):
    return T.main_text(source, ())[0]


def got(spark, rows, kind="page_id long, url string, html string"):
    out = T.extract(spark.createDataFrame(rows, kind), ["page_id"]).select("_page.page_id", "text", "n_chars", "n_templates").collect()
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    return sorted(((r["page_id"], r["text"], r["n_templates"]) for r in out), key=repr)


def test_query_equals_the_marked_articles(spark):
    """The given pages mark their articles: read by a plain pattern."""
    want = []
    for r in table(spark, SF_SMALL, "pages").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        words = " ".join(html.unescape(re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
        want.append((r["page_id"], r["url"], words, len(words)))
    rows = T.op13_html_extraction(spark, SF_SMALL).select("page_id", "url", "text", "n_chars").collect()
    assert sorted(map(tuple, rows)) == sorted(want)


@pytest.mark.parametrize("source, want", [
    (None or "", ""), ("plain", "plain"), ("a<b>c</b>d<br>e", "acd e"), ("x < y &amp; z &lt;b&gt; &am", "x < y & z <b> &am"),
    ("<p>a&nbsp;b\n\t c<p>d", "a b c d"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"), ("<script>var t='</p>';<p>x</p></script>y", "y"),
    ("<style>p{}</STYLE>y<!-- no --> z", "y z"), ("y<!-- open <p>z", "y"), ("y<script>z", "y"), ("y<a href='", "y"),
    ("<a title='a > b'>c</a>", "c"), ("<title>t</title><body>b", "b"),
    ("<nav>x</nav><p>y</p><div class='cookie-notice'>z</div>", "y"),
    ("<main><header><h1>T</h1></header><p>a</main><footer>f</footer>", "T a"),
    ("<header>site</header><article><h1>t</h1><p>one<section id=comments><p>c</section></article><article class=comment>n</article>", "t one"),
    ("<article><p>1<aside>2</aside><p>3<form>4</form><p>5<footer>6</footer></article>", "1 3 5"),
    ("<div class='with-sidebar'><div class='sidebar'>s</div>m</div>", "m"),
    ("<form><div><p>all the text of this page</p></div></form>", "all the text of this page"),
    ("<form><article>a</article><input></form>", "a"), ("<p>a<p hidden>b<p style='display: none'>c<p>d", "a d"),
    ("<aside><article>teaser</article></aside><article>real</article>", "real"),
    ("<article>a</article><article>b</article>", "a b"), ("<main>x<article>a</article></main>", "a"),
])
def test_one_page(source, want):
    assert text(source) == want


def page(i, extra="", body=None):
    body = body or f"<p>Own words number {'x' * (i + 1)} of this page.</p>"
    return f"<div class=x1>Our site since 19{i:02}</div><div class=q><p>{body}</p></div>{extra}"


def test_a_host_s_template_goes(spark):
    """Unnamed subtrees that recur beside different articles go; those of other hosts and rare ones stay."""
    banner = "<div class=z7>Buy our coffee today</div>"
    rows = [(i, f"http://a.example/{i}", page(i, banner)) for i in range(12)]
    rows += [(100 + i, "http://B.example:80/x", page(i, banner)) for i in range(2)]
    out = dict((r[0], r[1:]) for r in got(spark, rows))
    for i in range(12):
        assert out[i] == (f"Own words number {'x' * (i + 1)} of this page.", 2)
    assert "coffee" in out[100][0] and out[100][1] == 0


def test_copies_are_no_template(spark):
    """An article that was published many times, exactly or nearly so, keeps its words, and so do repeated plain paragraphs."""
    long = [f"Paragraph {c} of an article that was copied." for c in "abcdefghij"]
    art = lambda k: "<article>" + "".join(f"<p>{x + (' Changed ' + 'y' * k if i == k % 10 else '')}</p>" for i, x in enumerate(long)) + "</article>"
    rows = [(i, "http://c.example/", art(0)) for i in range(30)] + [(50 + i, "http://c.example/", art(i)) for i in range(20)]
    rows += [(100 + i, "http://c.example/", f"<article><p>All rights reserved.</p><p>{'z' * (i + 1)}</p></article>") for i in range(30)]
    out = got(spark, rows)
    for i, words, n in out:
        source = next(r[2] for r in rows if r[0] == i)
        assert words == " ".join(re.sub("<[^>]*>", " ", source).split()) and n == 0


def test_a_box_within_articles_goes(spark):
    box = "<div class=k3><p>Read our daily letter</p></div>"
    rows = [(i, "http://d.example/", f"<article><p>{'w' * (i + 1)}</p>{box}<p>{'v' * (i + 1)}</p></article>") for i in range(10)]
    assert got(spark, rows) == sorted(((i, f"{'w' * (i + 1)} {'v' * (i + 1)}", 1) for i in range(10)), key=repr)


def test_edges(spark):
    rows = [(1, None, None, "c"), (None, "", "", "c"), (2, "no host", "<p>a", None), (2, "no host", "<p>a", None),
            (3, "https://u@H.example/p", "<article>" + "É 💥 &copy; " * 50000, "c")]
    kind = "page_id long, url string, html string, text string"
    assert got(spark, rows, kind) == sorted([(1, "", 0), (None, "", 0), (2, "a", 0), (2, "a", 0), (3, ("É 💥 © " * 50000).strip(), 0)], key=repr)
    assert got(spark, [], kind) == []


@pytest.mark.parametrize("source", ["<" * 400000, "<" * 400000 + ">", "<a " + "\"'" * 200000, "<b>" * 40000 + "</i>" * 40000,
                                    "<div>" * 50000, "<!-- " * 100000, "<article>x" * 20000, "<p>x" * 50000, "<script>" * 50000])
def test_broken_pages_take_linear_time(source):
    start = time.process_time()
    text(source)
    T._rests(T.Page(source), [T.Page(source).root])
    assert time.process_time() - start < 20

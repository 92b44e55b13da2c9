import re
from html import unescape

import pytest

from dimwright.llm import html_text as H


def text_of(html):
    host, _, text, blocks, _ = H.read_page(html, "http://h/x")
    return text if blocks is None else " ".join(b[0] for b in blocks)


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a b"), ("<article>a<b>b</b>c<br>d</article>x", "abc d"),
    ("<article><p><b>x<br><p>y &amp; z&nbsp;&#233;</p><p>q</article><footer>f</footer>", "x y & z é q"),
    ("<body><nav>m</nav><div class='ad'>n</div><p>t</p><aside>s</aside><form>f</form><script>var a='</p>';</script></body>", "t"),
    ("<article><h1>T</h1><div class=comments><p>c</p></div><div id='cookie-notice'>n</div><p>t</p></article>", "T t"),
    ("<main><article>a</article><p>b</p></main>", "a"), ("<main>b<nav>n</nav></main><p>c</p>", "b"),
    ("<article><header><h1>T</h1><span>date</span></header>t</article>", "T t"), ("<p>a < b > c</p>", "a < b > c"),
    ("<article>a<!-- x > y -->b</article>", "ab"), ("<article title='a > b'>t</article>", "t"), ("<p hidden>a</p><p>b</p>", "b"),
    ("<ul><li class=ad>x<li>y</ul>", "y"), ("<article>cut <a href='x", "cut"), ("<script>never closed", ""), ("&am", "&am"),
    ("<article><p>a\n\t b</p> <p>c</p></article>", "a b c"), ("<td>a<td>b", "a b"),
    ("<body class='has-sidebar'><div class='page with-sidebar'><article>t</article></div></body>", "t"),
    ("<div class='related'><article>teaser</article></div><article>t<div class='notice'>n</div></article>", "t"),
    ("<article>t</article><section id='comments'><article class='comment'>c</article></section>", "t"),
    ("<div class='sidebar'><p>s</p></div><p>t</p>", "t"), ("<article><div class='article-header'><h1>T</h1></div>t</article>", "T t"),
    ("x</div></p>y", "x y"),
])
def test_reader(html, want):
    assert text_of(html) == want


def test_long_and_odd_input():
    assert text_of("<p>a " * 20_000).count("a") == 20_000
    assert text_of("<div>" * 3000 + "x") == "x"
    text_of("<" * 20_000)
    text_of("<a '" * 2000)


def test_site_templates_go(spark):
    rows = []
    for i in range(12):
        share = "<div><p>Follow us everywhere</p></div>"
        rows.append((i, f"https://h.example/{i}", f"<article><p>story {i}</p><p>a shared line</p>{share}</article>"))
        rows.append((100 + i, f"https://h.example/b{i}", f"<div><p>welcome to the site</p></div><p>note {i}</p>"))
        # the same text on many hosts is no template
        rows.append((200 + i, f"https://h{i}.example/", "<article><div>Follow us everywhere</div></article>"))
        # copies of one page are no template either
        rows.append((300 + i, f"https://copies.example/{i}", "<article><div><p>one page</p></div></article>"))
    rows += [(400, None, None), (401, "", ""), (401, "", ""), (402, "nohost", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' as text", "1 as `__host2`")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in H.main_text(df).collect()}
    assert got[3] == ("story 3 a shared line", 21) and got[103][0] == "note 3"
    assert got[205][0] == "Follow us everywhere" and got[305][0] == "one page"
    assert got[400] == ("", 0) and got[401] == ("", 0) and got[402] == ("x", 1)
    assert H.main_text(df).count() == len(rows) and H.main_text(df.limit(0)).count() == 0


def test_query(spark):
    """The pages of the table: article only, inline tags away, block tags as breaks."""
    import duckdb
    path = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select page_id, url, html from '{path}/pages.parquet'").fetchall()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in H.op7_html_main_text(spark, path).collect()}
    assert len(got) == len(rows)
    for page, url, html in rows:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S).group(1)
        body = unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|br|h1)>", " ", body)))
        want = " ".join(body.split())
        assert got[page] == (url, want, len(want))


@pytest.mark.parametrize("html,want", [
    ("<body class='single no-comments'><article>t</article></body>", "t"), ("<html class='no-ads'><p>t</p></html>", "t"),
    ("<div id='page' class='has-widgets cookie-consent'><article>t<div class='ad'>n</div></article></div>", "t"),
    ("<div class='cookie-consent'><main>t</main></div>", "t"), ("<main class='has-popup'>t</main>", "t"),
    ("<article class='post comments-open category-advertising'>t</article>", "t"),
    ("<div class='related'><article>teaser</article></div><p>the text of the page</p>", "the text of the page"),
    ("<div class='no-ads' hidden><article>a</article></div><p>t</p>", "t"), ("<article>t<article class='comment'>c</article></article>", "t"),
])
def test_class_words_of_wrappers(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize("html,want", [
    ("<svg class='icon'/><math/><article>t</article>", "t"), ("<svg/><p>a</p><svg><path d='x'/><text>n</text></svg><p>b</p>", "a b"),
    ("<title-bar>a</title-bar><object-view>b</object-view><p>c</p>", "ab c"), ("<title>n</title><p>c</p>", "c"),
    ("<svg\nclass='i' /><p>c</p>", "c"),
])
def test_raw_elements_end(html, want):
    assert text_of(html) == want


def test_section_template_of_a_large_host(spark):
    """A block on a tenth of a large host's pages goes; a block on three pages of it stays."""
    rows = [(i, f"https://big.example/{i}", f"<article><p>story {i}</p>" + ("<div>Section promo</div>" if i % 10 == 0 else "")
             + ("<div>same figure</div>" if i in (1, 2, 3) else "") + "</article>") for i in range(600)]
    got = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "story 0" and got[590] == "story 590" and got[2] == "story 2 same figure" and len(got) == 600

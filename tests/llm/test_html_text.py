import html
import re

from conftest import SF_SMALL

from tripstar.llm import html_text as H

PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<div id="menu"><a href=1>Home</a> <a href=2>About</a></div><div class="cookie-notice">We use cookies to do things that are long and boring.</div>
<div class="content"><h2>Title here</h2><p>Some long text of the article that goes on for a good while, so that it counts &amp; more.<p>Second &lt;b&gt;.<br>next
 line</div><div class="sidebar">Related: many more words that do not belong to the article proper at all, ever</div>
<div class="comments"><p>Great article! I loved every bit of it, thank you so much for writing this all.</p></div>
<form>Search this site for things that you like to read about, if any</form><footer>&copy; Footer text, quite long too, in fact longer</footer>"""


def test_structured_and_plain_pages():
    assert H.main_text(PAGE) == "Title here Some long text of the article that goes on for a good while, so that it counts & more. Second <b>. next line"
    assert H.main_text("<article><p>a</p><aside>no</aside><p>b &#x41;</p><div class='ad'>x</div></article><p>zzz") == "a b A"
    assert H.main_text("<p>short") == "short" and H.main_text("") == "" and H.main_text(None) == ""
    assert H.main_text("<nav>only a menu") == "" and H.main_text("no markup at all") == "no markup at all"
    assert H.main_text("<p>" + "long " * 50_000 + "<p><b>un<i>closed") == ("long " * 50_000).strip() + " unclosed"


def test_articles_inside_chrome():
    text = "The article goes on for a while, with a second clause and a third one, so that it counts."
    article, side = f"<article><h1>Title</h1><p>{text}</p><div class='ad'>x</div></article>", "<div class='sidebar'><p>Other words</p></div>"
    want = f"Title {text}"
    for page in (f"<body><form action=x>{article}{side}</form>", f"<form><main>{article}</main></form>", f"<div class='content-with-sidebar'>{article}{side}</div>",
                 f"<div class='no-sidebar'>{article}</div>", f"<div id='header-wrap'>{article}</div>", f"<div class='sidebar-right'>{article}</div>",
                 f"<nav><a href=1>Home</a><div>{article}</div><footer>f</footer>", f"<header>Top{article}", f"<div><nav>Menu{article}</div>",
                 f"<div class='menu'>Menu {article}", f"<form>{article}<div class='comments'><article>Great!</article></div></form>",
                 f"{article}<ol class='comment-list'><article>Great!</article></ol>", f"<div class='sidebar-page'><main>{article}</main></div>"):
        assert H.main_text(page) == want, page
    assert H.main_text(f"<div class='no-sidebar'><p>{text}</p></div>") == text
    # chrome stays chrome
    for page in (f"<nav>{article}</nav>", f"<aside>{article}</aside>", f"<div role='navigation'>{article}</div>", f"<div style='display:none'>{article}",
                 f"<form><p>{text}</p></form>", f"<p class='no-comments'>{text}</p>", f"<form><nav>{article}</nav></form>"):
        assert H.main_text(page) == "", page
    assert H.main_text(f"<div><p>{text}</p></div><div class='comments'><article>{'Great! ' * 40}</article></div>") == text
    assert H.main_text(f"<form><article><nav>Menu</nav><p>{text}</p></article></form>") == text


def test_whole_table_against_the_article_element(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in H.extract_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "<p>x</p>")], "page_id long, url string, html string")
    rows = H.extract_text(pages.selectExpr("*", "'c' AS text", "1 AS id")).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in rows) == [("1", "", 0), ("1", "", 0), ("2", "x", 1), ("None", "", 0)]
    assert H.extract_text(pages.limit(0)).count() == 0

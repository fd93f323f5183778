import html
import re
import time

from pyspark.sql import functions as F

from tallgrass.llm.html_text import extract, main_text


def test_keeps_the_article_alone():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>"</script></head><body>
    <header><div>Site</div></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="ad">Buy</div>
    <article><header><h1>Head &amp;amp; more</h1></header><p>One&nbsp;two
      three <b>bold</b><br>next<p>Short.<!-- no --><p>If a &lt; b &copy;<aside>Related</aside><p>End</article>
    <section id="comments"><p>nice one</p></section><div class="cookie-notice">We use</div><form>Mail<input></form>
    <footer>&copy; all</footer></body></html>"""
    assert main_text(page) == "Head &amp; more\nOne two three bold\nnext\nShort.\nIf a < b ©\nEnd"


def test_without_article_element():
    page = "<div id=menu><a href=/>Home</a></div><div class=content><p>" + "Long text here. " * 9 + "</p><p>b</p></div><ul><li><a href=/x>Link text</a></ul>"
    assert main_text(page) == ("Long text here. " * 9).strip() + "\nb"


def test_short_stretches_of_a_long_article():
    """Text after a removed element stays, however long what comes before is."""
    long = ("Long text here. " * 200).strip()
    for removed in ("<div class=ad>Buy</div>", "<aside>See</aside>", "<form>Mail</form>", "<ul><li><a href=/a>A</a><li><a href=/b>B</a></ul>"):
        page = f"<div class=content><p>{long}</p>{removed}<p>The closing words.</p></div>"
        assert main_text(page) == long + "\nThe closing words.", removed
        assert main_text(f"<div><p>Start.</p>{removed}</div><div><p>{long}</p></div>") == "Start.\n" + long, removed


def test_lines_of_links():
    prose = "Words &amp; more words that nobody links to."
    text = "Words & more words that nobody links to."
    for line in ("<p><a href=/x>A paragraph that is a link</a></p>", "<ul><li><a href=/x>A paragraph that is a link</a></li><li>Other</li></ul>"):
        own = "A paragraph that is a link" + ("\nOther" if "Other" in line else "")
        for around in ("<article>%s</article>", "<main>%s</main>", "<div>%s</div>"):
            assert main_text(around % f"<p>{prose}</p>{line}<p>{prose}</p>") == f"{text}\n{own}\n{text}", (line, around)
    links = "<ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul>"
    assert main_text(f"<article><p>{prose}</p>{links}</article>") == f"{text}\nOne\nTwo"
    assert main_text(f"<div><p>{prose}</p>{links}</div>") == text
    assert main_text(f"<div><a href=/>Home</a> | <a href=/b>More</a></div><p>{prose}</p>") == text
    assert main_text("<p><a href=/x>&quot;&quot;&quot;   \n   x</a> and words that are no link at all</p>") == '""" x and words that are no link at all'


def test_names_that_only_hold_a_mark():
    for kind in ('class="post has-comments"', 'class="tag-ad"', 'id="page" class="no-ads"', 'class="content with-sidebar"', 'data-id="comments"'):
        for name in ("article", "div", "section"):
            assert main_text(f"<{name} {kind}><p>The text of it.</p></{name}>") == "The text of it.", (kind, name)
    title = "<h2 id=advertising>Title</h2>"
    for own in ("article-header", "header", "entry-header"):
        assert main_text(f"<article><div class={own}>{title}</div><p>The text.</p></article>") == "Title\nThe text."
    for kind in ("ad-slot-1", "site-header", "ad_container", "x comments", "sidebar-left", "cookie-banner", "main-nav"):
        assert main_text(f"<p>The text.</p><div class='{kind}'>Other</div>") == "The text.", kind


def test_the_article_of_the_page_stays():
    article = "<article class=comments><p>The text of the page, longer than others.</p><div class=ad>Buy</div><p>End.</p></article>"
    text = "The text of the page, longer than others.\nEnd."
    other = "<article class=comment><p>Another says.</p></article>"
    for holder in ("%s", "<form id=aspnet>%s</form>", "<div class=sidebar><p>x</p><div class=widget>%s</div></div>", "<aside role=dialog>%s", "<main class=banner>%s</main>"):
        assert main_text("<div class=menu>Menu</div>" + holder % article + "<div class=comments>" + other + "</div>") == text, holder
        assert main_text(other + holder % article) == text, holder


def test_unclosed_and_odd_markup():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert main_text("plain") == "plain"
    assert main_text("<article><p>a<p>b") == "a\nb"
    assert main_text("<nav><a href=x>m</a><article><p>kept</p></article>") == "kept"
    assert main_text("<p>a <b title='x>y'>c</b> 1 < 2</p>") == "a c 1 < 2"
    assert main_text("<article><p>a</p><script>while(1)") == "a"
    assert len(main_text("<article>" + "<p>word</p>" * 20_000)) == 5 * 20_000 - 1


def test_rows(spark):
    rows = [(1, "u", "<article><p>é</p></article>", "x"), (1, "u", "<article><p>é</p></article>", "x"), (None, None, None, None)]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, "u", "é", 1)] * 2 + [(None, None, "", 0)], key=str)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def by_template(page):
    """The text of a page as the test data are made: blocks of its one article element."""
    blocks = re.split(r"</?(?:p|h1|br)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in blocks)
    return "\n".join(x for x in texts if x)


def test_every_page_of_the_test_data(spark):
    """With article tags or without, the distribution finds the same text."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {r.page_id: by_template(r.html) for r in pages.collect()}
    for own in (pages, pages.withColumn("html", F.regexp_replace("html", "</?article>", ""))):
        assert {r.page_id: r.text for r in extract(own).collect()} == expected


def test_broken_pages():
    assert main_text("<article><p class=byline>By A<p>Text one<p>Text two</article>") == "By A\nText one\nText two"
    assert main_text("<article><ul><li class=share>x<li>y</ul><p class=ad>z<p>end</article>") == "y\nend"
    assert main_text('<article><h2 id="related-work">R</h2><h2 class="section-header">S</h2><p>x y</p></article>') == "R\nS\nx y"
    assert main_text("<article><p>a</p><p><a href=x>one link</a></p></article>") == "a\none link"
    assert main_text('<p data-id="share">x</p><p title="id=ad">y</p>') == "x\ny"
    assert main_text("<p>a <a href='x>b</a> c</p><p>d</p>") == "a b c\nd"
    assert main_text("<head><title>t</title><p>a</p><!-- never ends <p>b") == "a"
    assert main_text("<table><tr><td class=ad>a<td>b<tr><td>c</table>d") == "b\nc\nd"
    assert main_text("<p>a</span></div></p>b<div class=ad/>c") == "a\nb\nc"


def test_marks_that_the_distribution_contradicts():
    text = "The words of the page go on and on. " * 8
    teasers = "<article><a href=/x>Other</a><p>A few words.</p></article>" * 2
    assert main_text(f"<div><p>{text}</p><p>End.</p></div>{teasers}") == text.strip() + "\nEnd."
    assert main_text(f"<p>Outside.</p><article><p>{text}</p><p>End.</p></article>") == text.strip() + "\nEnd."


def test_time_is_linear():
    for piece in ('<a "', '<a b="', "<a b='\"", "<a ", "<li><b>", "<ul><li>", "<div><p>", "</div>x", "<object>", "<span>", "<article>x", "<![CDATA["):
        begun = time.perf_counter()
        main_text(piece * 60_000 + ">")
        main_text(piece * 60_000 + 'b=">')
        assert time.perf_counter() - begun < 10, piece

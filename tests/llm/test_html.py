import re
import html as entities

from pulsemart.llm import html_text

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li>A<li>B</ul></nav>
<div id="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<article class="post"><header><h1>Head&shy;line &amp; more</h1></header>
<p>One <b>bo<i>ld</i></b>ly&nbsp;said<p>Two<br>lines <!-- no --> end &lt;tag&gt; &#233;&#x41;
<ul><li>x<li>y</ul><form><input value=q>Send</form><aside>side</aside>
<table><tr><td>1<td>2<tr><td>3</table><blockquote>quote</blockquote>
<div class="comments"><article class="comment"><p>Nice</p></article></div></article>
<aside>other</aside><footer>foot</footer></body></html>"""


def test_a_whole_page():
    want = "Head­line & more One boldly said Two lines end <tag> éA x y 1 2 3 quote"
    assert html_text.main_text(FULL) == want


def test_odd_pages():
    for page, want in [
        ("", ""),
        ("   ", ""),
        ("plain text", "plain text"),
        ("<p>a</p></p></div>b", "a b"),
        ("<article><p>a <b>b<p>c</b> d</article>", "a b c d"),
        ("<article>un<wbr>broken in<b>lin</b>e</article>", "unbroken inline"),
        ("<article><p>open <div title='a>b'>x</div>", "open x"),
        ("<script>never closed <p>x", ""),
        ("<article>" + "<div>" * 20_000 + "deep", "deep"),
        ("<main><h1>t</h1>m</main><p>no", "t m"),
        ("<article><p>1 < 2 & 3 > 2</article>", "1 < 2 & 3 > 2"),
    ]:
        assert html_text.main_text(page) == want


def rows(spark, found):
    return spark.createDataFrame(found, "page_id long, url string, html string, text string")


def test_template_goes_and_repeated_prose_stays(spark):
    def page(i, host):
        return (
            f"<body><div>Welcome to {host}<ul><li>Home<li>News</ul></div><div><p>Story {'abcdefghij'[i]} "
            f"of {host}.</p><p>Same closing line.</p></div><div>All rights, 20{i}</div></body>"
        )

    pages = [(i, f"https://{h}/{i}", page(i, h), "x") for h in ("a.org", "b.org") for i in range(10)]
    pages += [(50, None, None, None), (51, "no host", "<p>alone", None), (51, "no host", "<p>alone", None)]
    got = {(r["page_id"], r["url"]): r["text"] for r in html_text.extract(rows(spark, pages)).collect()}
    for i, url, _, _ in pages[:20]:
        host = url.split("/")[2]
        assert got[i, url] == f"Story {'abcdefghij'[i]} of {host}. Same closing line."
    assert got[50, None] == "" and got[51, "no host"] == "alone"
    assert html_text.extract(rows(spark, pages)).count() == len(pages)
    assert html_text.extract(rows(spark, [])).collect() == []


def test_pages_of_the_tables(spark):
    """A plain reading of this table's pages: the article's text without its tags."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for row in pages.collect():
        body = re.search(r"(?s)<article>(.*)</article>", row["html"])[1]
        bare = re.sub(r"</?b>", "", body)
        want[row["page_id"]] = " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", bare)).split())
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got == want


def test_deep_pages_through_both_passes(spark):
    deep = "<div>" * 20_000 + "<p>menu 7</p>" + "</div>" * 20_000
    rows = [(i, f"http://a.b/{i}", f"<body>{deep}<p>Own words of page {chr(97 + i)}.</p>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got == {i: f"Own words of page {chr(97 + i)}." for i in range(6)}


def test_equal_subtrees_have_equal_keys():
    one, two = (html_text.parse(f"<div><p>a {n} <b>c</b></p><hr></div>").children[0] for n in (1, 23))
    assert one.key == two.key and one.has_words
    others = ["<div><p>a 1 c</p><hr></div>", "<div><p>a 1</p><b>c</b><hr></div>", "<div><script>x</script></div>"]
    keys = {html_text.parse(p).children[0].key for p in others}
    assert len(keys) == 3 and one.key not in keys
    assert not html_text.parse(others[2]).children[0].has_words


def test_names_that_only_contain_a_word_keep_the_article():
    story = "The story itself, a good deal longer than all around it."
    for page in [
        f'<article class="post category-social tag-search"><p>{story}</article>',
        f'<div class="content has-sidebar"><p>{story}</div>',
        f'<div id="page" class="no-sidebar"><article>{story}</article></div>',
        f'<div class="post comments-open">{story}</div><div class="comments">Nice</div>',
        f'<body><form id="aspnetForm"><nav>Home</nav><div>{story}</div></form></body>',
        f'<div class="sidebar"><article>{story}</article></div>',
        f'<div class="related"><article>Teaser</article></div><div id="text">{story}</div>',
        f'<article class="card">Teaser</article><div id="text">{story}</div><p class="share">Share',
    ]:
        got = html_text.main_text(page)
        assert story in got and not set(got.split()) & {"Nice", "Home", "Share"}, page


def test_names_made_of_such_words_go():
    story = "The story itself, a good deal longer than all around it."
    for name in ("sidebar", "cookie-banner", "social_share", "widget-2", "big comments"):
        assert html_text.main_text(f'<div>{story}</div><div class="{name}">Other</div>') == story


def test_parts_on_many_pages_of_a_large_host_go(spark):
    """A notice on a fifth of the host, a menu of one folder, a line of its own; copies in prose stay."""
    names = [f"{a}{b}{c}" for a in "abcdefg" for b in "hijklmn" for c in "opqrstuv"][:300]
    pages = []
    for i, name in enumerate(names):
        folder = "sport" if i < 40 else "news"
        notice = "<div>Read our offer</div>" if i % 5 == 0 else ""
        menu = "<ul><li>Ball<li>Ring</ul>" if folder == "sport" else ""
        html = f"<body>{notice}{menu}<div><p>Story {name}</p><p>Thanks.</p></div><p>All rights</p></body>"
        pages.append((i, f"https://c.org/{folder}/{i}.html", html, "x"))
    got = {r["page_id"]: r["text"] for r in html_text.extract(rows(spark, pages)).collect()}
    assert got == {i: f"Story {name} Thanks." for i, name in enumerate(names)}

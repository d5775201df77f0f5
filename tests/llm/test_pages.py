import html
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from spindrift.llm import pages

SITE = """<html><body class="has-sidebar"><header><h1>Site</h1><a href=x>Home</a></header><div id=wrap>
<div class="sidebar-left">side text here</div><main><article class="post-12"><header class="entry-header"><h1>Title &amp; more</h1>
</header><p>One <b>bold</b> text, that is <a href=q>long</a>
 enough<p>Two<br>lines<!-- no --> here<ul><li>a<li>b</ul><div class="ad-box">buy</div><aside>x</aside><form><input><p>mail</form>
</article><section id="comments"><article class=comment><p>I agree with all of that, a very long comment indeed</article></section>
</main></div><div class="cookie-notice">We use cookies</div><footer>c</footer><script>if (a<b) "</p>"</script></body></html>"""


def test_other_parts_are_left_out():
    assert pages._Page(SITE).text(None) == "Title & more\n\nOne bold text, that is long enough\n\nTwo lines here\n\na\n\nb"


@pytest.mark.parametrize("source, want", [
    ("", ""), ("<", "<"), ("<p", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("<div><div><p>open", "open"), ("<!-- x", ""),
    ("<script>x", ""), ("a&nbsp;&#233;&am", "a é&am"), ("<p hidden>x</p><p>y", "y"),
    ("<body><nav>n</nav><p>y</p></body>", "y"), ("</p></div>text", "text"),
])
def test_broken_pages(source, want):
    assert pages._Page(source).text(None) == want


def test_pages_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in pages.extract_pages(df).collect()}
    for r in df.collect():
        body = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub("<[^>]*>", "", b.replace("<br>", " ")) for b in re.split("</?p>|</?h1>", body)]
        want = "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_a_host_agrees_on_a_path(spark):
    page = lambda main, side: f"<body><div class=text-1><p>{main}</p></div><div class=extra><p>{side}</p></div></body>"
    rows = [Row(page_id=i, url="http://a.org/x", html=page("main words " * 30, "few words")) for i in range(5)]
    rows += [
        # on its own this page would choose the longer block
        Row(page_id=5, url="https://A.org:80/y", html=page("main words " * 10, "other words " * 15)),
        Row(page_id=6, url=None, html=None), Row(page_id=7, url="nothing", html=""), Row(page_id=7, url="nothing", html=""),
        Row(page_id=None, url="http://a.org", html="<div>alone"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("path", F.lit(2))
    out = pages.extract_pages(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[5] == ("main words " * 10).strip() and by[6] == "" and by[7] == "" and by[None] == "alone"
    assert pages.extract_pages(df.limit(0)).collect() == []


LONG = "a long text of the body with many words " * 30
SHORT = "a second section with fewer words " * 3


@pytest.mark.parametrize("source", [
    f"<article><h1>Title</h1><p>Lead</p><div class=body><p>{LONG}</div></article>",
    f"<main><h1>Title</h1><div class=x><p>Lead</div><div class=body><p>{LONG}</div></main>",
    f"<div class=post><h1>Title</h1><p>Lead</p><div class=body><p>{LONG}</div></div>",
])
def test_title_and_lead_beside_a_body(source):
    page = f"<body><div class=menu>menu</div>{source}<footer>f</footer></body>"
    for path in (None, max(pages._Page(page).votes().items(), key=lambda x: x[1])[0]):
        assert pages._Page(page).text(path) == f"Title\n\nLead\n\n{LONG.strip()}"


def test_sections_of_an_article_stay_together():
    page = f"<body><article><section class=a><p>{LONG}</section><section class=b><p>{SHORT}</section></article></body>"
    assert pages._Page(page).text("body/article/section.a") == f"{LONG.strip()}\n\n{SHORT.strip()}"
    links = "<div class=list><a href=x>one more page</a> <a href=y>and another page</a></div>"
    assert pages._Page(f"<body><h1>Title</h1><div>{links}<div class=b><p>{LONG}</div></div>").text(None) == f"Title\n\n{LONG.strip()}"


def test_a_path_of_a_smaller_part_does_not_replace_the_page():
    page = f"<body><div class=text><p>{'few words ' * 40}</p></div><div class=other><p>{LONG}</p></div></body>"
    assert pages._Page(page).text("body/div.text") == LONG.strip()


@pytest.mark.parametrize("before, after", [
    ("<div class='content no-sidebar'>", "</div>"), ("<form id=aspnetForm>", "</form>"), ("<div id=search-results-page>", "</div>"),
    ("<div class=widget-area>", "</div>"), ("<div class=sidebar-right><div id=modal>", "</div></div>"),
])
def test_no_class_word_empties_a_page(before, after):
    inner = f"<h1>Title</h1><p>{LONG}<p class='alert-level'>An alert inside<div class='form-free body'>Free of forms</div>"
    side = "<div class=sidebar>x side</div><div class=comments><p>a remark</div>"
    want = f"Title\n\n{LONG.strip()}\n\nAn alert inside\n\nFree of forms"
    for body in (f"{before}{inner}{side}{after}", f"{before}<article>{inner}</article>{after}{side}"):
        assert pages._Page(f"<body><nav>n</nav>{body}<footer>f</footer></body>").text(None) == want


def test_inline_elements_stay():
    source = f"<article><p>The <math><mi>Area</mi></math> is <span class=menu>here</span> and {LONG}</p></article>"
    assert pages._Page(source).text(None) == f"The Area is here and {LONG.strip()}"


def test_long_remarks_do_not_replace_a_short_article():
    source = f"<body><div class=post><p>Short text of a page</div><div id=comments><p>{LONG}</div></body>"
    assert pages._Page(source).text(None) == "Short text of a page"
    assert pages._Page(f"<body><div id=comments><p>{LONG}</div></body>").text(None) == LONG.strip()


def test_ties_of_containers():
    page = "<body><div class=a><p>equal text</div><div class=b><p>equal text</div></body>"
    assert pages._Page(page).text("body/div.b") == pages._Page(page).text("body/div.b") == "equal text"

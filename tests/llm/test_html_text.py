import html
import re

from helpers import SF

from histoframe.llm.html_text import extract_main_text, main_text


def plain(page):
    """The article of the tables' pages, which have one template."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body)
    return "\n\n".join(x for x in (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in parts) if x)


def test_table_pages(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: (r.text, r.n_chars) for r in extract_main_text(df).collect()}
    for r in df.collect():
        assert found[r.page_id] == (plain(r.html), len(plain(r.html)))


def test_boilerplate_goes_and_content_stays():
    body = "<p>The first paragraph is long enough, it has commas, and it ends here.</p><p>Short.</p><ul><li>A point, with words.<li>Another point.</ul>"
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><header>Site</header><nav><a href=x>Home</a></nav>"
        f"<div id='cookie-notice'>We use cookies, please agree.</div><main><h1>Head&amp;line</h1>{body}<form><label>Mail</label></form></main>"
        "<aside>Other stories, here.</aside><div class='comments'><p>Nice read, I agree, thanks.</p></div><footer>2020</footer></body></html>"
    )
    assert main_text(page) == "Head&line\n\nThe first paragraph is long enough, it has commas, and it ends here.\n\nShort.\n\nA point, with words.\n\nAnother point."


def test_odd_pages(spark):
    assert main_text(None) == main_text("") == main_text("<p> </p>") == main_text("<script>x") == ""
    assert main_text("a &lt;b&gt;&nbsp; c") == "a <b> c"
    assert main_text("<p>one <b>two</p><p>three") == "one two\n\nthree"
    main_text("<" * 3000 + "a='\"" + "<p " * 3000)
    rows = [(1, "u", None, 1), (1, "u", None, 1), (None, None, "<p>x", 2), (2, "v", "<p>" + "y " * 300_000, 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    out = sorted((r.page_id or 0, r.text[:3], r.n_chars) for r in extract_main_text(df).collect())
    assert out == [(0, "x", 1), (1, "", 0), (1, "", 0), (2, "y y", 599_999)]
    assert extract_main_text(df.limit(0)).count() == 0

"""Archives are read back as written; main texts of pages."""

from __future__ import annotations

import glob
import hashlib
import time

import pytest
import zstandard

from oremill.llm import html_extract, warc
from oremill.session import scratch_dir

LONG = "<p>" + "long enough " * 100 + "</p>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/1", LONG), (2, None, LONG), (7, "http://a/é\r\nX: y", LONG), (7, "http://a/7", LONG), (3, "http://b", "short"), (4, "http://b", "short")]
    rows += [(5, "http://c", None), (6, "http://c", ""), (None, "http://c", LONG), (8, "http://d", "ü" * 999), (9, "http://d", "ü" * 999 + "\r\n\r\nWARC/1.1")]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def test_round_trip(spark, pages):
    out = warc.read(spark, warc.write(pages, scratch_dir(spark, "warc"))).collect()
    assert len(out) == 11
    given = {(r.page_id, r.html or "") for r in pages.collect()}
    for r in out:
        if r.record_type == "response":
            payload = bytes(r.payload)
            assert (r.page_id, payload.decode()) in given and r.refers_to is None
            assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        else:
            assert r.refers_to == 7 and r.payload is None
            assert (r.payload_bytes, r.payload_digest) == (len(LONG), hashlib.sha1(LONG.encode()).hexdigest())
    assert sorted((r.page_id is None, r.page_id or 0) for r in out if r.record_type == "revisit") == [(False, 1), (False, 2), (True, 0)]


def test_frames_are_independent_and_bundles_are_streams(spark, pages):
    folder = scratch_dir(spark, "warc")
    index = warc.write(pages, folder, frame_bytes=700, bundle_bytes=300)
    rows = index.collect()
    assert len({(r.bundle, r.frame) for r in rows}) > 3 and len({r.bundle for r in rows}) > 3
    found = warc.lookup(index, spark.createDataFrame([(7,), (6,), (99,)], "page_id long")).collect()
    assert sorted(r.page_id for r in found) == [6, 7, 7]
    count = 0
    for path in glob.glob(f"{folder.removeprefix('file://')}/*.warc.zst"):
        with open(path, "rb") as file:
            data = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        count += len(list(warc.parse(data)))
    assert count == 11


def test_archive_of_no_pages(spark, pages):
    assert warc.archived(spark, pages.limit(0)).count() == 0


NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><script>var t='</p><p>no';</script></head><body>{NAV}{body}<footer>&copy; all</footer></body></html>"


def text(body: str, html: str | None = None) -> str:
    return html_extract._main_text(page(body) if html is None else html, None, frozenset())


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<article><h1>Head</h1><p>One  &amp;\n two</p><p>three</article>", "Head\nOne & two\nthree"),
        ("<article><p><b>a<br>b<br><p>c</b></p></article>", "a b\nc"),
        ('<div class="ad">buy</div><article>t<!-- <p>no</p> --><div class="ad-box">buy</div>u</article>', "t\nu"),
        ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article><aside>s</aside>", "x\ny\n1\n2"),
        ('<article>a</article><section id="comments"><p>nice!</p></section>', "a"),
        ("<article>a<form><p>mail</p><input></form><script>x<y</script><style>p{}</style>b&nbsp;c</article>", "a\nb c"),
        ("<div><p>No article here at all, yet text.</p></div>", "No article here at all, yet text."),
        ("<article><p>1 &lt; 2 &#233;&eacute;</p><p> \n </p></article>", "1 < 2 éé"),
    ],
)
def test_main_text_of_a_page(body, expected):
    assert text(body) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<html class='has-notice'><body class='no-sidebar comments-open'><p>kept</p></body></html>", "kept"),
        ("<div class='content-sidebar-wrap'><article><p>kept</p></article><p>gone</p></div>", "kept"),
        ("<div class='content-sidebar-wrap'><main><p>kept</p><div class='comments'><article>gone</article></div></main></div>", "kept"),
        ("<p>kept</p><div class='comments-list'><article>gone</article></div>", "kept"),
        ("<p>kept</p><div class='sidebar'><article>gone</article></div>", "kept"),
        ("<p>kept</p><aside class='right'><article>gone</article></aside>", "kept"),
    ],
)
def test_names_of_layouts_do_not_hide_an_article(page, expected):
    assert html_extract._main_text(page, None, frozenset()) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<div class='comments-enabled'><article><p>kept</p></article></div>", "kept"),
        ("<div class='social-feed-page'><main><p>kept</p></main></div>", "kept"),
        ("<article>kept</article><div class='comment-list'><article>gone</article></div>", "kept"),
        ("<div class='ad-page'><article><p>kept</p><div class='promo'>gone</div></article></div>", "kept"),
    ],
)
def test_parts_of_names_do_not_hide_the_only_article(page, expected):
    assert html_extract._main_text(page, None, frozenset()) == expected


@pytest.mark.parametrize(
    "page, length",
    [
        ("<a " * 350_000, 1_049_999),
        ('<p "' * 250_000, 1_000_000),
        ('<p "' * 250_001 + ">x", 1),
        ('<p "><p \'\'><p \'"' * 60_000, None),
        ("<div>" * 100_000 + "</p>" * 100_000, 0),
        ("<div>" * 90_000 + "x" + "</div>" * 90_000, 1),
        ("<ul><li>x" * 50_000, 99_999),
        ("<!--" * 250_000, 0),
    ],
)
def test_broken_megabytes_take_seconds(page, length):
    begun = time.monotonic()
    found = html_extract._main_text(page, frozenset([1]), frozenset([1]))
    assert time.monotonic() - begun < 30
    assert length is None or len(found) == length


def test_tags_by_a_regular_expression():
    """Tags of well-formed pages, and of pages whose quotes do not close, against one pattern."""
    import random
    import re

    pattern = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
    pick = random.Random(7)
    for _ in range(3_000):
        made = "".join(pick.choice(["<p", "<a ", "</p", ">", '"', "'", " x", "=", "<", "<!--", "-->", "<!d", "/"]) for _ in range(pick.randrange(25)))
        markup, at, found = html_extract.Markup(made), 0, []
        while token := markup.next(at):
            found.append(token[:2])
            at = token[1]
        # A name with a quote in it is one name here; the pattern may cut it.
        if not re.search(r"<[/]?[a-z][^\s/>]*[\"']", made):
            assert found == [m.span() for m in pattern.finditer(made)], made


def test_names_that_speak_against_parts_of_an_article_are_settled_by_its_template(spark):
    def made(n: int) -> str:
        body = f"<h2 class='alert'>Warning number {n} of the day</h2><div class='share-price'>Closed at {n * 37} points on day {n}</div>"
        posts = "".join(f"<li><a href='/{i}'>Related story {i}</a></li>" for i in range(4))
        extra = "<div class='related-rare'>seen on one page only</div>" if n == 5 else ""
        body += f"<p>Story {n} tells what no other does.</p><div class='related-posts'><ul>{posts}</ul></div><div class='share-box'>Share this</div>{extra}"
        return page(f"<div class='w1'><div class='w2'><article>{body}</article></div></div>")

    df = spark.createDataFrame([(n, "http://h.example/", made(n)) for n in range(12)], "page_id long, url string, html string")
    for r in html_extract.extract(df).collect():
        n = r.page_id
        assert r.text.split("\n") == [f"Warning number {n} of the day", f"Closed at {n * 37} points on day {n}", f"Story {n} tells what no other does."]


def test_odd_pages():
    assert text("", "") == "" and text("", "<") == "<" and text("", "plain &amp; text") == "plain & text"
    assert text("", "<article><p>never closed") == "never closed"
    assert text("", "<article>İ<script>x</script>b</article>") == "İ b".replace(" ", "")
    deep = "<div>" * 5_000 + "x" + "</div>" * 5_000
    assert text("", f"<article>{deep}</article>") == "x"


def test_template_tells_content_from_menus_without_marks(spark):
    def plain(n: int) -> str:
        menu = "".join(f'<div class="k{i}"><a href="/{i}">Section number {i}</a></div>' for i in range(5))
        body = "".join(f"<p>Paragraph {j} of page {n} says something that no other page does say, {n * 31 + j}.</p>" for j in range(4))
        return f'<html><body><div class="top">{menu}</div><div class="x1"><div class="x2">{body}</div></div><div class="x3">Terms apply everywhere on this site, always.</div></body></html>'

    rows = [(n, "HTTP://user@Host.example/p", plain(n)) for n in range(12)]
    rows += [(n, None, page("<article>alone</article>")) for n in (20, 21)] + [(None, "http://host.example/z", None), (30, "not a url", "")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    found = {r.page_id: r for r in out.collect()}
    for n in range(12):
        assert found[n].text.split("\n") == [f"Paragraph {j} of page {n} says something that no other page does say, {n * 31 + j}." for j in range(4)]
        assert found[n].n_chars == len(found[n].text)
    assert found[20].text == found[21].text == "alone" and found[None].text == found[30].text == ""
    assert html_extract.extract(df.limit(0)).count() == 0


def test_templates_too_large_to_broadcast(spark, monkeypatch):
    rows = [(n, "http://h.example/", page(f"<article><p>text {n}</p></article>")) for n in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", -1)
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == {n: f"text {n}" for n in range(9)}


def test_query_gives_the_articles(spark, sf_dir):
    """The given pages mark their articles: all block texts inside, by a plainer way."""
    import html
    import re

    from oremill.llm.queries import QUERIES

    given = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op10_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(given)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", given[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1|ul|li|div)\b[^>]*>", re.sub(r"<br\s*/?>", " ", inner))
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
        assert r.text == "\n".join(line for line in lines if line), r.page_id
        assert r.n_chars == len(r.text)

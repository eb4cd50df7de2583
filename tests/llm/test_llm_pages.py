"""Content extraction and archives, on the given pages and on odd ones."""

import base64
import gzip
import hashlib
import html
import io
import random
import re
import time
import zlib

import brute
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loanlens.llm import arc_warc, html_content
from loanlens.llm.text import prepared
from loanlens.session import shared_dir

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><nav>menu</nav></header><div id="main"><h1>Title &amp; more</h1>
<p>First <b>bold</b> long paragraph
 of text, with punctuation, and more.</p><p>Short.</p><ul><li>One item<li>Two</ul><pre>code  x</pre><div class="ad-slot">BUY</div>
<form><p>Your name here please</p></form></div><div class="sidebar"><p>Other long text that could be a paragraph, but is not.</p></div>
<aside>as</aside><div class="cookie-notice">We use cookies, ok?</div><section id="comments"><p>Great post, thanks a lot for it!</p></section>
<div id="footer">c</div><footer>&copy; x</footer><script>if(a<b){"<p>"}</script><style>p{}</style></body></html>"""


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain &amp; text &lt;b&gt;", "plain & text <b>"), ("a<!-- no --> b<br>c", "a b c"),
    ("<p>a<p>b  c<br>d<ul><li>x<li>y</ul>e", "a\nb c d\nx\ny\ne"),
    (PAGE, "Title & more\nFirst bold long paragraph of text, with punctuation, and more.\nShort.\nOne item\nTwo\ncode x"),
    ("<article><header><h1>T</h1></header><p>x</p><div class='comments'><p>c1</p></div><table><tr><td>1<td>2<tr><td>3</table></article>"
     "<article class='comment'>nope</article>", "T\nx\n1\n2\n3"),
    ("<div><a href='x'>home</a> <a href=y>about</a></div><div><p>" + "Word, " * 50 + "</p><p>See <a href=z>this link</a>&nbsp;now.</p></div>",
     ("Word, " * 50).strip() + "\nSee this link now."),
    ("<nav>only a menu</nav><footer>and a footer</footer>", ""),
    ("<article><p>cut off in the middle of a <b>phra", "cut off in the middle of a phra"),
])
def test_main_text(page, text):
    assert html_content.main_text(page) == text


LONG = "A sentence of the article, with marks, that is long enough to count. "


@pytest.mark.parametrize("page, text", [
    # A wrapper that mentions what is beside it.
    (f"<div class='content has-sidebar'><article><h1>T</h1><p>{LONG}</p></article></div><p>Just a line.</p>", f"T\n{LONG.strip()}"),
    (f"<div class='content has-sidebar'><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div class='sidebar'>x</div>", f"T\n{LONG.strip()}\n{LONG.strip()}"),
    (f"<article class='post related-science'><p>{LONG * 3}</p></article><div>short</div>", (LONG * 3).strip()),
    (f"<main class='post comments-open'><p>{LONG}</p><div class='comments'><p>{LONG}</p></div></main>", LONG.strip()),
    (f"<article><p>{LONG}</p></article><section id='comments'><article><p>{LONG * 9}</p></article></section>", LONG.strip()),
    # The bulk in a list, a table or a nested section.
    (f"<article><h1>T</h1><p>Intro.</p><ul><li>{LONG * 5}<li>{LONG * 5}</ul><p>Closing.</p></article>",
     f"T\nIntro.\n{(LONG * 5).strip()}\n{(LONG * 5).strip()}\nClosing."),
    (f"<div><h1>T</h1><p>{LONG}</p><table><tr><td>{LONG * 9}</td><td>2</td></tr></table><p>{LONG}</p></div>",
     f"T\n{LONG.strip()}\n{(LONG * 9).strip()}\n2\n{LONG.strip()}"),
    (f"<main><h1>T</h1><section><p>{LONG}</p><section><p>{LONG * 9}</p></section></section><p>End.</p></main>",
     f"T\n{LONG.strip()}\n{(LONG * 9).strip()}\nEnd."),
    (f"<body><nav>m</nav><div id=lead><p>{LONG * 2}</p></div><div id=body><p>{LONG * 8}</p><p>Short.</p><p>{LONG}</p></div>",
     f"{(LONG * 2).strip()}\n{(LONG * 8).strip()}\nShort.\n{LONG.strip()}"),
])
def test_no_text_of_the_article_is_lost(page, text):
    assert html_content.main_text(page) == text


@pytest.mark.parametrize("tag", ["div", "b", "p", "li", "ul", "table", "section"])
def test_time_grows_with_the_page_not_its_depth(tag):
    began = time.process_time()
    assert html_content.main_text(f"<{tag}>" * 20_000 + LONG + f"</{tag}>" * 20_000) == LONG.strip()
    assert time.process_time() - began < 3


def test_ratios_against_a_plain_version():
    """The tag-path ratios by dictionaries of whole paths, read with the standard parser."""
    from html.parser import HTMLParser
    from statistics import pstdev

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.rows = [], []

        def handle_starttag(self, tag, attrs):
            self.open.append(tag)

        def handle_endtag(self, tag):
            self.open.pop()

        def handle_data(self, data):
            if data.strip():
                self.rows.append((tuple(self.open), len(data.strip()), sum(data.count(c) for c in ".,;:!?")))

    draw = random.Random(8)
    part = lambda: f"<p>{LONG * draw.randrange(1, 9)}</p>" if draw.random() < 0.6 else f"<{(t := draw.choice(['b', 'i', 'h2', 'span']))}>{'word ' * draw.randrange(1, 5)}</{t}>"
    for _ in range(30):
        page = "".join(f"<{(t := draw.choice(['div', 'section']))}>{''.join(part() for _ in range(draw.randrange(1, 6)))}</{t}>" for _ in range(8))
        plain = Plain()
        plain.feed(page)
        at = {p: [r for r in plain.rows if r[0] == p] for p, _, _ in plain.rows}
        means = [[sum(r[k] for r in at[p]) / len(at[p]) for p, _, _ in plain.rows] for k in (1, 2)]
        smooth = [[(2 * x[i] + sum(x[j] for j in (i - 1, i + 1) if 0 <= j < len(x))) / (2 + (i > 0) + (i < len(x) - 1)) for i in range(len(x))] for x in means]
        fused = [a * (1 + b) for a, b in zip(*smooth)]
        found = [n for n in html_content.Page(page).found if n.text.strip()]
        assert html_content.content_nodes(found) == [x >= 0.5 * pstdev(fused) for x in fused]


@pytest.mark.parametrize("page", ["<" * 5000, '<a "' * 5000, "<div>" * 3000 + "x", "</p>" * 5000, "<p>" + "w " * 500_000])
def test_strange_pages_end(page):
    html_content.main_text(page)


def test_given_pages(spark):
    pages = prepared(spark).read.parquet(f"{SMALL}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    rows = html_content.extract(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", article.replace("<br>", " ")))
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        assert r.text == "\n".join(line for line in lines if line) and r.n_chars == len(r.text)


def test_extract_keeps_other_columns(spark):
    pages = prepared(spark).createDataFrame([(1, "u", "<p>x</p>", "old"), (1, "u", "<p>x</p>", "old"), (None, None, None, None)],
                                            "page_id long, url string, html string, text string")
    rows = html_content.extract(pages)
    assert rows.columns == ["page_id", "url", "text", "text_", "n_chars"]
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "u", "old", "x", 1), (1, "u", "old", "x", 1), (None, None, None, "", 0)]
    assert html_content.extract(pages.limit(0)).count() == 0


# Archives -----------------------------------------------------------------------------

TRICKY = "\n\nfiledesc://x 1 2 3 4 5\nhttp://a 1.1.1.1 20000101000000 text/html 10\n\r\n\r\nWARC/1.1\r\n\r\n"
ROWS = [(7, "http://a b/c", "<p>ä\r\n\r\nx</p>"), (3, None, "<p>ä\r\n\r\nx</p>"), (5, "u", None), (5, "u", None), (None, "x", ""), (9, "y", TRICKY),
        (-4, "z\ny", "HTTP/1.1 200\r\n\r\nx"), (2**60, "q", "x" * 300_000), (2**60 + 1, "q", "x" * 300_000)]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def page_frame(spark, parts=2):
    frame = prepared(spark).createDataFrame(ROWS, "page_id long, url string, html string")
    return frame.withColumns({name: F.lit("x") for name in brute.CLASHING}).repartition(parts, "html")


@pytest.mark.parametrize("file_bytes, least", [(64_000_000, 0), (300, 0), (1, 1)])
def test_records_come_back(spark, file_bytes, least):
    rows = arc_warc.archived(page_frame(spark), least, file_bytes).collect()
    assert len(rows) == len(ROWS)
    first = {}
    for i, _, text in ROWS:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    got = {}
    for r in rows:
        got.setdefault((r.page_id, r.payload_digest), []).append(r)
    for i, _, text in ROWS:
        for r in got[i, digest(text)]:
            assert r.payload_bytes == len((text or "").encode())
            assert (r.refers_to is None) == (r.record_type == "response")
            if r.record_type == "revisit":
                assert r.refers_to == first[text or ""] and len((text or "").encode()) >= least
            elif len((text or "").encode()) >= least:
                assert r.page_id == first[text or ""]
    responses = sum(r.record_type == "response" for r in rows)
    assert responses == (5 if least == 0 else 7)
    assert arc_warc.archived(page_frame(spark).limit(0)).count() == 0


def test_both_versions_are_written_and_read(spark):
    path = shared_dir(spark, "arc")
    arc_warc.write_arc(page_frame(spark, 5), path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()
    versions = {arc_warc._opened(f.content).read().split(b"\n")[1][:1] for f in files}
    assert versions == {b"1", b"2"}
    read = arc_warc.arc_records(spark, path).collect()
    assert sorted((r.page_id, r.payload_digest) for r in read if r.page_id) == sorted((str(i), digest(t)) for i, _, t in ROWS if i is not None)


def test_files_are_bounded_by_bytes_and_records_are_members(spark):
    """Pages of 50 MB and a small limit: a record a file; small pages share files up to the limit."""
    path = shared_dir(spark, "arc")
    large = prepared(spark).range(2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.concat(F.lit("<p>x"), F.col("id").cast("string")), 10_000_000).alias("html"))
    assert {(r.payload_bytes, r.record_type) for r in arc_warc.archived(large, file_bytes=1_000_000).collect()} == {(50_000_000, "response")}
    small = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("y"), 900).alias("html")).coalesce(1)
    arc_warc.write_arc(small, path, file_bytes=20_000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()
    assert 9 <= len(files) <= 14
    for f in files:
        whole = gzip.decompress(f.content)
        records = list(arc_warc.read_arc(io.BytesIO(whole)))
        assert len(whole) < 21_000 and whole.startswith(b"filedesc:")
        rest, sizes = f.content, []
        while rest:
            one = zlib.decompressobj(31)
            sizes.append(len(one.decompress(rest)))
            rest = one.unused_data
        assert len(sizes) == len(records) + 1
    assert arc_warc.arc_records(spark, path).count() == 200


def test_damaged_archives():
    good = b"http://a 1.1.1.1 1999 text/plain 3\nabc\n"
    head = b"filedesc://x 0.0.0.0 1999 text/plain 4\n1 0\n\n"
    longer = b"http://b c 1.1.1.1 19990203040506 text/html 200 - - 0 f.arc 2\nhi\n"
    two = b"filedesc://x 0.0.0.0 1999 text/plain 200 - - 0 f 4\n2 0\n\n"
    read = lambda data: [(f["URL"], b) for _, f, b in arc_warc.read_arc(io.BytesIO(data))]
    assert read(head + good + b"rubbish\n" + good) == [("http://a", b"abc")] * 2
    assert read(head + good + b"http://cut 1.1.1.1 1999 text/plain 99\nabc") == [("http://a", b"abc")]
    assert read(two + longer) == [("http://b c", b"hi")] and read(b"") == []
    assert arc_warc.warc_date("19990203040506") == "1999-02-03T04:05:06Z"
    assert arc_warc.warc_date("1999") == "1999-01-01T00:00:00Z" and arc_warc.warc_date("x") == "1970-01-01T00:00:00Z"


def test_resources_and_foreign_bytes(spark):
    arc, warc = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    body = bytes(range(256))
    data = b"filedesc://x 0.0.0.0 1999 text/plain 4\n1 0\n\n" + b"dns:a 1.1.1.1 1999 text/dns %d\n" % len(body) + body + b"\n"
    from pathlib import Path

    Path(arc).mkdir(parents=True)
    Path(arc, "x.arc.gz").write_bytes(gzip.compress(data))
    arc_warc.convert(spark, arc, warc)
    (row,) = arc_warc.read_back(spark, warc).collect()
    assert tuple(row) == (None, 256, base64.b32encode(hashlib.sha1(body).digest()).decode(), "resource", None)

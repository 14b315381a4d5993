"""Main text of pages; WARC derivatives."""

import gzip
import hashlib
import json
import re
import base64
from html import unescape

import numpy as np
import pytest

from tessera.llm import html_extraction, warc
from tessera.llm.common import read_table, ship
from tests.conftest import SF_MID, SF_SMALL

PAGES = "page_id long, url string, html string, text string, record_id string, `a.b` string"
TREE = html_extraction.train(html_extraction.LABELLED)


def pages_frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x") for i, u, h in rows], PAGES)


def main(page):
    return html_extraction.main_text(page, TREE)


def test_tree_fits_its_table():
    table = np.array(html_extraction.LABELLED, dtype=float)
    assert (html_extraction.classify(TREE, table[:, :-1]) == table[:, -1].astype(bool)).mean() > 0.97


def test_query_equals_the_article_element(spark):
    ship(spark)
    got = {r["page_id"]: r for r in html_extraction.op9_html_extraction(spark, SF_MID).collect()}
    pages = read_table(spark, SF_MID, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"(?s)<article>(.*)</article>", p["html"])[1].replace("<br>", " ")
        blocks = (" ".join(unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(b for b in blocks if b)
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want)


LONG = "Here is a paragraph with enough words to be the text of an article, as anyone can see by reading it to the end. " * 2
NOISE = [
    "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>", "<div class='ad banner'>Buy this now, it is cheap and good.</div>",
    "<aside><p>" + "Something about the author. " * 5 + "</p></aside>", "<div id=comments><p>" + "I do not agree with this. " * 8 + "</p></div>",
    "<form><p>Your name please and your address too</p><input name=q><select><option>One</select></form>",
    "<div role='complementary'>" + "See also these other pages. " * 6 + "</div>", "<div class=\"cookie-notice\"><p>" + "We use cookies. " * 9 + "</p></div>",
    "<script>if (a < b) { document.write('<p>" + "no text " * 30 + "</p>'); }</script>", "<style>p > a { color: red }</style>",
    "<footer><p>&copy; 2020 Somebody, all rights reserved, " + "and so on " * 10 + "</p></footer>", "<!-- " + "a comment " * 30 + " -->",
]


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div class='post-content'>%s</div>", "<div>%s</div>", "%s"])
@pytest.mark.parametrize("noise", range(len(NOISE)))
def test_noise_is_left_out(wrap, noise):
    body = f"<h1>A title of some words</h1><p>{LONG}</p><p>{LONG}<b>bold</b> &amp; caf&eacute;&nbsp;x</p>"
    want = "\n".join(["A title of some words", LONG.strip(), f"{LONG}bold & café x"])
    for page in (NOISE[noise] + wrap % body, wrap % body + NOISE[noise]):
        assert main(f"<html><head><title>T</title></head><body>{page}</body></html>") == want


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<p>", ""), ("<article><p>a<p>b</article>", "a\nb"), ("<article><p title='a>b'>x  \n y</p></article>", "x y"),
    ("<article>1 &lt; 2 &#x41; &unknown;</article>", "1 < 2 A &unknown;"), ("<article><div><p>in</div></p></section>still</article>", "in\nstill"),
    ("<article>a<br>b</article>", "a b"), ("<article><header><h1>T</h1></header>x</article><header>no</header>", "T\nx"),
    ("<article>" + "<div>" * 3000 + "deep" + "</article>", "deep"), ("<article>x<script>never closed", "x"), ("<article>a < b and <3</article>", "a < b and <3"),
])
def test_odd_pages(page, want):
    assert main(page) == want


@pytest.mark.parametrize("page,want", [
    # a title before a linked byline
    (f"<article><h1>A short title</h1><p><a href=/who>By Some Body</a></p><p>{LONG}</p></article>", ["A short title", "By Some Body", LONG.strip()]),
    # a list of linked items
    (f"<article><p>{LONG}</p><p>See these:</p><ul><li><a href=/a>One thing</a> at last<li><a href=/b>Two</a><li>three <a href=/c>more</a></ul></article>",
     [LONG.strip(), "See these:", "One thing at last", "Two", "three more"]),
    # a short lead right after the menu
    (f"<nav><a href=/a>Home</a></nav><article><p>A lead of a few words only.</p><p>{LONG}</p></article>", ["A lead of a few words only.", LONG.strip()]),
    # a short last paragraph before a linked footer, and before a list of links without a name
    (f"<article><p>{LONG}</p><p>That is all.</p></article><footer><a href=/a>Imprint</a></footer>", [LONG.strip(), "That is all."]),
    (f"<article><p>{LONG}</p><p>That is all.</p></article><ul><li><a href=/a>More</a><li><a href=/b>Pages</a></ul>", [LONG.strip(), "That is all."]),
    # text outside the article before and after links
    (f"<p>{LONG}</p><p><a href=/a>Read it</a></p><article><p>Text.</p></article><p><a href=/b>Next</a></p><p>{LONG}</p>", ["Text."]),
])
def test_article_blocks_next_to_links(page, want):
    assert main(f"<html><body>{page}</body></html>").split("\n") == want


@pytest.mark.parametrize("names", [
    "layout has-sidebar", "wrapper no-sidebar", "post comments-open", "post-123 post type-post hentry category-news tag-search",
    "content-area with-side-menu", "sidebar-right layout",
])
@pytest.mark.parametrize("tag", ["div", "article", "main"])
def test_names_of_the_whole_page_lose_nothing(tag, names):
    body = f"<h1>A title of some words</h1><p>{LONG}</p><p>{LONG}</p>"
    noise = f"<div class=comments><p>{'I do not agree. ' * 9}</p></div>"
    want = ["A title of some words", LONG.strip(), LONG.strip()]
    assert main(f"<html><body><{tag} class='{names}'>{body}{noise}</{tag}></body></html>").split("\n") == want
    if tag == "div":
        assert main(f"<html><body><div class='{names}'><article>{body}</article>{noise}</div></body></html>").split("\n") == want


@pytest.mark.parametrize("name", ["comment", "comment-body depth-2", "teaser"])
def test_articles_that_are_comments_do_not_count(name):
    page = f"<div><h1>A title of some words</h1><p>{LONG}</p><p>{LONG}</p></div><article class='{name}'><p>{'I agree with it. ' * 12}</p></article>"
    assert main(f"<html><body>{page}</body></html>").split("\n") == ["A title of some words", LONG.strip(), LONG.strip()]


def test_long_comments_stay_out():
    page = f"<div><p>{LONG}</p></div><div class=comments>" + f"<p>{LONG}</p>" * 20 + "</div>"
    assert main(f"<html><body>{page}</body></html>") == LONG.strip()


def test_the_article_element_decides_where_there_is_one():
    table = np.array(html_extraction.LABELLED, dtype=float)
    assert (html_extraction.classify(TREE, table[:, :-1]) == table[:, -1].astype(bool)).all()
    rows = np.array([
        (0, a, w, x, wb, xb, wa, xa, h)
        for a in (0, 1) for w in (1, 5, 16, 26, 300) for x in (0, 0.4, 1) for wb in (0, 3, 90) for xb in (0, 0.6, 1)
        for wa in (0, 3, 90) for xa in (0, 0.3, 1) for h in (0, 1)
    ])
    assert (html_extraction.classify(TREE, rows) == rows[:, 1].astype(bool)).all()


@pytest.mark.parametrize("depth", [600, 10_000])
@pytest.mark.parametrize("closed", [True, False])
def test_deep_nesting_loses_nothing(depth, closed):
    inner = "<div>" * depth + f"<p>{LONG}</p>" + "</div>" * depth * closed
    page = f"<body><nav><a href=/>Home</a></nav><article><h1>A title of some words</h1>{inner}<p>{LONG} again</p></article><p>A note of some words after it, which is not the article.</p></body>"
    text = " ".join(LONG.split())
    assert main(page) == f"A title of some words\n{text}\n{text} again"


def test_many_stray_end_tags_take_no_time():
    from time import perf_counter

    start = perf_counter()
    main("<div>" * 20_000 + "</p></section>" * 20_000 + LONG)
    assert perf_counter() - start < 5


@pytest.mark.parametrize("article", ["<article>%s</article>", "<div>%s</div>"])
def test_a_form_around_the_page_is_its_frame(article):
    body = article % f"<h1>A title of some words</h1><p>{LONG}</p><p>{LONG}</p>"
    page = f"<body><form id=aspnetForm><nav><ul><li><a href=/a>Home</a></ul></nav>{body}<footer>&copy; Somebody</footer></form></body>"
    text = " ".join(LONG.split())
    assert main(page) == f"A title of some words\n{text}\n{text}"


def test_formulas_and_unclosed_controls_hide_nothing():
    text = " ".join(LONG.split())
    assert main(f"<article><p>{LONG}Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>") == f"{text} Where x=2 holds."
    assert main(f"<article><p>{LONG}</p><select><p>{LONG}</p><button type=x><p>{LONG}</p></article>") == "\n".join([text] * 3)
    assert main(f"<article><p>{LONG}</p><select><option>One</select><button>Send</button></article>") == text


def test_extract_edges(spark):
    ship(spark)
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<article>x</article>"), (3, "u", "<article>" + "w " * 300_000 + "</article>")]
    got = html_extraction.extract(pages_frame(spark, rows), out="main").collect()
    assert [r["main"] for r in got] == ["", "", "", "x", ("w " * 300_000).strip()]
    assert html_extraction.extract(pages_frame(spark, []), out="main").count() == 0


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_query_links_and_digests(spark):
    ship(spark)
    pages = {r["url"]: r["html"] for r in read_table(spark, SF_SMALL, "pages").collect()}
    sources = {r["record_id"]: r for r in warc.responses(read_table(spark, SF_SMALL, "pages")).collect()}
    got = warc.op6_warc_derivatives(spark, SF_SMALL).collect()
    assert len(got) == 2 * len(sources) and len({r["record_id"] for r in got}) == len(got)
    for r in got:
        data = r["block"].encode()
        assert r["refers_to"] in sources and r["block_digest"] == sha1(data) and r["content_length"] == len(data)
        page = pages[r["target_uri"]]
        assert r["payload_digest"] == sha1(page.encode())
        if r["record_type"] == "metadata":
            meta = json.loads(r["block"])["Envelope"]
            assert meta["WARC-Header-Metadata"]["WARC-Record-ID"] == r["refers_to"]
            http = meta["Payload-Metadata"]["HTTP-Response-Metadata"]
            assert http["Status"] == "200" and http["HTML-Metadata"]["Title"] is not None
            assert len(http["HTML-Metadata"]["Links"]) == page.count("<a ")
        else:
            assert r["block"] == "\n".join(b.text for b in html_extraction.blocks(page))


def response(body, *headers, status="200 OK"):
    head = "\r\n".join([f"HTTP/1.1 {status}", *headers]).encode()
    return head + b"\r\n\r\n" + body


def text_of(block):
    out = warc.derivatives("<urn:x>", [("WARC-Type", "response")], block)
    return out[1][3].decode() if len(out) > 1 else None


def test_codings_and_charsets():
    html = "<p>Grüße</p>".encode("latin-1")
    kind = "Content-Type: text/html; charset=iso-8859-1"
    assert text_of(response(html, kind)) == "Grüße"
    assert text_of(response(gzip.compress(html), kind, "Content-Encoding: gzip")) == "Grüße"
    chunked = b"4\r\n" + html[:4] + b"\r\n" + f"{len(html) - 4:x};x=1\r\n".encode() + html[4:] + b"\r\n0\r\n\r\n"
    assert text_of(response(chunked, kind, "Transfer-Encoding: chunked")) == "Grüße"
    assert text_of(response(b"<meta charset='latin-1'><p>\xe9</p>", "Content-Type: text/html")) == "é"
    assert text_of(response(b"a\nb", "Content-Type: text/plain")) == "a\nb"
    assert text_of(response(b"\x89PNG", "Content-Type: image/png")) is None
    assert text_of(b"not http") is None
    assert text_of(response(b"x", "Content-Type: text/html; charset=no-such")) == "x"


def test_repeated_headers_are_all_kept():
    source = [("WARC-Type", "response"), ("WARC-Concurrent-To", "<urn:a>"), ("WARC-Concurrent-To", "<urn:b>")]
    block = response(b"<p>t</p>", "Content-Type: text/html", "Set-Cookie: a=1", "set-cookie: b=2", "Link: </x>")
    meta = json.loads(warc.derivatives("<urn:x>", source, block)[0][3])["Envelope"]
    assert meta["WARC-Header-Metadata"] == {"WARC-Type": "response", "WARC-Concurrent-To": ["<urn:a>", "<urn:b>"]}
    headers = meta["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"]
    assert headers == {"Content-Type": "text/html", "Set-Cookie": ["a=1", "b=2"], "Link": "</x>"}


def test_all_gzip_members_are_read():
    kind = ("Content-Type: text/html", "Content-Encoding: gzip")
    assert text_of(response(gzip.compress(b"<p>one ") + gzip.compress(b"two</p>"), *kind)) == "one two"
    assert text_of(response(gzip.compress(b"<p>one</p>") + b"\0\0", *kind)) == "one"


def test_codings_are_undone_in_turn():
    import zlib

    body, kind = b"<p>some text</p>", "Content-Type: text/html"
    raw = zlib.compressobj(wbits=-15)
    deflated = raw.compress(body) + raw.flush()
    chunks = lambda b: b"%x\r\n%s\r\n0\r\n\r\n" % (len(b), b)
    for coded, *headers in [
        (deflated, "Content-Encoding: deflate"), (zlib.compress(body), "Content-Encoding: deflate"),
        (chunks(gzip.compress(body)), "Transfer-Encoding: gzip, chunked"), (chunks(deflated), "Transfer-Encoding: chunked", "Content-Encoding: deflate"),
        (gzip.compress(zlib.compress(body)), "Content-Encoding: deflate, gzip"), (chunks(gzip.compress(deflated)), "Transfer-Encoding: gzip", "Transfer-Encoding: chunked", "Content-Encoding: Deflate"),
        (body, "Content-Encoding: br"),
    ]:
        assert text_of(response(coded, kind, *headers)) == "some text", headers


def test_references_are_decoded_and_hidden_links_left_out():
    page = (
        "<!-- <title>no</title><a href=/hidden> --><title>AT&amp;T &#8211; x</title><meta name=d content='a &lt; b'>"
        "<script src=/s.js?a=1&amp;b=2>document.write('<a href=/written>')</script><style>a{background:url(<img src=/no>)}</style>"
        "<a href='/x?a=1&amp;b=2'>y</a><img src=/i.png>"
    )
    meta = json.loads(warc.derivatives("<urn:x>", [], response(page.encode(), "Content-Type: text/html"))[0][3])
    found = meta["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]
    assert found["Title"] == "AT&T \u2013 x" and found["Metas"] == [{"name": "d", "content": "a < b"}]
    assert found["Links"] == [
        {"path": "script@src", "url": "/s.js?a=1&b=2"}, {"path": "a@href", "url": "/x?a=1&b=2"}, {"path": "img@src", "url": "/i.png"},
    ]


def test_members_round_trip():
    records = warc.derivatives("<urn:x>", [("WARC-Target-URI", "http://a/"), ("X", "y")], response(b"<p>t</p>", "Content-Type: text/html"))
    data = b"".join(warc.member(h, b) for _, _, h, b in records)
    assert list(warc.parse(data)) == [(h, b) for _, _, h, b in records]
    plain = b"".join(warc.serialize(h, b) for _, _, h, b in records)
    assert list(warc.parse(plain)) == [(h, b) for _, _, h, b in records]


def test_derive_edges(spark):
    ship(spark)
    assert warc.derive(warc.responses(pages_frame(spark, []))).count() == 0
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>x")]
    records = warc.responses(pages_frame(spark, rows))
    other = spark.createDataFrame([("<urn:i>", "warcinfo", [("a", "b")], b"x"), (None, "response", [], b""), ("<urn:n>", "response", [], None)], warc.RECORD)
    got = warc.derive(records.unionByName(other)).collect()
    assert sorted(r["record_type"] for r in got) == ["conversion"] * 3 + ["metadata"] * 3

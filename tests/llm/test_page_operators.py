import base64
import gzip
import hashlib
import html
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import pages, warc
from tessera.llm.page_tree import blocks, parse, subtree_hashes

PAGE = "page_id long, url string, html string"


def text_of(page):
    return "\n".join(blocks(parse(page)))


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<article><p>a <b>b</b>c<br>d</p></article><p>out", "a bc d"),
    ("<nav><a>m</a><article><p>x</p></article>", "x"),
    ("<article><header><h1>T</h1><p>by</p></header><p>x</p><section class='user-comments'><p>c</p></section></article>", "T\nx"),
    ("<body><header>h</header><div class='cookie-notice'>n</div><div id=sideBar>s</div><main><p>x</p></main><footer>f", "x"),
    ("<p>a &amp; b &am c &lt;d&gt; &#233;&nbsp;e &amp;amp; f", "a & b &am c <d> é e &amp; f"),
    ("<script>var t='</p>';</script><style>p{}</style><p>x<!-- no --><form><p>f</p></form>y", "x\ny"),
    ("<p>a<", "a<"), ("<p>a<b class='", "a"), ("<p>1 < 2", "1 < 2"), ("<div hidden>h</div><p aria-hidden=true>i</p>x", "x"),
    ("<article>one<ul><li>two<li>three</ul></article><article class=comment>no</article>", "one\ntwo\nthree"),
    ("<title>t</title><p>x", "x"), ("<script>never closed <p>x", ""), ("</p></div>x</b>", "x"),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\nb\nc\nd"), ("<P CLASS=Ad>no</P><P>Yes", "Yes"),
    ("<p>a<script>s</script>b<a href=\"x>c</a>d</p>e", "abcd\ne"),
])
def test_blocks(page, want):
    assert text_of(page) == want


@pytest.mark.parametrize("page, want", [
    ("<div style=\"overflow: hidden\"><p>a</p></div><p title='a hidden gem' data-x=\"x id=nav\">b</p>", "a\nb"),
    ("<p data-hidden=1>a<p data-class='ad'>b<p title=\"class=ad\">c<p hidden>d<p HIDDEN=''>e", "a\nb\nc"),
    ("<div class='content-sidebar-wrap'><article><p>body</p></article><div class=sidebar><p>s</p></div></div>", "body"),
    ("<div class='has-sidebar'><main><p>body</p></main></div>", "body"),
    ("<div class='elementor-widget-container'><p>long body</p></div><div class=widget><p>w</p></div>", "long body"),
    ("<div class=has-sidebar>long body<br>more</div><div class=widget>w</div>", "long body more"),
    ("<main><p>a body longer than its teasers</p></main><article><p>one</p></article><article><p>two</p></article>", "a body longer than its teasers"),
    ("<div><p>a body longer than its teaser</p></div><article><p>one</p></article>", "a body longer than its teaser\none"),
    ("<article><p>the longest</p></article><div class=related><article><p>teaser</p></article></div>", "the longest"),
    ("<article><p>post</p><div class=comments><p>longer than the post</p></div></article>", "post"),
    ("<div class=no-comments><p>all there is</p></div>", "all there is"),
])
def test_marks_are_names_and_never_drop_the_article(page, want):
    assert text_of(page) == want


def test_reader_equals_plain_split_of_the_given_pages(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inner = re.search(r"(?s)<article>(.*)</article>", r.html)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", x.replace("<br>", " ")))).strip() for x in re.split("</?(?:p|h1)>", inner)]
        assert text_of(r.html) == "\n".join(x for x in parts if x)


def test_deep_and_broken_markup_does_not_fail():
    deep = "<div>" * 5000 + "x" + "</div>" * 4000
    assert text_of(deep) == "x" and subtree_hashes(parse(deep))
    assert text_of("<" * 2000) and text_of("<a href=\"" * 300 + "x") == ""


def site(spark):
    rows = [(i, f"http://a.example/{i}", f"<div id=top><div class=x><p>Same box</p></div><p>body {i}</p><div><p>boiler</p></div></div>") for i in range(12)]
    rows += [(i, "http://b.example/y", "<div class=x><p>copy of one article</p></div>") for i in range(12, 20)]
    rows += [(20, "http://c.example/z", "<div class=x><p>Same box</p></div><p>alone</p>"), (None, None, None), (21, None, ""), (21, None, "")]
    return spark.createDataFrame(rows, PAGE)


def test_templates_go_and_copies_stay(spark):
    extra = site(spark).select("*", *[F.lit("clash").alias(c) for c in ("__id", "__page", "host", "hashes", "templates", "text", "n_chars")])
    found = {}
    for r in pages.extract(extra).collect():
        found.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert all(found[i] == [f"body {i}"] for i in range(12))
    assert all(found[i] == ["copy of one article"] for i in range(12, 20))
    assert found[20] == ["Same box\nalone"] and found[None] == [""] and found[21] == ["", ""]


def test_no_pages(spark):
    none = spark.createDataFrame([], PAGE)
    assert pages.extract(none).count() == 0 and warc.derivatives(warc.page_responses(none)).count() == 0


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_derivatives_refer_to_their_response(spark):
    source = site(spark)
    responses = warc.page_responses(source)
    by_id = {r.record_id: r for r in responses.collect()}
    made = warc.derivatives(responses, keep=("page_id",)).collect()
    assert len(made) == 2 * source.count()
    for r in made:
        response = by_id[r.refers_to]
        block, record = bytes(r.block), bytes(r.record)
        payload = bytes(response.block).partition(b"\r\n\r\n")[2]
        assert r.page_id == response.page_id and r.target_uri == response.target_uri
        assert r.block_digest == sha1(block) and r.payload_digest == sha1(payload) and r.content_length == len(block)
        head = record.partition(b"\r\n\r\n")[0].decode().split("\r\n")
        assert head[0] == "WARC/1.0" and f"WARC-Refers-To: {r.refers_to}" in head and f"Content-Length: {len(block)}" in head
        (headers, again), = warc.split_records(record)
        assert again == block and dict(headers)["WARC-Type"] == r.warc_type
        if r.warc_type == "metadata":
            assert f"source-payload-digest: {sha1(payload)}\r\n".encode() in block and b"http-status: 200\r\n" in block
    assert len({r.record_id for r in made if r.page_id is not None and r.page_id < 21}) == 42
    assert [tuple(r) for r in sorted(warc.derivatives(responses, keep=("page_id",)).collect(), key=str)] == [tuple(r) for r in sorted(made, key=str)]


def test_conversion_text_and_other_types():
    def one(head, payload):
        record = {"record_id": "<urn:x>", "target_uri": None, "date": None, "headers": None, "payload_digest": None,
                  "block": head.encode() + b"\r\n\r\n" + payload}
        return {r[0]: r for r in warc.derive(record)}
    page = one("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1", "<title>T</title><p>caf\xe9<br>x<script>s</script><a href='/l'>l</a>".encode("latin-1"))
    assert page["conversion"][9].decode() == "café\nxl" and b"title: T\r\noutlink: /l\r\n" in page["metadata"][9]
    assert set(one("HTTP/1.1 404 Gone\r\nContent-Type: image/png", b"\x89")) == {"metadata"}
    plain = one("HTTP/1.1 200 OK\r\nContent-Type: text/plain", b"a <b>\n")
    assert plain["conversion"][9] == b"a <b>\n"
    assert set(warc.derive({"record_id": None, "target_uri": None, "date": None, "headers": None, "payload_digest": None, "block": None}).__next__()[:1]) == {"metadata"}


def test_reading_files(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>x"
    data = b"".join(warc.serialise([("WARC-Type", t), ("WARC-Record-ID", f"<urn:{t}>"), ("Content-Length", str(len(block)))], block) for t in ("request", "response"))
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(data))
    found = warc.read_responses(spark, str(tmp_path)).collect()
    assert len(found) == 2 and all(bytes(r.block) == block and r.record_id == "<urn:response>" for r in found)
    assert [r.warc_type for r in warc.derivatives(warc.read_responses(spark, str(tmp_path))).collect()].count("conversion") == 2
    with pytest.raises(ValueError):
        list(warc.split_records(data[:-30]))


@pytest.mark.parametrize("name", ["social-science", "search-results-study", "dialog-transcript", "widget-left", "shareholders", "formation", "header-image-story"])
def test_a_word_within_a_name_does_not_drop_a_section(name):
    assert text_of(f"<article><p>a</p><section class='{name}'><p>b</p></section><div id='{name}'><p>c</p></div></article>") == "a\nb\nc"


@pytest.mark.parametrize("name", ["related-posts", "share-buttons", "cookie-notice", "sidebar-left", "footer-links", "ad-container", "user-comments", "comment-list", "newsletter-box", "Menu"])
def test_names_of_what_is_not_the_article(name):
    assert text_of(f"<article><p>a</p><div class='x {name}'><p>b</p></div></article>") == "a"


def test_a_body_in_two_widgets_and_character_data():
    assert text_of("<article><div class='widget-left'><p>a</p></div><div class='widget-right'><p>b</p></div></article>") == "a\nb"
    assert text_of("x <![CDATA[y > z &amp; <b>]]> w") == "x y > z &amp; <b> w" and text_of("x <![CDATA[y") == "x y"


def test_a_section_template_of_a_large_host_goes(spark):
    """A notice on a twentieth of a host's pages is deleted as on a small host, and what differs stays."""
    note = "<div class=x><p>Dispatch of this section is delayed</p></div>"
    rows = [(i, f"http://big.example/{i}", f"<article><p>story {i}</p>{note if i % 20 == 0 else ''}<div><p>box of {i}</p></div></article>") for i in range(400)]
    df = spark.createDataFrame(rows, PAGE)
    found = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert found == {i: f"story {i}\nbox of {i}" for i in range(400)}
    kept = {r.page_id: r.text for r in pages.extract(df, min_pages=10 ** 6).collect()}  # templates off
    assert sum(kept[i] != found[i] for i in kept) == 20

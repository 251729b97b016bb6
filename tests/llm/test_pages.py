"""WARC round trips and main texts."""

import base64
import hashlib

import pytest

from folioloom.llm import html_extract, store, warc

LONG = "<p>é line\r\n\r\nWARC/1.1 </p>" * 3000
PAGES = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y\r\nInjected: 1", "<p>one</p>"), (3, None, None), (4, "http://b.example/", ""), (5, "u", LONG),
    (6, "u", LONG), (7, "u", "tail\r\n\r\n"), (8, "v", "0\r\n\r\n"), (8, "v", "0\r\n\r\n"), (None, "w", "null id"),
]


def test_warc(spark):
    path = store.fresh_path(spark, "test-warc")
    df = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id bigint, url string, html string, payload int").repartition(3)
    warc.write(df.cache(), path)
    got = warc.read(spark, path).collect()
    assert len(got) == len(PAGES) and all(r["verified"] for r in got)
    data = {p[0]: (p[2] or "").encode() for p in PAGES}
    for r in got:
        raw = data[r["page_id"]]
        assert r["payload_bytes"] == len(raw)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert r["payload"] == (raw if r["record_type"] == "response" else None)
    refers = {(r["page_id"], r["record_type"]): r["refers_to"] for r in got}
    assert refers[2, "revisit"] == 1 and refers[4, "revisit"] == 3 and refers[6, "revisit"] == 5
    assert refers[8, "response"] is None and refers[8, "revisit"] == 8
    assert (None, "response") in refers


def test_broken_archives():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc"))
    with pytest.raises(ValueError):
        warc.unchunk(b"5\r\nabc\r\n0\r\n\r\n")


SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><{main}><h1>Title &amp; more</h1>{paragraphs}<div class="ad">Buy</div><form><input name=q>Search</form></{end}>
<aside class="sidebar">Side</aside><section id="comments"><p>Reader says</p></section><footer>&copy; site</footer><script>var x = "</p>";</script></body></html>"""


def page(main, texts):
    return SITE.format(main=main, end=main.split()[0], paragraphs="".join(f"<p>{t}</p>" for t in texts))


def test_main_text(spark):
    rows = []
    for host, main in (("a", "article"), ("b", "main"), ("c", 'div class="post-content"'), ("d", "div")):
        for k in range(6):
            texts = [f"Text {host} {k} {j} with <b>some</b>\n  words &lt;here&gt;" for j in range(k + 2)]
            rows.append((f"http://{host}.example/{k}", page(main, texts), k, host, "Title & more\n" + "\n".join(t.replace("<b>some</b>\n  words &lt;here&gt;", "some words <here>") for t in texts)))
    df = spark.createDataFrame(rows, "url string, html string, page_id bigint, host string, want string")
    got = html_extract.extract(df.drop("host")).collect()
    assert [(r["url"], r["text"]) for r in got if r["text"] != r["want"]] == []
    assert all(r["n_chars"] == len(r["want"]) for r in got)


def test_odd_pages(spark):
    odd = ["", None, "plain text &amp; <b>more", "<p>a<p>b<li>c", "<article><p>in<p>side", "<!-- only -->", "<div hidden>no</div><div>yes</div>", "<p>x" * 3000]
    df = spark.createDataFrame([(k, None, h, "old") for k, h in enumerate(odd)], "page_id bigint, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got == {0: "", 1: "", 2: "plain text & more", 3: "a\nb\nc", 4: "in\nside", 5: "", 6: "yes", 7: "\n".join(["x"] * 3000)}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_wrappers_fold_and_align():
    w = html_extract.page_wrapper(html_extract.tree("<body><h2>a</h2><p>1</p><h2>b</h2><p>2</p><ul><li>x<li>y</ul></body>"))
    body = w[html_extract.KIDS][0]
    assert [(k[0], k[2]) for k in body[html_extract.KIDS]] == [("h2", True), ("p", True), ("ul", False)]
    other = html_extract.page_wrapper(html_extract.tree("<body><h2>a</h2><p>1</p><div>new</div><ul><li>x</ul></body>"))
    merged = html_extract.merge(w, other)[html_extract.KIDS][0]
    assert [(k[0], k[1]) for k in merged[html_extract.KIDS]] == [("h2", False), ("p", False), ("div", True), ("ul", False)]

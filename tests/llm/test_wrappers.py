"""Wrappers: any order of pages, any depth, broken attributes, hosts without telling names; and the corpus' own articles."""

import os
import random
import re
from html import unescape

import pytest

from folioloom.llm import html_extract as H


def slots_of(pages):
    out = {}
    for p in pages:
        H.add(out, H.page_slots(H.tree(p)))
    return out


def test_any_order_of_pages_gives_one_wrapper():
    rng = random.Random(3)
    parts = ["<p>{0}</p>", "<div><i>{0}</i></div>", "<ul><li>{0}<li>b</ul>", "<h2>{0}</h2><p>x</p>", "<div class=box>{0}</div>"]
    pages = ["<body>" + "".join(rng.choice(parts).format(rng.random()) for _ in range(rng.randint(1, 9))) + "</body>" for _ in range(12)]
    want = slots_of(pages)
    for _ in range(8):
        rng.shuffle(pages)
        got = slots_of(pages)
        assert got == want and H.main_region(got) == H.main_region(want)


@pytest.mark.parametrize("n", [5, 9, 40])
def test_long_runs_of_siblings_fold(n):
    run = "".join(f"<div class=k{chr(97 + k % 26)}{chr(97 + k // 26)}>t</div>" for k in range(n))
    body = H.page_wrapper(H.tree(f"<body>{run * 3}</body>"))[H.KIDS][0]
    assert len(body[H.KIDS]) == n and all(k[2] for k in body[H.KIDS])


def test_depth_has_no_bound(spark):
    deep = "<div>" * 20_000 + "core" + "</div>" * 20_000
    df = spark.createDataFrame([(1, "http://a/", deep), (2, "http://a/", deep.replace("core", "else")), (3, "http://b/", "<p>x" * 20_000)], "page_id int, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract(df).collect()}
    assert got[1] == "core" and got[2] == "else" and got[3].count("x") == 20_000


def test_quotes_that_are_not_closed():
    cases = {
        "<p title=it's>Hello</p><p>It's fine</p>": "Hello\nIt's fine", '<p class="a title="b">one</p><p>two</p>': "one\ntwo", "<p a='x>y'>in</p>": "in",
        "<p a=\"1>2\">in</p>": "in", '<p title="open>one</p><p>two</p>': "one\ntwo", "a < b <p>c": "a < b\nc", "<p": "", "<br/>x<hr/>y": "x\ny",
    }
    for html, want in cases.items():
        assert H.main_text(html, None) == want, html


def test_hosts_without_telling_names(spark):
    """No article element and no telling class: what varies is the text, what is the same on each page is the site's."""
    rng = random.Random(5)
    rows, want = [], {}
    for host in ("x", "y"):
        for k in range(9):
            body = [" ".join(rng.choices("abcdefgh", k=rng.randint(20, 60))) for _ in range(rng.randint(2, 6))]
            menu = "".join(f'<div><a href="/{j}">Page number {j} of the site</a></div>' for j in range(12))
            page = f"<body><div class=qa>{menu}</div><div class=qb><h2>Part</h2>{''.join(f'<p>{t}</p>' for t in body)}<section>Write to us at any time</section></div><div class=qc>All of {host}</div></body>"
            rows.append((k, f"http://{host}/", page))
            want[host, k] = "\n".join(["Part", *body])
    got = H.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    assert {(r["url"][7], r["page_id"]): r["text"] for r in got} == want


DATA = "/root/testdata/sf0.001/pages.parquet"


@pytest.mark.skipif(not os.path.exists(DATA), reason="tables aren't here")
def test_articles_of_the_corpus(spark):
    """Words of each article, read from its markup by a plain search: precision and recall of the extracted words."""
    pages = spark.read.parquet(DATA)
    got = {r["page_id"]: r["text"].split() for r in H.extract(pages).collect()}
    hit = extracted = wanted = 0
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want = unescape(re.sub(r"<[^>]*>", " ", article)).split()
        mine = got[r["page_id"]]
        extracted, wanted = extracted + len(mine), wanted + len(want)
        hit += len(want) if mine == want else len(set(mine) & set(want))
    assert hit >= 0.99 * extracted and hit >= 0.99 * wanted

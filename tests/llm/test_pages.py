"""Operators on pages against brute force, and edge cases."""

from __future__ import annotations

import hashlib
import html
import random
import re

import pytest
from check_queries import connect
from pyspark.sql import functions as F

from minegrain.llm import queries as q
from minegrain.llm.html_text import blocks_of, common_lines, main_text
from minegrain.llm.url_rules import RULES, judge_urls
from minegrain.llm.warc import END, MAGIC, page_records, read_warc, write_warc

FALSE_RECORD = MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello" + END
ODD_PAGES = [
    (1, "http://a.org/x", None),
    (2, None, ""),
    (3, "no scheme", "short"),
    (4, "http://A.Example.ORG/es/1?q#f", "y" * 150),
    (5, "http://b.com/fr/1\r\nX: y", "y" * 150),
    (6, "http://c.net/1", "z" * 50),
    (7, "http://c.net/2", "z" * 50),
    (8, "http://c.net/3", "before " + FALSE_RECORD + " after " * 20),
    (9, "http://c.net/4", FALSE_RECORD * 3),
    (None, "http://c.net/5", "y" * 150),
    (None, "http://c.net/5", "w" * 150),
    (4, "http://A.Example.ORG/es/1?q#f", "y" * 150),
    (10, "http://d.example.org/en/12", "é漢😀 \r\n\r\n" + MAGIC + " tail " * 30),
    (11, "http://d.example.org", MAGIC),
    (12, "http://d.example.org/en/2", "v" * 300_000),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_PAGES, "page_id long, url string, html string").selectExpr(
        "*", "1 as host", "2 as path", "3 as id", "4 as digest", "5 as key", "6 as text"
    )


@pytest.fixture(scope="module")
def pages(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").cache()


# --- WARC


def brute_records(rows):
    low = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            low[b] = min(low.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        keep = low.get(b) if sum((x[2] or "").encode() == b for x in rows) > 1 else None
        revisit = keep is not None and keep != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("compression,split", [("gzip", "128m"), ("none", "128m"), ("none", "700b")])
def test_archives_round_trip(spark, odd, tmp_path, compression, split):
    path = str(tmp_path / "a")
    write_warc(odd.coalesce(2), path, compression=compression)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = page_records(read_warc(spark, path)).collect()
        whole = read_warc(spark, path, payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert sorted(map(tuple, got), key=str) == brute_records(ODD_PAGES)
    payloads = sorted(bytes(r.payload) for r in whole if "WARC-Type: response" in r["head"])
    want = [r for r in brute_records(ODD_PAGES) if r[3] == "response"]
    assert sorted(hashlib.sha256(p).hexdigest() for p in payloads) == sorted(r[2] for r in want)


def test_all_pages_come_back(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    write_warc(pages, path)
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, page_records(read_warc(spark, path)).collect()), key=str) == brute_records(rows)


def test_archive_sql(spark, sf):
    got = q.QUERIES["op1_warc"](spark, sf).collect()
    want = connect(sf).execute(q.SQL["op1_warc"]).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_archive(spark, odd, tmp_path):
    write_warc(odd.filter("false"), str(tmp_path / "a"))
    assert read_warc(spark, str(tmp_path / "a")).count() == 0


def test_binary_payloads_and_foreign_headers(spark, tmp_path):
    body = bytes(range(256)) * 3
    head = b"WARC/1.0\r\ncontent-length:  %d\r\nWARC-Type: resource\r\n\r\n" % len(body)
    (tmp_path / "x.warc").write_bytes((head + body + b"\r\n\r\n") * 2)
    got = read_warc(spark, str(tmp_path), payload=True).collect()
    assert [bytes(r.payload) for r in got] == [body] * 2
    assert {r.payload_digest for r in got} == {hashlib.sha256(body).hexdigest()}


# --- URL rules


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, say in RULES:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, say))
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules(spark, pages, odd):
    labels = spark.createDataFrame([(1, 0, 1), (1, None, None), (None, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    for df in (pages, odd):
        for lab in (labels, labels.filter("false")):
            got = judge_urls(df, lab).collect()
            urls = {}
            for i, u in df.select("page_id", "url").collect():
                urls.setdefault(i, set()).add(brute_rule(u))
            assert len(got) == df.count()
            for r in got:
                assert any((r.host, r.path, r.rule) == w[:3] and (w[3] is None or r.verdict == w[3]) for w in urls[r.page_id])
                assert r.verdict in ("allow", "block")
    assert judge_urls(odd.filter("false"), labels).count() == 0


def test_template_tree_parts_bad_branches(spark):
    rows, labels = [], []
    for i in range(400):
        branch = ("news", "shop", "spam")[i % 3]
        rows.append((i, f"http://h.info/{branch}/{i}/item-{i}.html"))
        labels.append((i, 0 if branch == "spam" else 1, 0))
    rows += [(1000, "http://h.info/spam/9/item-77.html"), (1001, "http://h.info/news/9/item-77.html"), (1002, "http://h.info/")]
    got = judge_urls(
        spark.createDataFrame(rows, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ).collect()
    by = {r.page_id: r for r in got}
    assert by[1000].verdict == "block" and by[1001].verdict == "allow" and by[1002].template == "/"
    assert "spam" in by[1000].template and by[0].template == by[3].template
    assert all(r.verdict == ("block" if r.page_id % 3 == 2 else "allow") for r in got if r.page_id < 400)


def test_many_children_become_a_wildcard(spark):
    rows = [(i, f"http://h.info/{chr(97 + i % 26)}{chr(97 + i // 26)}/x") for i in range(200)]
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), labels)
    assert {r.template for r in got.collect()} == {"/*/*"}


@pytest.mark.parametrize("clean", [23, 24])
def test_bad_branch_among_any_number_of_siblings(spark, clean):
    names = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(clean)] + ["spam"]
    rows = [(i, f"http://h.info/{name}/x{i}") for i, name in enumerate(n for n in names for _ in range(40))]
    labels = [(i, 0 if "/spam/" in u else 1, 0) for i, u in rows if i % 2]
    got = judge_urls(
        spark.createDataFrame(rows, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ).collect()
    assert all((r.verdict == "block") == r.path.startswith("/spam/") for r in got) and len(got) == len(rows)
    assert all(r.template.startswith("/spam/") == r.path.startswith("/spam/") for r in got)


# --- main text


def test_articles_of_all_pages(pages):
    got = {r.page_id: r for r in main_text(pages).collect()}
    for r in pages.collect():
        body = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = [html.unescape(re.sub(r"<[a-z/][^>]*>", " ", p)) for p in re.split(r"</?(?:p|h1)>", body)]
        want = "\n\n".join(p for p in (re.sub(r"\s+", " ", p).strip() for p in parts) if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def test_markup():
    page = """<html><head><title>T</title></head><body class="has-sidebar"><header>Top</header><div id="cookie-notice">We use
    cookies</div><main><header><h1>Head &amp; &#8364;</h1></header><p>One <b>two</b>
    three<!-- no --><p>a < b</p><aside>side</aside><form><p>mail</p></form><ul><li>x<li>y</ul>
    <script>var a = "<p>no</p>";</script><section class="comments"><p>first!</p></section></main>
    <div role="contentinfo">foot</div></body></html>"""
    assert [t for t, k in blocks_of(page) if k == 2] == ["Head & €", "One two three", "a < b", "x", "y"]
    assert [t for t, k in blocks_of("<p>open <i>text") if k] == ["open text"]
    assert blocks_of(None) == [] and blocks_of("") == [] and blocks_of("<div></div>") == []
    assert blocks_of("<article><p>left open")[0] == ("left open", 2)


def test_names_of_containers():
    body = "<p>The long story of the day</p><p>and how it ends.</p>"
    side = "<p>Home</p>"
    for name in ("content with-sidebar", "has-sidebar", "no-ads", "layout-menu-left", "post share-enabled"):
        for page in (f'<div class="{name}">{body}</div>', f'<div class="{name}">{side}</div><div>{body * 3}</div>'):
            assert all(k for _, k in blocks_of(page)), name
    for name in ("sidebar", "main-sidebar", "sidebar-left", "ad", "ad-container", "related-posts", "nav_menu", "cookie-notice"):
        assert [t for t, k in blocks_of(f'<div class="x {name}">{side}</div>{body}') if k][0] != "Home", name
        assert [k for _, k in blocks_of(f'<div id="{name}">{body}</div>{side}')] == [1, 1, 1], name
    assert [k for _, k in blocks_of(f"<main>{side}</main><div class=comments>{body}</div>")] == [2, 0, 0]


def lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_common_lines():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        at = common_lines(a, b)
        rest = iter(b)
        assert at == sorted(set(at)) and all(any(a[i] == y for y in rest) for i in at) and len(at) == lcs(a, b)


def test_differencing_removes_shared_lines(spark):
    page = "<body><div>Site name</div><div>Story {0} begins</div><p>and goes on {0}.</p><div>All rights reserved</div></body>"
    rows = [(i, f"http://h.info/a/{i}", page.format(i)) for i in range(8)]
    rows += [(20, "http://alone.info/x", page.format(20)), (None, None, None), (21, None, "<p>free text</p>")]
    rows += [(22, "http://h.info/b/zz", "<article><p>All rights reserved</p></article>"), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("lines", F.lit(2))
    got = sorted(((r.page_id, r.text) for r in main_text(df).collect()), key=str)
    want = [(i, f"Story {i} begins\n\nand goes on {i}.") for i in range(1, 8)]
    assert [g for g in got if g[0] in range(1, 8)] == want
    assert [t for i, t in got if i == 0][0] == [t for i, t in got if i == 0][1]
    by = dict(got)
    assert by[20].startswith("Site name\n\n") and by[None] == "" and by[21] == "free text" and by[22] == "All rights reserved"
    assert main_text(df.filter("false")).count() == 0

from urllib.parse import urldefrag, urljoin

import duckdb

from fairtally.llm.oracles import ORACLES
from fairtally.llm.queries import URL_RULES
from fairtally.llm.urls import filter_urls, page_links

SCHEMA = "page_id bigint, url string, html string, host string, node string, rule string"


def run(spark, rows, **more):
    pages = spark.createDataFrame([(*r, "h", "n", "r") for r in rows], SCHEMA)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, URL_RULES, **more).collect()}


def test_rules_and_parts(spark):
    found = run(
        spark,
        [
            (1, "http://WWW.Example.com/en/x?q#f", None),
            (2, "https://a.example.com/en/", ""),
            (3, "https://example.com/fr", None),
            (4, "http://b.net/es/1", None),
            (5, "http://b.net?x/es/", None),
            (6, None, None),
            (7, "no scheme", None),
            (8, "http://notexample.com/en/", None),
            (9, "http://xnet/es/", None),
            (10, "", None),
        ],
    )
    assert found[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[2] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert found[3] == ("example.com", "/fr", "com/", "allow")
    assert found[4] == ("b.net", "/es/1", "net/es/", "block")
    assert found[5] == ("b.net", "", None, "allow")
    assert found[6] == found[7] == found[10] == ("", "", None, "allow")
    assert found[8] == ("notexample.com", "/en/", "com/", "allow")
    assert found[9] == ("xnet", "/es/", None, "allow")


def test_block_reaches_aliases_but_not_explicit_allow(spark):
    link = '<html><head><LINK href="{}" rel="canonical"></head>'
    found = run(
        spark,
        [
            (1, "http://a.org/1#top", link.format("http://b.org/1")),
            (2, "http://b.org/1", '<meta http-equiv="refresh" content="0; url=https://c.net/es/7">'),
            (3, "http://ok.com/1", link.format("http://b.org/1")),
            (4, "http://d.org/1", link.format("/2")),
            (5, "http://d.org/2", link.format("relative")),
            (6, "http://e.org/1", "nothing"),
            (6, "http://e.org/1", "nothing"),
        ],
        redirects=spark.createDataFrame([("http://e.org/1", "http://d.org/2"), (None, "x")], "a string, b string"),
    )
    assert [found[i][3] for i in (1, 2, 3, 4, 5, 6)] == ["block", "block", "allow", "allow", "allow", "allow"]


def test_no_pages(spark):
    assert run(spark, []) == {}


TARGETS = [
    "page.html", "?id=1", "../a", "../../../a/b", "./c", "d/./e/../f", "..", ".", "/x/../y/.", "//h.org/z/w",
    "https://s.org/p/q?r=/../s", "x?y=../z", "&amp;t", "?a=1&amp;b=2", "../es/r.html", "http://c.net/es/7",
]
BASES = ["http://h.org", "http://h.org/", "http://h.org/one", "http://h.org/one/two/three?q=/a/b#f", "https://h.org/one/two/"]


def test_relative_targets_equal_the_standard_library(spark):
    rows, want = [], set()
    for base in BASES:
        for own in (None, "/other/place", "sub/", "http://b.org/deep/er"):
            head = "" if own is None else f"<base target=x href='{own}'>"
            for t in TARGETS:
                rows.append((len(rows), base, f'{head}<link data-href="no" rel="alternate canonical" href="{t}">'))
                plain = t.replace("&amp;", "&")
                target = urldefrag(urljoin(urljoin(base, own or ""), plain))[0]
                want.add((urldefrag(base)[0], target))
    rows += [(900 + i, "http://h.org/m", f"<link rel=canonical href={t}>") for i, t in enumerate(["mailto:a@b", "#top", "javascript:x"])]
    rows += [(910, "http://h.org/m", "<link rel='not-canonical' href=q>"), (911, "plain", "<link rel=canonical href=q>"), (912, None, rows[0][2])]
    # The library keeps dots behind a host or another scheme, and takes an empty segment for none.
    rows += [(920, "http://h.org/m", "<link rel=canonical href=https://s.org/p/../q?r=/../s>"), (921, "http://h.org/m", "<link rel=canonical href=a//../b>")]
    rows += [(922, "http://h.org/m", "<link rel=canonical href=//h.org/z/..>")]
    want |= {("http://h.org/m", "http://h.org/"), ("http://h.org/m", "https://s.org/q?r=/../s"), ("http://h.org/m", "http://h.org/a/b")}
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {tuple(r) for r in page_links(pages).collect()} == want


def test_links_equal_sql(spark):
    link = '<link rel="canonical" href="{}">'.format
    refresh = '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [
        (1, "http://b.net/fr2/a", link("../es/r.html")),
        (2, "http://b.net/k", "<base href='/es/'>" + refresh("k2")),
        (3, "http://b.net/de/1", "<link rel='alternate canonical' href=1b>"),
        (4, "http://b.net/de/1b", refresh("./../fr/x")),
        (5, "http://b.net/de/2", link("?id=1")),
        (6, "http://b.net/de/2?id=1", "x"),
        (7, "http://ok.com/1", link("http://b.net/es/")),
        (8, None, link("http://b.net/es/")),
        (9, "plain", link("es/1")),
        (10, "http://b.net/de/3", link("mailto:x@b.net/es/")),
        (11, "http://b.net/de/4", "<link rel=canonical-not href=/es/1><link REL=Canonical href=/de/5/>"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted(tuple(r)[:5] for r in filter_urls(pages, URL_RULES).collect())
    with duckdb.connect() as db:
        db.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
        db.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
        assert sorted(db.execute(ORACLES["op2_url_filters"]).fetchall()) == got
    assert [r[0] for r in got if r[4] == "block"] == [1, 2, 3, 4]

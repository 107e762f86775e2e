import random

import numpy as np
import pytest

from fairtally.llm import extract
from frames import words

SCHEMA = "page_id bigint, url string, html string, text string, host string, row_id bigint, plain string"


def run(spark, rows, **more):
    pages = spark.createDataFrame([(*r, "t", "h", 1, "p") for r in rows], SCHEMA)
    return sorted(map(tuple, extract.extract_text(pages, **more).collect()), key=repr)


def text(source):
    page = extract.parse_page(source)
    return page.article if page.has_article else page.plain


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        ("<article><h1>A &amp; B</h1><p>x\n <b>y</b>&nbsp;z<br>w<p>next</article><footer>f</footer>", ["A & B", "x y z w", "next"]),
        ("<main><nav>n</nav><p>a<div class='comment-list'>c</div><aside>s</aside>b</main>", ["a", "b"]),
        ("<article><p>a</p><form><p>f</p></form><script>var x='</p><p>no'</script><style>p{}</style><p>b</article>", ["a", "b"]),
        ("<article><p title='a > b'>a</p><!-- <p>no</p> --><div id=\"cookie-notice\"><p>no</p></div></article>", ["a"]),
        ("<article><header><h1>Title</h1></header><ul><li>1<li>2</ul><table><tr><td>c</table></article><p>out", ["Title", "1", "2", "c"]),
        ("<article><p>&lt;b&gt; &#233;&#x4e2d; &unknown;</p></article>", ["<b> é中 &unknown;"]),
        ("<p>plain<div class=ad>ad</div><p hidden>h</p><p>two", ["plain", "two"]),
        ("<article>open <p>never closed <b>bold", ["open", "never closed bold"]),
        ("no markup < 3 at all", ["no markup < 3 at all"]),
        ("<head><title>t</title><body><article><p>b</article>", ["b"]),
        ("<article><p>a<!-- open comment <p>b", ["a"]),
        ("", []),
    ],
)
def test_blocks(source, blocks):
    assert text(source) == blocks


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        ("<article><p>one <script>x</script> two", ["one two"]),
        ("<article><p>one <button class='share'><div>x</div></button> two <svg><g><text>no</text></g></svg>three</p>four", ["one two three", "four"]),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", ["so x=1 holds"]),
        ("<article><p>one <span class='ad'>buy</span> two <a class='share'><div>s</div></a>three</p><p>four", ["one two three", "four"]),
        ("<article><p>one <select><option>a<option>b</p><p>two", ["one", "two"]),
        ("<article><p>one <span class='ad'>never closed</p><p>two", ["one", "two"]),
        ("<article><p>last <span class='ad'>ad", ["last"]),
        ("<article><p>a</article><article class='comment'><p>c</article><article class='teaser related'><p>t</article>", ["a"]),
        ("<article class='comment'><p>first</article><article id=main-story><p>a</article>", ["a"]),
        ("<article class='teaser'><p>the only one</article><p>out", ["the only one"]),
        ("<main><article class='related-item'><p>all there is</article></main>", ["all there is"]),
        ("<article><p>a</p><div class='user-comment'>c</div><div id='ad-slot-1'>x</div><div class='sponsored-content'>s</div></article>", ["a"]),
        ("<article><p>a</p><div class='cookie-notice-text'>c</div><div class='main-content'>b</div><div class='text-1'>d</div></article>", ["a", "b", "d"]),
    ],
)
def test_blocks_end_at_blocks_only_and_other_articles_go(source, blocks):
    assert text(source) == blocks


def brute_repeated(streams, width):
    seen = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - width + 1):
            seen.setdefault(tuple(s[i : i + width]), set()).add(p)
    return [[len(seen[tuple(s[i : i + width])]) > 1 if i + width <= len(s) else False for i in range(len(s))] for s in streams]


@pytest.mark.parametrize("width", [1, 3, 5, 8])
def test_suffix_array_equals_brute_force(width):
    rng = random.Random(width)
    streams = [[rng.randrange(3) for _ in range(rng.randint(0, 40))] for _ in range(12)]
    tokens, pages = [], []
    for p, s in enumerate(streams):
        tokens += [*s, -p - 1]
        pages += [p] * (len(s) + 1)
    found = extract.repeated_windows(np.array(tokens), np.array(pages), width).tolist()
    want = [x for s in brute_repeated(streams, width) for x in [*s, False]]
    assert found == want


@pytest.mark.parametrize("shard", [{"shard_pages": 3}, {"shard_tokens": 60}, {}])
def test_boilerplate_of_a_host_goes_whatever_the_shards(spark, shard):
    rng = random.Random(1)
    notice = " ".join(words(rng, 12))
    own = [" ".join(words(rng, 15)) for _ in range(10)]
    rows = [(i, f"http://H.org/{i}", f"<p>{own[i]}</p><p>{notice}</p><p>n{i} only</p>") for i in range(10)]
    rows += [(50, "http://other.org/", f"<p>{notice}</p>"), (51, "http://h.org/a", f"<article><p>{own[0]}</p></article><p>{own[1]}")]
    got = {r[0]: r[2] for r in run(spark, rows, **shard)}
    for i in range(10):
        assert got[i] == (f"n{i} only" if i == 1 else f"{own[i]}\nn{i} only")
    assert got[50] == notice
    assert got[51] == own[0]


def test_odd_rows(spark):
    long = "<article>" + "".join(f"<p>{w}</p>" for w in words(random.Random(2), 20_000)) + "</article>"
    rows = [(1, None, None), (2, "u", ""), (None, "http://a/b", "<article><p>é"), (3, "http://a/c", long)]
    rows += [(4, "http://a/d", "<p>same words here")] * 2
    got = run(spark, rows)
    assert len(got) == 6
    by = {r[0]: r for r in got}
    assert by[1] == (1, None, "", 0) and by[2] == (2, "u", "", 0) and by[None][2:] == ("é", 1)
    assert by[3][2].count("\n") == 19_999 and by[3][3] == len(by[3][2])
    assert by[4][2] == "same words here"
    assert run(spark, []) == []


@pytest.mark.parametrize(
    ("source", "blocks"),
    [
        ("<article class='post has-sidebar'><p>a</article>", ["a"]),
        ("<main class='no-sidebar'><p>a</main>", ["a"]),
        ("<article class='widget'><div class='entry-header'><h1>t</h1></div><div class='sidebar left'>s</div><p>a</article>", ["t", "a"]),
        ("<div id='content' class='share-enabled'><p>a</div><div class='site-footer'>f</div>", ["a"]),
    ],
)
def test_names_set_aside_as_whole_tokens(source, blocks):
    assert text(source) == blocks


def test_unmarked_blocks_beside_articles_stay_if_unique(spark):
    rng = random.Random(3)
    body, notice = " ".join(words(rng, 30)), " ".join(words(rng, 12))
    outer = f"<div>{notice}</div><div>Share this</div>"
    rows = [(i, f"http://h.org/{i}", f"<article><p>a{i}</article>{outer}") for i in range(3)]
    rows.append((9, "http://h.org/9", f"<article></article><div><p>{body}</p></div>{outer}"))
    rows.append((8, "http://h.org/8", f"<div>before it</div><article>card</article><p>{body[::-1]}</p>{outer}"))
    got = {r[0]: r[2] for r in run(spark, rows)}
    assert got == {0: "a0", 1: "a1", 2: "a2", 9: body, 8: f"before it\ncard\n{body[::-1]}"}


def test_copies_and_quotations_stay(spark):
    rng = random.Random(4)
    page, other, quote = (" ".join(words(rng, n)) for n in (40, 40, 9))
    rows = [(i, "http://h.org/1", f"<p>{page}") for i in range(3)] + [(3, "http://h.org/2", f"<p>{page}")]
    rows += [(4, "http://q.org/1", f"<p>{page} {quote}"), (5, "http://q.org/2", f"<p>{other} {quote}")]
    got = {r[0]: r[2] for r in run(spark, rows)}
    assert [got[i] for i in range(4)] == [page] * 4
    assert got[4] == f"{page} {quote}" and got[5] == f"{other} {quote}"

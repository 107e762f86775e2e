"""Main text of web pages: the article's blocks, and what is unique to a page where none is marked.

Text outside of an article is compared with all other pages of its host: a suffix array over the
token streams finds long substrings that distinct pages share, and these are boilerplate.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import slices, stored, with_computed
from fairtally.llm.urls import url_parts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_RUN = 8
#: Tokens of a run that only one other page shares, before it counts as boilerplate and no quotation.
QUOTE_RUN = 15
SHARD_PAGES = 2_000
SHARD_TOKENS = 500_000
PART_BYTES = 4 << 20

#: Elements whose content is never text of the page.
SILENT = frozenset("script style noscript template svg iframe object head title select option textarea button canvas audio video datalist".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
#: Elements that hold something other than the article.
ASIDE = frozenset("nav footer aside form menu dialog".split())
#: Words in class, id or role that say the same of a container.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "form header menu modal nav navbar navigation newsletter notice notices popup promo promoted related replies search share "
    "sharing sidebar social sponsor sponsored subscribe toolbar widget contentinfo complementary dialog alert".split()
)
#: What may stand beside them in a name, as numbers may: comment-list and ad-slot-1, but not entry-header or has-sidebar.
BESIDE_WORDS = frozenset(
    "list box bar banner wrap wrapper container block area section inner outer item items link links left right top bottom "
    "site slot unit user reader content text body".split()
)
#: Words that say of an article element beside another one that it is not the page's article.
OTHER_ARTICLES = frozenset("ad ads advert advertisement comment comments promo promoted related replies reply sponsored teaser teasers".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br math".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(["article", "main"])
#: Elements that end an open paragraph, as HTML leaves out its end tag.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

MARK = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
NAMES = re.compile(r"(?i)(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HIDDEN = re.compile(r"(?i)(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)")


@dataclass
class Page:
    article: list[str] = field(default_factory=list)  # blocks of the article
    plain: list[str] = field(default_factory=list)  # blocks in no marked region
    spots: list[int] = field(default_factory=list)  # of each of these, the article's blocks before it
    aside: list[str] = field(default_factory=list)  # blocks of menus, footers and the like
    has_article: bool = False
    others: bool = False  # whether an article element is named as a comment, teaser or advert


def _names(attributes: str) -> Iterator[set[str]]:
    """The words of each name in class, id and role."""
    for found in NAMES.finditer(attributes):
        for token in (found[1] or found[2] or found[3] or "").lower().split():
            yield {w for w in re.split(r"[^a-z0-9]+", token) if w and not w.isdigit()}


def _other_article(attributes: str) -> bool:
    return any(w & OTHER_ARTICLES and w <= OTHER_ARTICLES | BESIDE_WORDS for w in _names(attributes))


def _set_aside(name: str, attributes: str, in_main: bool) -> bool:
    if name in ASIDE or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body"):
        return False
    if HIDDEN.search(attributes):
        return True
    if name in MAIN:
        return False
    for words in _names(attributes):
        says = words & ASIDE_WORDS
        if says and words <= ASIDE_WORDS | BESIDE_WORDS and not (in_main and says == {"header"}):
            return True
    return False


def parse_page(source: str | None) -> Page:
    """Blocks of a page by region; a block is what stands between two block-level tags.

    Article elements named as comments, teasers or adverts are set aside, unless no other holds text.
    """
    page = _parse_page(source, True)
    return page if page.article or not page.others else _parse_page(source, False)


def _parse_page(source: str | None, others_aside: bool) -> Page:
    page, text, beside = Page(), [], []
    if not source:
        return page
    # Open elements as (name, silent, aside, main, formula): what holds for an element holds inside it.
    open_: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
    place = 0

    def taken(parts: list[str]) -> str:
        block = " ".join("".join(parts).split())
        parts.clear()
        return block

    def end_aside() -> None:
        if beside and (block := taken(beside)):
            page.aside.append(block)

    def end_block() -> None:
        # Inside of what is set aside only that text ends: an advert within a line does not end the line.
        end_aside()
        _, silent, aside, main, _ = open_[-1]
        if text and not (silent or aside) and (block := taken(text)):
            if not main:
                page.spots.append(len(page.article))
            (page.article if main else page.plain).append(block)

    def close(name: str) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i][0] == name:
                # Up to the outermost block that ends here, if it is of the text.
                ended = next((k for k in range(i, len(open_)) if open_[k][0] not in INLINE and not (open_[k][1] or open_[k][4])), None)
                if open_[-1][2] and not open_[i - 1][2]:
                    end_aside()
                if ended is not None:
                    del open_[ended + 1 :]
                    end_block()
                del open_[i:]
                return

    def put(part: str) -> None:
        _, silent, aside, *_ = open_[-1]
        if not silent:
            (beside if aside else text).append(part)

    for mark in MARK.finditer(source):
        if mark.start() < place:  # inside a script or the like
            continue
        if mark.start() > place and not open_[-1][1]:
            put(html.unescape(source[place : mark.start()]))
        place = mark.end()
        name = (mark[2] or mark[5] or "").lower()
        if not name:
            if mark[0].startswith("<![CDATA["):
                put(mark[0][9:-3])
            continue
        if mark[1] or mark[4]:
            if name == "p" and all(o[0] != "p" for o in open_):
                end_block()  # an end tag alone is an empty paragraph
            close(name)
            continue
        if name == "br":
            put(" ")
        inside = open_[-1][1] or open_[-1][4]  # of what is silent, or of a formula: no block ends there
        if name in ENDS_P and not inside:
            # An open p, with what it holds, ends here if no other block stands between.
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] == "p":
                    end_block()
                    del open_[i:]
                    break
                if open_[i][0] not in INLINE or (open_[i][2] and not open_[i - 1][2]):
                    break
        if name not in INLINE and name not in SILENT and not inside:
            end_block()
        if name in VOID:
            continue
        if name == "body" and any(o[1] for o in open_):  # a head without its end tag
            del open_[1:]
        _, silent, aside, main, formula = open_[-1]
        attributes = mark[3] or mark[6] or ""
        aside_now = aside or _set_aside(name, attributes, main)
        if name == "article" and not aside_now and _other_article(attributes):
            page.others, aside_now = True, others_aside
        if name in MAIN and not aside_now and not silent:
            main = page.has_article = True
        if attributes.rstrip().endswith("/") and name not in INLINE and name not in RAW and name in ("svg", "math"):
            continue
        open_.append((name, silent or name in SILENT, aside_now, main, formula or name == "math"))
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, place)
            place = end.end() if end else len(source)
            open_.pop()
    if place < len(source):
        put(html.unescape(source[place:]))
    close_at = next((k for k, o in enumerate(open_) if k and (o[1] or o[2])), len(open_))
    end_aside()
    del open_[close_at:]
    end_block()
    return page


PARSED = (
    "same bigint, page_id bigint, url string, host string, has_article boolean, article array<string>, "
    "plain array<string>, spots array<int>, aside array<string>, outer bigint"
)


def _same(page: Page) -> int:
    """A number that pages with equal blocks share."""
    parts = (page.article, page.plain, page.aside)
    return xxhash.xxh3_64_intdigest("\2".join("\1".join(p) for p in parts).encode("utf-8", "surrogatepass")) - 2**63


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html", PART_BYTES):
            pages = [parse_page(v.as_py()) for v in part.column("html")]
            yield pa.record_batch(
                {
                    "same": pa.array([_same(p) for p in pages], pa.int64()),
                    "page_id": part.column("page_id"),
                    "url": part.column("url"),
                    "host": part.column("host"),
                    "has_article": pa.array([p.has_article for p in pages], pa.bool_()),
                    "article": pa.array([p.article for p in pages], pa.list_(pa.string())),
                    "plain": pa.array([p.plain for p in pages], pa.list_(pa.string())),
                    "spots": pa.array([p.spots for p in pages], pa.list_(pa.int32())),
                    "aside": pa.array([p.aside for p in pages], pa.list_(pa.string())),
                    "outer": pa.array([sum(b.count(" ") + 2 for b in p.plain + p.aside) for p in pages], pa.int64()),
                }
            )


def window_ranks(tokens: np.ndarray, width: int) -> np.ndarray:
    """Rank of the ``width`` tokens from each position on, by prefix doubling.

    Sorting positions by it gives the suffix array as far as that many tokens tell suffixes apart.
    """
    _, rank = np.unique(tokens, return_inverse=True)
    done = 1
    while done < width:
        step = min(done, width - done)
        later = np.full(len(rank), -1, np.int64)
        later[: len(rank) - step] = rank[step:]
        _, rank = np.unique(rank.astype(np.int64) * (len(rank) + 1) + later + 1, return_inverse=True)
        done += step
    return rank


def page_counts(tokens: np.ndarray, pages: np.ndarray, width: int) -> np.ndarray:
    """In how many pages the window from each position occurs."""
    if not len(tokens):
        return np.zeros(0, np.int64)
    rank = window_ranks(tokens, width)
    order = np.argsort(rank, kind="stable")  # the suffix array; equal windows are neighbours in page order
    sorted_rank, sorted_page = rank[order], pages[order]
    new = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
    other = np.concatenate([[True], sorted_page[1:] != sorted_page[:-1]]) | new
    starts = np.flatnonzero(new)
    found = np.zeros(len(tokens), np.int64)
    found[order] = np.repeat(np.add.reduceat(other.astype(np.int64), starts), np.diff(np.append(starts, len(order))))
    return found


def repeated_windows(tokens: np.ndarray, pages: np.ndarray, width: int) -> np.ndarray:
    """Whether the window from each position occurs in another page too."""
    return page_counts(tokens, pages, width) > 1


def cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Positions inside a window that begins at one of ``starts``."""
    edge = np.zeros(n + width + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge)[:n] > 0


def boilerplate(starts: np.ndarray, counts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Positions in windows of three pages or more, or in a run of QUOTE_RUN tokens that two pages share."""
    starts, at = np.unique(starts, return_index=True)
    often = counts[at] > 2
    gone = cover(starts[often], width, n)
    runs = np.split(starts, np.flatnonzero(np.diff(starts) != 1) + 1)
    long = [r for r in runs if len(r) + width - 1 >= QUOTE_RUN]
    return gone | cover(np.concatenate(long), width, n) if long else gone


SHARED = "same bigint, host string, at int, mark bigint, n int"


def _host_suffixes(width: int):
    """Of one shard of a host: the windows of its pages' outer text, as rows to add up over shards.

    A window's first row counts its pages in the shard. Windows of blocks in no marked region also come
    with their place, for that page's own decision; so do, by a negative place, whole blocks that are
    shorter than a window beside an article.
    """

    def run(shard: pa.Table) -> pa.Table:
        numbers: dict[str, int] = {}
        stream, owner, hashes = [], [], []
        places: list[tuple[int, int]] = []  # page row and token number of each position
        for i, (plain, aside) in enumerate(zip(shard.column("plain").to_pylist(), shard.column("aside").to_pylist())):
            words = [w for block in plain for w in block.split()]
            for part, offset in ((words, 0), *(((b.split(), None)) for b in aside)):
                for k, w in enumerate(part):
                    stream.append(numbers.setdefault(w, len(numbers)))
                    hashes.append(w)
                    places.append((i, k if offset == 0 else -1))
                owner += [i] * len(part)
                stream.append(-len(stream) - 1)  # a number of its own parts streams
                hashes.append("")
                places.append((i, -1))
                owner.append(i)
        tokens, pages = np.array(stream, np.int64), np.array(owner, np.int64)
        within = page_counts(tokens, pages, width)
        # Windows that hold a separator are none.
        ends = np.cumsum(np.concatenate([[0], tokens < 0]))
        whole = np.zeros(len(tokens), bool)
        if len(tokens) >= width:
            whole[: len(tokens) - width + 1] = ends[width:] == ends[: len(tokens) - width + 1]
        told: set[int] = set()
        rows: dict[str, list] = {"same": [], "at": [], "mark": [], "n": []}
        ids = shard.column("same").to_pylist()
        has_article = shard.column("has_article").to_pylist()
        for p in np.flatnonzero(whole).tolist():
            mark = xxhash.xxh3_64_intdigest("\0".join(hashes[p : p + width])) - 2**63
            i, k = places[p]
            if k < 0 and mark in told:
                continue
            rows["same"].append(ids[i] if k >= 0 else None)
            rows["at"].append(k if k >= 0 else None)
            rows["mark"].append(mark)
            rows["n"].append(int(within[p]) if mark not in told else 0)
            told.add(mark)
        for i, (plain, aside) in enumerate(zip(shard.column("plain").to_pylist(), shard.column("aside").to_pylist())):
            once: set[int] = set()
            for k, block in enumerate([*plain, *aside]):
                if len(block.split()) < width:
                    mark = xxhash.xxh3_64_intdigest("\0\0" + block) - 2**63
                    own = has_article[i] and k < len(plain)
                    rows["same"].append(ids[i] if own else None)
                    rows["at"].append(-k - 1 if own else None)
                    rows["mark"].append(mark)
                    rows["n"].append(0 if mark in once else 1)
                    once.add(mark)
        host = shard.column("host")[0].as_py()
        return pa.table(
            {
                "same": pa.array(rows["same"], pa.int64()),
                "host": pa.array([host] * len(rows["mark"]), pa.string()),
                "at": pa.array(rows["at"], pa.int32()),
                "mark": pa.array(rows["mark"], pa.int64()),
                "n": pa.array(rows["n"], pa.int32()),
            }
        )

    return run


def _texts(width: int):
    """The article's blocks and, in their places, the blocks in no marked region without boilerplate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("article", "plain", "spots", "starts"))
            for article, blocks, spots, found in zip(*columns):
                words = [b.split() for b in blocks]
                n = sum(map(len, words))
                starts = np.array([(f["at"], f["n"]) for f in found or []], np.int64).reshape(-1, 2)
                short, starts = starts[starts[:, 0] < 0], starts[starts[:, 0] >= 0]
                gone = boilerplate(starts[:, 0], starts[:, 1], width, n)
                repeated = set((-short[:, 0] - 1).tolist())
                kept, at, before = [], 0, 0
                for k, (w, spot) in enumerate(zip(words, spots)):
                    left = " ".join(t for t, g in zip(w, gone[at : at + len(w)]) if not g)
                    at += len(w)
                    kept += article[before:spot]
                    before = spot
                    if left and k not in repeated:
                        kept.append(left)
                texts.append("\n".join(kept + article[before:]))
            yield pa.record_batch(
                {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string())}
            )

    return run


def extract_text(pages: DataFrame, min_run: int = MIN_RUN, shard_pages: int = SHARD_PAGES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    The text is the blocks of ``article`` or ``main`` elements without the menus, notices, adverts,
    forms, comments and the like in them, joined by line ends; nothing in an article is dropped for
    being repeated. Blocks outside of articles and of menus and the like stay in their places, less
    the runs of ``min_run`` or more tokens that two other pages of the host have outside of their
    articles too, or QUOTE_RUN or more that one other has; beside an article, shorter blocks go if
    another page has them. Hosts of any size are cut into shards by pages and tokens; windows are then added up over
    the shards of a host, so the cut changes nothing. Null or empty html gives an empty text; pages
    with null urls are one host; rows with equal blocks count as one page and get equal texts.
    """
    host, _ = url_parts(F.col("url"))
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    parsed = stored(with_computed(source, host=host).select("page_id", "url", "host", "html").mapInArrow(_parse, PARSED), "parsed")
    distinct = parsed.select("same", "host", "has_article", "plain", "aside").dropDuplicates(["host", "same"])
    sizes = parsed.groupBy("host", "same").agg(F.max("outer").alias("outer"))
    sizes = sizes.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.sum("outer").alias("tokens"))
    needed = F.greatest(F.ceil(F.col("pages") / shard_pages), F.ceil(F.col("tokens") / shard_tokens))
    cut = sizes.select("host", needed.alias("shards")).where("shards > 1")  # few: large hosts only
    shards = F.pmod(F.xxhash64("same"), F.coalesce("shards", F.lit(1)))
    # Dealt anew by shard: the join's own dealing would bring all shards of a host to one task.
    outer = distinct.join(cut, "host", "left").withColumn("shard", shards).drop("shards").repartition("host", "shard")
    windows = stored(outer.groupBy("host", "shard").applyInArrow(_host_suffixes(min_run), SHARED), "windows")
    common = windows.groupBy("host", "mark").agg(F.sum("n").alias("pages")).where("pages > 1")
    own = windows.where("same IS NOT NULL").join(common, ["host", "mark"])
    place = F.struct("at", F.col("pages").alias("n"))
    starts = own.groupBy("host", "same").agg(F.collect_list(place).alias("starts"))  # at most two per token of the page
    # Pages without unmarked blocks have nothing to decide and are not moved.
    columns = ["page_id", "url", "article", "plain", "spots", "starts"]
    decided = parsed.where("size(plain) > 0").join(starts, ["host", "same"], "left").select(*columns)
    whole = parsed.where("size(plain) = 0").withColumn("starts", F.lit(None).cast(starts.schema["starts"].dataType)).select(*columns)
    rows = whole.union(decided)
    texts = rows.mapInArrow(_texts(min_run), "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))

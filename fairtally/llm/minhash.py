"""Near-duplicate documents: MinHash signatures met in an inverted join over coordinate and value.

A signature has COORDINATES minima. Documents are posted under each (coordinate, value); those that
agree in MATCHES coordinates or more are compared on their full shingle sets. With 64 coordinates
and 37 matches, a pair of similarity 0.8 is missed with a probability of about 1e-5.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import connected_components, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COORDINATES = 64
MATCHES = 37
SIMILARITY_PERCENT = 80
STAR_ROUNDS = 1
CACHE_WORDS = 200_000
#: Shingles of at most so many unsettled documents are rare: pairs that need one meet through it.
RARE = 16

SIGNED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature array<int>"


class WordHashes(dict):
    """64-bit hashes of words; starts anew when it holds many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int, hashes: dict) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; bytes.lower and bytes.split are ASCII only."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    return np.unique(total)


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2026)
    return rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def sign_documents(size: int, coordinates: int = COORDINATES):
    """A mapInArrow function: number of shingles, two hashes of the set, and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        a, b = (x[:, None] for x in multipliers(coordinates))
        for batch in batches:
            counts, set_a, set_b, signatures = [], [], [], []
            for value in batch.column("text"):
                s = shingle_set(value.as_py(), size, hashes)
                counts.append(len(s))
                set_a.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                set_b.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)))
                if not len(s):
                    signatures.append(None)
                    continue
                least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
                short = (s >> np.uint64(32)).astype(np.uint32)
                for start in range(0, len(short), 4096):
                    np.minimum(least, (short[start : start + 4096] * a + b).min(axis=1), out=least)
                signatures.append(least.view(np.int32))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "set_a": pa.array(set_a, pa.int64()),
                    "set_b": pa.array(set_b, pa.int64()),
                    "signature": pa.array(signatures, pa.list_(pa.int32())),
                }
            )

    return run


def shingle_blobs(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            blobs = [shingle_set(v.as_py(), size, hashes).tobytes() for v in batch.column("text")]
            yield pa.record_batch({"rep": batch.column("doc_id"), "blob": pa.array(blobs, pa.binary())})

    return run


def single_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sets = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column("blob")]
            reps = np.repeat(batch.column("rep").to_numpy(), [len(s) for s in sets])
            yield pa.record_batch({"rep": pa.array(reps, pa.int64()), "shingle": pa.array(np.concatenate(sets), pa.int64())})


def count_matches(least: int):
    """Keeps pairs whose signatures agree in at least ``least`` coordinates, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            matches = (x == y).sum(axis=1)
            keep = matches >= least
            yield pa.record_batch(
                {
                    "a": batch.column("a").filter(pa.array(keep)),
                    "b": batch.column("b").filter(pa.array(keep)),
                    "matches": pa.array(matches[keep], pa.int32()),
                }
            )

    return run


def confirm(percent: int):
    """Keeps pairs with 100 * intersection >= percent * union of their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("blob_a"), batch.column("blob_b")):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch({"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)})

    return run


class _Links:
    """Candidate pairs to confirmed links between representatives of different texts."""

    def __init__(self, documents: DataFrame, reps: DataFrame, shingle: int, percent: int, matches: int, coordinates: int):
        self.percent, self.matches = percent, matches
        self.signatures = reps.select("rep", "n_shingles", "signature")
        self.prefix = stored(self._prefix(reps, coordinates), "prefix")
        wanted = self.prefix.select("rep").distinct()
        texts = documents.join(wanted, documents.doc_id == wanted.rep, "left_semi").select("doc_id", "text")
        # Repeated rows of a document are the same set; one is enough.
        blobs = texts.mapInArrow(shingle_blobs(shingle), "rep bigint, blob binary").groupBy("rep").agg(F.first("blob").alias("blob"))
        self.blobs = stored(blobs, "shingles")

    def _prefix(self, reps: DataFrame, coordinates: int) -> DataFrame:
        """Postings that suffice to meet every pair of ``matches`` common coordinate-value pairs.

        Values of one document only can't be shared. Of the m that are left, rarest first, a pair
        with t matches shares one of the first m - t + 1: the others are skipped.
        """
        value = F.col("value").bitwiseAND(F.lit(0xFFFFFFFF))
        posts = reps.select("rep", "n_shingles", F.posexplode("signature").alias("k", "value")).select(
            "rep", "n_shingles", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(value.cast("long")).alias("token")
        )
        shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        lists = posts.join(shared, "token").groupBy("rep", "n_shingles").agg(
            F.array_sort(F.collect_list(F.struct("df", "token"))).alias("order")  # at most one per coordinate
        )
        first = F.slice("order", 1, F.size("order") - (self.matches - 1))
        tokens = lists.where(F.size("order") >= self.matches).select("rep", F.explode(first).alias("p")).select("rep", F.col("p.token").alias("token"))
        again = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token")
        return tokens.join(again, "token")

    def matched(self, pairs: DataFrame) -> DataFrame:
        """(a, b, matches) of the pairs whose signatures agree often enough."""
        side = lambda x: self.signatures.select(
            F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"sig_{x}")
        )
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        return both.where(fits).select("a", "b", "sig_a", "sig_b").mapInArrow(
            count_matches(self.matches), "a bigint, b bigint, matches int"
        )

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        side = lambda x: self.blobs.select(F.col("rep").alias(x), F.col("blob").alias(f"blob_{x}"))
        both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        return both.select("a", "b", "blob_a", "blob_b").mapInArrow(confirm(self.percent), "a bigint, b bigint")

    def posted(self, groups: DataFrame) -> DataFrame:
        """Postings with the present component of each representative."""
        return self.prefix.join(groups, F.col("rep") == F.col("node"), "left").select(
            "token", "rep", F.coalesce("component", "rep").alias("comp")
        )

    def star_pairs(self, groups: DataFrame, turn: int) -> DataFrame:
        """Each posting with one center of its list, where that is of another component yet."""
        posts = self.posted(groups)
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        centers = posts.groupBy("token").agg(F.min(F.struct(order.alias("o"), "rep", "comp")).alias("c"))
        far = posts.join(centers, "token").where(F.col("comp") != F.col("c.comp"))
        return far.select(F.col("c.rep").alias("a"), F.col("rep").alias("b")).distinct()

    def unsettled(self, groups: DataFrame) -> DataFrame:
        """Postings of lists with several components, with the largest one (``top``); written, as several steps read them."""
        posts = self.posted(groups)
        sizes = posts.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
        largest = sizes.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
        return stored(posts.join(largest.where("comps > 1").select("token", F.col("top.comp").alias("top")), "token"), "unsettled")

    def shared_shingles(self, unsettled: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What may still find a partner, (rep, n, s, c, tokens), and the rare shingles of it, (rep, shingle).

        Of n shingles s are shared with another unsettled document and c with more than RARE - 1 others.
        Shingles that no other document of the unsettled lists has can't be common to a pair, so s
        bounds every similarity; a document with too few shared shingles is left out. Of pairs without
        a common rare shingle, c is a bound too.
        """
        wanted = unsettled.select("rep").distinct()
        rows = self.blobs.join(wanted, "rep", "left_semi").mapInArrow(single_shingles, "rep bigint, shingle bigint")
        rows = stored(rows, "single-shingles")
        common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        shared = stored(rows.join(common, "shingle"), "shared-shingles")
        sums = shared.groupBy("rep").agg(F.count(F.lit(1)).alias("s"), F.count_if(F.col("df") > RARE).alias("c"))
        sized = sums.join(self.signatures.select("rep", F.col("n_shingles").alias("n")), "rep")
        lists = self.prefix.groupBy("rep").agg(F.collect_list("token").alias("tokens"))  # at most one per coordinate
        facts = stored(sized.where(F.col("s") * 100 >= F.col("n") * self.percent).join(lists, "rep"), "facts")
        return facts, shared.where(F.col("df") <= RARE).select("rep", "shingle")

    def rare_pairs(self, groups: DataFrame, facts: DataFrame, rare: DataFrame) -> DataFrame:
        """Pairs of different components that common rare shingles could make similar enough, each once.

        A list has at most RARE documents. A pair shares what its lists show and c shingles at most.
        """
        here = rare.join(facts.select("rep", "n", "c"), "rep").join(groups, F.col("rep") == F.col("node"), "left")
        one = F.struct("rep", F.coalesce("component", "rep").alias("comp"), "n", "c")
        lists = here.groupBy("shingle").agg(F.array_sort(F.collect_list(one)).alias("l"))
        lists = lists.where(F.size(F.array_distinct("l.comp")) > 1)
        met = lists.select("l", F.explode("l").alias("x")).select("x", F.explode("l").alias("y")).where("x.rep < y.rep AND x.comp != y.comp")
        pairs = met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("r"))
        most = F.least("x.c", "y.c") + F.col("r")
        fits = most * 100 >= (F.col("x.n") + F.col("y.n") - most) * self.percent
        return pairs.where(fits).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))

    def _may(self, x: str, y: str, shared: str = "s") -> Column:
        """Whether the similarity bound min(s) / (n_x + n_y - min(s)) reaches the threshold."""
        least = F.least(F.col(f"{x}{shared}"), F.col(f"{y}{shared}"))
        return least * 100 >= (F.col(f"{x}n") + F.col(f"{y}n") - least) * self.percent

    def hub_pairs(self, unsettled: DataFrame, facts: DataFrame) -> DataFrame:
        """As star_pairs, where the center of a list is what shares the most: it is like most others."""
        posts = unsettled.join(facts.drop("tokens", "c"), "rep")
        order = F.struct((F.col("s") / F.col("n")).alias("share"), (-F.col("rep")).alias("o"), "rep", "comp", "n", "s")
        far = posts.join(posts.groupBy("token").agg(F.max(order).alias("c")), "token")
        far = far.where((F.col("comp") != F.col("c.comp")) & self._may("", "c."))
        return far.select(F.col("c.rep").alias("a"), F.col("rep").alias("b")).distinct()

    def rest_pairs(self, unsettled: DataFrame, facts: DataFrame) -> DataFrame:
        """All pairs of different components that share a posting and may be similar enough without rare shingles, each once.

        Lists within one component make none; in other lists all but the largest component's
        members meet all members, so a large group of near copies meets only what isn't in it.
        """
        able = unsettled.join(facts, "rep")
        few = able.where("comp != top").select("token", *[F.col(c).alias(f"x_{c}") for c in ("rep", "comp", "n", "c", "tokens")])
        # Of the lists that a pair shares, the one with the least token speaks for it. At least one
        # side is outside of its largest component; if both are, the smaller asks.
        speaks = F.array_min(F.array_intersect("tokens", "x_tokens")) == F.col("token")
        once = (F.col("comp") == F.col("top")) | (F.col("x_rep") < F.col("rep"))
        met = few.join(able, "token").where((F.col("comp") != F.col("x_comp")) & once & self._may("", "x_", "c") & speaks)
        return met.select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b"))


def _at(groups: DataFrame, end: str) -> DataFrame:
    return groups.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))


def _between(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components, with these as c_a and c_b."""
    ends = pairs.join(_at(groups, "a"), "a", "left").join(_at(groups, "b"), "b", "left")
    ends = ends.withColumn("c_a", F.coalesce("c_a", "a")).withColumn("c_b", F.coalesce("c_b", "b"))
    return ends.where("c_a != c_b")


def _merged(groups: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """Components after new links, and whether there were any: only links between components matter."""
    found = connected_components(_between(groups, links).select(F.col("c_a").alias("a"), F.col("c_b").alias("b")), "near-groups")
    if found is None:
        return groups, False
    old = groups.join(found.select(F.col("node").alias("component"), F.col("component").alias("new")), "component", "left").select(
        "node", F.coalesce("new", "component").alias("component")
    )
    fresh = found.join(groups.select("node"), "node", "left_anti")
    return stored(old.union(fresh), "near-groups"), True


def _best(near: DataFrame, most: int = 1) -> DataFrame:
    """The ``most`` pairs of each b with the most matches; later steps still see all others."""
    if most == 1:
        return near.groupBy("b").agg(F.max(F.struct("matches", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    ranked = near.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("matches", "a")), asc=False).alias("m"))
    return ranked.select("b", F.explode(F.slice("m", 1, most)).alias("m")).select(F.col("m.a").alias("a"), "b")


def near_duplicates(
    documents: DataFrame,
    shingle: int,
    percent: int = SIMILARITY_PERCENT,
    matches: int = MATCHES,
    coordinates: int = COORDINATES,
    star_rounds: int = STAR_ROUNDS,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept.

    Reads ``doc_id`` and ``text``; other columns don't matter. Equal sets are one representative,
    so copies never meet. In a star round every posting meets one center of its list and confirms its
    best match, then one whose center shares the most; last, all pairs of different components
    that a bound does not exclude are counted and confirmed too: no list is cut. Null or empty texts have no shingles and are linked with nothing; a null doc_id is
    linked with nothing and has no component (kept is false); rows with the same doc_id are
    one document.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(docs.mapInArrow(sign_documents(shingle, coordinates), SIGNED), "signatures")
    key = ["n_shingles", "set_a", "set_b"]
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    # Only the smallest document of a set has its signature moved.
    members = stored(full.select("doc_id", *key).join(classes, key).select("doc_id", "rep"), "members")
    own = members.where("doc_id = rep").select("rep").distinct()
    reps = stored(
        full.join(own, full.doc_id == own.rep, "left_semi").groupBy(F.col("doc_id").alias("rep")).agg(
            F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
        ),
        "representatives",
    )
    links = _Links(docs, reps, shingle, percent, matches, coordinates)
    # Each step is written before the next reads it: one plan over all of them has so many broadcasts and
    # shuffles at once that the driver's heap grows for them, also on few rows. Joins with a table that is
    # empty by a constant condition are left out of the plan.
    groups = links.signatures.where(F.lit(False)).select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    for turn in range(star_rounds):
        near = stored(_best(links.matched(links.star_pairs(groups, turn))), "star-pairs")
        groups, more = _merged(groups, links.confirmed(near))
        if not more:
            break
    unsettled = links.unsettled(groups)
    facts, rare = links.shared_shingles(unsettled)
    near = stored(_best(links.matched(links.hub_pairs(unsettled, facts)), 4), "hub-pairs")
    groups, more = _merged(groups, links.confirmed(near))
    if more:
        unsettled = links.unsettled(groups)
    met = stored(links.rest_pairs(unsettled, facts).union(links.rare_pairs(groups, facts, rare)).distinct(), "met")
    left = stored(links.matched(met), "candidates")
    groups, _ = _merged(groups, links.confirmed(_best(left, 4)))
    groups, _ = _merged(groups, links.confirmed(_between(groups, left)))

    placed = members.join(groups, F.col("rep") == F.col("node"), "left").select(
        F.col("doc_id").alias("id"), F.coalesce("component", "rep").alias("found")
    )
    # Documents that are their own component need no row of the right side.
    moved = placed.where("id != found").groupBy("id").agg(F.min("found").alias("found"))
    result = signed.join(moved, signed.doc_id == moved.id, "left")
    component = F.coalesce("found", "doc_id")
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def drop_duplicates(documents: DataFrame, shingle: int, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """One document of each group (all columns): that with the smallest doc_id.

    Rows with one doc_id are one document: of repeated rows the one with the smallest hash stays. A row
    without doc_id takes part under a number from its text, larger than any doc_id in use, so it goes where a
    document with an id says the same, and of equal ones one stays; without words too it stays.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns]
    text = F.col("text").cast("string")
    own = F.xxhash64(text).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    number = F.coalesce(F.col("doc_id").cast("long"), F.when(text.rlike(r"[^\x20\x09-\x0D]"), own))
    rows = documents.select(F.struct(*columns).alias("row"), number.alias("_number"))
    judged = near_duplicates(documents.select(number.alias("doc_id"), text.alias("text")), shingle, percent)
    judged = stored(judged.where("doc_id IS NOT NULL").select("doc_id", "kept"), "judged")
    gone = stored(judged.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    again = stored(judged.groupBy(F.col("doc_id").alias("_again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_again"), "again")
    rest = rows.join(gone, F.col("_number") == F.col("_gone"), "left_anti")
    once = rest.join(again, F.col("_number") == F.col("_again"), "left_anti").select("row")
    repeated = rest.join(again, F.col("_number") == F.col("_again"), "left_semi")
    first = repeated.groupBy("_number").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return once.union(first).select(*[F.col(f"row.`{c}`").alias(c) for c in documents.columns])

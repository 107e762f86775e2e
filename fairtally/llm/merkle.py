"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

Each source's rows are the leaves of a tree, the sources' subroots those of one more tree above. Nodes
of the trees link to their parent and hold a segment: the siblings met on the way. Self-joins of the
node table double how far a link reaches and concatenate the segments, until all reach the root;
every run of leaves then takes its parent's whole path in one last step. Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import stored
from fairtally.operators.ordering import numbered

FANOUT = 16
HEX = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the sources; the others are numbered from 0 in the order of their sources.
TOP = -1


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Mapping[str, Column], columns: Sequence[str] = COLUMNS) -> Column:
    return hashed(*[framed(values[c]) for c in columns])


@dataclass(frozen=True)
class Manifest:
    """The trees of a table.

    ``runs``: (tree, up, n, level, members): the leaves in runs, members being (idx, digest, key, carried
    columns); level and up name the node above a run, or the leaf itself if it is its tree's only one.
    ``links``: (tree, level, idx, path): the whole way of each inner node to the root. ``subroots``:
    (tree, subroot). ``root``: None for an empty table.
    """

    runs: DataFrame
    links: DataFrame
    subroots: DataFrame
    root: str | None


def _step(at: Column, siblings: Column) -> Column:
    return F.struct(at.cast("int").alias("at"), siblings.alias("siblings"))


def _others(digests: Column, at: Column) -> Column:
    return F.array_join(F.filter(digests, lambda x, i: i != at), "")


def _run_up(nodes: DataFrame, fanout: int, *members: str) -> DataFrame:
    """Nodes (tree, n, idx, digest, members ...) in their runs of at most ``fanout``, with the digest above."""
    run = F.array_sort(F.collect_list(F.struct("idx", "digest", *members)))
    up = F.floor(F.col("idx") / fanout).cast("bigint")
    grouped = nodes.groupBy("tree", "n", up.alias("up")).agg(run.alias("members"))
    whole = F.sha2(F.array_join("members.digest", "").cast("binary"), 256)
    return grouped.withColumn("digest", whole)


def _child_links(runs: DataFrame, level: int) -> DataFrame:
    """From the runs below ``level``: (tree, level, idx) of each member's own node, its parent, its segment."""
    each = runs.select("tree", "up", F.col("members.digest").alias("digests"), F.posexplode("members").alias("at", "m"))
    return each.select(
        F.col("m.tree0").alias("tree"),
        F.col("m.level0").alias("level"),
        F.col("m.idx0").alias("idx"),
        F.struct("tree", F.lit(level).alias("level"), F.col("up").alias("idx")).alias("parent"),
        F.array(_step(F.col("at"), _others(F.col("digests"), F.col("at")))).alias("path"),
    )


def _climb(nodes: DataFrame, most: int, level: int, fanout: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """All levels above ``nodes`` (tree, n, idx, digest, tree0, level0, idx0); ``most``: the largest n.

    Returns the links of the nodes, level by level, and per level the nodes that are their tree's only one.
    """
    links, tops = [], [nodes.where("n = 1")]
    while most > 1:
        level += 1
        runs = stored(_run_up(nodes.where("n > 1"), fanout, "tree0", "level0", "idx0"), "runs")
        links.append(_child_links(runs, level))
        nodes = runs.select(
            "tree", F.ceil(F.col("n") / fanout).cast("bigint").alias("n"), F.col("up").alias("idx"), "digest",
            F.col("tree").alias("tree0"), F.lit(level).alias("level0"), F.col("up").alias("idx0"),
        )
        most = math.ceil(most / fanout)
        tops.append(nodes.where("n = 1"))
    return links, tops


def _joined(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _jump(links: DataFrame, height: int) -> DataFrame:
    """Pointer jumping: links that reach one node up become links to the root, in log2(height) rounds.

    A round joins each link with the link of the node it leads to. Nodes without a link are roots.
    Round k needs, on the right, only nodes that something is 2**k steps below.
    """
    reach = 1
    while reach < height:
        far = links.where((F.col("tree") == TOP) | (F.col("level") > reach))
        onward = far.select(
            F.struct("tree", "level", "idx").alias("at_node"), F.col("parent").alias("further"), F.col("path").alias("rest")
        )
        met = links.join(onward, links["parent"] == onward["at_node"], "left")
        links = stored(
            met.select(
                "tree", "level", "idx",
                F.coalesce("further", "parent").alias("parent"),
                F.when(F.col("rest").isNotNull(), F.concat("path", "rest")).otherwise(F.col("path")).alias("path"),
            ),
            "links",
        )
        reach *= 2
    return links


LINKS = "tree bigint, level int, idx bigint, parent struct<tree:bigint,level:int,idx:bigint>, path array<struct<at:int,siblings:string>>"


def build_manifest(
    documents: DataFrame,
    columns: Sequence[str] = COLUMNS,
    key: str = "doc_id",
    group: str = "source",
    fanout: int = FANOUT,
    carry: Mapping[str, Column] | None = None,
) -> Manifest:
    """The Merkle trees over all rows; a leaf is the digest of ``columns``, in that order.

    Leaves ascend by ``key`` within their ``group``, nulls first, and rows of one key by digest, so
    repeated rows are leaves of their own and any order of reading gives the same tree. ``carry`` adds
    columns to the leaves. Other columns don't matter, whatever their names. Each text is hashed
    where it is read and never moved; a source with most of the rows is dealt to many blocks.
    """
    leaf = leaf_digest({c: F.col(f"`{c}`") for c in columns}, columns)
    carried = dict(carry or {})
    base = documents.select(
        F.col(f"`{group}`").alias("_group"), F.col(f"`{key}`").alias("_key"), leaf.alias("digest"),
        F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carried.items()]).alias("carried"),
    )
    order = [F.asc_nulls_first("_group"), F.asc_nulls_first("_key"), F.col("digest")]
    placed = stored(numbered(base, *order), "leaves")
    groups = placed.groupBy("_group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = stored(numbered(groups, F.col("first"), place="tree"), "trees")
    n_trees, most = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    spark = documents.sparkSession
    named = trees.withColumnRenamed("_group", "_tree_group")
    leaves = placed.join(named, placed["_group"].eqNullSafe(named["_tree_group"])).select(
        "tree", "n", (F.col("place") - F.col("first")).alias("idx"), "digest", F.col("_key").alias("key"), "carried"
    )
    runs = _run_up(leaves, fanout, "key", "carried")
    alone = F.col("n") == 1
    runs = runs.withColumn("digest", F.when(alone, F.col("members")[0]["digest"]).otherwise(F.col("digest")))
    runs = stored(runs.withColumn("level", F.when(alone, 0).otherwise(1)), "leaf-runs")
    if not most:
        empty = spark.createDataFrame([], LINKS)
        return Manifest(runs, empty, spark.createDataFrame([], "tree bigint, subroot string"), None)
    above = runs.select(
        "tree", F.ceil(F.col("n") / fanout).cast("bigint").alias("n"), F.col("up").alias("idx"), "digest",
        F.col("tree").alias("tree0"), F.col("level").alias("level0"), F.col("up").alias("idx0"),
    )
    links, tops = _climb(above, math.ceil(most / fanout), 1, fanout)
    subroots = stored(_joined(tops), "subroots")
    upper = subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(n_trees).cast("bigint").alias("n"), F.col("tree").alias("idx"), "digest",
        "tree0", "level0", "idx0",
    )
    top_links, top = _climb(upper, n_trees, 0, fanout)
    root = _joined(top).select("digest").first()["digest"]
    all_links = [*links, *top_links]
    linked = stored(_joined(all_links), "links") if all_links else spark.createDataFrame([], LINKS)
    return Manifest(runs, _jump(linked, len(all_links)), subroots.select("tree", F.col("digest").alias("subroot")), root)


def proofs(manifest: Manifest) -> DataFrame:
    """Per leaf: tree, idx, key, leaf, carried (struct), subroot, root, path.

    ``path`` has a step (at, siblings) for each level from the leaf to the root: the digests of the other
    nodes of the run, left to right, and how many of them stand before the one proved. A run of one
    node is a step without siblings; a table of one leaf has no steps.
    """
    runs = manifest.runs.join(manifest.subroots, "tree")
    links = manifest.links.select("tree", "level", F.col("idx").alias("up"), F.col("path").alias("rest"))
    found = runs.join(links, ["tree", "level", "up"], "left")
    each = found.select(
        "tree", "n", "subroot", "rest", F.col("members.digest").alias("digests"), F.posexplode("members").alias("at", "m")
    )
    own = F.when(F.col("n") > 1, F.array(_step(F.col("at"), _others(F.col("digests"), F.col("at")))))
    no_steps = F.array().cast("array<struct<at:int,siblings:string>>")
    return each.select(
        "tree", F.col("m.idx").alias("idx"), F.col("m.key").alias("key"), F.col("m.digest").alias("leaf"), F.col("m.carried").alias("carried"),
        "subroot", F.lit(manifest.root).alias("root"),
        F.concat(F.coalesce(own, no_steps), F.coalesce("rest", no_steps)).alias("path"),
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["siblings"]), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""

    def up(digest: Column, step: Column) -> Column:
        cut = step["at"] * HEX
        return hashed(step["siblings"].substr(F.lit(1), cut), digest, step["siblings"].substr(cut + 1, F.length(step["siblings"])))

    return F.aggregate(path, leaf, up)

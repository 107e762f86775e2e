"""Near-duplicate vectors by a robust-pruned flat graph, searched by range from medoids.

Vectors of one label are cut into overlapping cluster shards of bounded size. Each shard builds a
pruned neighbour graph; the adjacency lists of a vector's shards are united. In its home shard each
vector then is a query: a greedy search from the medoids, which expands over the range once it is
reached. Where united edges of nodes in range lead to other shards, the query goes on there, in
rounds, until no edge leads to a shard it has not seen. Every link is verified in double precision;
recall is audited against brute force, the index is built wider where it falls short, and where the
widest one does, all shards of a label are compared with each other.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import connected_components, stored, with_computed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_COSINE = 0.93
MAX_SHARD = 2000
SPLIT_WAYS = 32
SPLIT_SAMPLE = 4000
SPLIT_LEVELS = 6
ALPHA = 1.2
AUDIT_QUERIES = 1000
#: Queries that one task takes to a shard.
VISIT_QUERIES = 8000
LEAST_RECALL = 0.98
#: How far below the range a search still follows edges.
SLACK = 0.03


@dataclass(frozen=True)
class Width:
    """How much an index overlaps and how far a search looks."""

    overlap: int
    degree: int
    beam: int


WIDTHS = (Width(3, 16, 48), Width(6, 32, 128), Width(12, 64, 384))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embedding: str = "embedding"):
    """Vectors that can link: not null or empty, without null or non-finite components, not zero."""
    v = F.col(embedding)
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & sound & F.exists(v, lambda x: x != 0)


def _split(sample: pa.Table) -> pa.Table:
    """Cluster centers of a group from its bounded sample."""
    x = unit(matrix(sample.column("v")))
    x = x[np.lexsort(x.T[::-1])]
    k = min(sample.column("ways")[0].as_py(), len(x))
    chosen, far = [0], 1 - x @ x[0]
    for _ in range(k - 1):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, 1 - x @ x[chosen[-1]])
    centers = x[chosen]
    for _ in range(8):
        near = (x @ centers.T).argmax(axis=1)
        centers = np.stack([x[near == j].mean(axis=0) if (near == j).any() else centers[j] for j in range(k)])
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    return pa.table({"grp": [sample.column("grp")[0].as_py()], "centers": pa.array([centers.ravel()], pa.list_(pa.float64()))})


def _direction(v):
    """The vector over its greatest absolute component.

    Quotients are correctly rounded, so exact multiples of a vector give equal arrays; and equal
    arrays are one direction but for the last bit of a component.
    """
    return F.transform(v, lambda x: x / F.col("top"))


def _assign(overlap: int):
    def run(rows: pa.Table, split: pa.Table) -> pa.Table:
        x = unit(matrix(rows.column("v")))
        centers = matrix(split.column("centers")).reshape(-1, x.shape[1]) if split.num_rows else x[:1]
        similar = x @ centers.T
        order = np.argsort(-similar, axis=1, kind="stable")[:, :overlap]
        grp, home = rows.column("grp")[0].as_py(), rows.column("home").to_numpy(zero_copy_only=False)
        at = np.repeat(np.arange(len(x)), order.shape[1])
        first = np.tile(np.arange(order.shape[1]) == 0, len(x))
        return pa.table(
            {
                "rep": rows.column("rep").take(pa.array(at)),
                "v": rows.column("v").take(pa.array(at)),
                "weight": rows.column("weight").take(pa.array(at)),
                "grp": pa.array([f"{grp}/{j}" for j in order.ravel()], pa.string()),
                "home": pa.array(first & home[at], pa.bool_()),
            }
        )

    return run


def _blocks(sized: DataFrame, most: int) -> DataFrame:
    """Rows of groups of ``n`` above ``most`` dealt by hash into blocks of about 4/5 of it."""
    block = F.pmod(F.xxhash64(F.lit("block"), "rep"), F.ceil(F.col("n") * 5 / (4 * most)))
    return sized.withColumn("grp", F.when(F.col("n") > most, F.concat_ws("#", "grp", block.cast("string"))).otherwise(F.col("grp")))


SHARDED = "rep bigint, v array<double>, weight bigint, grp string, home boolean"


def overlapping_shards(vectors: DataFrame, width: Width, most: int = MAX_SHARD) -> DataFrame:
    """Vectors (rep, v, weight, grp) in shards; the one with ``home`` asks for the vector's links.

    A group above ``most`` is split by centers that are fitted on about SPLIT_SAMPLE vectors of it, and every
    vector goes to its nearest center and to the next ones (``overlap``), until all shards are small.
    What a split leaves with more than half of its group, or SPLIT_LEVELS splits leave above
    ``most``, no center tells apart: it is dealt into blocks ``group#i``, and a search visits all of them.
    """
    done, left = [], vectors.withColumn("home", F.lit(True)).select("rep", "v", "weight", "grp", "home")
    for level in range(SPLIT_LEVELS):
        sizes = left.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        if level:
            parent = F.substring_index("grp", "/", level)
            stuck = sizes.join(before.withColumnsRenamed({"grp": "parent", "n": "of"}), parent == F.col("parent"))
            stuck = stuck.where((F.col("n") > most) & (F.col("n") * 2 > F.col("of"))).select("grp", "n")
            done.append(_blocks(left.join(stuck, "grp"), most).select(*left.columns))
            sizes = sizes.join(stuck, "grp", "left_anti")
        before = sizes
        sized = left.join(sizes, "grp")
        done.append(sized.where(F.col("n") <= most).select(*left.columns))
        big = sized.where(F.col("n") > most)
        if level and big.isEmpty():
            break
        luck = F.xxhash64("rep") / 2.0**64 + 0.5
        ways = F.least(F.lit(SPLIT_WAYS), F.ceil(F.col("n") * 3 / most)).cast("int")
        # About SPLIT_SAMPLE vectors of a group, told by each one's own hash: nothing is gathered to be ranked.
        sample = big.where(luck * F.col("n") <= SPLIT_SAMPLE).select("grp", "v", ways.alias("ways"))
        centers = sample.groupBy("grp").applyInArrow(_split, "grp string, centers array<double>")
        salts = sizes.where(F.col("n") > most).select("grp", F.explode(F.sequence(F.lit(0), (F.col("n") / 20_000).cast("int"))).alias("salt"))
        salted = big.withColumn("salt", F.pmod(F.xxhash64("rep"), (F.col("n") / 20_000).cast("int") + 1).cast("int"))
        # A split keeps about the same overlap over all levels: only the first one copies vectors.
        dealt = (
            salted.select(*left.columns, "salt")
            .groupBy("grp", "salt")
            .cogroup(centers.join(salts, "grp").groupBy("grp", "salt"))
            .applyInArrow(_assign(width.overlap if level == 0 else 2), SHARDED)
        )
        left = stored(dealt, "shards")
    else:
        sizes = left.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        done.append(_blocks(left.join(sizes, "grp"), most).select(*left.columns))
    shards = done[0]
    for more in done[1:]:
        shards = shards.union(more)
    return stored(shards, "shards")


def pruned_neighbours(x: np.ndarray, degree: int) -> list[np.ndarray]:
    """Robust-pruned out-neighbours of each unit vector, with a few far ones, made symmetric."""
    n, rng = len(x), np.random.default_rng(7)
    most = min(n - 1, 3 * degree)
    out: list[set] = [set() for _ in range(n)]
    for start in range(0, n, 256):
        similar = x[start : start + 256] @ x.T
        for i in range(len(similar)):
            similar[i, start + i] = -2
        near = np.argpartition(-similar, most - 1, axis=1)[:, :most] if most else np.empty((len(similar), 0), int)
        for i in range(len(similar)):
            cand = near[i][np.argsort(-similar[i, near[i]], kind="stable")]
            own = 2 - 2 * similar[i, cand]  # squared distances
            between = 2 - 2 * (x[cand] @ x[cand].T)
            alive, picked = np.ones(len(cand), bool), []
            while alive.any() and len(picked) < degree:
                p = int(alive.argmax())
                picked.append(p)
                # A candidate that is much nearer to a neighbour than to the vector is reached by that one.
                alive &= ALPHA**2 * between[p] > own
                alive[p] = False
            out[start + i].update(cand[picked].tolist())
            out[start + i].update(int(j) for j in rng.integers(0, n, 4) if j != start + i)
    for i in range(n):
        for j in list(out[i]):
            out[j].add(i)
    return [np.array(sorted(s), np.int64) for s in out]


def medoids(x: np.ndarray, count: int = 8) -> np.ndarray:
    """The vector nearest to the mean, and those far from each other: where searches start."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    far = 1 - x @ x[chosen[0]]
    for _ in range(min(count, len(x)) - 1):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, 1 - x @ x[chosen[-1]])
    return np.unique(chosen)


def _build(degree: int, least: float):
    """Adjacency lists, and the home shards to which edges lead that a search over the range can use."""
    # Two vectors further apart are not both in (slack) range of one query.
    reach = np.cos(np.arccos(least) + np.arccos(max(least - SLACK, -1.0))) - 1e-9

    def run(shard: pa.Table) -> pa.Table:
        reps, x = shard.column("rep").to_numpy(), unit(matrix(shard.column("v")))
        homes = np.array(shard.column("home_grp").to_pylist(), object)
        lists = pruned_neighbours(x, degree)
        exits = [sorted(set(homes[a[x[a] @ x[i] >= reach]].tolist()) - {homes[i]}) for i, a in enumerate(lists)]
        return pa.table(
            {
                "rep": reps,
                "near": pa.array([reps[a] for a in lists], pa.list_(pa.int64())),
                "exits": pa.array(exits, pa.list_(pa.string())),
            }
        )

    return run


def range_search(x: np.ndarray, query: int, graph: list[np.ndarray], starts: np.ndarray, beam: int, least: float) -> np.ndarray:
    """Nodes with a similarity of at least ``least`` - SLACK: greedy search, then expansion over the range."""
    q, seen = x[query], np.zeros(len(x), bool)
    seen[starts] = True
    nodes, scores = starts, x[starts] @ q
    expanded = np.zeros(len(nodes), bool)
    slack = least - SLACK
    while True:
        order = np.argsort(-scores, kind="stable")
        nodes, scores, expanded = nodes[order], scores[order], expanded[order]
        # The best of the beam, and everything that is in range or close to it.
        waiting = np.flatnonzero(~expanded & ((np.arange(len(nodes)) < beam) | (scores >= slack)))
        if not len(waiting):
            return nodes[scores >= slack]
        turn = waiting[scores[waiting] >= slack] if scores[waiting[0]] >= slack else waiting[:4]
        expanded[turn] = True
        fresh = np.unique(np.concatenate([graph[i] for i in nodes[turn]]))
        fresh = fresh[~seen[fresh]]
        if len(fresh):
            seen[fresh] = True
            nodes, scores = np.concatenate([nodes, fresh]), np.concatenate([scores, x[fresh] @ q])
            expanded = np.concatenate([expanded, np.zeros(len(fresh), bool)])


def _search(beam: int, least: float, audited: bool):
    """Per home vector its number of links, and a spanning forest of the links that the shard has found."""

    def run(shard: pa.Table) -> pa.Table:
        raw, reps = matrix(shard.column("v")), shard.column("rep").to_numpy()
        norm, x = np.linalg.norm(raw, axis=1), unit(raw)
        weight = shard.column("weight").to_numpy()
        home = shard.column("home").to_numpy(zero_copy_only=False)
        asks = shard.column("ask").to_numpy(zero_copy_only=False)
        place = {r: i for i, r in enumerate(reps.tolist())}
        # United lists name vectors of other shards too; the query goes on there by the exits.
        graph = [np.array(sorted(place[r] for r in near if r in place), np.int64) for near in shard.column("near").to_pylist()]
        exits = shard.column("exits").to_pylist()
        starts, root = medoids(x), list(range(len(reps)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        a, b, links, go = [], [], [], []
        for i in np.flatnonzero(asks if audited else home).tolist():
            found = range_search(x, i, graph, starts, beam, least - 1e-9)
            leads = sorted({e for j in {i, *found.tolist()} for e in exits[j]})
            found = found[found != i]
            exact = raw[found] @ raw[i] / (norm[found] * norm[i])
            # Only what this shard is home of counts here; the rest counts at its own home.
            found = found[(exact >= least) & home[found]]
            a.append(reps[i])
            b.append(None)
            links.append(int(weight[found].sum()))
            go.append(leads)
            if audited:
                a += [reps[i]] * len(found)
                b += reps[found].tolist()
                links += [None] * len(found)
                go += [None] * len(found)
                continue
            for j in found.tolist():
                r, s = find(i), find(j)
                if r != s:
                    root[max(r, s)] = min(r, s)
                    a.append(reps[i])
                    b.append(reps[j])
                    links.append(None)
                    go.append(None)
        return _found(a, b, links, go)

    return run


FOUND = "a bigint, b bigint, links bigint, go array<string>"


def _found(a: list, b: list, links: list, go: list) -> pa.Table:
    return pa.table(
        {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64()), "go": pa.array(go, pa.list_(pa.string()))}
    )


def _visit(least: float, audited: bool):
    """Queries from elsewhere against all vectors of which a shard is the home, as ``_search`` gives it."""

    def run(asked: pa.Table, shard: pa.Table) -> pa.Table:
        a, b, links, go = [], [], [], []
        if asked.num_rows and shard.num_rows:
            raw, reps = matrix(shard.column("v")), shard.column("rep").to_numpy()
            norm, weight = np.linalg.norm(raw, axis=1), shard.column("weight").to_numpy()
            exits = shard.column("exits").to_pylist()
            ids, queries = asked.column("q").to_numpy(), matrix(asked.column("qv"))
            label = np.arange(len(reps))
            for start in range(0, len(ids), 512):
                q = queries[start : start + 512]
                cosine = q @ raw.T / (np.linalg.norm(q, axis=1)[:, None] * norm)
                for i, own in zip(ids[start : start + 512].tolist(), cosine):
                    # Blocks of one group are shards that a query visits together with its own.
                    own[reps == i] = -2
                    found = np.flatnonzero(own >= least)
                    leads = {e for j in np.flatnonzero(own >= least - SLACK).tolist() for e in exits[j]}
                    a.append(i)
                    b.append(None)
                    links.append(int(weight[found].sum()))
                    go.append(sorted(leads))
                    if audited:
                        ends = found
                    else:  # one link to each of the trees that the query connects
                        trees, at = np.unique(label[found], return_index=True)
                        ends = found[at]
                        if len(trees) > 1:
                            label[np.isin(label, trees)] = trees[0]
                    a += [i] * len(ends)
                    b += reps[ends].tolist()
                    links += [None] * len(ends)
                    go += [None] * len(ends)
        return _found(a, b, links, go)

    return run


def _searched(index: DataFrame, asked, width: Width, least: float, audited: bool, everywhere: bool = False) -> DataFrame:
    """What the queries (home rows where ``asked``) find: per visit a row of counts, and rows of links.

    The first round is the search in the home shard; each later one takes the queries to the shards
    that the last one's edges led to. ``everywhere`` takes them to all shards of their label instead.
    """
    homes = index.where("home")
    queries = homes.where(asked).select(F.col("rep").alias("q"), F.col("v").alias("qv"), F.col("grp").alias("from"))
    seen = queries.select("q", F.col("from").alias("to"))
    first = index.withColumn("ask", F.col("home") & asked).groupBy("grp").applyInArrow(_search(width.beam, least, audited), FOUND)
    found = stored(first, "links")
    total, leads = found, found.where("b IS NULL").select(F.col("a").alias("q"), F.explode("go").alias("to"))
    root = lambda c: F.regexp_extract(c, r"^([^/#]*)", 1)
    shards = homes.groupBy(F.col("grp").alias("to")).agg(F.count(F.lit(1)).alias("n"))
    family = shards.where("to LIKE '%#%'").select(F.col("to").alias("block"), F.substring_index("to", "#", 1).alias("of"))
    while True:
        if everywhere:
            leads = queries.join(shards, root("from") == root("to")).select("q", "to")
        else:
            # One block of a group stands for all of them.
            reached = leads.union(seen).where("to LIKE '%#%'").select("q", F.substring_index("to", "#", 1).alias("of")).distinct()
            leads = leads.union(reached.join(family, "of").select("q", F.col("block").alias("to")))
        fresh = stored(leads.distinct().join(seen, ["q", "to"], "left_anti"), "visits")
        if fresh.isEmpty():
            return total
        parts = fresh.groupBy("to").agg(F.ceil(F.count(F.lit(1)) / VISIT_QUERIES).alias("parts"))
        part = F.pmod(F.xxhash64("q"), F.col("parts")).alias("part")
        asking = fresh.join(parts, "to").select("q", "to", part).join(queries.select("q", "qv"), "q")
        answering = homes.join(parts, F.col("grp") == F.col("to")).select(
            F.col("grp").alias("at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "rep", "v", "weight", "exits"
        )
        more = asking.groupBy("to", "part").cogroup(answering.groupBy("at", "part")).applyInArrow(_visit(least, audited), FOUND)
        more = stored(more, "links")
        total, seen = total.union(more), seen.union(fresh)
        if everywhere:
            return total
        leads = more.where("b IS NULL").select(F.col("a").alias("q"), F.explode("go").alias("to"))


def _brute(ids: np.ndarray, groups: np.ndarray, queries: np.ndarray, least: float):
    """Links of a bounded set of queries with every row, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("grp").to_pylist(), object)
            for grp in set(names.tolist()) & set(groups.tolist()):
                rows, own = np.flatnonzero(names == grp), np.flatnonzero(groups == grp)
                x = matrix(batch.column("v").take(pa.array(rows)))
                q = np.stack([queries[k] for k in own])
                cosine = (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1))
                k, i = np.nonzero(cosine >= least)
                reps = batch.column("rep").to_numpy()[rows[i]]
                keep = reps != ids[own[k]]
                yield pa.record_batch({"a": pa.array(ids[own[k]][keep], pa.int64()), "b": pa.array(reps[keep], pa.int64())})

    return run


def _indexed(vectors: DataFrame, width: Width, most: int, least: float = LEAST_COSINE) -> DataFrame:
    """Shards with the united adjacency list of each vector, and the shards where its edges lead."""
    shards = overlapping_shards(vectors, width, most)
    homes = shards.where("home").select("rep", F.col("grp").alias("home_grp"))
    built = shards.join(homes, "rep").groupBy("grp").applyInArrow(_build(width.degree, least), "rep bigint, near array<bigint>, exits array<string>")
    # At most the lists of the shards that a vector is in.
    lists = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("near", "exits")]
    united = built.groupBy("rep").agg(*lists)
    return stored(shards.join(united, "rep"), "graph")


def audit(index: DataFrame, vectors: DataFrame, width: Width, least: float, queries: int = AUDIT_QUERIES) -> float:
    """Share of the links of up to ``queries`` vectors (smallest hashes) that the index finds."""
    asked = vectors.orderBy(F.xxhash64("rep"), "rep").limit(queries).select("rep", "grp", "v").collect()
    if not asked:
        return 1.0
    ids, groups = np.array([r["rep"] for r in asked]), np.array([r["grp"] for r in asked], object)
    vectors_of = np.empty(len(asked), object)
    for k, r in enumerate(asked):
        vectors_of[k] = np.array(r["v"])
    true = vectors.select("rep", "grp", "v").mapInArrow(_brute(ids, groups, vectors_of, least), "a bigint, b bigint")
    found = _searched(index, F.col("rep").isin(ids.tolist()), width, least, True).where("b IS NOT NULL")
    hit = true.join(found.select("a", "b", F.lit(1).alias("hit")).distinct(), ["a", "b"], "left")
    n, hits = hit.agg(F.count(F.lit(1)), F.count("hit")).first()
    return hits / n if n else 1.0


def near_vectors(embeddings: DataFrame, least: float = LEAST_COSINE, most: int = MAX_SHARD, least_recall: float = LEAST_RECALL) -> DataFrame:
    """Per row: vec_id, n_links, component_id (the smallest vec_id reachable), kept.

    Vectors link when their labels are equal and not null, they have as many components, and their
    cosine is at least ``least``. Unusable vectors link with nothing. Equal vectors, and vectors that
    differ in length only, are one node of the graph with their number as its weight, and link with each other. A null vec_id has no
    component and links with nothing; rows with the same vec_id are vectors of their own that share an id.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))
    grp = F.concat_ws("|", F.col("label").cast("string"), F.size("v").cast("string"))
    able = rows.where(usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", grp.alias("grp"), "v")
    able = with_computed(able, top=F.array_max(F.transform("v", F.abs)))
    able = with_computed(able.select("vec_id", "grp", _direction("v").alias("w")), v=F.col("w")).drop("w")
    classes = able.groupBy("grp", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    members = stored(able.join(classes.withColumnRenamed("v", "w"), (able.grp == classes.grp) & (able.v == F.col("w"))).select("vec_id", "rep", "weight"), "vector-members")
    nodes = stored(classes, "vectors")
    for width in WIDTHS:
        index = _indexed(nodes, width, most, least)
        recall = audit(index, nodes, width, least)
        if recall >= least_recall:
            break
    else:
        warnings.warn(f"recall {recall:.3f} at the greatest width: all shards of a label are compared", stacklevel=2)
    found = _searched(index, F.lit(True), width, least, False, everywhere=recall < least_recall)
    # Every vector has one home, where alone it is counted.
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    groups = connected_components(found.where("b IS NOT NULL").select("a", "b"), "vector-groups")
    if groups is None:
        groups = embeddings.sparkSession.createDataFrame([], "node bigint, component bigint")
    per_rep = counts.join(groups, F.col("a") == F.col("node"), "left").select(
        F.col("a").alias("rep"), "links", F.coalesce("component", "a").alias("component")
    )
    placed = members.join(per_rep, "rep", "left").groupBy("vec_id").agg(
        F.max(F.col("links") + F.col("weight") - 1).alias("links"), F.min("component").alias("component")
    )
    result = rows.select("vec_id").join(placed.withColumnRenamed("vec_id", "id"), F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

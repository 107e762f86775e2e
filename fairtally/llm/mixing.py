"""Mixing sources to target weights: hierarchical budgets, and a token prefix of each leaf's epochs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairtally.llm.common import WORD

SEED = 17
MAX_EPOCHS = 2
MOST_LEAVES = 100_000
LEVELS = ("domain", "language", "source")

#: Sources of the web domain; all others are the curated domain.
WEB_SOURCES = tuple(f"src{i}" for i in range(10))


@dataclass(frozen=True)
class Tree:
    """Weights of the nodes of a domain-language-source tree.

    ``levels`` are column expressions that place a row. ``weights`` has the weight of a node by its
    path of values, as ("web",) or ("web", "en"); others weigh ``default``. Weights count against
    those of the siblings present. A weight of 0 leaves a node out.
    """

    levels: tuple[Column, ...]
    weights: Mapping[tuple, float] = field(default_factory=dict)
    default: float = 1.0

    def weight(self, path: tuple) -> float:
        value = float(self.weights.get(path, self.default))
        if not 0 <= value < float("inf"):
            raise ValueError(f"weight of {path} must be finite and not negative")
        return value


def default_tree(documents: DataFrame) -> Tree:
    """For tables with lang and source: two domains at 6 to 4, languages at 5, 2, 2 and 1, sources alike."""
    web = F.col("source").isin(*WEB_SOURCES)
    levels = (F.when(web, "web").otherwise("curated"), F.col("lang"), F.col("source"))
    languages = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}
    weights: dict[tuple, float] = {("web",): 6.0, ("curated",): 4.0}
    for domain in ("web", "curated"):
        weights |= {(domain, lang): w for lang, w in languages.items()}
    return Tree(levels, weights)


def _share(budget: float, weights: list[float], most: list[float]) -> list[float]:
    """Budget by weight; what one can't take goes to the others by weight, until none can take more."""
    given, open_ = [0.0] * len(weights), [i for i, w in enumerate(weights) if w > 0]
    while open_ and budget > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if most[i] <= budget * weights[i] / total]
        if not full:
            for i in open_:
                given[i] = budget * weights[i] / total
            break
        for i in full:
            given[i] = most[i]
        budget -= sum(most[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return given


def leaf_budgets(supply: Mapping[tuple, int], tree: Tree, budget: int, max_epochs: int) -> dict[tuple, int]:
    """Tokens that each leaf is to give, at most ``max_epochs`` times what it has.

    A node's limit is what its leaves of positive weight can give, so a shortage is taken over by
    siblings first, and by the siblings of an ancestor only when the whole branch is exhausted.
    """
    tops: dict[tuple, list[tuple]] = {}
    for path in sorted(supply, key=repr):
        for depth in range(len(path)):
            children = tops.setdefault(path[:depth], [])
            if path[: depth + 1] not in children[-1:]:  # sorted: equal ones follow each other
                children.append(path[: depth + 1])

    limits: dict[tuple, float] = {}

    def limit(node: tuple) -> float:
        if node not in limits:
            below = tops.get(node)
            limits[node] = sum(limit(c) for c in below if tree.weight(c) > 0) if below else float(supply[node] * max_epochs)
        return limits[node]

    found: dict[tuple, int] = {}

    def divide(node: tuple, share: float) -> None:
        below = tops.get(node)
        if not below:
            found[node] = int(share + 1e-6)
            return
        for child, part in zip(below, _share(share, [tree.weight(c) for c in below], [limit(c) for c in below])):
            divide(child, part)

    if supply:
        divide((), min(float(budget), limit(())))
    return found


def _placed(documents: DataFrame, tree: Tree) -> DataFrame:
    """Rows as struct ``row`` with the values of the tree's levels and their number of words."""
    levels = [c.cast("string").alias(name) for c, name in zip(tree.levels, LEVELS)]
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *levels, words.alias("n_tokens"))


def _with_plan(rows: DataFrame, plan: list[tuple], columns: str) -> DataFrame:
    """Rows with the numbers of their leaf. The plan has a row per leaf, at most MOST_LEAVES (checked)."""
    schema = ", ".join(f"p_{name} string" for name in LEVELS) + ", " + columns
    leaves = F.broadcast(rows.sparkSession.createDataFrame(plan, schema))
    same = [F.col(name).eqNullSafe(F.col(f"p_{name}")) for name in LEVELS]
    return rows.join(leaves, same).drop(*[f"p_{name}" for name in LEVELS])


def _key(seed: int, epoch: Column) -> Column:
    """Order of a document within an epoch of its leaf: a hash of seed, epoch and id."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))))


def select_mixture(documents: DataFrame, tree: Tree, budget: int | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The documents as struct ``row`` with domain, language, source, n_tokens and epochs (1 or more).

    ``budget`` is in words, by default as many as there are. Each leaf takes whole epochs and then
    the longest prefix of the next one's seeded order that stays within its budget; documents with
    the same key (repeated rows) are taken or left together. Null levels are leaves of their own,
    a null or empty text has no tokens and comes along with its place in the order. No leaf is
    gathered anywhere: the end of a prefix is found from sums over 65,536 ranges of the order,
    then within one such range.
    """
    rows = _placed(documents, tree)
    sums = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n")).limit(MOST_LEAVES + 1).collect()
    if len(sums) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves")
    supply = {tuple(r[name] for name in LEVELS): r["n"] for r in sums}
    total = sum(supply.values()) if budget is None else budget
    shares = leaf_budgets(supply, tree, total, max_epochs)
    # (levels, whole epochs, tokens of the next one); a leaf without tokens takes no epoch.
    plan = [(*leaf, min(n // supply[leaf], max_epochs) if supply[leaf] else 0, n % supply[leaf] if supply[leaf] else 0) for leaf, n in shares.items()]
    slim = rows.withColumn("row", F.struct(F.col("row.doc_id").alias("doc_id")))
    partial = _with_plan(slim, [p for p in plan if p[-1]], "full bigint, rest bigint")
    keyed = partial.select(*LEVELS, "rest", "full", "n_tokens", _key(seed, F.col("full")).alias("key"))
    ranged = keyed.withColumn("part", F.substring("key", 1, 4))
    parts = ranged.groupBy(*LEVELS, "rest", "part").agg(F.sum("n_tokens").alias("n"))
    # At most 65,536 rows per leaf.
    before = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    reach = parts.withColumn("before", F.coalesce(before, F.lit(0))).where("before + n > rest AND before <= rest")
    ends = reach.groupBy(*LEVELS).agg(F.min(F.struct("part", "before")).alias("end")).collect()
    end_of = {tuple(r[name] for name in LEVELS): (r["end"]["part"], r["end"]["before"]) for r in ends}
    cut = [(*p, *end_of[p[: len(LEVELS)]]) for p in plan if p[-1] and p[: len(LEVELS)] in end_of]
    last = _with_plan(slim, cut, "full bigint, rest bigint, part string, before bigint").withColumn("key", _key(seed, F.col("full")))
    within = last.where(F.substring("key", 1, 4) == F.col("part"))
    running = F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, 0))
    taken = within.withColumn("sum", F.col("before") + running).where("sum <= rest")
    keys = {tuple(r[name] for name in LEVELS): r["key"] for r in taken.groupBy(*LEVELS).agg(F.max("key").alias("key")).collect()}
    # Everything up to the last key taken, else all of the ranges before the one that is cut.
    final = [(*p[:-1], keys.get(p[: len(LEVELS)]) or end_of.get(p[: len(LEVELS)], ("",))[0] if p[-1] else "") for p in plan]
    chosen = _with_plan(rows, final, "full bigint, last string")
    epochs = F.col("full") + F.when((F.col("last") != "") & (_key(seed, F.col("full")) <= F.col("last")), 1).otherwise(0)
    return chosen.withColumn("epochs", epochs.cast("int")).where("epochs > 0").drop("full", "last")


def mixed_documents(documents: DataFrame, tree: Tree, budget: int | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The columns of the documents, one row for each epoch that takes a document."""
    chosen = select_mixture(documents, tree, budget, max_epochs, seed)
    each = chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("_epoch"))
    return each.select(*[F.col(f"row.{c}").alias(c) for c in documents.columns])

"""Positions and running sums over a whole ordered table, in two levels: blocks, then rows within a block.

The table is dealt into ranges of its order and written once; each range is a block. What lies before a
block is known from one small row per block, so no task ever sees more rows than a block has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairtally.storage import written

# monotonically_increasing_id puts the partition above these bits and the row within it below.
ROW_BITS = 33
BLOCK, TIE, MARK = "__block", "__tie", "__mark"


def _sorted_blocks(rows: DataFrame, order: list[Column], blocks: int | None) -> DataFrame:
    """The rows in blocks, written once, with their block and their mark, which rises along the order.

    Rows equal in ``order`` keep the order in which they are read; that order being the last key,
    very many equal rows are dealt to several blocks too.
    """
    marked = rows.withColumn(TIE, F.monotonically_increasing_id())
    keys = [*order, F.col(TIE)]
    n = blocks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = marked.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    table = written(ranges.drop(TIE).withColumn(MARK, F.monotonically_increasing_id()), "blocks")
    return table.withColumn(BLOCK, F.shiftright(MARK, ROW_BITS))


def _before(table: DataFrame, **sums: Column) -> DataFrame:
    """(block, <names>): the sums of all earlier blocks. One row per block passes the driver."""
    totals = sorted(table.groupBy(BLOCK).agg(*[v.alias(k) for k, v in sums.items()]).collect())
    kinds = {f.name: f.dataType.simpleString() for f in table.groupBy().agg(*[v.alias(k) for k, v in sums.items()]).schema}
    rows, running = [], dict.fromkeys(sums)
    for total in totals:
        rows.append((total[BLOCK], *running.values()))
        for k in sums:
            if total[k] is not None:
                running[k] = total[k] if running[k] is None else running[k] + total[k]
    schema = ", ".join([f"{BLOCK} bigint", *[f"`{k}` {kind}" for k, kind in kinds.items()]])
    return F.broadcast(table.sparkSession.createDataFrame(rows, schema))


def numbered(rows: DataFrame, *order: Column, place: str = "place", blocks: int | None = None) -> DataFrame:
    """The rows with their position from 0 in ``order`` over the whole table (``place bigint``).

    One shuffle by ranges, no window, no task with all rows. Null keys come where ``order`` puts
    them; equal rows are numbered as they are read; an empty table stays empty.
    """
    table = _sorted_blocks(rows, list(order), blocks)
    before = _before(table, __rows=F.count(F.lit(1)))
    own = F.col(MARK).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = table.join(before, BLOCK)
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], (F.coalesce("__rows", F.lit(0)) + own).alias(place))


def running_sums(
    rows: DataFrame, sums: dict[str, Column], *order: Column, place: str = "place", blocks: int | None = None
) -> DataFrame:
    """The rows with ``place`` and, per entry of ``sums``, the sum of it up to and with the row.

    As SQL's sum over all rows up to the current one, but the window spans one block only and the
    blocks before it are added as one number. Null values add nothing; before the first value the sum
    is null. Sums of doubles are added in another order than row by row.
    """
    named = rows.select("*", *[v.alias(f"__v_{k}") for k, v in sums.items()])
    table = _sorted_blocks(named, list(order), blocks)
    before = _before(table, __rows=F.count(F.lit(1)), **{f"__b_{k}": F.sum(f"__v_{k}") for k in sums})
    upto = Window.partitionBy(BLOCK).orderBy(MARK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = table.select("*", *[F.sum(f"__v_{k}").over(upto).alias(f"__w_{k}") for k in sums]).join(before, BLOCK)
    own = F.col(MARK).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    total = {k: F.coalesce(F.col(f"__b_{k}") + F.col(f"__w_{k}"), F.col(f"__b_{k}"), F.col(f"__w_{k}")) for k in sums}
    return within.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        (F.coalesce("__rows", F.lit(0)) + own).alias(place),
        *[v.alias(k) for k, v in total.items()],
    )


def prefix_reaching(rows: DataFrame, weight: Column, threshold: int, *order: Column, blocks: int | None = None) -> DataFrame:
    """The shortest prefix of the ordered rows whose weights add up to ``threshold``, all rows if they don't.

    Weights are integers of at least 0, nulls count as 0. Adds ``place`` and ``running``, the sum up to
    and with the row.
    """
    if threshold < 1:
        raise ValueError("threshold must be positive")
    w = F.coalesce(weight.cast("bigint"), F.lit(0))
    w = F.when(w >= 0, w).otherwise(F.raise_error(F.lit("negative weight")).cast("bigint"))
    summed = running_sums(rows.withColumn("__weight", w), {"running": F.col("__weight")}, *order, blocks=blocks)
    return summed.where(F.col("running") - F.col("__weight") < threshold).drop("__weight")

"""Nearest centers out of a table that need not fit a driver or an executor.

The table is written once, in blocks of neighbours with the box that each fills. A task holds a slice of
its points and streams the blocks past it, so a center array never is part of a plan or a function, and no
point is copied per block. Points meet only blocks whose box is as near as what they have found already.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.functions.batches import BAD_POINT, coordinates
from fairtally.storage import scratch_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Centers of a block, and points that are compared with the blocks at a time, or more if they have few coordinates.
BLOCK, SLICE = 4096, 65_536
SLICE_VALUES = 1 << 19
#: Neighbouring points that choose their blocks together, and the pairs of such groups and blocks that a task looks at.
GROUP, GROUP_PAIRS = 128, 1 << 22
#: Coordinates of the centers that one task puts into blocks.
PART_VALUES = 1 << 21
PAIRS = 1 << 17

BLOCKED = "low array<double>, high array<double>, ids array<bigint>, centers array<double>"


def _tiles(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Positions of the points (d x n) in tiles of at most ``most`` neighbours: halves along the widest coordinate."""
    done, left = [], [np.arange(x.shape[1])]
    while left:
        part = left.pop()
        if len(part) <= most:
            done.append(part)
            continue
        own, half = x[:, part], len(part) // 2
        by = np.argpartition(own[(own.max(axis=1) - own.min(axis=1)).argmax()], half)
        left += [part[by[half:]], part[by[:half]]]
    return done


def _in_blocks(d: int, block: int):
    """A mapInArrow function: a task's centers as blocks, one per row; the ids of a block ascend."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        x, ids = coordinates([table.column("center")], d), table.column("cluster_id").to_numpy()
        if np.isnan(x).any():
            raise ValueError(BAD_POINT)
        tiles, step = _tiles(x, block), max(1, PART_VALUES // (8 * block * d))
        for start in range(0, len(tiles), step):
            some = [t[np.argsort(ids[t])] for t in tiles[start : start + step]]
            values = [x[:, t] for t in some]
            columns = {
                "low": [v.min(axis=1) for v in values],
                "high": [v.max(axis=1) for v in values],
                "ids": [ids[t] for t in some],
                "centers": [v.T.ravel() for v in values],
            }
            kinds = {"ids": pa.int64()}
            yield pa.record_batch({k: pa.array(v, pa.list_(kinds.get(k, pa.float64()))) for k, v in columns.items()})

    return run


def _read(path: str, rows: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of all files below a path, in one order."""
    files, folder = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    for info in sorted(files.get_file_info(pafs.FileSelector(folder)), key=lambda f: f.path):
        if info.base_name.startswith(("_", ".")):
            continue
        with files.open_input_file(info.path) as source:
            yield from pq.ParquetFile(source).iter_batches(batch_size=rows, columns=columns)


def _boxes(path: str, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest coordinates (d x blocks) of each block."""
    low, high = zip(*[[coordinates([b.column(c)], d) for c in ("low", "high")] for b in _read(path, 4096, ["low", "high"]) if b.num_rows])
    return np.concatenate(low, axis=1), np.concatenate(high, axis=1)


def _blocks(path: str, d: int, block: int, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, ids, centers) of the wanted blocks."""
    number = 0
    for batch in _read(path, max(1, PART_VALUES // (8 * block * d)), ["ids", "centers"]):
        for i in np.flatnonzero(wanted[number : number + batch.num_rows]).tolist():
            ids, centers = (batch.column(c)[i].values.to_numpy() for c in ("ids", "centers"))
            yield number + i, ids, centers.reshape(-1, d)
        number += batch.num_rows


def _apart(low: np.ndarray, high: np.ndarray, box_low: np.ndarray, box_high: np.ndarray) -> np.ndarray:
    """Squared distances (n x m) between n and m boxes, given by their least and largest coordinates (d x n, d x m).

    Summed coordinate by coordinate like those of points, so no rounding makes one larger than that of two points within.
    """
    total = np.zeros((low.shape[1], box_low.shape[1]))
    for a, b, c, e in zip(low, high, box_low, box_high):
        gap = np.maximum(c[None, :] - b[:, None], a[:, None] - e[None, :])
        np.maximum(gap, 0, out=gap)
        total += gap * gap
    return total


def _nearer(x: np.ndarray, ids: np.ndarray, centers: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
    """Lowers (distance, id) of the points (d x n) by one block.

    A product of matrices tells which centers can be nearest, up to its rounding; for those the
    distance is summed coordinate by coordinate, as everywhere else, so ties are the same.
    """
    norms, step = (centers**2).sum(axis=1), max(1, PAIRS // len(ids))
    for a in range(0, x.shape[1], step):
        part = x[:, a : a + step]
        own = (part**2).sum(axis=0)
        rough = own[:, None] + norms[None, :] - 2 * (part.T @ centers.T)
        error = 1e-12 * (own + norms.max())
        bound = np.minimum(rough.min(axis=1) + error, best[a : a + step] + error)
        point, center = np.nonzero(rough <= (bound + error)[:, None])
        dist = np.zeros(len(point))
        for column, value in zip(part, centers.T):
            dist += (column[point] - value[center]) ** 2
        order = np.lexsort((ids[center], dist, point))
        first = order[np.unique(point[order], return_index=True)[1]]
        at, d, i = point[first] + a, dist[first], ids[center[first]]
        closer = (d < best[at]) | ((d == best[at]) & (i < index[at]))
        best[at[closer]], index[at[closer]] = d[closer], i[closer]


def _search(x: np.ndarray, low: np.ndarray, high: np.ndarray, blocks) -> tuple[np.ndarray, np.ndarray]:
    """(id, distance) of the center nearest to each of the points (d x n).

    ``low`` and ``high`` are the boxes of the blocks; ``blocks`` gives (number, ids, centers) of those wanted. Each
    group of neighbouring points first meets the block nearest to its middle, then its points meet every
    other block whose box is not farther than the nearest center by then.
    """
    n, m = x.shape[1], low.shape[1]
    tiles = _tiles(x, max(GROUP, -(-n * m // GROUP_PAIRS)))
    order, sizes = np.concatenate(tiles), np.array([len(t) for t in tiles])
    starts = np.cumsum(sizes) - sizes
    x = x[:, order]
    least, most = np.minimum.reduceat(x, starts, axis=1), np.maximum.reduceat(x, starts, axis=1)
    # The points of each group; shorter groups name their last one again.
    points = starts[:, None] + np.minimum(np.arange(sizes.max()), sizes[:, None] - 1)
    best, index = np.full(n, np.inf), np.full(n, np.iinfo(np.int64).max)

    def meet(at: np.ndarray, ids: np.ndarray, centers: np.ndarray) -> None:
        own_best, own_index = best[at], index[at]
        _nearer(x[:, at], ids, centers, own_best, own_index)
        best[at], index[at] = own_best, own_index

    middle = least / 2 + most / 2
    home = _apart(middle, middle, low, high).argmin(axis=1)
    for number, ids, centers in blocks(np.bincount(home, minlength=m) > 0):
        meet(points[home == number].ravel(), ids, centers)
    near = _apart(low, high, least, most) <= np.maximum.reduceat(best, starts)
    near[home, np.arange(len(tiles))] = False
    for number, ids, centers in blocks(near.any(axis=1)):
        at = points[near[number]].ravel()
        box = slice(number, number + 1)
        at = at[_apart(x[:, at], x[:, at], low[:, box], high[:, box])[:, 0] <= best[at]]
        if len(at):
            meet(at, ids, centers)
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return index[back], best[back]


def _compare(path: str, features: str, d: int, block: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = []

        def result(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            x = coordinates([table.column(features)], d)
            if not np.isfinite(x).all():
                raise ValueError(BAD_POINT)
            boxes.extend([] if boxes else _boxes(path, d))
            index, best = _search(x, *boxes, lambda wanted: _blocks(path, d, block, wanted))
            found = pa.table({"row": table.column("row"), "cluster_id": pa.array(index), "dist": pa.array(best)})
            yield from found.to_batches(max_chunksize=10_000)

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                yield from result(held)
                held, n = [], 0
        if n:
            yield from result(held)

    return run


def nearest_in_table(
    points: DataFrame, centers: DataFrame, dim: int, features: str = "features", block: int = BLOCK, size: int | None = None
) -> DataFrame:
    """All columns of ``points`` with ``cluster_id bigint`` and ``dist`` of the nearest row of ``centers``.

    ``centers`` has (cluster_id, center); ids are unique and may have gaps; of equally near centers the
    lowest id wins, as in ``with_nearest``. Malformed points and centers raise, an empty table of
    centers too. Each task reads the table twice per ``size`` points, and holds the box of each block.
    """
    spark = points.sparkSession
    path, blocks = scratch_dir(spark, "centers"), scratch_dir(spark, "center-blocks")
    table = centers.select(F.col("cluster_id").cast("bigint").alias("cluster_id"), F.col("center").cast("array<double>").alias("center"))
    table.write.parquet(path)
    table = spark.read.parquet(path)
    count = table.count()
    if not count:
        raise ValueError("no centers")
    # Of equal centers only the lowest id can win. Ranges of the coordinates keep neighbours in one task.
    unequal = table.groupBy("center").agg(F.min("cluster_id").alias("cluster_id"), F.count_if(F.col("cluster_id").isNull()).alias("nulls"))
    no_id = F.raise_error(F.lit("center without an id")).cast("bigint")
    unequal = unequal.select("center", F.when(F.col("nulls") == 0, F.col("cluster_id")).otherwise(no_id).alias("cluster_id"))
    parts = unequal.repartitionByRange(max(1, -(-count * dim // PART_VALUES)), "center")
    parts.mapInArrow(_in_blocks(dim, block), BLOCKED).write.parquet(blocks)
    rows = points.select(F.struct("*").alias("row"), F.col(features).cast("array<double>").alias("_x"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, cluster_id bigint, dist double"
    found = rows.mapInArrow(_compare(blocks, "_x", dim, block, size or max(SLICE, SLICE_VALUES // dim)), schema)
    return found.select("row.*", "cluster_id", "dist")

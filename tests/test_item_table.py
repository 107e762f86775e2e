"""The replayable item source: offsets, restarts in mid-table, bounded batches."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fairtally.sources.item_table import BEGIN, ItemTableReader, table_items
from fairtally.streaming import running


def write_table(spark, path, n, files, start=0, mode="errorifexists"):
    spark.range(start, start + n).select((F.col("id") % 13).alias("item"), "id").repartitionByRange(files, "id").write.mode(mode).parquet(path)


def reader(path, **options):
    return ItemTableReader({"path": path, "column": "id"} | options)


def ids(source, start, end):
    return [x for p in source.partitions(start, end) for b in source.read(p) for x in b.column(0).to_pylist()]


def test_offsets_cover_all_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark, path, 1000, 3)
    source = reader(path, rowsPerTrigger="170", rowsPerPartition="64")
    at, seen, sizes = source.initialOffset(), [], []
    while (end := source.latestOffset()) != at:
        assert source.latestOffset() == end  # asked again before it is planned
        parts = source.partitions(at, end)
        assert all(0 < p.stop - p.start <= 64 for p in parts)
        rows = ids(source, at, end)
        assert rows == ids(source, at, end)  # replay
        seen += rows
        sizes.append(len(rows))
        at = end
    assert sorted(seen) == list(range(1000)) and sizes == [170] * 5 + [150]
    assert source.partitions(at, at) == []


def test_later_files_go_on(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark, f"{path}/batch=0", 50, 2)
    source = reader(path, rowsPerTrigger="1000")
    first = source.latestOffset()
    assert len(ids(source, source.initialOffset(), first)) == 50
    write_table(spark, f"{path}/batch=1", 30, 1, start=50)
    assert sorted(ids(source, first, source.latestOffset())) == list(range(50, 80))


def test_gone_file_and_wrong_order_raise(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark, path, 20, 1)
    source = reader(path, rowsPerTrigger="10")
    end = source.latestOffset()
    with pytest.raises(ValueError, match="go back"):
        source.partitions(end, source.initialOffset())
    with pytest.raises(FileNotFoundError):
        source.partitions(end | {"file": "zz"}, end | {"file": "zzz"})
    with pytest.raises(ValueError):
        reader(path, rowsPerTrigger="0")
    assert reader(str(tmp_path / "none")).latestOffset()["file"] == BEGIN[0]


def run(spark, tmp_path, rows, out="freq"):
    items = table_items(spark, str(tmp_path / "t"), str(tmp_path / "ck"), rows_per_trigger=rows, rows_per_partition=100)
    query = running.start_frequencies(items, str(tmp_path / out), str(tmp_path / "ck"), availableNow=True)
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_query_restarts_in_mid_table(spark, tmp_path):
    write_table(spark, str(tmp_path / "t"), 1000, 3)
    done = []
    for rows in (300, 450, 300, 300):  # the bound may change between runs
        done += run(spark, tmp_path, rows)
        total = min(1000, sum((300, 450, 300, 300)[: len(done)]))
        counts = dict(map(tuple, running.read_frequencies(spark, str(tmp_path / "freq")).collect()))
        assert sum(counts.values()) == total
    assert done == [300, 450, 250]
    assert counts == dict(Counter(i % 13 for i in range(1000)))


def test_failed_batch_is_read_again(spark, tmp_path, monkeypatch):
    write_table(spark, str(tmp_path / "t"), 600, 2)
    run(spark, tmp_path, 200)
    write = running.write_batch
    monkeypatch.setattr(running, "write_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, 200)
    monkeypatch.setattr(running, "write_batch", write)
    for _ in range(3):
        run(spark, tmp_path, 200)
    counts = dict(map(tuple, running.read_frequencies(spark, str(tmp_path / "freq")).collect()))
    assert counts == dict(Counter(i % 13 for i in range(600)))


def test_continuous_query_runs_several_bounded_batches(spark, tmp_path):
    write_table(spark, str(tmp_path / "t"), 900, 3)
    items = table_items(spark, str(tmp_path / "t"), str(tmp_path / "ck"), rows_per_trigger=250)
    query = running.start_frequencies(items, str(tmp_path / "freq"), str(tmp_path / "ck"), processingTime="0 seconds")
    try:
        query.processAllAvailable()
        sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert sizes == [250, 250, 250, 150]

from __future__ import annotations

from collections import Counter

import pytest

from fairtally import HashFamily, build_sketch, file_items, item_frequencies, sketch_report, socket_items
from fairtally.streaming import prefix, running, tables
from helpers import sketch_tables

H3 = HashFamily(width=16, a=(17, 101, 2003), b=(5, 42, 1234), sign_a=(3, 7, 11), sign_b=(1, 0, 5))


def batch_items(i):
    return [(i * 37 + j * j) % 23 for j in range(200)]


def deliver(spark, folder, i):
    """One batch, as several files, arrives as a whole."""
    rows = [(str(x),) for x in batch_items(i)]
    spark.createDataFrame(rows, "value string").repartition(2).write.mode("append").text(folder)


def run_batches(spark, tmp_path, threshold, batches):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in batches:
        deliver(spark, folder, i)
        stream = prefix.start_prefix_stream(
            file_items(spark, folder), H3, threshold, out, str(tmp_path / "ck"), availableNow=True
        )
        stream.query.awaitTermination()
    return out


def check_prefix(spark, out, threshold, accepted):
    want = Counter(x for i in accepted for x in batch_items(i))
    assert dict(prefix.prefix_frequencies(spark, out, threshold).collect()) == dict(want)
    cm, cs = sketch_tables(list(want.elements()), H3)
    got = {(r.r, r.c): (r.cm, r.cs) for r in prefix.prefix_sketch(spark, out, threshold, H3).cells.collect()}
    assert got == {key: (cm[key], cs[key]) for key in cm}


def test_whole_batches_until_the_threshold(spark, tmp_path):
    out = run_batches(spark, tmp_path, 500, range(5))
    lengths = prefix.batch_lengths(spark, out)
    assert {r.batch_id: r.before for r in prefix.accepted_batches(lengths, 500).collect()} == {0: 0, 1: 200, 2: 400}
    check_prefix(spark, out, 500, range(3))
    # The same tables answer for any lower threshold.
    check_prefix(spark, out, 200, range(1))
    row = prefix.prefix_report(spark, out, 500, H3, 3).first()
    df = spark.createDataFrame([(x,) for i in range(3) for x in batch_items(i)], "item bigint")
    assert row == sketch_report(item_frequencies(df), build_sketch(df, H3), 3).first()
    with pytest.raises(ValueError):
        prefix.accepted_batches(lengths, 0)


def test_failure_between_the_two_writes(spark, tmp_path, monkeypatch):
    run_batches(spark, tmp_path, 500, [0])
    write, failed = prefix.write_batch, []

    def failing(rows, table, batch_id):
        if table.endswith("cells") and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")
        return write(rows, table, batch_id)

    monkeypatch.setattr(prefix, "write_batch", failing)
    with pytest.raises(Exception, match="lost"):
        run_batches(spark, tmp_path, 500, [1])
    assert failed == [1]
    monkeypatch.setattr(prefix, "write_batch", write)
    # The restart repeats batch 1; batch 2 arrives with it and becomes its own batch.
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    prefix.start_prefix_stream(
        file_items(spark, folder), H3, 500, out, str(tmp_path / "ck"), availableNow=True
    ).query.awaitTermination()
    run_batches(spark, tmp_path, 500, [2, 3])
    check_prefix(spark, out, 500, range(3))


def test_stop_at_threshold_ends_an_endless_query(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        deliver(spark, folder, i)
    items = file_items(spark, folder, max_files_per_trigger=2)
    stream = prefix.start_prefix_stream(items, H3, 300, out, str(tmp_path / "ck"))
    stream.await_threshold()
    assert stream.reached and not stream.query.isActive
    total = sum(r.n for r in prefix.accepted_batches(prefix.batch_lengths(spark, out), 300).collect())
    assert 300 <= total <= 600


def test_nothing_arrived_yet(spark, tmp_path):
    out = str(tmp_path / "out")
    assert prefix.prefix_frequencies(spark, out, 5).collect() == []
    row = prefix.prefix_report(spark, out, 5, H3, 2).first()
    assert (row.n, row.n_distinct, row.n_topk) == (0, 0, 0)


def test_running_state_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    for i in range(2):
        deliver(spark, folder, i)
        for start, name, extra in (
            (running.start_frequencies, "freq", ()),
            (running.start_sketch, "cells", (H3,)),
        ):
            start(
                file_items(spark, folder), *extra, str(tmp_path / name), str(tmp_path / f"ck-{name}"), availableNow=True
            ).awaitTermination()
    everything = batch_items(0) + batch_items(1)
    assert dict(running.read_frequencies(spark, str(tmp_path / "freq")).collect()) == dict(Counter(everything))
    cm, cs = sketch_tables(everything, H3)
    got = {(r.r, r.c): (r.cm, r.cs) for r in running.read_sketch(spark, str(tmp_path / "cells"), H3).cells.collect()}
    assert got == {key: (cm[key], cs[key]) for key in cm}


def test_writing_a_batch_twice_replaces_it(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 5)], "item bigint, cnt bigint")
    for _ in range(2):
        tables.write_batch(rows, table, 3)
    assert [tuple(r) for r in tables.read_batches(spark, table, running.FREQ_SCHEMA).collect()] == [(1, 5, 3)]


def test_socket_source_is_a_stream_of_items(spark):
    items = socket_items(spark, "localhost", 9999)  # nothing connects before the query starts
    assert items.isStreaming and items.dtypes == [("item", "bigint")]


def files_of(path):
    return [p for p in path.rglob("part-*") if ".crc" not in p.name]


FREQ = "item bigint, cnt bigint"


def put(spark, table, batch_id, rows):
    return tables.write_batch(spark.createDataFrame(rows, FREQ), table, batch_id)


def latest(spark, table):
    return dict(map(tuple, running.read_frequencies(spark, table).collect()))


def test_few_files_and_compaction(spark, tmp_path):
    table = f"{tmp_path}/t"
    for b in range(5):
        rows = spark.createDataFrame([(i, 10 * b + i) for i in range(b, 60)], FREQ).repartition(40)
        tables.write_batch(rows, table, b)
        assert len(files_of(tmp_path / f"t/batch_id={b}")) <= 2
    before = latest(spark, table)
    assert before == {i: 10 * min(i, 4) + i for i in range(60)}
    assert running.compact_frequencies(spark, table) == 3
    assert sorted(tables.read_listing(spark, table).live) == [3, 4]
    assert latest(spark, table) == before
    assert len(tables.vacuum(spark, table, 0)) == 4
    assert sorted(p.name for p in (tmp_path / "t").glob("batch_id=*")) == ["batch_id=3", "batch_id=4"]
    # The newest batch may run again, and more may follow.
    put(spark, table, 4, [(0, 999)])
    put(spark, table, 5, [(1, 7)])
    after = latest(spark, table)
    assert (after[0], after[1], after[59]) == (999, 7, 89)
    assert running.compact_frequencies(spark, table) == 4
    assert latest(spark, table) == after
    tables.vacuum(spark, table, 0)
    assert latest(spark, table) == after and tables.vacuum(spark, table, 0) == []


@pytest.mark.parametrize("between", ["listing and batches", "plan and rows"])
def test_reader_beside_the_first_compaction_gets_all_rows(spark, tmp_path, monkeypatch, between):
    table = f"{tmp_path}/t"
    for b in range(4):
        put(spark, table, b, [(b, 10 + b)])
    want = {b: 10 + b for b in range(4)}
    if between == "listing and batches":
        listing = tables.read_listing

        def slow(*args):
            found = listing(*args)
            monkeypatch.setattr(tables, "read_listing", listing)
            assert running.compact_frequencies(spark, table) == 2
            return found

        monkeypatch.setattr(tables, "read_listing", slow)
        reader = running.read_frequencies(spark, table)
    else:
        reader = running.read_frequencies(spark, table)
        assert running.compact_frequencies(spark, table) == 2
    put(spark, table, 4, [(0, 99)])
    assert dict(map(tuple, reader.collect())) == want
    late = running.read_frequencies(spark, table)
    assert dict(map(tuple, late.collect())) == want | {0: 99}
    # Folders that went too early are an error, not fewer rows.
    stale = running.read_frequencies(spark, table)
    running.compact_frequencies(spark, table)
    tables.vacuum(spark, table, 0)
    with pytest.raises(Exception, match="(?i)not.?exist|not found"):
        stale.collect()


def test_rewrite_of_a_folded_batch_wins_over_the_fold(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/t"
    for b in range(4):
        put(spark, table, b, [(b, b)])
    write = tables._write

    def slow(rows, where, batch_id):
        folder = write(rows, where, batch_id)
        monkeypatch.setattr(tables, "_write", write)
        put(spark, table, 1, [(1, 50)])
        return folder

    monkeypatch.setattr(tables, "_write", slow)
    assert running.compact_frequencies(spark, table) is None
    assert latest(spark, table) == {0: 0, 1: 50, 2: 2, 3: 3}
    assert running.compact_frequencies(spark, table) == 2
    assert latest(spark, table) == {0: 0, 1: 50, 2: 2, 3: 3}
    assert len(tables.vacuum(spark, table, 0)) == 5  # three folded, one replaced, one never counted


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    """The slower one starts again from the version of the faster."""
    table = f"{tmp_path}/t"
    put(spark, table, 0, [(0, 0)])
    files, beaten = tables.Files.put, []

    def beat(self, name, text):
        if not beaten:
            beaten.append(name)
            put(spark, table, 7, [(7, 7)])
        files(self, name, text)

    monkeypatch.setattr(tables.Files, "put", beat)
    put(spark, table, 1, [(1, 1)])
    assert latest(spark, table) == {0: 0, 1: 1, 7: 7}
    assert tables.read_listing(spark, table).number == 2


def test_write_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/t"
    for b in range(4):
        put(spark, table, b, [(b, b), (9, b)])
    before, old = latest(spark, table), tables.read_listing(spark, table)
    with monkeypatch.context() as m:
        m.setattr(tables.Files, "put", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            running.compact_frequencies(spark, table)
    assert latest(spark, table) == before and tables.read_listing(spark, table) == old
    # A try that was not listed goes with the next vacuum, not before its delay.
    assert tables.vacuum(spark, table) == [] and len(tables.vacuum(spark, table, 0)) == 1
    assert running.compact_frequencies(spark, table) == 2
    assert latest(spark, table) == before


def test_old_lists_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "KEEP_LISTS", 3)
    table = f"{tmp_path}/t"
    for b in range(6):
        put(spark, table, b, [(b, b)])
    assert len([p for p in (tmp_path / "t/_lists").iterdir() if p.name.isdigit()]) == 3
    assert latest(spark, table) == {b: b for b in range(6)}


def test_arrived_counts_a_repeated_batch_once():
    arrived = prefix.Arrived()
    arrived.add(0, 10)
    arrived.add(1, 5)
    arrived.add(1, 5)
    assert (arrived.before(1), arrived.before(2), arrived.total) == (10, 15, 15)

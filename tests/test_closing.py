"""The stop inside the state gives the rows of the table form, after failures and restarts too."""

from collections import Counter

import pytest

from fairtally.sources.items import file_items
from fairtally.streaming import closing


def batch_items(i):
    return [(i * 31 + j * j) % 17 for j in range(100)]


def deliver(spark, folder, i):
    spark.createDataFrame([(str(x),) for x in batch_items(i)], "value string").repartition(2).write.mode("append").text(folder)


def run(spark, tmp_path, threshold, batches):
    for i in batches:
        deliver(spark, str(tmp_path / "in"), i)
        query = closing.start_until(
            file_items(spark, str(tmp_path / "in")), threshold, str(tmp_path / "out"), str(tmp_path / "ck"), availableNow=True
        )
        query.awaitTermination()


def counts(spark, tmp_path):
    return dict(map(tuple, closing.read_until(spark, str(tmp_path / "out")).collect()))


@pytest.mark.parametrize("threshold, accepted", [(250, 3), (200, 2)])
def test_whole_batches_until_the_threshold(spark, tmp_path, threshold, accepted):
    # Every batch is a query of its own: the state comes back from the checkpoint each time.
    run(spark, tmp_path, threshold, range(4))
    assert counts(spark, tmp_path) == dict(Counter(x for i in range(accepted) for x in batch_items(i)))


def test_failed_write_runs_again(spark, tmp_path, monkeypatch):
    run(spark, tmp_path, 150, [0])
    write = closing.write_batch
    monkeypatch.setattr(closing, "write_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, 150, [1])
    monkeypatch.setattr(closing, "write_batch", write)
    run(spark, tmp_path, 150, [2])
    assert counts(spark, tmp_path) == dict(Counter(batch_items(0) + batch_items(1)))


def test_nothing_yet_and_bad_threshold(spark, tmp_path):
    assert closing.read_until(spark, str(tmp_path / "out")).collect() == []
    with pytest.raises(ValueError):
        closing.start_until(file_items(spark, str(tmp_path)), 0, "t", "c")

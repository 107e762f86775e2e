"""A fair k-means run that was stopped goes on from its log."""

import random

import numpy as np
import pytest

from fairtally.operators import fair
from fairtally.operators.rounds import Round, RoundLog

SCHEMA = "features array<double>, grp string"


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(6)
    rows = [([rng.gauss(10 * (i % 3), 2), rng.gauss(0, 2)], "A" if rng.random() < 0.7 else "B") for i in range(600)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1).persist()


def test_stopped_run_ends_bit_equal(spark, points, tmp_path, monkeypatch):
    whole = fair.fair_kmeans(points, 3, 5, seed=2)
    step, calls = fair.fair_step, []

    def failing(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return step(*args)

    monkeypatch.setattr(fair, "fair_step", failing)
    with pytest.raises(RuntimeError, match="lost"):
        fair.fair_kmeans(points, 3, 5, seed=2, log=str(tmp_path / "log"))
    assert len(calls) == 3
    again = fair.fair_kmeans(points, 3, 5, seed=2, log=str(tmp_path / "log"))
    assert len(calls) == 6 and np.array_equal(again, whole)  # rounds 3 to 5 only
    assert np.array_equal(fair.fair_kmeans(points, 3, 5, seed=2, log=str(tmp_path / "log")), whole) and len(calls) == 6
    log = sorted(p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith("."))
    assert log == ["job", *[f"round-{i:06d}" for i in range(6)]]
    # Fewer or more rounds of the same job use it too.
    monkeypatch.setattr(fair, "fair_step", step)
    assert np.array_equal(fair.fair_kmeans(points, 3, 2, seed=2, log=str(tmp_path / "log")), fair.fair_kmeans(points, 3, 2, seed=2))


def test_another_job_is_refused(spark, points, tmp_path):
    fair.fair_kmeans(points, 3, 1, init=[[0, 0], [10, 0], [20, 0]], log=str(tmp_path))
    with pytest.raises(ValueError, match="another job"):
        fair.fair_kmeans(points, 3, 1, init=[[0, 0], [10, 0], [20, 1]], log=str(tmp_path))


def test_rounds_are_exact_and_written_once(spark, tmp_path):
    log = RoundLog(spark, str(tmp_path), {"k": 1})
    assert log.last(9) is None
    c = np.array([[0.1 + 0.2, 1e-310, -0.0]])
    log.append(Round(4, c, {"gamma": 1 / 3}))
    log.append(Round(4, c + 1))
    found = RoundLog(spark, str(tmp_path), {"k": 1}).last(9)
    assert found.number == 4 and found.centers.tobytes() == c.tobytes() and found.facts == {"gamma": 1 / 3}
    assert log.last(3) is None

"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, connect
from fairtally.storage import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
# Queries of the corpus operators have their own tests beside them.
OWN = [name for name in queries() if not name.startswith("op") and name != "pipeline"]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(OWN) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, name):
    same, n, detail = compare(spark, con, name, SF_DIR)
    assert n > 0
    assert same is True, detail


def test_entry(spark):
    assert entry(spark).columns == ["cluster_id", "na", "nb"]
    assert entry(spark).count() == 4


def test_scratch_follows_the_session(spark):
    old = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if old:
        assert first.startswith(old)

"""Rejected lines: parsed and rejected make up what was read, with reason and place."""

import pytest

from fairtally.sources.checked import read_items_checked, read_points_checked
from fairtally.sources.items import parse_items
from fairtally.sources.points import parse_points

LINES = ["1,2,A", "x,2,A", "", "1,2", "1,nan,B", "3,4,B,", "5,-6.5,B", "1e3,2,A", "1,,A", " 7,8,A"]


@pytest.mark.parametrize("dim", [2, None])
def test_points(spark, tmp_path, dim):
    for i in range(3):
        (tmp_path / f"f{i}.txt").write_text("\n".join(LINES[i:]) + "\n")
    found = read_points_checked(spark, str(tmp_path), dim)
    lines = spark.read.text(str(tmp_path))
    want = parse_points(lines, dim, "DROPMALFORMED")
    assert sorted(map(tuple, found.good.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert (found.n_read, found.n_good, found.n_rejected) == (27, want.count(), found.rejected.count())
    assert found.n_read == found.n_good + found.n_rejected == lines.count()
    for r in found.rejected.collect():
        first = int(r.file[-5])
        assert LINES[first:][r.line] == r.value and r.block_start == 0
    by_value = {r.value: r.reason for r in found.rejected.collect()}
    assert by_value["x,2,A"] == by_value["1,nan,B"] == "not a number"
    if dim:
        assert by_value["1,2"] == by_value[""] == "wrong number of fields"


def test_places_in_blocks(spark, tmp_path):
    text = "".join(f"{i},{i},A\n" if i % 50 else f"bad{i}\n" for i in range(5000))
    (tmp_path / "big.txt").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        found = read_points_checked(spark, str(tmp_path), 2)
        rows = found.rejected.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r.block_start for r in rows}) > 2 and found.n_rejected == 100 and found.n_read == 5000
    data = text.encode()
    for r in rows:
        start = 0 if r.block_start == 0 else data.index(b"\n", r.block_start) + 1
        assert data[start:].split(b"\n")[r.line].decode() == r.value


def test_items(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n+2\n-3\n 4\nfive\n\n9223372036854775808\n")
    found = read_items_checked(spark, str(tmp_path))
    assert sorted(r.item for r in found.good.collect()) == [-3, 1, 2]
    assert sorted((r.line, r.value, r.reason) for r in found.rejected.collect()) == [
        (3, " 4", "not an integer"), (4, "five", "not an integer"), (5, "", "not an integer"), (6, "9223372036854775808", "not an integer")
    ]
    good = spark.createDataFrame([("1",), ("+2",), ("-3",)], "value string")
    assert sorted(parse_items(good).collect()) == sorted(found.good.collect())


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    found = read_points_checked(spark, str(tmp_path), 2)
    assert (found.n_read, found.good.collect(), found.rejected.collect()) == (0, [], [])

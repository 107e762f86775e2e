from __future__ import annotations

import pytest

from fairtally import group_counts, parse_points, point_dimensions, read_lines, read_points, write_points
from fairtally.functions.text import fields, utf16_length
from helpers import points_frame
from pyspark.sql import functions as F


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize(
    "text, want",
    [
        ("", [""]),
        ("a  b  ", ["a", "", "b"]),
        ("   ", []),
        (" a", ["", "a"]),
        ("a\n b ", ["a\n", "b"]),
        ("one", ["one"]),
    ],
)
def test_fields_drop_only_trailing_empties(spark, text, want):
    assert lines(spark, text).select(fields(F.col("value"), " ")).first()[0] == want


def test_utf16_length_counts_surrogates(spark):
    assert lines(spark, "è😀a").select(utf16_length(F.col("value"))).first()[0] == 4


@pytest.mark.parametrize("dim", [2, None])
def test_parse_points(spark, dim):
    got = parse_points(lines(spark, "40.5,-74.25,B", "1e3, 2 ,xA"), dim).collect()
    assert [(r.features, r.grp) for r in got] == [([40.5, -74.25], "B"), ([1000.0, 2.0], "xA")]


def test_parse_keeps_other_columns_and_any_dimension(spark):
    frame = spark.createDataFrame([(1, "1,2,3,A"), (2, "5,B")], "id int, value string")
    got = {r.id: (r.features, r.grp) for r in parse_points(frame).collect()}
    assert got == {1: ([1.0, 2.0, 3.0], "A"), 2: ([5.0], "B")}


@pytest.mark.parametrize("dim", [2, None])
@pytest.mark.parametrize("bad", ["1,x,A", "NaN,2,A", ",2,A"])
def test_malformed_line_fails_or_is_left_out(spark, dim, bad):
    frame = lines(spark, "1,2,A", bad)
    with pytest.raises(Exception, match="malformed point"):
        parse_points(frame, dim).collect()
    assert parse_points(frame, dim, mode="DROPMALFORMED").count() == 1


def test_wrong_number_of_fields_is_malformed_for_known_dim(spark):
    with pytest.raises(Exception, match="malformed point"):
        parse_points(lines(spark, "1,A"), 2).collect()
    with pytest.raises(ValueError):
        parse_points(lines(spark, "1,A"), 2, mode="PERMISSIVE")


def test_blank_line_counts_as_point_of_no_group(spark):
    points = parse_points(lines(spark, "1,2,A", ""))
    assert tuple(group_counts(points).first()) == (2, 1, 0)
    assert tuple(point_dimensions(points).first()) == (0, 2)


def test_group_is_a_suffix(spark):
    points = points_frame(spark, [((0,), "A"), ((0,), "xA"), ((0,), "B"), ((0,), "P"), ((0,), "a")])
    assert tuple(group_counts(points).first()) == (5, 2, 1)
    with pytest.raises(ValueError):
        group_counts(points, ("A", "AA"))


def test_write_and_read(spark, tmp_path):
    path = str(tmp_path / "points")
    write_points(points_frame(spark, [((1.23456, -2), "A"), ((1000000.5, 0.0005), "B")]), path)
    assert sorted(r.value for r in read_lines(spark, path, partitions=3).collect()) == [
        "1.235,-2.000,A",
        "1000000.500,0.001,B",
    ]
    back = {r.grp: r.features for r in read_points(spark, path, dim=2).collect()}
    assert back == {"A": [1.235, -2.0], "B": [1000000.5, 0.001]}


def test_all_coordinates_are_written(spark, tmp_path):
    points = spark.createDataFrame([([1.0, 2.0, 3.0], "A"), ([5.0], "B"), ([], "C")], "place array<double>, side string")
    write_points(points, str(tmp_path / "p"), features="place", grp="side")
    back = {r.grp: list(r.features) for r in read_points(spark, str(tmp_path / "p")).collect()}
    assert back == {"A": [1.0, 2.0, 3.0], "B": [5.0], "C": []}


@pytest.mark.parametrize("row", [([1.0, 2.0], None), ([1.0, None], "A"), (None, "A")])
def test_missing_parts_raise(spark, tmp_path, row):
    points = spark.createDataFrame([row], "features array<double>, grp string")
    with pytest.raises(Exception, match="missing coordinate or label"):
        write_points(points, str(tmp_path / "p"))

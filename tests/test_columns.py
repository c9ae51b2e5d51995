import datetime

import pytest
from pyspark.sql import functions as F

from tamiz.functions.columns import (
    Roles,
    columns_except,
    drop_missing_rows,
    preview,
    select_except,
    standardise_types,
    table_shape,
)
from tamiz.functions.labels import class_counts, derive_label_map, drop_unknown_target, map_labels, unmap_labels
from tests.conftest import collected


def test_columns_except_keeps_order():
    assert columns_except(["c", "a", "b"], ["a", "z"]) == ["c", "b"]


def test_select_except_with_spaces_and_dots(rows):
    df = rows("`petal length` double, `a.b` int, c int", [(1.0, 2, 3)])
    assert select_except(df, ["c"]).collect()[0].asDict() == {"petal length": 1.0, "a.b": 2}


def test_standardise_types(rows):
    when = datetime.datetime(2024, 1, 1, 0, 0, 0, 500000)
    df = rows(
        "row_id int, n int, x double, s string, at timestamp, day date, c int, t int",
        [(1, 3, float("nan"), "2.5", when, datetime.date(1970, 1, 2), 7, None)],
    ).withColumn("local", F.lit("2024-01-01 00:00:00.5").cast("timestamp_ntz"))
    roles = Roles(("n", "x", "s", "at", "day", "local"), ("c",), ("t",))
    out = standardise_types(df, roles).first()
    assert out["n"] == 3.0 and out["s"] == 2.5 and out["day"] == 86400.0 and out["c"] == "7"
    # NaN and NULL stay missing: no text 'nan' appears.
    assert out["x"] is None and out["t"] is None
    assert out["at"] == out["local"] == 1704067200.5


def test_garbage_number_stops_unless_lenient(rows):
    df = rows("row_id int, x string", [(1, "12"), (2, "twelve")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        standardise_types(df, Roles(("x",))).collect()
    assert collected(standardise_types(df, Roles(("x",)), lenient=True), "row_id") == [(1, 12.0), (2, None)]


def test_roles_are_checked(rows):
    with pytest.raises(ValueError, match="more than one role"):
        Roles(("a",), ("a",))
    with pytest.raises(ValueError, match="not in the table"):
        standardise_types(rows("row_id int", [(1,)]), Roles(("x",)))


def test_labels_there_and_back(rows):
    df = rows("i int, s string", [(1, "a"), (2, "b"), (3, "zz"), (4, None)])
    mapped = map_labels(df, "s", {"a": 0, "b": 1})
    assert collected(mapped, "i") == [(1, "a", 0), (2, "b", 1), (3, "zz", None), (4, None, None)]
    kept = drop_unknown_target(mapped)
    assert collected(unmap_labels(kept, "__target__", {"a": 0, "b": 1}, "back"), "i") == [
        (1, "a", 0, "a"),
        (2, "b", 1, "b"),
    ]


def test_large_label_map_is_joined(rows):
    mapping = {f"label {i}": i for i in range(300)}
    df = rows("i int, s string", [(1, "label 299"), (2, "none")])
    assert collected(map_labels(df, "s", mapping, "t"), "i") == [(1, "label 299", 299), (2, "none", None)]


def test_numeric_targets_map_by_their_text(rows):
    df = rows("t int", [(0,), (1,), (2,)])
    assert collected(map_labels(df, "t", {"0": 5, "1": 6}, "c"), "t") == [(0, 5), (1, 6), (2, None)]


def test_derived_labels_and_counts(rows):
    df = rows("s string", [("b",), ("a",), ("b",), (None,)])
    assert derive_label_map(df, "s") == {"a": 0, "b": 1}
    assert class_counts(df, "s") == {"a": 1, "b": 2}


def test_drop_missing_rows_counts_nan(rows):
    df = rows("i int, x double, y double", [(1, 1.0, None), (2, float("nan"), 1.0), (3, None, 1.0)])
    assert collected(drop_missing_rows(df, ["x"]).select("i"), "i") == [(1,)]
    assert drop_missing_rows(df, []).count() == 3


def test_preview_and_shape(rows):
    df = rows("row_id int, x int", [(i, i) for i in range(20)], 7)
    assert [r["row_id"] for r in preview(df, "row_id").collect()] == [0, 1, 2, 3, 4]
    assert tuple(table_shape(df).first()) == (20, 2)
    assert tuple(table_shape(df.where("false")).first()) == (0, 2)

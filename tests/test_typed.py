"""Types that values bear out, and what becomes of values that do not fit."""

import pytest
from pyspark.sql import functions as F

from response_ledger.operators.typed import (
    cast_plan, column_types, flatten_typed, held_value, typed, value_counts, vocabulary_columns,
)
from response_ledger.operators.vocabulary import vocabulary
from response_ledger.table_ledgers import mixed_spec
from tests.test_ledgers import body, pages


def types(spark, texts, tolerance=0.0):
    frame = spark.createDataFrame([(one,) for one in texts], "a string").repartition(3)
    (found,) = column_types(frame, ["A"], tolerance).collect()
    return found["kind"], found["values"], found["misfits"]


@pytest.mark.parametrize(
    "texts, kind",
    [
        (["1", "-20", "0", None], "bigint"), (["1", "2.5"], "double"), (["1", "1e3"], "double"),
        (["9223372036854775807"], "bigint"), (["9223372036854775808"], "string"), (["9007199254740993", "0.5"], "string"),
        (["007", "1"], "string"), (["", "1"], "string"), ([" 1"], "string"), (["NaN"], "string"), (["1e999"], "string"),
        (["2024-02-29", "1999-01-01"], "date"), (["2023-02-29"], "string"), (["2024-02-29", "5"], "string"),
        ([None, None], "string"), ([], "string"), (["-0"], "bigint"), (["1.0"], "double"), (["true"], "string"),
    ],
)
def test_least_type(spark, texts, kind):
    assert types(spark, texts) == (kind, sum(one is not None for one in texts), 0)


def test_tolerance_is_a_share_of_the_values(spark):
    texts = ["1"] * 8 + ["1.5", "x", None, None]
    assert types(spark, texts, 0.1) == ("double", 10, 1)
    assert types(spark, texts, 0.2) == ("bigint", 10, 2)
    assert types(spark, texts, 0.05) == ("string", 10, 0)


def test_counts_merge(spark):
    frame = spark.createDataFrame([(str(i) if i % 3 else f"{i}.5", "x") for i in range(300)], "a string, b string")
    whole = value_counts(frame, ["a", "b"]).collect()
    assert [tuple(one) for one in whole] == [("a", 300, 200, 300, 0), ("b", 300, 0, 0, 0)]


def test_values_that_do_not_fit_are_rescued(spark):
    rows = [("1", "2024-01-01"), ("x", "soon"), (None, None), ("2.5", "2024-13-01")]
    frame = spark.createDataFrame(rows, "a string, d string").withColumn("k", F.monotonically_increasing_id())
    found = typed(frame, {"a": "bigint", "d": "date"}, keep=("k",)).orderBy("k").collect()
    assert [(one["a"], str(one["d"]), one["rescued"]) for one in found] == [
        (1, "2024-01-01", None), (None, "None", {"a": "x", "d": "soon"}), (None, "None", None),
        (None, "None", {"a": "2.5", "d": "2024-13-01"}),
    ]


def test_both_shapes_are_flattened_by_the_vocabulary(spark):
    columns = vocabulary_columns(vocabulary(mixed_spec(spark)), "RECALLS")
    assert columns == ["productid", "quantity", "feinumber", "recalleventid", "recallinitiationdt", "phasetxt"]
    listed = pages(spark, body([{"PRODUCTID": "1", "QUANTITY": "2"}, {"PRODUCTID": "2", "QUANTITY": "2.5"}]))
    tabular = pages(spark, body({"COLUMNS": ["QUANTITY", "PRODUCTID"], "DATA": [["2", "1"], ["2.5", "2"]]}, total=2))
    for frame, shape in ((listed, False), (tabular, True)):
        flat = flatten_typed(frame, columns, tabular=shape)
        kinds = dict(flat.dtypes)
        assert (kinds["productid"], kinds["quantity"], kinds["phasetxt"]) == ("bigint", "double", "string")
        assert sorted((one["productid"], one["quantity"]) for one in flat.collect()) == [(1, 2.0), (2, 2.5)]
    assert cast_plan(column_types(listed.limit(0).selectExpr("content as a"), ["a"])) == {"a": "string"}


def test_held_values_come_back_as_they_were(spark):
    texts = ["12", "-7", "0.1", "3e-5", "2024-12-31", "9007199254740992"]
    frame = spark.createDataFrame([(one,) for one in texts], "a string")
    row = frame.select(
        *[F.collect_list(held_value(F.col("a"), kind)).alias(kind) for kind in ("bigint", "double", "date")]
    ).first()
    assert row["bigint"] == [12, -7, 9007199254740992] and row["double"] == [12.0, -7.0, 0.1, 3e-5, 2.0**53]
    assert [str(one) for one in row["date"]] == ["2024-12-31"]

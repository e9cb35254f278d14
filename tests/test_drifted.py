"""Files of different types under one schema: what fits, what is rescued, what is opened."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.session import scratch_path
from response_ledger.sources.drifted import read_drifted, schema_classes

WANTED = "id bigint, share double, at timestamp, tags array<string>, note string"


@pytest.mark.parametrize(
    ("kind", "written", "wanted", "read"),
    [
        ("int", 7, "bigint", 7),
        ("string", "7", "bigint", 7),
        ("string", "-7", "bigint", -7),
        ("string", "07", "bigint", None),
        ("string", " 7", "bigint", None),
        ("string", "", "bigint", None),
        ("string", "99999999999999999999", "bigint", None),
        ("double", 7.0, "bigint", 7),
        ("double", 7.5, "bigint", None),
        ("double", float("nan"), "bigint", None),
        ("bigint", 2**31, "int", None),
        ("bigint", 2**53 + 1, "double", None),
        ("string", "1e3", "double", 1000.0),
        ("string", "x", "double", None),
        ("boolean", True, "string", "true"),
        ("boolean", True, "bigint", None),
        ("date", datetime.date(2026, 1, 2), "timestamp", datetime.datetime(2026, 1, 2)),
        ("string", '["a"]', "array<string>", ["a"]),
        ("string", "a", "array<string>", None),
        ("array<int>", [1, 2], "string", "[1,2]"),
        ("array<int>", [1, 2], "array<string>", None),
    ],
)
def test_a_value_comes_over_whole_or_is_rescued(spark, kind, written, wanted, read):
    path = scratch_path(spark, "drift")
    spark.createDataFrame([(written,), (None,)], f"ID {kind}").coalesce(1).write.parquet(f"{path}/a")
    schema = T.StructType.fromDDL(f"id {wanted}")
    rows = read_drifted(spark, path, schema).orderBy(F.col("rescued").isNull(), F.col("id").isNull()).collect()
    assert rows[0]["id"] == read and (rows[0]["rescued"] is not None) == (read is None)
    assert rows[1]["id"] is None and rows[1]["rescued"] is None


def test_classes_are_united_and_more_or_fewer_columns_allowed(spark):
    path = scratch_path(spark, "drift")
    spark.range(3).write.parquet(f"{path}/run_id=1 %+")
    spark.createDataFrame([("1", "x", 5), ("b", "y", 6)], "id string, share string, extra int").write.parquet(
        f"{path}/run_id=x"
    )
    spark.createDataFrame([(9, 0.5, "n")], "id bigint, share double, note string").write.parquet(f"{path}/run_id=3")
    assert schema_classes(spark, path).count() == 3
    schema = T.StructType.fromDDL(WANTED)
    rows = read_drifted(spark, path, schema)
    assert rows.columns == [*schema.names, "rescued"]
    assert sorted((one["id"], one["rescued"]) for one in rows.where("rescued is null").collect()) == [
        (0, None), (1, None), (2, None), (9, None),
    ]
    lost = sorted(one["rescued"].items() for one in rows.where("rescued is not null").collect())
    assert sorted(map(sorted, lost)) == [[("id", "b"), ("share", "y")], [("share", "x")]]


def test_filters_reach_the_files_of_the_wanted_types(spark):
    path = scratch_path(spark, "drift")
    spark.range(3).write.parquet(f"{path}/a")
    spark.createDataFrame([("5",)], "id string").write.parquet(f"{path}/b")
    rows = read_drifted(spark, path, T.StructType.fromDDL("id bigint")).where("id = 2").select("id")
    assert "EqualTo(id,2)" in rows._jdf.queryExecution().executedPlan().toString()
    assert [one["id"] for one in rows.collect()] == [2]


def test_nothing_there(spark, tmp_path):
    assert read_drifted(spark, str(tmp_path), T.StructType.fromDDL(WANTED)).count() == 0

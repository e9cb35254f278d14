"""Resume against the bucketed index: the same rows as the plain join, and none of the ledger moved."""

import pytest
from pyspark.sql import functions as F

from response_ledger.operators.workset import remaining
from response_ledger.session import scratch_path, setting
from response_ledger.sources.held_ids import held_among, held_ids, refresh_held_ids, remaining_by_buckets
from response_ledger.sources.ledger import append_ledger, read_ledger
from response_ledger.table_ledgers import ledger_rows

BUCKETS = 8


def responses(spark, ids, request_type="PRODUCT"):
    frame = spark.createDataFrame([(one,) for one in ids], "id bigint").withColumn("content", F.lit("{}"))
    return ledger_rows(frame, request_type=F.lit(request_type), path_id=F.col("id"), content=F.col("content"))


@pytest.fixture
def target(spark):
    path = scratch_path(spark, "target")
    append_ledger(responses(spark, [*range(0, 300, 3), None, 6, 6, -4]), f"{path}/run_id=1 %+")
    append_ledger(responses(spark, [1, 2], "EVENT"), f"{path}/run_id=1 %+")
    return path


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_the_same_rows_after_every_refresh(spark, target):
    index = scratch_path(spark, "held")
    workset = spark.range(-10, 310).repartition(BUCKETS, "id")
    for run in ([], [1, 4, None], [1, 7, 308]):
        if run:
            append_ledger(responses(spark, run), f"{target}/run_id=2")
        refresh_held_ids(spark, target, index, "PRODUCT", BUCKETS)
        left = {one["id"] for one in remaining_by_buckets(workset, index, "PRODUCT").collect()}
        assert left == {one["id"] for one in remaining(workset, read_ledger(spark, target), "PRODUCT").collect()}
    assert refresh_held_ids(spark, target, index, "PRODUCT") == 0
    with pytest.raises(ValueError, match="8 buckets"):
        refresh_held_ids(spark, target, index, "PRODUCT", BUCKETS + 1)
    with pytest.raises(FileNotFoundError, match="refresh"):
        held_ids(spark, index, "EVENT")


def test_a_file_is_read_once(spark, target):
    index = scratch_path(spark, "held")
    files = refresh_held_ids(spark, target, index, "PRODUCT", BUCKETS)
    held = held_ids(spark, index, "PRODUCT").count()
    append_ledger(responses(spark, [900]).coalesce(1), f"{target}/run_id=3")
    assert files > 1 and refresh_held_ids(spark, target, index, "PRODUCT") == 1
    assert held_ids(spark, index, "PRODUCT").count() == held + 1


def test_neither_side_is_moved(spark, target):
    index = scratch_path(spark, "held")
    refresh_held_ids(spark, target, index, "PRODUCT", BUCKETS)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        told = plan(remaining_by_buckets(spark.range(400), index, "PRODUCT"))
        assert told.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in told
        dealt = plan(remaining_by_buckets(spark.range(400).repartition(BUCKETS, "id"), index, "PRODUCT"))
        # The one that deals the workset.
        assert dealt.count("Exchange hashpartitioning") == 1


def test_few_ids_open_few_buckets(spark, target):
    index = scratch_path(spark, "held")
    refresh_held_ids(spark, target, index, "PRODUCT", BUCKETS)
    few = held_among(spark, index, "PRODUCT", [6, 6, 7])
    assert [one["id"] for one in few.collect()] == [6]
    assert "SelectedBucketsCount: " in plan(few) and f"SelectedBucketsCount: {BUCKETS} out" not in plan(few)
    many = held_among(spark, index, "PRODUCT", list(range(40)))
    assert {one["id"] for one in many.collect()} == set(range(0, 40, 3))
    assert held_among(spark, index, "PRODUCT", []).count() == 0


def test_a_new_catalog_finds_the_ids(spark, target):
    index = scratch_path(spark, "held")
    refresh_held_ids(spark, target, index, "PRODUCT", BUCKETS)
    before = held_ids(spark, index, "PRODUCT").count()
    for one in spark.catalog.listTables():
        if one.name.startswith("held_ids_"):
            spark.sql(f"DROP TABLE {one.name}")
    assert held_ids(spark, index, "PRODUCT").count() == before

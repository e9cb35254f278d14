"""What must hold for any input, on seeded random ones."""

import random

import pytest
from pyspark.sql import functions as F

from response_ledger.operators.workset import assign_batches, first_ids, remaining
from response_ledger.plans.requests import plan_pages


@pytest.mark.parametrize("seed", range(4))
def test_resume_splits_the_workset(spark, seed):
    rng = random.Random(seed)
    wanted = {rng.randint(-500, 500) for _ in range(400)}
    fetched = [
        (rng.choice(["PRODUCT", "EVENT"]), rng.choice([None, *range(-600, 600)])) for _ in range(900)
    ]
    workset = spark.createDataFrame([(one,) for one in wanted], "id bigint").repartition(5)
    ledger = spark.createDataFrame(fetched, "request_type string, path_id bigint").repartition(3)
    left = {one["id"] for one in remaining(workset, ledger, "PRODUCT").collect()}
    held = {one for kind, one in fetched if kind == "PRODUCT" and one is not None}
    assert left == wanted - held
    # Fetching what is left leaves nothing, whatever else is in the ledger.
    more = spark.createDataFrame([("PRODUCT", one) for one in left] or [("PRODUCT", None)], ledger.schema)
    assert remaining(workset, ledger.union(more), "PRODUCT").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_pages_hold_each_record_once(spark, seed):
    rng = random.Random(seed)
    total, rows = rng.randint(0, 5000), rng.randint(1, 700)
    plan = plan_pages(spark, "https://service.example/rest", total, ["productid"], rows)
    last = F.least(F.col("start") + F.col("rows") - 1, F.lit(total))
    found = plan.select(F.explode(F.sequence("start", last)).alias("place")).collect()
    assert sorted(one["place"] for one in found) == list(range(1, total + 1))


@pytest.mark.parametrize("seed", range(4))
def test_batches_are_consecutive_and_whole(spark, seed):
    rng = random.Random(seed)
    # A few dense stretches far apart, so that ranges are of very uneven width.
    ids = set()
    for _ in range(rng.randint(1, 6)):
        first = rng.randint(-(10**15), 10**15)
        ids.update(range(first, first + rng.randint(1, 900)))
    size = rng.randint(1, 400)
    frame = spark.createDataFrame([(one,) for one in ids], "id bigint").repartition(7)
    found = {one["id"]: (one["n"], one["batch_no"]) for one in assign_batches(frame, size).collect()}
    assert found == {
        one: (place, (place - 1) // size + 1) for place, one in enumerate(sorted(ids), 1)
    }
    limit = rng.randint(0, len(ids))
    assert sorted(one["id"] for one in first_ids(frame, limit).collect()) == sorted(ids)[:limit]

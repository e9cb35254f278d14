"""Trees of digests against a plain comparison, and that equal branches are not opened."""

import random

import pytest
from pyspark.sql import functions as F

from response_ledger.operators.drift import build_tree, depth_for, differing_leaves, drift
from response_ledger.session import delete_path, scratch_path
from response_ledger.table_ledgers import ledger_rows

DEPTH = 3


def ledger(spark, rows):
    frame = spark.createDataFrame(rows, "id bigint, start int, body string").repartition(3)
    return ledger_rows(
        frame.withColumn("content", F.coalesce("body", F.lit(""))),
        request_type=F.lit("PRODUCT"), path_id=F.col("id"), start=F.col("start"), content=F.col("content"),
        sha_256=F.sha2("body", 256),
    )


def tree(spark, rows, depth=DEPTH):
    path = scratch_path(spark, "tree")
    build_tree(ledger(spark, rows), path, depth)
    return path


def plain(left, right):
    found = {}
    for side, rows in enumerate((left, right)):
        for number, start, body in rows:
            found.setdefault((number, start), ([], []))[side].append(body or "" if body is not None else "null")
    states = {}
    for key, (one, two) in found.items():
        if sorted(one) != sorted(two):
            state = "changed" if one and two else "left only" if one else "right only"
            states[key] = (state, len(one), len(two))
    return states


def differences(spark, left, right, depth=DEPTH):
    found = drift(spark, left, right, depth).collect()
    return {(row["path_id"], row["start"]): (row["state"], row["left_responses"], row["right_responses"]) for row in found}


@pytest.mark.parametrize("seed", range(2))
def test_differences_are_those_of_a_plain_comparison(spark, seed):
    rng = random.Random(seed)
    left = [(rng.choice([None, *range(80)]), rng.choice([None, 1, 2]), rng.choice(["a", "b", None])) for _ in range(300)]
    right = [row for row in left if rng.random() > 0.02]
    right += [(rng.choice([5, 500 + seed, None]), 1, "c") for _ in range(3)]
    rng.shuffle(right)
    expected = plain(left, right)
    assert expected and differences(spark, tree(spark, left), tree(spark, right)) == expected


def test_equal_and_empty_ledgers(spark):
    rows = [(1, None, "a"), (1, None, "a"), (2, None, "b")]
    one, none = tree(spark, rows), tree(spark, [])
    assert differences(spark, one, tree(spark, rows[::-1])) == {}
    assert differences(spark, none, tree(spark, [])) == {}
    assert differences(spark, one, none) == {(1, None): ("left only", 2, 0), (2, None): ("left only", 1, 0)}
    # The same distinct contents, another number of them.
    assert differences(spark, one, tree(spark, rows[1:])) == {(1, None): ("changed", 2, 1)}
    with pytest.raises(ValueError, match="levels"):
        build_tree(ledger(spark, rows), scratch_path(spark, "tree"), 1)


def test_what_is_equal_is_not_opened(spark):
    rows = [(number, None, "a") for number in range(400)]
    changed = [*rows[:123], (123, None, "b"), *rows[124:]]
    left, right = tree(spark, rows), tree(spark, changed)
    _, tops = differing_leaves(spark, left, right, DEPTH)
    assert len(tops) == 1
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(left).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for one in (left, right):
        for name in ("rows", f"level={DEPTH}"):
            for folder in files.listStatus(path(one, name)):
                if folder.isDirectory() and folder.getPath().getName() != f"top={tops[0]}":
                    delete_path(spark, folder.getPath().toString())
                    gone += 1
    assert gone > 100
    assert differences(spark, left, right) == {(123, None): ("changed", 1, 1)}


def test_depth_grows_with_the_ledger():
    assert [depth_for(n) for n in (0, 4_096 * 256, 4_096 * 256 + 1, 10**10)] == [2, 2, 3, 6]

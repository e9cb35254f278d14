"""
Where two copies of a ledger differ, found from a tree of digests instead of a join of all rows.

Every response has a key, what was asked for, and its md5 places the key among the leaves of a tree
with sixteen children a node. A leaf's digest is made from counts and sums over its responses,
which Spark aggregates before it shuffles; the digest of any other node is the sha-256 of those of
its children. Two trees of the same depth are compared from the root: the children are
read of nodes that differ, and the responses below leaves that differ are compared key by key.

A tree is a folder with a table per level and one of the rows, from the second level on in
folders by the first two digits of the place, so what is equal is not opened further down. Keys are
spread by their digest, so no node is larger than its keys' repetitions make it.

Defined cases: a ledger without rows has a root without children, and differs from any other one
in all of that one's keys; a key fetched several times is compared as a whole, by how often
each content occurs; null contents count as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from response_ledger.sources.ledger import hadoop_uri

# What a call asked for. Pages are told apart by everything in their payload.
CALL_KEY = ("request_type", "path_id", "start", "rows", "asked")
# Leaves and rows are in folders by this many digits.
FOLDER_DIGITS = 2
LEAF_ROWS = 4_096

_KEY = "request_type string, path_id bigint, start int, rows int, asked string"
_ROWS = f"{_KEY}, responses bigint, high bigint, low bigint, place string"
_NODES = "place string, digest string, responses bigint"


def depth_for(responses: int) -> int:
    """Levels below the root for about `LEAF_ROWS` responses a leaf; both copies need the same."""
    depth = FOLDER_DIGITS
    while responses > LEAF_ROWS * 16**depth:
        depth += 1
    return depth


def _asked() -> Column:
    filters = F.transform("filters", lambda one: F.array_sort(F.map_entries(one)))
    return F.when(
        F.col("path_id").isNull(),
        F.to_json(F.struct("url", "display_columns", filters.alias("filters"), "sort", "sort_order")),
    )


def keyed(ledger: DataFrame) -> DataFrame:
    """A row per call key: how often it was answered, and two sums over the digests of the answers."""
    answer = F.xxhash64(F.coalesce("sha_256", F.lit("")), F.col("sha_256").isNull())
    other = F.xxhash64(F.lit(1), F.coalesce("sha_256", F.lit("")), F.col("sha_256").isNull())

    def summed(value: Column) -> Column:
        # Halves, so that sums of any number of them stay within a bigint.
        return F.sum(F.shiftright(value, 32))

    return (
        ledger.withColumn("asked", _asked())
        .groupBy(*CALL_KEY)
        .agg(
            F.count(F.lit(1)).alias("responses"),
            summed(answer).alias("high"),
            summed(other).alias("low"),
        )
    )


def build_tree(ledger: DataFrame, folder: str, depth: int) -> None:
    """Write a ledger's tree. Only the key columns and `sha_256` of the ledger are read."""
    if depth < FOLDER_DIGITS:
        raise ValueError(f"a tree has at least {FOLDER_DIGITS} levels")
    spark, root = ledger.sparkSession, hadoop_uri(folder).rstrip("/")
    place = F.substring(F.md5(F.to_json(F.struct(*CALL_KEY))), 1, depth)
    rows = keyed(ledger).withColumn("place", place)
    _dealt(rows).write.mode("overwrite").partitionBy("top").parquet(f"{root}/rows")
    kept = _read(spark, root, "rows", _ROWS)
    # One number of every key's row; leaves are sums of them, whatever order they come in.
    row = F.xxhash64(*CALL_KEY, "responses", "high", "low")
    again = F.xxhash64(F.lit(1), *CALL_KEY, "responses", "high", "low")
    nodes = kept.groupBy("place").agg(
        F.sha2(
            F.concat_ws(",", F.count(F.lit(1)), F.sum(F.shiftright(row, 32)), F.sum(F.shiftright(again, 32))), 256
        ).alias("digest"),
        F.sum("responses").alias("responses"),
    )
    for level in range(depth, -1, -1):
        if level >= FOLDER_DIGITS:
            _dealt(nodes).write.mode("overwrite").partitionBy("top").parquet(f"{root}/level={level}")
        else:
            nodes.coalesce(1).write.mode("overwrite").parquet(f"{root}/level={level}")
        if level:
            children = _read(spark, root, f"level={level}", _NODES)
            parent = F.substring("place", 1, level - 1) if level > 1 else F.lit("")
            # At most sixteen children in a list.
            listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda one: one["digest"])
            nodes = children.groupBy(parent.alias("place")).agg(
                F.sha2(F.concat_ws(",", listed), 256).alias("digest"), F.sum("responses").alias("responses")
            )


def _dealt(frame: DataFrame) -> DataFrame:
    """Rows in folders by the first digits, those of a folder together, however few tasks there are."""
    return (
        frame.withColumn("top", F.substring("place", 1, FOLDER_DIGITS))
        .repartitionByRange("place")
        .sortWithinPartitions("place")
    )


def _read(spark: SparkSession, root: str, name: str, schema: str, tops: list[str] | None = None) -> DataFrame:
    frame = spark.read.schema(f"{schema}, top string").parquet(f"{root}/{name}")
    return frame if tops is None else frame.where(F.col("top").isin(tops))


def differing_leaves(spark: SparkSession, left: str, right: str, depth: int) -> tuple[DataFrame | None, list[str]]:
    """The places of leaves that differ, and the folders they are in; None where the trees are equal."""
    roots = [hadoop_uri(one).rstrip("/") for one in (left, right)]
    differing, tops = None, None
    for level in range(depth + 1):
        pair = []
        for root in roots:
            nodes = (
                _read(spark, root, f"level={level}", _NODES, tops)
                if level >= FOLDER_DIGITS
                else spark.read.schema(_NODES).parquet(f"{root}/level={level}")
            )
            if differing is not None:
                above = F.substring("place", 1, level - 1) if level > 1 else F.lit("")
                nodes = nodes.withColumn("above", above).join(
                    differing.select(F.col("place").alias("above")), "above", "left_semi"
                )
            pair.append(nodes.select("place", "digest"))
        one, two = pair[0].withColumnRenamed("digest", "left"), pair[1].withColumnRenamed("digest", "right")
        differing = one.join(two, "place", "full").where(~F.col("left").eqNullSafe(F.col("right"))).select("place")
        if level <= FOLDER_DIGITS:
            # Up to 256 places.
            places = sorted(row["place"] for row in differing.collect())
            if not places:
                return None, []
            differing = spark.createDataFrame([(place,) for place in places], "place string")
            tops = places if level == FOLDER_DIGITS else None
    return differing, tops


def drift(spark: SparkSession, left: str, right: str, depth: int) -> DataFrame:
    """
    The calls that two trees' ledgers answer differently: their key, `state` ('left only', 'right
    only' or 'changed') and how many responses each ledger has.
    """
    leaves, tops = differing_leaves(spark, left, right, depth)
    sides = []
    for folder in (left, right):
        rows = _read(spark, hadoop_uri(folder).rstrip("/"), "rows", _ROWS, tops)
        rows = rows.limit(0) if leaves is None else rows.join(leaves, "place", "left_semi")
        sides.append(rows.select(*CALL_KEY, F.struct("responses", "high", "low").alias("held")))
    one, two = sides[0].alias("one"), sides[1].alias("two")
    same_key = [F.col(f"one.{name}").eqNullSafe(F.col(f"two.{name}")) for name in CALL_KEY]
    both = one.join(two, same_key, "full").where(~F.col("one.held").eqNullSafe(F.col("two.held")))
    state = (
        F.when(F.col("two.held").isNull(), "left only").when(F.col("one.held").isNull(), "right only").otherwise("changed")
    )
    return both.select(
        *[F.coalesce(f"one.{name}", f"two.{name}").alias(name) for name in CALL_KEY],
        state.alias("state"),
        F.coalesce("one.held.responses", F.lit(0)).alias("left_responses"),
        F.coalesce("two.held.responses", F.lit(0)).alias("right_responses"),
    )

"""Intervals of offsets by key: what they cover together, and what is left uncovered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Offsets that are merged in one group first, so that a key with most intervals is many groups.
SPAN = 1 << 20


def _islands(intervals: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("low") > reached + 1), 1).otherwise(0)
    marked = intervals.select(*keys, "low", "high", begins.alias("_begins"))
    island = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        marked.withColumn("_island", island).groupBy(*keys, "_island")
        .agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_island")
    )


def merged(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """
    (keys, low, high): intervals that overlap or touch as one. Both ends belong to an interval; one
    that ends before it begins is none.

    Intervals that begin in the same stretch of `SPAN` offsets are merged first; what is left of each
    stretch, one interval if the key has no holes there, is merged by key.
    """
    some = intervals.where("low <= high").withColumn("_stretch", F.floor(F.col("low") / SPAN))
    return _islands(_islands(some, [*keys, "_stretch"]).drop("_stretch"), keys)


def holes(islands: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """
    (keys, low, high): what `islands`, as `merged` returns them, leave open of 1 to `total`, for
    every key of `totals`; one without islands is open as a whole.
    """
    ends = totals.select(*keys, (F.col("total") + 1).alias("low"), (F.col("total") + 1).alias("high"))
    inside = islands.join(totals.select(*keys, "total"), keys).where("low <= total").drop("total")
    order = Window.partitionBy(*keys).orderBy("low")
    first = F.coalesce(F.lag("high").over(order), F.lit(0)) + 1
    return (
        inside.select(*ends.columns).unionByName(ends)
        .withColumn("_first", first)
        .select(*keys, F.greatest("_first", F.lit(1)).alias("low"), (F.col("low") - 1).alias("high"))
        .where("low <= high")
    )


def pages_touched(intervals: DataFrame, rows: int) -> DataFrame:
    """`start` of every page of `rows` offsets, counted from 1, that has a part of an interval."""
    page = F.explode(F.sequence(F.expr(f"(low - 1) div {int(rows)}"), F.expr(f"(high - 1) div {int(rows)}")))
    return intervals.select(page.alias("_page")).distinct().select((F.col("_page") * rows + 1).alias("start"))

"""Gapless global row numbers without pulling all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.session import scratch_path

_SLOT = "_slot"
# monotonically_increasing_id() holds the task number above bit 33, the row number below.
_ROW_BITS = 33


def number_rows(frame: DataFrame, key: str, name: str = "n") -> DataFrame:
    """
    `frame` with its 1-based position by `key`, which must be unique and not null.

    The rows are range-partitioned, sorted inside each range and written once to the
    scratch folder with the place each got; range bounds come from sampling, so they must
    not be drawn a second time. A row's number is its place in the range plus the size of
    the ranges before it. Those sizes are one row per range, which bounds both the window
    over them and the broadcast.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, "numbered")
    (
        frame.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn(_SLOT, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    schema = T.StructType([*frame.schema.fields, T.StructField(_SLOT, T.LongType())])
    stored = spark.read.schema(schema).parquet(path).withColumn(
        "_range", F.shiftright(_SLOT, _ROW_BITS)
    )
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    place = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stored.join(F.broadcast(offsets), "_range").select(
        *frame.columns, (F.col("_offset") + place + 1).alias(name)
    )

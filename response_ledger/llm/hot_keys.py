"""Joins of rows with one row per key, where a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from response_ledger.session import landed

# The most frequent keys, which are joined without moving their rows. Any other key holds less than
# the `HOT`th part of all rows, so what it leaves to one task gets smaller with more of them.
HOT = 1_000


def most_frequent(counted: DataFrame, key: str, many: int = HOT) -> DataFrame:
    """The rows of the `many` keys that have the greatest `n`, written; never more than `many` rows."""
    return landed(counted.orderBy(F.desc("n"), key).limit(many), "hot")


def join_by_key(rows: DataFrame, single: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """
    `rows` joined with `single`, which has one row per key; `hot` holds the rows of `single` of the
    most frequent keys. These, as many as `HOT` at the most, are broadcast and their rows stay where
    they are; all other rows are dealt by key. The result is the plain join's, whichever keys are hot.
    """
    hot = F.broadcast(hot.select(*single.columns))
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(single, key)
    return rows.join(hot, key).unionByName(rest)

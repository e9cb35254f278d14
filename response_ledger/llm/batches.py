"""Running Python steps over long texts with little memory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from response_ledger.session import landed, setting

# Spark hands Python 10,000 rows at a time by default; of long texts that is too much to hold.
TEXT_ROWS = 256
LONG_TEXT_ROWS = 16


def evaluated(frame: DataFrame, purpose: str, rows: int = TEXT_ROWS) -> DataFrame:
    """A frame with Python steps, evaluated now in Arrow batches of few rows, and read back."""
    with setting(frame.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)):
        return landed(frame, purpose)


def set_aside(frame: DataFrame, names: Iterable[str]) -> DataFrame:
    """A frame whose own columns of these names are kept under other ones, see `put_back`."""
    return frame.withColumnsRenamed({name: f"__own_{name}" for name in frame.columns if name in names})


def put_back(frame: DataFrame, columns: list[str], names: Iterable[str]) -> DataFrame:
    """`columns`, those that were set aside among them."""
    return frame.select(*[F.col(f"__own_{name}").alias(name) if name in names else F.col(name) for name in columns])

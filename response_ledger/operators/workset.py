"""The ids a by-id endpoint is fetched for: where they come from and what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from response_ledger.operators.numbering import number_rows
from response_ledger.operators.records import explode_records
from response_ledger.schemas import SOURCE_TYPE


def id_value(text: Column) -> Column:
    """Id text as a number; text that is no integer fails the job, whatever the session's settings."""
    value = text.try_cast("bigint")
    refused = F.raise_error(F.concat(F.lit("id is no integer: "), text)).cast("bigint")
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(refused)


def record_ids(ledger: DataFrame, id_column: str) -> DataFrame:
    """The id column of every record of the paged endpoint's responses, as text."""
    pages = ledger.where(F.col("request_type") == SOURCE_TYPE)
    return explode_records(pages, [id_column]).where(F.col(id_column.lower()).isNotNull())


def create_workset(ledger: DataFrame, id_column: str) -> DataFrame:
    """Distinct ids of a paged run, as `id bigint`; text that is no number is an error."""
    ids = record_ids(ledger, id_column)
    return ids.select(id_value(F.col(id_column.lower())).alias("id")).distinct()


def create_worksets(ledger: DataFrame, id_columns: list[str]) -> DataFrame:
    """The worksets of several id columns out of one pass over the bodies: (id_column, id)."""
    pages = ledger.where(F.col("request_type") == SOURCE_TYPE)
    kinds = F.array(
        *[
            F.struct(F.lit(name).alias("id_column"), id_value(F.col(name)).alias("id"))
            for name in id_columns
        ]
    )
    ids = explode_records(pages, id_columns).select(F.inline(kinds))
    return ids.where(F.col("id").isNotNull()).distinct()


def rejected_ids(ledger: DataFrame, id_column: str) -> DataFrame:
    """Id texts `create_workset` would fail on, with how often each occurs."""
    text = F.col(id_column.lower())
    return (
        record_ids(ledger, id_column)
        .where(text.try_cast("bigint").isNull())
        .groupBy(text.alias("id_text"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def remaining(workset: DataFrame, fetched: DataFrame, request_type: str) -> DataFrame:
    """
    The workset less every id the target already holds for this endpoint.

    Only `path_id` and `request_type` of the target are read. Its ids are made distinct
    before the exchange, so an id refetched any number of times costs one row per task, and
    the join reuses the partitioning both distincts leave behind. A NULL id never matches.
    """
    held = (
        fetched.where((F.col("request_type") == request_type) & F.col("path_id").isNotNull())
        .select(F.col("path_id").alias("id"))
        .distinct()
    )
    return workset.join(held, "id", "left_anti")


def first_ids(workset: DataFrame, limit: int) -> DataFrame:
    """The first `limit` ids in id order."""
    return workset.select("id").orderBy("id").limit(limit)


def batch_number(place: str, batch_size: int) -> Column:
    """The 1-based batch of the row at a 1-based place."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return F.expr(f"({place} - 1) div {int(batch_size)} + 1")


def assign_batches(workset: DataFrame, batch_size: int) -> DataFrame:
    """Each id with its place `n` in id order and its 1-based `batch_no`."""
    return number_rows(workset, "id").withColumn("batch_no", batch_number("n", batch_size))

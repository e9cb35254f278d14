"""
Records as a typed table, the types being those that the documented columns' values bear out.

The types form a lattice: every bigint is a double, a date is neither, and every value is a
string. For each documented column the values that each type holds are counted, by aggregates
that merge, so one pass over all records finds the least type that holds them all, or all but
a tolerated share. The types become one cast plan; a value that its column's type does not hold
is not lost, but kept as text in the `rescued` map.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from response_ledger.operators.records import explode_records, explode_tables

# From the least on; a number with leading zeros is a code, not a number.
_HELD = {
    "bigint": r"^-?(?:0|[1-9][0-9]{0,18})$",
    "double": r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}
KINDS = (*_HELD, "string")
RESCUED = "rescued"


class ColumnType(NamedTuple):
    column: str
    values: int
    kind: str
    misfits: int


def held_value(text: Column, kind: str) -> Column:
    """The text as a value of the kind, NULL where that kind does not hold it."""
    if kind == "string":
        return text
    value = text.try_cast(kind)
    fits = text.rlike(_HELD[kind])
    if kind == "double":
        # A whole number beyond 2**53 would come back as another one.
        exact = ~text.rlike(_HELD["bigint"]) | (F.abs(text.try_cast("decimal(38,0)")) <= 1 << 53)
        fits = fits & (F.abs(value) < float("inf")) & F.coalesce(exact, F.lit(False))
    return F.when(fits, value)


def value_counts(records: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: how many values it has, and how many of them each kind holds."""
    names = [name.lower() for name in columns]
    counts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("values"),
            *[F.count(held_value(F.col(name), kind)).alias(kind) for kind in _HELD],
        )
        for name in names
    ]
    return records.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def column_types(records: DataFrame, columns: list[str], tolerance: float = 0.0) -> DataFrame:
    """
    (column, values, kind, misfits): for each column the least kind that holds all of its
    values, or leaves out no more than `tolerance` of them; a column without values is a string.
    """
    misfits = {kind: F.col("values") - F.col(kind) for kind in _HELD}
    least = F.when(F.col("values") == 0, "string")
    left = F.when(F.col("values") == 0, F.lit(0).cast("bigint"))
    for kind, missing in misfits.items():
        fits = missing <= F.col("values") * tolerance
        least, left = least.when(fits, kind), left.when(fits, missing)
    return value_counts(records, columns).select(
        "column",
        "values",
        least.otherwise("string").alias("kind"),
        left.otherwise(F.lit(0).cast("bigint")).alias("misfits"),
    )


def vocabulary_columns(vocabulary: DataFrame, request_type: str, role: str = "display") -> list[str]:
    """An endpoint's documented names, in documented order; as many as its documentation lists."""
    rows = (
        vocabulary.where((F.col("request_type") == request_type) & (F.col("role") == role))
        .groupBy("column")
        .agg(F.min("ordinal").alias("ordinal"))
        .orderBy("ordinal", "column")
    )
    return [one["column"] for one in rows.collect()]


def cast_plan(types: DataFrame) -> dict[str, str]:
    """`column_types` as a plan to cast by: one row per documented column."""
    return {one["column"]: one["kind"] for one in types.collect()}


def typed(records: DataFrame, plan: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """
    Records of text columns by a plan, with the texts that do not fit as `rescued`, a map from
    column to text, NULL where all fit. A column of that name gives way.
    """
    cast = {name: held_value(F.col(name), kind) for name, kind in plan.items()}
    lost = [
        F.struct(F.lit(name).alias("key"), F.when(value.isNull(), F.col(name)).alias("value"))
        for name, value in cast.items()
    ]
    entries = F.filter(F.array(*lost), lambda one: one["value"].isNotNull())
    rescued = F.when(F.size(entries) > 0, F.map_from_entries(entries))
    return records.select(
        *keep, *[value.alias(name) for name, value in cast.items() if name != RESCUED], rescued.alias(RESCUED)
    )


def flatten_typed(
    pages: DataFrame,
    columns: list[str],
    tolerance: float = 0.0,
    keep: tuple[str, ...] = (),
    tabular: bool = False,
) -> DataFrame:
    """
    Bodies as a table typed by what their own values bear out. The bodies are read twice: once
    for the types, once for the table.
    """
    exploded = explode_tables if tabular else explode_records
    plan = cast_plan(column_types(exploded(pages, columns), columns, tolerance))
    return typed(exploded(pages, columns, keep), plan, keep)

"""Records out of raw bodies: the list shape and the COLUMNS/DATA shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT_JSON = {"allowSingleQuotes": "false"}


def _field_struct(fields: list[str]) -> str:
    return "struct<" + ",".join(f"`{name.upper()}`:string" for name in fields) + ">"


def _mixed_array(fields: list[str]) -> Column:
    """`RESULT` element by element: each kept as text, then asked for the fields."""
    texts = F.from_json("content", "struct<RESULT:array<string>>", STRICT_JSON)["RESULT"]
    return F.transform(
        texts,
        lambda one: F.struct(
            *[F.get_json_object(one, f"$['{name.upper()}']").alias(name.upper()) for name in fields]
        ),
    )


def record_array(fields: list[str]) -> Column:
    """
    A body's `RESULT` list as structs of the asked fields, texts under upper-cased names;
    NULL where `RESULT` is no list.

    The parser is given the asked fields only, so the others (large texts among them) are
    skipped as they are read. A list with elements that are no objects cannot be read that
    way; only such a body is read again element by element.
    """
    typed = F.from_json("content", f"struct<RESULT:array<{_field_struct(fields)}>>", STRICT_JSON)
    return F.coalesce(typed["RESULT"], _mixed_array(fields))


def read_pages(pages: DataFrame, fields: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Per page: `keep`, the reported `total` and the `records`, out of one parse."""
    body = F.from_json(
        "content",
        f"struct<RESULTCOUNT:string,RESULT:array<{_field_struct(fields)}>>",
        STRICT_JSON,
    )
    total = F.coalesce("body.RESULTCOUNT", F.get_json_object("content", "$.RESULTCOUNT"))
    return pages.select(*keep, "content", body.alias("body")).select(
        *keep,
        total.cast("bigint").alias("total"),
        F.coalesce("body.RESULT", _mixed_array(fields)).alias("records"),
    )


def explode_records(pages: DataFrame, fields: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """
    One row per element of a body's `RESULT` list: `keep`, then the asked fields as text
    under their lower-cased names. An absent or null field is NULL; a body whose `RESULT`
    is no list has no rows.
    """
    # The list is read inside the explode: over a column of its own Spark would infer a
    # not-empty filter from the explode, push it below and read every body again for it.
    return pages.select(*keep, F.explode(record_array(fields)).alias("record")).select(
        *keep, *[F.col("record")[name.upper()].alias(name.lower()) for name in fields]
    )


def flatten_records(pages: DataFrame, columns: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """List-shaped bodies as a typed table; `columns` maps documented names to types."""
    rows = explode_records(pages, list(columns), keep)
    return rows.select(
        *keep, *[F.col(name.lower()).cast(kind).alias(name.lower()) for name, kind in columns.items()]
    )


def explode_tables(pages: DataFrame, fields: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """
    One row per row of a COLUMNS/DATA body: `keep`, then the asked fields as text under their
    lower-cased names; one the body does not name is NULL.
    """
    body = F.from_json(
        "content",
        "struct<RESULT:struct<COLUMNS:array<string>,DATA:array<array<string>>>>",
        STRICT_JSON,
    )["RESULT"]
    rows = (
        pages.select(*keep, body.alias("body"))
        .select(*keep, F.col("body.COLUMNS").alias("names"), F.explode_outer("body.DATA").alias("cells"))
        .where(F.col("cells").isNotNull())
    )

    def cell(name: str) -> Column:
        place = F.array_position("names", F.lit(name.upper())).cast("int")
        return F.when(place > 0, F.get("cells", place - 1))

    return rows.select(*keep, *[cell(name).alias(name.lower()) for name in fields])


def flatten_tabular(pages: DataFrame, columns: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """COLUMNS/DATA bodies as a typed table; a column the body does not name is NULL."""
    rows = explode_tables(pages, list(columns), keep)
    return rows.select(
        *keep, *[F.col(name.lower()).cast(kind).alias(name.lower()) for name, kind in columns.items()]
    )

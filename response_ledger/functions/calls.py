"""Column expressions for planning a call and judging its reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from response_ledger.schemas import (
    CALL_PAUSES,
    LARGE_TEXT_COLUMN,
    LARGE_TEXT_PAGE_CAP,
    PAGE_CAP,
    RETRIABLE_STATUSES,
    PauseSchedule,
)


def call_url(base_url: str, path: Column, path_id: Column | None = None) -> Column:
    """Base plus path; with an id, everything from the placeholder on gives way to it."""
    if path_id is None:
        return F.concat(F.lit(base_url), path)
    known = F.when(path_id.isNotNull(), path_id.cast("string")).otherwise(
        F.raise_error(F.lit("a by-id call without an id")).cast("string")
    )
    return F.concat(F.lit(base_url), F.substring_index(path, "{", 1), known)


def format_filters(filters: Column) -> Column:
    """Compact JSON with single quotes, the payload's spelling; no filters is `[]`."""
    return F.replace(F.coalesce(F.to_json(filters), F.lit("[]")), F.lit('"'), F.lit("'"))


def canonical_filters(filters: Column) -> Column:
    """Filters as a text that does not depend on the order of names and values; '' for none."""
    entries = F.transform(
        filters,
        lambda one: F.array_sort(
            F.transform(
                F.map_entries(one),
                lambda entry: F.struct(entry["key"].alias("name"), F.sort_array(entry["value"]).alias("values")),
            )
        ),
    )
    return F.coalesce(F.to_json(F.array_sort(entries)), F.lit(""))


def form_body(
    display_columns: Column,
    filters: Column,
    start: Column,
    rows: Column,
    sort: Column,
    sort_order: Column,
) -> Column:
    """The form field a paged call posts: `payload=` and a JSON object, keys always present."""
    payload = F.struct(
        F.array_join(display_columns, ",").alias("displaycolumns"),
        format_filters(filters).alias("filter"),
        start.alias("start"),
        rows.alias("rows"),
        sort.alias("sort"),
        sort_order.alias("sortorder"),
    )
    return F.concat(F.lit("payload="), F.to_json(payload, {"ignoreNullFields": "false"}))


def page_rows(display_columns: Column, asked: Column | None = None) -> Column:
    """Rows per page: what the caller asked for unless 0 or NULL, else the service's cap."""
    cap = (
        F.when(F.array_contains(display_columns, LARGE_TEXT_COLUMN), F.lit(LARGE_TEXT_PAGE_CAP))
        .otherwise(F.lit(PAGE_CAP))
        .cast("int")
    )
    if asked is None:
        return cap
    return F.coalesce(F.nullif(asked, F.lit(0)), cap).cast("int")


def page_count(total: Column, rows: Column) -> Column:
    """Pages that cover `total` records."""
    return F.ceil(total / rows).cast("bigint")


def http_class(status: Column) -> Column:
    """`ok` for 2xx; `retriable` for a transient status or none at all; else `terminal`."""
    return (
        F.when(status.isNull() | status.isin(*RETRIABLE_STATUSES), "retriable")
        .when(status.between(200, 299), "ok")
        .otherwise("terminal")
    )


def backoff_seconds(tries: Column, pauses: PauseSchedule = CALL_PAUSES) -> Column:
    """The schedule's pause after this many tries, without jitter; its ends hold beyond them."""
    place = F.least(F.greatest(tries.cast("int"), F.lit(1)), F.lit(len(pauses)))
    return F.when(tries.isNotNull(), F.get(F.array(*[F.lit(float(one)) for one in pauses]), place - 1))


def body_length(header_length: Column, raw: Column) -> Column:
    """The length header as it came, else the decoded body's bytes."""
    return F.coalesce(header_length, F.octet_length(raw).cast("bigint"))


def utf8_text(raw: Column) -> Column:
    """The body as text, NULL unless it is valid UTF-8 to the last byte."""
    return F.try_validate_utf8(raw.cast("string"))

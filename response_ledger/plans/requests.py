"""Turning an endpoint into planned calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from response_ledger.functions.calls import call_url, canonical_filters, form_body
from response_ledger.operators.intervals import holes, merged, pages_touched
from response_ledger.operators.records import STRICT_JSON
from response_ledger.schemas import (
    DEFAULT_FILTERS,
    DEFAULT_SORT,
    DEFAULT_SORT_ORDER,
    ENDPOINTS,
    FIRST_OFFSET,
    LARGE_TEXT_COLUMN,
    LARGE_TEXT_PAGE_CAP,
    PAGE_CAP,
    REQUEST,
    SOURCE_TYPE,
)

Filters = list[dict[str, list[str]]]


def rows_for(display_columns: list[str], rows: int | None = None) -> int:
    """Page size of a run: what was asked for unless 0 or None, else the service's cap."""
    return rows or (LARGE_TEXT_PAGE_CAP if LARGE_TEXT_COLUMN in display_columns else PAGE_CAP)


def _columns(names: list[str]) -> Column:
    return F.array(*[F.lit(one) for one in names]).cast("array<string>")


def filter_maps(filters: Filters | None) -> Column:
    """Filters as the ledger keeps them: one single-key map each, NULL for none."""
    kind = REQUEST["filters"].dataType
    if filters is None:
        return F.lit(None).cast(kind)
    maps = [
        F.map_from_arrays(
            _columns(list(one)), F.array(*[_columns(values) for values in one.values()])
        )
        for one in filters
    ]
    return F.array(*maps).cast(kind)


def _request(endpoint: str, display_columns: list[str], **given: Column) -> list[Column]:
    columns = {
        "request_type": F.lit(endpoint),
        "method": F.lit(ENDPOINTS[endpoint].method),
        "display_columns": _columns(display_columns),
        **given,
    }
    return [
        columns.get(one.name, F.lit(None)).cast(one.dataType).alias(one.name) for one in REQUEST
    ]


def plan_pages(
    spark: SparkSession,
    base_url: str,
    total: int,
    display_columns: list[str],
    rows: int,
    filters: Filters | None = DEFAULT_FILTERS,
    sort: str = DEFAULT_SORT,
    sort_order: str = DEFAULT_SORT_ORDER,
) -> DataFrame:
    """One request per offset page, covering every filtered record; no record, no page."""
    starts = spark.range(FIRST_OFFSET, total + FIRST_OFFSET, rows).withColumnRenamed("id", "start")
    return request_pages(starts, base_url, display_columns, rows, filters, sort, sort_order)


def request_pages(
    starts: DataFrame,
    base_url: str,
    display_columns: list[str],
    rows: int,
    filters: Filters | None = DEFAULT_FILTERS,
    sort: str = DEFAULT_SORT,
    sort_order: str = DEFAULT_SORT_ORDER,
) -> DataFrame:
    """One request per page that begins at a `start`."""
    start = F.col("start").cast("int")
    given = {
        "url": call_url(base_url, F.lit(ENDPOINTS[SOURCE_TYPE].path)),
        "filters": filter_maps(filters),
        "sort": F.lit(sort),
        "sort_order": F.lit(sort_order),
        "start": start,
        "rows": F.lit(rows),
    }
    body = form_body(
        _columns(display_columns),
        given["filters"],
        start,
        F.lit(rows),
        given["sort"],
        given["sort_order"],
    )
    return starts.select(*_request(SOURCE_TYPE, display_columns, **given, body=body))


def landed_spans(
    ledger: DataFrame,
    total: int,
    display_columns: list[str],
    filters: Filters | None = DEFAULT_FILTERS,
    sort: str = DEFAULT_SORT,
    sort_order: str = DEFAULT_SORT_ORDER,
) -> DataFrame:
    """
    (low, high): the offsets a ledger's pages hold of what is asked for now, in pages of any size.

    A page counts if it was asked for with the same filters, columns and order, and if it reports
    the total the source has now: under another total the same offset is another record.
    """
    asked = (
        (F.col("request_type") == SOURCE_TYPE)
        & F.col("start").isNotNull()
        & (F.col("rows") > 0)
        & F.col("display_columns").eqNullSafe(_columns(display_columns))
        & (canonical_filters(F.col("filters")) == canonical_filters(filter_maps(filters)))
        & F.col("sort").eqNullSafe(sort)
        & F.col("sort_order").eqNullSafe(sort_order)
    )
    reported = F.from_json("content", "struct<RESULTCOUNT:string>", STRICT_JSON)["RESULTCOUNT"].try_cast("bigint")
    low = F.col("start").cast("bigint")
    return (
        ledger.where(asked).where(reported == total)
        .select(low.alias("low"), F.least(low + F.col("rows") - 1, F.lit(total)).alias("high"))
    )


def missing_spans(spans: DataFrame, total: int) -> DataFrame:
    """(low, high): what `spans` leave open of the offsets 1 to `total`."""
    key = spans.select(F.lit(0).alias("key"), "low", "high")
    whole = spans.sparkSession.range(1).select(F.lit(0).alias("key"), F.lit(total).cast("bigint").alias("total"))
    return holes(merged(key, ["key"]), whole, ["key"]).drop("key")


def plan_missing_pages(
    spans: DataFrame,
    base_url: str,
    total: int,
    display_columns: list[str],
    rows: int,
    filters: Filters | None = DEFAULT_FILTERS,
    sort: str = DEFAULT_SORT,
    sort_order: str = DEFAULT_SORT_ORDER,
) -> DataFrame:
    """The requests of `plan_pages` for those pages of which `spans` leave a part open."""
    starts = pages_touched(missing_spans(spans, total), rows)
    return request_pages(starts, base_url, display_columns, rows, filters, sort, sort_order)


def plan_ids(
    ids: DataFrame,
    base_url: str,
    endpoint: str,
    display_columns: list[str],
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One request per row of `ids` (column `id`), carrying no payload."""
    if not ENDPOINTS[endpoint].by_id:
        raise ValueError(f"{endpoint} takes no id")
    url = call_url(base_url, F.lit(ENDPOINTS[endpoint].path), F.col("id"))
    return ids.select(
        *_request(endpoint, display_columns, url=url, path_id=F.col("id")), *keep
    )


def plan_single(spark: SparkSession, base_url: str, endpoint: str, display_columns: list[str]) -> DataFrame:
    """The one request of an endpoint that takes neither payload nor id."""
    if ENDPOINTS[endpoint].by_id:
        raise ValueError(f"{endpoint} is called once per id, not once")
    url = call_url(base_url, F.lit(ENDPOINTS[endpoint].path))
    return spark.range(1).select(*_request(endpoint, display_columns, url=url))


def plan_probe(spark: SparkSession, base_url: str, filters: Filters | None = DEFAULT_FILTERS) -> DataFrame:
    """The one-row, no-column page that tells how many records the filters match."""
    return plan_pages(spark, base_url, 1, [], 1, filters)

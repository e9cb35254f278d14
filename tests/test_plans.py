import json

import pytest
from pyspark.sql import functions as F

from response_ledger.functions.calls import (
    backoff_seconds,
    call_url,
    format_filters,
    http_class,
    page_rows,
)
from response_ledger.plans.requests import (
    filter_maps,
    plan_ids,
    plan_pages,
    plan_probe,
    plan_single,
    rows_for,
)
from response_ledger.schemas import DEFAULT_FILTERS, ENDPOINTS, REQUEST, endpoints

BASE = "https://service.example/rest"


def test_catalogue(spark):
    rows = {one["request_type"]: one for one in endpoints(spark).collect()}
    assert list(rows) == list(ENDPOINTS) and len(rows) == 9
    assert [name for name, one in rows.items() if one["accepts_payload"]] == ["RECALLS"]
    by_column = {}
    for name, one in rows.items():
        by_column.setdefault(one["id_column"], []).append(name)
    assert {key: len(names) for key, names in by_column.items()} == {
        None: 2,
        "productid": 3,
        "recalleventid": 4,
    }
    assert all(one["needs_ids"] == (one["id_column"] is not None) for one in rows.values())


@pytest.mark.parametrize("size", [1, 7, 40])
@pytest.mark.parametrize("total", [0, 1, 39, 40, 41, 283])
def test_every_record_is_in_exactly_one_page(spark, total, size):
    pages = plan_pages(spark, BASE, total, ["rid"], size).collect()
    records = [one["start"] + place for one in pages for place in range(one["rows"])]
    assert [one for one in records if one <= total] == list(range(1, total + 1))
    assert len(records) - total < size


def test_a_page_says_what_it_was_asked_for(spark):
    (page,) = plan_pages(spark, BASE, 3, ["rid"], 9, [{"phase": ["Ongoing"]}]).collect()
    assert page["filters"] == [{"phase": ["Ongoing"]}] and page["path_id"] is None
    assert (page["sort"], page["sort_order"], page["display_columns"]) == ("productid", "asc", ["rid"])


def test_page_body_is_a_form_field_of_json(spark):
    plan = plan_pages(spark, BASE, 2600, ["productid", "rid"], 2500)
    assert plan.schema.names == REQUEST.names
    body = plan.collect()[1]["body"]
    assert body.startswith("payload=")
    assert json.loads(body.removeprefix("payload=")) == {
        "displaycolumns": "productid,rid",
        "filter": "[{'centercd':['CBER','CDER']}]",
        "start": 2501,
        "rows": 2500,
        "sort": "productid",
        "sortorder": "asc",
    }


def test_no_filters_are_an_empty_list(spark):
    plan = plan_pages(spark, BASE, 1, ["productid"], 5, filters=None).collect()[0]
    assert plan["filters"] is None
    assert json.loads(plan["body"].removeprefix("payload="))["filter"] == "[]"


def test_filter_spelling(spark):
    text = spark.range(1).select(format_filters(filter_maps(DEFAULT_FILTERS)).alias("x")).first()["x"]
    assert text == "[{'centercd':['CBER','CDER']}]"


def test_probe_asks_for_one_row_and_no_columns(spark):
    (probe,) = plan_probe(spark, BASE).collect()
    sent = json.loads(probe["body"].removeprefix("payload="))
    assert (sent["rows"], sent["start"], sent["displaycolumns"]) == (1, 1, "")


@pytest.mark.parametrize("endpoint", [one for one in ENDPOINTS.values() if one.by_id], ids=lambda one: one.name)
def test_a_by_id_call_is_its_address(spark, endpoint):
    plan = plan_ids(spark.range(31, 34), BASE, endpoint.name, ["rid"]).collect()
    fixed, _ = endpoint.path.split("{")
    assert sorted((one["path_id"], one["url"], one["method"]) for one in plan) == [
        (number, f"{BASE}{fixed}{number}", "GET") for number in (31, 32, 33)
    ]
    empty = {name: one[name] for one in plan for name in REQUEST.names if one[name] is None}
    assert set(empty) == {"filters", "sort", "sort_order", "start", "rows", "body"}
    addressed = spark.range(31, 32).select(call_url(BASE, F.lit(endpoint.path), F.col("id")).alias("url"))
    assert addressed.first()["url"] == f"{BASE}{fixed}31"


def test_by_id_endpoints_need_an_id(spark):
    with pytest.raises(ValueError, match="once per id"):
        plan_single(spark, BASE, "CODE_INFO", [])
    ids = spark.createDataFrame([(None,)], "id bigint")
    with pytest.raises(Exception, match="without an id"):
        plan_ids(ids, BASE, "PRODUCT", []).collect()


def test_an_endpoint_without_ids_or_pages_is_one_call(spark):
    plan = plan_single(spark, BASE, "PRODUCT_TYPES", ["phase"]).collect()
    assert [(one["method"], one["url"], one["path_id"], one["body"]) for one in plan] == [
        ("GET", BASE + ENDPOINTS["PRODUCT_TYPES"].path, None, None)
    ]


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("asked", [None, 0, 1, 612, 12_000])
def test_the_page_size_is_the_asked_one_or_the_caps(spark, asked, large):
    columns = ["phase", *(["codeinformation"] if large else [])]
    expected = asked or (2500 if large else 5000)
    assert rows_for(columns, asked) == expected
    given = F.array(*[F.lit(one) for one in columns])
    frame = spark.range(1).select(page_rows(given, F.lit(asked).cast("int")).alias("rows"))
    assert frame.first()["rows"] == expected


def test_statuses(spark):
    rows = spark.createDataFrame([(one,) for one in (200, 204, 304, 401, 403, 404, 429, 503, None)], "s int")
    judged = [one["c"] for one in rows.select(http_class(F.col("s")).alias("c")).collect()]
    assert judged == [
        "ok", "ok", "terminal", "terminal", "retriable", "terminal", "retriable", "retriable", "retriable",
    ]


def test_pauses_follow_the_schedule(spark):
    tries = spark.createDataFrame([(0,), (1,), (2,), (3,), (9,), (None,)], "t int")
    rows = tries.select(
        backoff_seconds(F.col("t"), (0.5, 4.0, 7.0)).alias("own"), backoff_seconds(F.col("t")).alias("usual")
    ).collect()
    assert [one["own"] for one in rows] == [0.5, 0.5, 4.0, 7.0, 7.0, None]
    assert [one["usual"] for one in rows] == [1.5, 1.5, 2.25, 3.375, 30.0, None]

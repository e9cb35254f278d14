"""
Ledgers, bodies and replies rendered from the test tables.

`orders` plays the paged record set (o_orderkey a product id, o_custkey an event id),
`customer` the by-id responses of an earlier run, `events` a log of single tries and
`documents` / `pages` bodies and documentation. Every row of a table is used.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.operators.numbering import number_rows
from response_ledger.plans.requests import filter_maps
from response_ledger.schemas import DEFAULT_FILTERS, LARGE_TEXT_PAGE_CAP, LEDGER, REPLY_FIELDS, REQUEST
from response_ledger.session import scratch_path
from response_ledger.sources.documents import land_documents
from response_ledger.sources.ledger import PAGE_GROUP_ROWS, append_ledger, page_group_rows, target_path

BASE_URL = "https://service.example/rest"
PAGE_ROWS = LARGE_TEXT_PAGE_CAP

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Directory of a rendered ledger, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        directory = scratch_path(spark, name)
        write(directory)
        _written[key] = directory
    return _written[key]


def ledger_rows(frame: DataFrame, **given: Column) -> DataFrame:
    """Ledger rows with the given columns, the digest and length of `content`, and defaults."""
    defaults = {
        "url": F.lit(f"{BASE_URL}/recalls/"),
        "signature": F.lit("1755700000"),
        "display_columns": F.array(F.lit("productid"), F.lit("recalleventid")),
        "content_type": F.lit("application/json;charset=UTF-8"),
        "content_length": F.octet_length(given["content"]),
        "sha_256": F.sha2(given["content"].cast("binary"), 256),
        "fetched_at": F.timestamp_micros(F.lit(1_787_227_200_000_000)),
    }
    columns = {**defaults, **given}
    return frame.select(
        *[columns.get(one.name, F.lit(None)).cast(one.dataType).alias(one.name) for one in LEDGER]
    )


def page_rows_of_orders(
    spark: SparkSession,
    sf_dir: str,
    size: int = PAGE_ROWS,
    filters: list[dict[str, list[str]]] = DEFAULT_FILTERS,
    statuses: tuple[str, ...] = ("F", "O", "P"),
    **given: Column,
) -> DataFrame:
    """`orders` of some statuses as list-shaped pages of at most `size` records in key order."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin(*statuses))
    total = orders.count()
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("PRODUCTID"),
        F.col("o_custkey").cast("string").alias("RECALLEVENTID"),
        F.col("o_orderstatus").alias("CENTERCD"),
        F.col("o_orderpriority").alias("PRODUCTSHORTREASONTXT"),
        F.col("o_totalprice").cast("string").alias("PRODUCTDISTRIBUTEDQUANTITY"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("RECALLINITIATIONDT"),
    )
    numbered = number_rows(orders.select("o_orderkey", record.alias("record")), "o_orderkey")
    page = F.floor((F.col("n") - 1) / size)
    pages = numbered.groupBy(page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("n", "record"))).alias("members")
    )
    content = F.to_json(
        F.struct(
            F.lit("success").alias("MESSAGE"),
            F.lit(total).alias("RESULTCOUNT"),
            F.lit(400).alias("STATUSCODE"),
            F.col("members.record").alias("RESULT"),
        )
    )
    columns = {
        "request_type": F.lit("RECALLS"),
        "filters": filter_maps(filters),
        "sort": F.lit("productid"),
        "sort_order": F.lit("asc"),
        "start": F.col("page") * size + 1,
        "rows": F.lit(size),
        "content": F.col("content"),
    }
    return ledger_rows(pages.select("page", content.alias("content")), **{**columns, **given})


def paged_runs(spark: SparkSession, sf_dir: str) -> str:
    """
    Pages of `orders` under three filters: status F in two runs and a third that got no further
    than its first two pages, status O twice in one run, the second time in larger pages, and
    status P, of which no run has come to its first page yet.
    """

    def write(path: str) -> None:
        for run in PAGED_RUNS:
            append_paged_run(spark, sf_dir, path, *run)

    return once(spark, sf_dir, "paged_runs", write)


# Hour, run, status, page size and how many pages; None stands for all.
PAGED_RUNS = (
    (0, "r1", "F", 300, None),
    (1, "r2", "F", 300, None),
    (2, "r1", "O", 200, None),
    (3, "r1", "O", 500, None),
    (4, "r3", "F", 300, 2),
    (5, "r3", "P", 10, -1),
)


def append_paged_run(
    spark: SparkSession, sf_dir: str, path: str, hour: int, run: str, status: str, size: int, pages: int | None
) -> None:
    """A run's pages of the orders of one status; of a negative number of pages the first are missing."""
    at = F.timestamp_micros(F.lit(1_787_227_200_000_000 + hour * 3_600_000_000))
    rows = page_rows_of_orders(spark, sf_dir, size, [{"centercd": [status]}], (status,), fetched_at=at)
    if pages is not None:
        rows = rows.where(F.col("start") <= pages * size if pages >= 0 else F.col("start") > -pages * size)
    append_ledger(rows, f"{path}/run_id={run}", page_group_rows(size))


def mixed_pages(spark: SparkSession, sf_dir: str) -> str:
    """
    `orders` as pages of records whose fields are of mixed types: whole numbers among
    fractions, numbers with leading zeros, words among numbers, and for urgent orders no date.
    """
    urgent = F.col("o_orderpriority") == "1-URGENT"
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    record = F.struct(
        key.cast("string").alias("PRODUCTID"),
        F.when(key % 2 == 0, F.floor(price).cast("string")).otherwise(price.cast("string")).alias("QUANTITY"),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("FEINUMBER"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus"))
        .otherwise(F.col("o_custkey").cast("string")).alias("RECALLEVENTID"),
        F.when(urgent, F.concat(F.lit("n/a "), F.col("o_custkey").cast("string")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("RECALLINITIATIONDT"),
    )
    body = F.to_json(
        F.struct(F.lit("success").alias("MESSAGE"), F.array_sort(F.collect_list(record)).alias("RESULT"))
    )

    def write(path: str) -> None:
        pages = table(spark, sf_dir, "orders").groupBy(F.expr("o_orderkey div 2000").alias("page"))
        rows = pages.agg(body.alias("content"))
        append_ledger(
            ledger_rows(rows, request_type=F.lit("RECALLS"), start=F.col("page"), content=F.col("content")),
            path, PAGE_GROUP_ROWS,
        )

    return once(spark, sf_dir, "mixed_pages", write)


def mixed_spec(spark: SparkSession) -> DataFrame:
    """The spec that documents the fields of those records, and one more."""
    names = "ProductId, Quantity, FEINumber, RecallEventId, RecallInitiationDt, PhaseTxt"
    text = (
        f"<b>Display columns</b> <i>{names}</i> <b>Sort</b> <i>ProductId</i> <b>Filter</b> <i>PhaseTxt</i>"
    )
    paths = {"/recalls/": {"post": {"description": text}}}
    return spark.range(1).select(F.lit(json.dumps({"paths": paths})).alias("text"))


def holed_pages(spark: SparkSession, sf_dir: str) -> str:
    """
    Pages of all `orders` in three sizes that overlap and leave holes, one that was asked for under
    other filters, and one from when the source had fewer records.
    """

    def write(path: str) -> None:
        start = F.col("start")
        for run, (size, kept) in enumerate(
            ((100, (start % 700) < 400), (75, (start % 1050) > 800), (300, start <= 300))
        ):
            rows = page_rows_of_orders(spark, sf_dir, size).where(kept)
            append_ledger(rows, f"{path}/run_id=r{run}", page_group_rows(size))
        others = page_rows_of_orders(spark, sf_dir, 5000, [{"phase": ["Ongoing"]}])
        fewer = page_rows_of_orders(spark, sf_dir, 5000, statuses=("F", "O"))
        append_ledger(others.unionByName(fewer), f"{path}/run_id=r9", PAGE_GROUP_ROWS)

    return once(spark, sf_dir, "holed_pages", write)


def served_pages(spark: SparkSession, sf_dir: str) -> str:
    """Bodies of all pages of 250 `orders`, one folder per offset, for a transport to serve."""

    def write(path: str) -> None:
        pages = page_rows_of_orders(spark, sf_dir, SERVED_ROWS)
        pages.select("start", "content").repartition("start").write.partitionBy("start").parquet(path)

    return once(spark, sf_dir, "served", write)


SERVED_ROWS = 250


def pages_ledger(spark: SparkSession, sf_dir: str) -> str:
    return once(
        spark, sf_dir, "pages", lambda path: append_ledger(page_rows_of_orders(spark, sf_dir), path, PAGE_GROUP_ROWS)
    )


def tabular_body(names: list[str], cells: list[Column]) -> Column:
    return F.to_json(
        F.struct(
            F.lit("success").alias("MESSAGE"),
            F.lit(1).alias("RESULTCOUNT"),
            F.lit(400).alias("STATUSCODE"),
            F.struct(
                F.array(*[F.lit(one) for one in names]).alias("COLUMNS"),
                F.array(F.array(*[one.cast("string") for one in cells])).alias("DATA"),
            ).alias("RESULT"),
        )
    )


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    `customer` as by-id responses: the BUILDING segment was fetched as EVENT, AUTOMOBILE as
    CODE_INFO, MACHINERY without an id, the others as EVENT_PRODUCTS.
    """
    segment = F.col("c_mktsegment")
    body = tabular_body(
        ["RECALLEVENTID", "FIRMLEGALNAM", "AMOUNT"],
        [F.col("c_custkey"), F.col("c_name"), F.col("c_acctbal")],
    )
    return ledger_rows(
        table(spark, sf_dir, "customer").withColumn("content", body),
        request_type=F.when(segment == "BUILDING", "EVENT")
        .when(segment == "AUTOMOBILE", "CODE_INFO")
        .when(segment == "MACHINERY", "EVENT")
        .otherwise("EVENT_PRODUCTS"),
        path_id=F.when(segment != "MACHINERY", F.col("c_custkey")),
        content=F.col("content"),
    )


def customers_ledger(spark: SparkSession, sf_dir: str) -> str:
    return once(
        spark, sf_dir, "customers", lambda path: append_ledger(customer_rows(spark, sf_dir), path)
    )


def events_ledger(spark: SparkSession, sf_dir: str) -> str:
    """`events` as responses: one per (type, user) and point in time."""

    def write(path: str) -> None:
        events = table(spark, sf_dir, "events").withColumn(
            "content", F.to_json(F.struct("event_id", "props"))
        )
        append_ledger(
            ledger_rows(
                events,
                request_type=F.upper("event_type"),
                path_id=F.col("user_id"),
                fetched_at=F.col("ts"),
                content=F.col("content"),
            ),
            path,
        )

    return once(spark, sf_dir, "events", write)


def documents_ledger(spark: SparkSession, sf_dir: str) -> str:
    """`documents` as responses; a text with line breaks was hashed with blanks instead."""

    def write(path: str) -> None:
        documents = table(spark, sf_dir, "documents")
        hashed = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
        append_ledger(
            ledger_rows(
                documents,
                request_type=F.upper("lang"),
                path_id=F.col("doc_id"),
                sha_256=F.sha2(hashed.cast("binary"), 256),
                content=F.col("text"),
            ),
            path,
        )

    return once(spark, sf_dir, "documents", write)


def event_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    `events` as one try each of the call with id event_id, `$.k` of the props being the
    tries before it. By type: error a failure in the body, signup HTTP 503, view HTTP 404,
    purchase no answer, click a body - cut off below value 10, with a bad last byte below 20, closing a list that
    is not its own below 30, half of these with text behind.
    """
    kind, value = F.col("event_type"), F.col("value")
    good = tabular_body(["VALUE"], [value])
    whole = F.when(
        kind == "error",
        F.to_json(F.struct(F.lit("no such id").alias("MESSAGE"), F.lit(417).alias("STATUSCODE"))),
    ).otherwise(good)
    cut = F.when(
        (kind == "click") & (value < 10), F.substring(whole, F.lit(1), F.length(whole) - 1)
    ).when(
        (kind == "click") & (value >= 20) & (value < 30),
        F.concat(whole, F.when(value < 25, ",{}]").otherwise(',{}] junk')),
    ).otherwise(whole)
    raw = F.when(
        (kind == "click") & (value >= 10) & (value < 20),
        F.concat(cut.cast("binary"), F.unhex(F.lit("FF"))),
    ).otherwise(cut.cast("binary"))
    given = {
        "request_type": F.lit("EVENT"),
        "method": F.lit("GET"),
        "url": F.concat(F.lit(f"{BASE_URL}/recalls/event/"), F.col("event_id").cast("string")),
        "path_id": F.col("event_id"),
        "display_columns": F.array(F.lit("value")),
        "signature": F.lit("1755700000"),
        "status": F.when(kind == "signup", 503)
        .when(kind == "view", 404)
        .when(kind == "purchase", F.lit(None))
        .otherwise(200),
        "content_type": F.lit("application/json"),
        "raw": F.when(kind.isin("click", "error"), raw),
        "fetched_at": F.col("ts"),
        "error_class": F.when(kind == "purchase", "transport"),
        "error_message": F.when(kind == "purchase", "connection refused"),
    }
    kinds = [*REQUEST.fields, *REPLY_FIELDS]
    replies = table(spark, sf_dir, "events").select(
        *[given.get(one.name, F.lit(None)).cast(one.dataType).alias(one.name) for one in kinds],
        F.col("user_id").alias("batch_no"),
        F.get_json_object("props", "$.k").cast("int").alias("attempts"),
    )
    return staged(spark, sf_dir, "replies", replies)


def staged(spark: SparkSession, sf_dir: str, name: str, frame: DataFrame) -> DataFrame:
    """A rendered table, landed in as many files as the session has cores."""
    cores = spark.sparkContext.defaultParallelism
    path = once(spark, sf_dir, name, lambda path: frame.repartition(cores).write.parquet(path))
    return spark.read.schema(frame.schema).parquet(path)


def marked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` put into markup whole, their special characters (and each e) escaped."""
    text = F.col("text")
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"), ("e", "&#x65;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    fragment = F.concat(
        F.lit("<p>Read <b class='x'> "), F.col("lang"),
        F.lit(" </b> &#9679; <!-- <i>no</i> --><i>lost <I>"), text,
        F.lit("<u></u></I> tail <b>open"),
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", fragment.alias("markup"))
    return staged(spark, sf_dir, "markup", documents)


def order_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    One spec document per order, describing three endpoints with names made of the order's
    own values; an urgent order's spec names the sort heading twice.
    """
    name = F.concat
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    sort = F.when(F.col("o_orderpriority") == "1-URGENT", "<b>Sort</b> &#9679; <b>Sort </b>").otherwise(
        "<b> Sort\n</b> &#9679; "
    )
    paged = name(
        F.lit("<p>Options</p><b>Display columns </b>- values: <i> ProductId,  Key_"),
        key,
        F.lit(" ,Cust_"),
        customer,
        F.lit("</i>; "),
        sort,
        F.lit("<i>Key_"),
        key,
        F.lit("</i><b>Filter</b> <i>Status_"),
        F.col("o_orderstatus"),
        F.lit(", CENTER&amp;CD</i>"),
    )
    sentence = name(
        F.lit("Gets the types in JSON format including the following columns:  Cust_"),
        customer,
        F.lit(",Status_"),
        F.col("o_orderstatus"),
        F.lit(".\n"),
    )

    def operation(method: str, text: Column) -> Column:
        return F.create_map(F.lit(method), F.struct(text.alias("description"), F.lit("x").alias("summary")))

    paths = F.create_map(
        F.lit("/recalls/"), operation("post", paged),
        F.lit("/search/producttypes"), operation("get", sentence),
        F.lit("/recalls/product/{productid}"), operation("get", F.lit("Gets a product.")),
    )
    text = F.to_json(F.struct(F.lit("2.0").alias("swagger"), paths.alias("paths")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return staged(spark, sf_dir, "specs", orders)


def supplier_documents(spark: SparkSession, sf_dir: str) -> str:
    """
    A landed documentation page and a landed spec per supplier. Pages of suppliers with a negative
    balance name no spec, those of nations below 5 one that was not landed.
    """
    key = F.col("s_suppkey").cast("string")
    site = F.concat(F.lit("https://docs.example/s"), key, F.lit("/a b/"))
    spec = F.concat(F.lit("spec/s=1&p="), key, F.lit(".json"))
    script = F.concat(F.lit("<p>\u00e9</p>\n<script>url = '"), spec, F.lit("';</script>\n"))
    described = F.concat(
        F.lit("Gets the types in JSON format including the following columns:  Supp_"), key,
        F.lit(",Nation_"), F.col("s_nationkey").cast("string"), F.lit(".\n"),
    )
    paths = F.create_map(
        F.lit("/search/producttypes"),
        F.create_map(F.lit("get"), F.struct(described.alias("description"), F.lit("x").alias("summary"))),
    )

    def write(path: str) -> None:
        suppliers = table(spark, sf_dir, "supplier")
        land_documents(
            suppliers.select(
                F.concat(site, F.lit("index.html")).alias("url"),
                F.when(F.col("s_acctbal") < 0, F.lit("<p>none</p>")).otherwise(script).alias("text"),
            ),
            path,
        )
        land_documents(
            suppliers.where("s_nationkey >= 5").select(
                F.concat(site, spec).alias("url"),
                F.to_json(F.struct(F.lit("2.0").alias("swagger"), paths.alias("paths"))).alias("text"),
            ),
            path,
        )

    return once(spark, sf_dir, "supplier_documents", write)


def two_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """
    The customers' responses by customer and by nation, and a copy of them in which, of customers
    with a balance below 1,000, those of nations below 3 are missing, those of 5 to 8 have another
    body, and those beyond 20 were fetched under another id besides.
    """
    customers = table(spark, sf_dir, "customer").withColumn(
        "content", tabular_body(["RECALLEVENTID", "FIRMLEGALNAM"], [F.col("c_custkey"), F.col("c_name")])
    )
    nation, low = F.col("c_nationkey"), F.col("c_acctbal") < 1000
    other = customers.where(~(low & (nation < 3))).withColumn(
        "content", F.when(low & nation.between(5, 8), F.concat("content", F.lit(" "))).otherwise(F.col("content"))
    )

    def rows(frame: DataFrame, more: int = 0) -> DataFrame:
        by = [("EVENT", F.col("c_custkey")), ("EVENT_PRODUCTS", nation)]
        found = [
            ledger_rows(frame, request_type=F.lit(kind), path_id=number + more, content=F.col("content"))
            for kind, number in by
        ]
        return found[0].unionByName(found[1])

    return rows(customers), rows(other).unionByName(rows(customers.where(low & (nation > 20)), 1_000_000_000))


def older_schema() -> T.StructType:
    """A ledger from before filters were kept."""
    return T.StructType([one for one in LEDGER if one.name != "filters"])


def fetched_twice(spark: SparkSession, sf_dir: str) -> str:
    """The raw pages as two runs under one destination: one fetched once, one twice."""

    def write(path: str) -> None:
        pages = spark.read.schema(LEDGER).parquet(pages_ledger(spark, sf_dir))
        for run in ("plain", "forced", "forced"):
            append_ledger(pages, target_path(path, "RECALLS", run), PAGE_GROUP_ROWS)

    return once(spark, sf_dir, "fetched_twice", write)


def united_ledger(spark: SparkSession, sf_dir: str) -> str:
    """The customers' responses twice: as an older writer left them, and with filters."""

    def write(path: str) -> None:
        customers = spark.read.schema(LEDGER).parquet(customers_ledger(spark, sf_dir)).withColumn(
            "filters", F.array(F.create_map(F.lit("centercd"), F.array(F.lit("CBER"))))
        )
        old = [one.name for one in older_schema()]
        customers.select(*old).write.parquet(f"{path}/run_id=1")
        append_ledger(customers.select(*LEDGER.names), f"{path}/run_id=2")

    return once(spark, sf_dir, "united", write)


def drifted_ledger(spark: SparkSession, sf_dir: str) -> str:
    """
    The customers' responses as four writers left them: ids as numbers of 4 bytes, as they should be,
    as text (every seventh behind a letter, every eleventh with a zero before it) and as doubles (every
    fifth with a half), lengths as text by the third, and no filters by the first.
    """

    def write(path: str) -> None:
        customers = spark.read.schema(LEDGER).parquet(customers_ledger(spark, sf_dir))
        held, text = F.col("path_id"), F.col("path_id").cast("string")
        spelt = F.when(held % 7 == 0, F.concat(F.lit("C"), text)).when(held % 11 == 0, F.concat(F.lit("0"), text))
        half = F.when(held % 5 == 0, held + F.lit(0.5)).otherwise(held.cast("double"))
        customers.drop("filters").withColumn("path_id", held.cast("int")).write.parquet(f"{path}/run_id=1")
        append_ledger(customers, f"{path}/run_id=2")
        third = customers.withColumn("path_id", F.coalesce(spelt, text))
        third.withColumn("content_length", F.col("content_length").cast("string")).write.parquet(f"{path}/run_id=3")
        customers.withColumn("path_id", half).write.parquet(f"{path}/run_id=4")

    return once(spark, sf_dir, "drifted", write)


def failed_rows(frame: DataFrame, request_type: str) -> DataFrame:
    """Ids as rows of a failures table, as far as streams read them."""
    return frame.select(F.lit(request_type).alias("request_type"), F.col("id").alias("path_id"))

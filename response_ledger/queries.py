"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.functions.calls import backoff_seconds, body_length, page_count, page_rows, utf8_text
from response_ledger.functions.text import (
    inline_elements,
    normalize_space,
    resolve_link,
    sentence_columns,
    spec_link,
    split_columns,
)
from response_ledger.operators import audit
from response_ledger.operators.drift import build_tree, depth_for, drift
from response_ledger.operators.fetch import Reply, Send
from response_ledger.operators.outcomes import (
    classify,
    dead_letters,
    outcome_totals,
    retry_queue,
    run_totals,
    to_ledger,
)
from response_ledger.operators.records import explode_records, flatten_records, flatten_tabular
from response_ledger.operators.typed import column_types, flatten_typed, vocabulary_columns
from response_ledger.operators.vocabulary import vocabulary, vocabulary_errors
from response_ledger.operators.workset import (
    assign_batches,
    create_workset,
    create_worksets,
    first_ids,
    rejected_ids,
    remaining,
)
from response_ledger.plans.job import CallOptions, IncompleteRunError, run_stage, run_stages
from response_ledger.plans.requests import (
    landed_spans,
    missing_spans,
    plan_ids,
    plan_missing_pages,
    plan_pages,
)
from response_ledger.session import landed, scratch_path
from response_ledger.sources.compaction import compact, read_compacted, vacuum
from response_ledger.sources.current_index import read_current, refresh_index
from response_ledger.sources.documents import linked_specs, read_landed
from response_ledger.sources.drifted import read_drifted
from response_ledger.sources.held_ids import refresh_held_ids, remaining_by_buckets
from response_ledger.sources.ledger import (
    PAGE_GROUP_ROWS,
    append_ledger,
    ledger_is_empty,
    read_ledger,
    read_runs,
    required_violations,
    target_path,
)
from response_ledger.streaming.pending import read_requested, stream_pending
from response_ledger.streaming.worksets import read_emitted, stream_workset
from response_ledger.table_ledgers import (
    BASE_URL,
    PAGE_ROWS,
    PAGED_RUNS,
    SERVED_ROWS,
    append_paged_run,
    customers_ledger,
    documents_ledger,
    drifted_ledger,
    event_replies,
    events_ledger,
    failed_rows,
    fetched_twice,
    holed_pages,
    ledger_rows,
    marked_documents,
    mixed_pages,
    mixed_spec,
    once,
    order_specs,
    paged_runs,
    pages_ledger,
    served_pages,
    supplier_documents,
    table,
    two_copies,
    united_ledger,
)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ledger(spark, pages_ledger(spark, sf_dir))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ledger(spark, customers_ledger(spark, sf_dir))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts judged and landed, as a run does before it splits them."""
    judged = classify(event_replies(spark, sf_dir))
    path = once(spark, sf_dir, "judged", judged.write.parquet)
    return spark.read.schema(judged.schema).parquet(path)


def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset pages that cover all orders."""
    total = table(spark, sf_dir, "orders").count()
    plan = plan_pages(spark, BASE_URL, total, ["productid", "codeinformation"], PAGE_ROWS)
    return plan.select("url", "start", "rows", "sort", "sort_order")


def page_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form body each of those pages posts."""
    total = table(spark, sf_dir, "orders").count()
    plan = plan_pages(spark, BASE_URL, total, ["productid", "codeinformation"], PAGE_ROWS)
    return plan.select("start", "method", "body")


def page_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landed page: how many records it holds and the lowest and highest id."""
    ids = explode_records(_pages(spark, sf_dir), ["productid"], keep=("start",))
    number = F.col("productid").cast("bigint")
    return ids.groupBy("start").agg(
        F.count(F.lit(1)).alias("records"), F.min(number).alias("first_id"), F.max(number).alias("last_id")
    )


def workset_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct event ids inside the raw pages."""
    return create_workset(_pages(spark, sf_dir), "recalleventid")


def workset_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct product ids inside the raw pages."""
    return create_workset(_pages(spark, sf_dir), "productid")


def workset_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of ids out of one pass over the pages."""
    return create_worksets(_pages(spark, sf_dir), ["productid", "recalleventid"])


def workset_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many ids of each kind there are to fetch."""
    return workset_kinds(spark, sf_dir).groupBy("id_column").agg(F.count(F.lit(1)).alias("ids"))


def remaining_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids of the raw pages that have no EVENT response yet."""
    workset = create_workset(_pages(spark, sf_dir), "recalleventid")
    return remaining(workset, _customers(spark, sf_dir), "EVENT")


def remaining_by_held_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through an index of the held ids, which was refreshed after each of two runs."""
    target, index = scratch_path(spark, "target"), scratch_path(spark, "held")
    early = F.col("path_id") % 2 == 0
    for run, rows in (("r1", _customers(spark, sf_dir).where(early)), ("r2", _customers(spark, sf_dir).where(~early))):
        append_ledger(rows, f"{target}/run_id={run}")
        refresh_held_ids(spark, target, index, "EVENT")
    return remaining_by_buckets(create_workset(_pages(spark, sf_dir), "recalleventid"), index, "EVENT")


def remaining_against_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a target that holds no row of the endpoint the whole workset stands."""
    workset = create_workset(_pages(spark, sf_dir), "recalleventid")
    return remaining(workset, _customers(spark, sf_dir), "PRESS_RELEASE_URLS")


def remaining_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 ids left, in id order."""
    return first_ids(remaining_events(spark, sf_dir), 100)


def batch_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch of 1,000 product ids: size and bounds."""
    batches = assign_batches(create_workset(_pages(spark, sf_dir), "productid"), 1000)
    return batches.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


def id_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One planned call per event id still to be fetched."""
    plan = plan_ids(remaining_events(spark, sf_dir), BASE_URL, "EVENT", ["recalleventid", "firmlegalnam"])
    return plan.select(
        "request_type", "method", "url", "path_id", F.array_join("display_columns", ",").alias("columns"),
        (F.col("start").isNull() & F.col("filters").isNull() & F.col("body").isNull()).alias("bare"),
    )


def page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page-size rule per order: the large column asked for or not, 0 and NULL passed on."""
    wanted = F.array(
        F.lit("productid"),
        F.when(F.col("o_orderstatus") == "F", F.lit("codeinformation")).otherwise(F.lit("rid")),
    )
    asked = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0)).when(
        F.col("o_orderpriority") == "2-HIGH", F.col("o_custkey").cast("int")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", page_rows(wanted, asked).alias("rows"))


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three records that cover each customer's orders."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total"))
    return orders.select("o_custkey", page_count(F.col("total"), F.lit(3)).alias("pages"))


def call_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a call attempt, judged: requests per batch and outcome."""
    return outcome_totals(classify(event_replies(spark, sf_dir)))


def kept_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger rows of the attempts that succeeded."""
    kept = to_ledger(_judged(spark, sf_dir))
    return kept.select("request_type", "url", "path_id", "content_length", "sha_256", "content")


def failed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts that came to an end without a response, and why."""
    letters = dead_letters(_judged(spark, sf_dir))
    codes = [F.coalesce(F.col(one).cast("string"), F.lit("none")).alias(one) for one in ("status", "api_status")]
    return letters.select("path_id", "attempts", *codes, "outcome", "failure")


def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts to make again and their pause before jitter."""
    queue = retry_queue(_judged(spark, sf_dir))
    return queue.select("path_id", "attempts", backoff_seconds(F.col("attempts")).alias("delay_seconds"))


def attempt_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all settled attempts, the first failure named."""
    totals = run_totals(_judged(spark, sf_dir))
    return totals.select("written", "failed", "batches", F.col("first_failure.url").alias("first_failed_url"))


def requeued_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids whose call was not kept: failures stage nothing, so they are asked for again."""
    judged = _judged(spark, sf_dir)
    ids = judged.select(F.col("path_id").alias("id")).distinct()
    return remaining(ids, to_ledger(judged), "EVENT")


def body_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest and length of every document as a response body."""
    raw = F.col("text").cast("binary")
    declared = F.when(F.col("lang") == "en", F.col("n_chars"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(raw, 256).alias("sha_256"), body_length(declared, raw).alias("content_length")
    )


def undecodable_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language, bodies that are valid UTF-8; a French one has lost its last byte."""
    raw = F.when(
        F.col("lang") == "fr", F.concat(F.col("text").cast("binary"), F.unhex(F.lit("C3")))
    ).otherwise(F.col("text").cast("binary"))
    return (
        table(spark, sf_dir, "documents").groupBy("lang")
        .agg(
            F.count(utf8_text(raw)).alias("decoded"),
            F.count_if(utf8_text(raw).isNull()).alias("undecodable"),
        )
    )


def rejected_id_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are no number: pages whose records carry the priority where an id belongs."""
    record = F.struct(
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias("PRODUCTID")
    )
    body = F.to_json(F.struct(F.lit("success").alias("MESSAGE"), F.array(record).alias("RESULT")))
    orders = table(spark, sf_dir, "orders").withColumn("content", body)
    return rejected_ids(
        ledger_rows(orders, request_type=F.lit("RECALLS"), content=F.col("content")), "productid"
    )


def flattened_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the raw pages as a typed table."""
    kinds = {
        "productid": "bigint",
        "recalleventid": "bigint",
        "centercd": "string",
        "productshortreasontxt": "string",
        "productdistributedquantity": "double",
        "recallinitiationdt": "date",
    }
    return flatten_records(_pages(spark, sf_dir), kinds).withColumn(
        "recallinitiationdt", F.col("recallinitiationdt").cast("string")
    )


def flattened_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The COLUMNS/DATA bodies as a typed table; one asked column is in none of them."""
    kinds = {"recalleventid": "bigint", "firmlegalnam": "string", "amount": "double", "phasetxt": "string"}
    return flatten_tabular(_customers(spark, sf_dir), kinds, keep=("request_type",)).withColumn(
        "phasetxt", F.coalesce("phasetxt", F.lit("not in the body"))
    )


# One order in five has no date.
_DATE_TOLERANCE = 0.25


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    pages = read_ledger(spark, mixed_pages(spark, sf_dir))
    return pages, vocabulary_columns(vocabulary(mixed_spec(spark)), "RECALLS")


def documented_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least type of every documented column, strictly, and with a share of misfits tolerated."""
    pages, columns = _mixed(spark, sf_dir)
    records = explode_records(pages, columns)
    strict, lenient = (
        column_types(records, columns, share).withColumn("tolerance", F.lit(share))
        for share in (0.0, _DATE_TOLERANCE)
    )
    return strict.unionByName(lenient)


def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as a table typed by their own values, the texts that do not fit rescued."""
    pages, columns = _mixed(spark, sf_dir)
    flat = flatten_typed(pages, columns, _DATE_TOLERANCE)
    return flat.select(
        "productid", "quantity", "feinumber", "recalleventid",
        F.coalesce(F.col("recallinitiationdt").cast("string"), F.lit("")).alias("recallinitiationdt"),
        F.coalesce("phasetxt", F.lit("none")).alias("phasetxt"),
        F.coalesce(F.to_json("rescued"), F.lit("")).alias("rescued"),
    )


def current_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest response per endpoint and id out of an append-only ledger."""
    current = audit.current_responses(read_ledger(spark, events_ledger(spark, sf_dir)))
    return current.select("request_type", "path_id", "content")


def current_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    Which pages of a ledger of several runs, filters and page sizes are current: under one
    filter the second run's, as the third is not complete, under another the second page size's,
    under the last what there is of the only run.
    """
    return _records_by_page(audit.current_responses(read_ledger(spark, paged_runs(spark, sf_dir))))


def _records_by_page(pages: DataFrame) -> DataFrame:
    records = explode_records(pages, ["productid"], keep=("filters", "start", "rows"))
    return records.groupBy(
        F.get(F.element_at(F.get("filters", F.lit(0)), "centercd"), F.lit(0)).alias("status"), "rows", "start"
    ).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(F.col("productid").cast("bigint")).alias("first_id"),
        F.max(F.col("productid").cast("bigint")).alias("last_id"),
    )


def refreshed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    The same ledger, its runs landed one after another, each followed by a refresh of its index
    that reads the new files alone: the current pages after every run.
    """
    ledger, index = scratch_path(spark, "ledger"), scratch_path(spark, "index")
    views = []
    for run in PAGED_RUNS:
        append_paged_run(spark, sf_dir, ledger, *run)
        version = refresh_index(spark, ledger, index)
        seen = _records_by_page(read_current(spark, ledger, index))
        views.append(landed(seen.withColumn("version", F.lit(version)), "view"))
    whole = views[0]
    for view in views[1:]:
        whole = whole.unionByName(view)
    return whole


def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of 250 orders to fetch yet, given landed pages of other sizes with holes between."""
    total = table(spark, sf_dir, "orders").count()
    columns = ["productid", "recalleventid"]
    spans = landed_spans(read_ledger(spark, holed_pages(spark, sf_dir)), total, columns)
    return plan_missing_pages(spans, BASE_URL, total, columns, 250).select("url", "start", "rows")


def missing_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same holes, as runs of offsets."""
    total = table(spark, sf_dir, "orders").count()
    spans = landed_spans(
        read_ledger(spark, holed_pages(spark, sf_dir)), total, ["productid", "recalleventid"]
    )
    return missing_spans(spans, total)


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event per type and user, over a frame that is no ledger."""
    events = table(spark, sf_dir, "events")
    latest = audit.latest_per_key(events, ("event_type", "user_id"), ("ts", "event_id"))
    return latest.select("event_type", "user_id", "event_id", "value")


def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose stored digest is not that of their content."""
    wrong = audit.integrity(read_ledger(spark, documents_ledger(spark, sf_dir)))
    return wrong.select("request_type", "path_id", "sha_256", "content_sha_256")


def drifted_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls that a ledger and a damaged copy of it answer differently, by their trees of digests."""
    left, right = (landed(one, "copy") for one in two_copies(spark, sf_dir))
    trees = [scratch_path(spark, "tree") for _ in range(2)]
    depth = depth_for(left.count())
    for ledger, tree in zip((left, right), trees):
        build_tree(ledger, tree, depth)
    found = drift(spark, *trees, depth)
    return found.select("request_type", "path_id", "state", "left_responses", "right_responses")


def malformed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    Bodies that are not one JSON object: cut off, with text behind, or closing a list that is
    not theirs, with and without text behind.
    """
    props = F.col("props")
    cut = (
        F.when(F.col("event_type") == "view", F.substring(props, F.lit(1), F.length(props) - 1))
        .when(F.col("event_type") == "click", F.concat(props, F.lit(" trailing")))
        .when(F.col("event_type") == "signup", F.concat(props, F.lit(",{}]")))
        .when(F.col("event_type") == "error", F.concat(props, F.lit(",{}] tail")))
        .otherwise(props)
    )
    events = table(spark, sf_dir, "events").withColumn("content", cut)
    rows = ledger_rows(
        events, request_type=F.upper("event_type"), path_id=F.col("event_id"), content=F.col("content")
    )
    return audit.malformed(rows).select("request_type", "path_id")


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported against found records, per run: one fetched once, one fetched twice."""
    runs = read_runs(spark, fetched_twice(spark, sf_dir), "RECALLS")
    return audit.coverage(runs, "productid", run=("run_id",))


def compacted_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' responses in small files of two runs, compacted after each and vacuumed."""
    path = scratch_path(spark, "compacted")
    for run in ("r1", "r2"):
        append_ledger(_customers(spark, sf_dir).repartition(12), f"{path}/run_id={run}")
        compact(spark, path)
        vacuum(spark, path)
    return (
        read_compacted(spark, path)
        .groupBy("request_type", "path_id")
        .agg(F.count(F.lit(1)).alias("responses"), F.countDistinct("sha_256").alias("bodies"))
    )


def united_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory whose older files lack a column, in two subdirectories, read as one."""
    return (
        read_ledger(spark, united_ledger(spark, sf_dir))
        .groupBy("request_type", F.col("filters").isNull().alias("without_filters"))
        .agg(F.count(F.lit(1)).alias("responses"), F.count("path_id").alias("with_id"))
    )


def drifted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose ids are numbers of several types and text, read as one; ids that do not fit as text."""
    rows = read_drifted(spark, drifted_ledger(spark, sf_dir))
    return rows.groupBy("request_type", "path_id", F.col("rescued")["path_id"].alias("id_text")).agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_if(F.col("content_length") == F.octet_length("content")).alias("whole"),
    )


def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches of the NOT NULL rule per required column."""
    documents = table(spark, sf_dir, "documents")
    rows = ledger_rows(
        documents,
        request_type=F.nullif(F.col("lang"), F.lit("de")),
        content_type=F.nullif(F.col("source"), F.lit("web")),
        content=F.col("text"),
    )
    return required_violations(rows)


def sentence_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column lists written as sentences out of every line item, read back."""
    description = F.concat(
        F.lit("Gets the line in JSON format including the following columns:  Part_"),
        F.col("l_partkey").cast("string"), F.lit(",SUPP_"), F.col("l_suppkey").cast("string"),
        F.lit(" , ,Line_"), F.col("l_linenumber").cast("string"), F.lit(". And more, text.\n"),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.posexplode(sentence_columns(description)).alias("pos", "column")
    )


def column_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document split like a comma list: how many names, and a digest of them."""
    names = split_columns(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(names).alias("names"), F.md5(F.array_join(names, "|")).alias("digest")
    )


def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its white space collapsed."""
    text = normalize_space(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(text).alias("chars"), F.md5(text).alias("digest")
    )


def escaped_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents put into markup with their special characters escaped, scanned back whole."""
    found = inline_elements(F.col("markup"))
    return (
        marked_documents(spark, sf_dir)
        .select("doc_id", F.posexplode(found).alias("pos", "element"))
        .select(
            "doc_id",
            "pos",
            F.col("element.tag").alias("tag"),
            F.md5(F.col("element.text")).alias("digest"),
        )
    )


def page_link_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The element scan over whole web pages, for `<a>`: texts in document order."""
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", F.posexplode(inline_elements(F.col("html"), ("a",))).alias("pos", "element"))
        .select("page_id", "pos", F.col("element.text").alias("text"))
    )


def spec_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spec each page loads, found in its markup and made absolute."""
    script = F.concat(
        F.lit("<script>var u; url = 'index.html'; url = \"src/p"),
        F.col("page_id").cast("string"),
        F.lit('.json"; url = "other.json";</script>'),
    )
    found = table(spark, sf_dir, "pages").withColumn("link", spec_link(F.concat("html", script)))
    return found.select("page_id", resolve_link(F.col("url"), F.col("link")).alias("spec_url"))


def endpoint_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documented columns of every endpoint of every order's spec document."""
    return vocabulary(order_specs(spark, sf_dir), keep=("o_orderkey",)).select(
        "o_orderkey", "request_type", "role", "ordinal", "column"
    )


def landed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and specs landed as files, each page's spec found by its link, and what that documents."""
    # Opening a file takes far longer than its bytes, so each is read once.
    specs = landed(linked_specs(landed(read_landed(spark, supplier_documents(spark, sf_dir)), "documents")), "specs")
    found = vocabulary(specs, keep=("page_url",)).select("page_url", "request_type", "role", "ordinal", "column")
    lost = specs.where(F.col("text").isNull()).select(
        "page_url", F.lit("not landed").alias("request_type"), F.lit("").alias("role"), F.lit(0).alias("ordinal"),
        F.col("url").alias("column"),
    )
    return found.unionByName(lost)


def vocabulary_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints those documents do not describe the known way."""
    return (
        vocabulary_errors(order_specs(spark, sf_dir), keep=("o_orderkey",))
        .groupBy("request_type", "role", "error")
        .agg(F.count(F.lit(1)).alias("specs"), F.min("o_orderkey").alias("first_key"))
    )


def streamed_workset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remaining event ids found by a file stream over the raw pages, four files at a time."""
    emitted = scratch_path(spark, "emitted")
    query = stream_workset(
        spark,
        pages_ledger(spark, sf_dir),
        customers_ledger(spark, sf_dir),
        "EVENT",
        emitted,
        scratch_path(spark, "stream"),
        max_files_per_trigger=4,
    )
    query.awaitTermination()
    return read_emitted(spark, emitted).select("id")


def pending_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    The customers of the raw pages requested by a stream in four runs. After the first the segments
    BUILDING and FURNITURE land and MACHINERY fails; after the second it fails again, all pages come
    once more and HOUSEHOLD lands; after the third AUTOMOBILE fails.
    """
    root = scratch_path(spark, "pending")
    pages, target, failures = (f"{root}/{one}" for one in ("pages", "target", "failures"))
    customers = table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey").cast("bigint"))

    def of(*segments: str) -> DataFrame:
        return customers.where(F.col("c_mktsegment").isin(*segments))

    def land(*segments: str) -> None:
        rows = of(*segments).withColumn("body", F.lit("{}"))
        append_ledger(ledger_rows(rows, request_type=F.lit("EVENT"), path_id=F.col("id"), content=F.col("body")), target)

    def fail(*segments: str) -> None:
        failed_rows(of(*segments), "EVENT").write.mode("append").parquet(failures)

    def run() -> None:
        stream_pending(
            spark, pages, target, failures, "EVENT", f"{root}/requests", f"{root}/state"
        ).awaitTermination()

    raw = read_ledger(spark, pages_ledger(spark, sf_dir))
    append_ledger(raw, pages, PAGE_GROUP_ROWS)
    run()
    land("BUILDING", "FURNITURE")
    fail("MACHINERY")
    run()
    fail("MACHINERY")
    append_ledger(raw, pages, PAGE_GROUP_ROWS)
    land("HOUSEHOLD")
    run()
    fail("AUTOMOBILE")
    run()
    return read_requested(spark, f"{root}/requests").groupBy("id").agg(
        F.count(F.lit(1)).alias("requests"), F.max("tries").alias("tries")
    )


def answer_with_the_id() -> Send:
    """A transport that needs no network: a by-id call is answered with the id it asks for."""

    def send(call: dict) -> Reply:
        asked = call["url"].split("?")[0].rsplit("/", 1)[-1]
        result = f'{{"COLUMNS": ["ID"], "DATA": [[{json.dumps(asked)}]]}}'
        body = f'{{"MESSAGE": "success", "RESULTCOUNT": 1, "STATUSCODE": 400, "RESULT": {result}}}'
        return Reply(200, body.encode(), "application/json;charset=UTF-8")

    return send


CALLS = CallOptions(answer_with_the_id, BASE_URL, cooldown=(0.0, 0.0))


def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    A by-id stage over the ids of the raw pages, limited to a third, and the same stage
    resumed: every product is fetched exactly once.
    """
    dest, source = scratch_path(spark, "run"), pages_ledger(spark, sf_dir)
    total = table(spark, sf_dir, "orders").count()
    for size, limit in ((total // 4, total // 3), (total // 2, None)):
        run_stage(
            spark, "PRODUCT", "r1", dest, CALLS, ["productid"],
            ids_source=source, batch_size=max(1, size), limit=limit,
        )
    fetched = read_ledger(spark, target_path(dest, "PRODUCT", "r1"))
    return fetched.select("path_id", "url", "content_length", "content")


class PageServer:
    """
    A transport that serves the rendered pages of `orders`, and fails by a hash of the offset: the
    first digit of its md5 tells a page that is gone (1), cut off (2) or always busy (0); the rest
    of the second digit by 3 how many tries any other page fails before it is served.

    Each call leaves a file in `log`, in a folder all tasks share, which is how a try is told from
    the one before it.
    """

    def __init__(self, pages: str, log: str) -> None:
        self.pages, self.log = pages, log

    def __call__(self) -> Send:
        store, pages = pafs.FileSystem.from_uri(self.pages) if "://" in self.pages else (pafs.LocalFileSystem(), self.pages)
        log = self.log.split("://", 1)[-1] if "://" in self.log else self.log

        def body(start: int) -> bytes:
            table = pq.read_table(f"{pages}/start={start}", columns=["content"], filesystem=store, partitioning=None)
            return table.column("content")[0].as_py().encode()

        def send(call: dict) -> Reply:
            asked = json.loads(call["body"].removeprefix("payload="))
            start, kind = asked["start"], "application/json"
            if asked["rows"] == 1:  # the probe
                return Reply(200, body(1), kind)
            digits = hashlib.md5(str(start).encode()).hexdigest()
            mine = f"{log}/start={start}"
            store.create_dir(mine, recursive=True)
            earlier = len(store.get_file_info(pafs.FileSelector(mine)))
            with store.open_output_stream(f"{mine}/{uuid.uuid4().hex}") as file:
                file.write(b"")
            if digits[0] == "0" or digits[0] not in "12" and earlier < int(digits[1], 16) % 3:
                return Reply(503, b"busy")
            if digits[0] == "1":
                return Reply(404, b"")
            whole = body(start)
            return Reply(200, whole[:-1] if digits[0] == "2" else whole, kind)

        return send


def paged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    A paged stage over all `orders`, through a service that fails: what became of every page, in
    which try, and the records that the ledger holds of it.
    """
    dest, log = scratch_path(spark, "run"), scratch_path(spark, "calls")
    calls = CallOptions(
        PageServer(served_pages(spark, sf_dir), log), BASE_URL, cooldown=(0.0, 0.0), pauses=(0.0,) * 4
    )
    total = table(spark, sf_dir, "orders").count()
    try:
        run_stage(
            spark, "RECALLS", "r1", dest, calls, ["productid"], rows=SERVED_ROWS,
            batch_size=max(1, total // SERVED_ROWS // 2),
        )
    except IncompleteRunError:
        pass  # pages that are never served are what the failures below report
    ledger = read_ledger(spark, target_path(dest, "RECALLS", "r1"))
    number = F.col("productid").cast("bigint")
    kept = explode_records(ledger, ["productid"], keep=("start",)).groupBy("start").agg(
        F.count(F.lit(1)).alias("records"), F.min(number).alias("first_id"), F.max(number).alias("last_id")
    ).select("start", F.lit("ok").alias("outcome"), F.lit("kept").alias("failure"), "records", "first_id", "last_id")
    schema = "start int, outcome string, failure string"
    letters = target_path(dest, "RECALLS", "r1", "api_failures")
    if ledger_is_empty(spark, letters):
        return kept
    none = F.lit(0).cast("bigint")
    lost = read_ledger(spark, letters, T.StructType.fromDDL(schema)).select(
        "start", "outcome", "failure", none.alias("records"), none.alias("first_id"), none.alias("last_id")
    )
    return kept.unionByName(lost)


def forced_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two by-id stages after a paged one, run twice with force: every id is appended twice."""
    dest = scratch_path(spark, "run")
    append_ledger(_pages(spark, sf_dir), target_path(dest, "RECALLS", "r1"), PAGE_GROUP_ROWS)
    total = table(spark, sf_dir, "orders").count()
    columns = {"PRODUCT": ["productid"], "EVENT": ["recalleventid"]}
    for _ in range(2):
        run_stages(spark, "r1", dest, CALLS, columns, tuple(columns), batch_size=total, force=True)
    found = [read_ledger(spark, target_path(dest, name, "r1")) for name in columns]
    return found[0].unionByName(found[1]).groupBy("request_type", "path_id").agg(
        F.count(F.lit(1)).alias("copies")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    one.__name__: one
    for one in (
        page_plan, page_payloads, page_members, workset_events, workset_products, workset_kinds, workset_size,
        remaining_events, remaining_by_held_ids, remaining_against_nothing, remaining_first, batch_bounds, id_requests,
        page_sizes, page_counts, call_outcomes, kept_responses, failed_calls, retry_schedule,
        attempt_totals, requeued_ids, body_digests, undecodable_bodies, rejected_id_texts,
        flattened_records, flattened_tables, documented_types, typed_records, current_responses, current_pages, refreshed_view, missing_pages,
        missing_offsets, latest_events, integrity_report,
        malformed_bodies, drifted_responses, coverage_report, compacted_ledger, united_files, drifted_files, missing_values, sentence_names,
        column_lists, normalized_texts, escaped_elements, page_link_texts, spec_links,
        endpoint_vocabulary, landed_vocabulary, vocabulary_rejects, streamed_workset, pending_requests, resumed_run, paged_run, forced_run,
    )
}

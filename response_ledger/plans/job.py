"""A run: plan an endpoint's calls, make them batch by batch, land what came back."""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from response_ledger.operators.fetch import (
    Connect,
    Transient,
    fetch_requests,
    is_connection_error,
    with_attempts,
)
from response_ledger.operators.numbering import number_rows
from response_ledger.operators.outcomes import (
    OK,
    RETRIABLE,
    classify,
    dead_letters,
    retry_queue,
    to_ledger,
)
from response_ledger.operators.workset import (
    batch_number,
    create_workset,
    create_worksets,
    remaining,
)
from response_ledger.plans.requests import (
    Filters,
    plan_ids,
    plan_pages,
    plan_probe,
    plan_single,
    landed_spans,
    plan_missing_pages,
    rows_for,
)
from response_ledger.schemas import (
    BATCH_SIZE,
    CALL_PAUSES,
    COOLDOWN_SECONDS,
    DEFAULT_FILTERS,
    ENDPOINTS,
    MAX_WORKERS,
    SOURCE_TYPE,
    PauseSchedule,
)
from response_ledger.session import (
    READER_BATCH,
    READER_BATCH_ROWS,
    delete_path,
    scratch,
    scratch_path,
    setting,
)
from response_ledger.sources.ledger import (
    BODY_GROUP_ROWS,
    PAGE_GROUP_ROWS,
    append_ledger,
    hadoop_uri,
    ledger_is_empty,
    page_group_rows,
    read_ledger,
    require_ledger,
    target_path,
)

CHUNK_BATCHES = 256
# Calls handed to Python at a time. So few fit a socket's buffer, and Python makes calls while the
# JVM lands the replies to those before; of 10,000 each waits for the other.
CALL_ROWS = 1_000

logger = logging.getLogger(__name__)


class IncompleteRunError(Exception):
    """Raised at the end of a stage that has failures; its successes are in the ledger by then."""


class CallOptions(NamedTuple):
    """How a run talks to the service. `connect` opens one transport per task."""

    connect: Connect
    base_url: str
    max_workers: int = MAX_WORKERS
    cooldown: tuple[float, float] = COOLDOWN_SECONDS
    # After each try; their number is that of the tries.
    pauses: PauseSchedule = CALL_PAUSES
    # Which errors of the transport are tried again, for clients with error classes of their own.
    transient: Transient = is_connection_error


class StageReport(NamedTuple):
    written: int
    batches: int
    failed: int


class Settled(NamedTuple):
    """Landed requests: exactly one row per request, where it is, and rows per outcome."""

    outcomes: DataFrame
    landing: str
    totals: dict[str, int]

    @property
    def kept(self) -> int:
        return self.totals.get(OK, 0)

    @property
    def lost(self) -> int:
        return sum(self.totals.values()) - self.kept


def settle(requests: DataFrame, calls: CallOptions, group_rows: int = PAGE_GROUP_ROWS) -> Settled:
    """
    Make every call until it succeeds, fails for good or runs out of tries.

    Each try is landed once and read back, so no reply is asked for twice: Spark would call
    the service again for every use of an unlanded frame. The few tasks that may call only land
    the replies; all tasks judge them.
    """
    spark = requests.sparkSession
    landing = scratch_path(spark, "landing")
    pending, totals = with_attempts(requests), {}
    for attempt in range(1, len(calls.pauses) + 1):
        landed, answered = f"{landing}/try={attempt}", scratch_path(spark, "replies")
        replies = fetch_requests(
            pending, calls.connect, calls.max_workers, calls.cooldown, calls.transient
        )
        with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(CALL_ROWS)):
            replies.write.option("parquet.block.row.count.limit", group_rows).parquet(answered)
        judged = classify(spark.read.schema(replies.schema).parquet(answered), calls.pauses)
        judged.write.option("parquet.block.row.count.limit", group_rows).parquet(landed)
        delete_path(spark, answered)
        tried = spark.read.schema(judged.schema).parquet(landed)
        counts = {one["outcome"]: one["count"] for one in tried.groupBy("outcome").count().collect()}
        again = counts.pop(RETRIABLE, 0)
        for outcome, count in counts.items():
            totals[outcome] = totals.get(outcome, 0) + count
        if not again:
            break
        pending = retry_queue(tried, calls.pauses)
    tries = spark.read.schema(judged.schema).option("recursiveFileLookup", "true").parquet(landing)
    return Settled(tries.where(F.col("outcome") != RETRIABLE), landing, totals)


def source_total(spark: SparkSession, calls: CallOptions, filters: Filters | None = DEFAULT_FILTERS) -> int:
    """How many records the filters match; the probe is not kept."""
    probe = plan_probe(spark, calls.base_url, filters).withColumn("batch_no", F.lit(0).cast("bigint"))
    settled = settle(probe, calls)
    row = settled.outcomes.select("result_count", "url", "failure").first()
    delete_path(spark, settled.landing)
    if settled.kept != 1 or row["result_count"] is None:
        raise IncompleteRunError(f"No record count from {row['url']}: {row['failure']}")
    return row["result_count"]


def stage_ids(
    spark: SparkSession,
    request_type: str,
    ids_source: str | None,
    directory: str,
    force: bool,
    workset: DataFrame | None = None,
) -> DataFrame:
    """The ids a by-id stage has to fetch: its workset, less what the target holds."""
    if workset is None and ids_source is None:
        raise ValueError(f"{request_type} needs ids_source, the directory of a prior {SOURCE_TYPE} run")
    if workset is None:
        workset = create_workset(require_ledger(spark, ids_source), ENDPOINTS[request_type].id_column)
    if force or ledger_is_empty(spark, directory):
        return workset
    return remaining(workset, read_ledger(spark, directory), request_type)


def plan_stage(
    spark: SparkSession,
    request_type: str,
    directory: str,
    calls: CallOptions,
    display_columns: list[str],
    filters: Filters | None = DEFAULT_FILTERS,
    rows: int | None = None,
    ids_source: str | None = None,
    workset: DataFrame | None = None,
    batch_size: int = BATCH_SIZE,
    force: bool = False,
    limit: int | None = None,
    resume_pages: bool = False,
) -> DataFrame:
    """
    Every call of a stage with its `batch_no`, the limit applied after the resume. The ids
    come from the paged run at `ids_source`, or ready-made as `workset`. A paged endpoint is
    planned whole, unless `resume_pages` asks for the offsets alone that no page in its ledger
    holds yet.
    """
    endpoint = ENDPOINTS[request_type]
    if endpoint.paged:
        total, size = source_total(spark, calls, filters), rows_for(display_columns, rows)
        if resume_pages and not force and not ledger_is_empty(spark, directory):
            spans = landed_spans(read_ledger(spark, directory), total, display_columns, filters)
            left = plan_missing_pages(spans, calls.base_url, total, display_columns, size, filters)
            numbered = number_rows(left, "start")
            if limit is not None:
                numbered = numbered.where(F.col("n") <= limit)
            return numbered.withColumn("batch_no", batch_number("n", batch_size)).drop("n")
        pages = plan_pages(spark, calls.base_url, total, display_columns, size, filters)
        if limit is not None and limit * size < total:
            logger.warning("Only the first %s pages are fetched", limit)
            pages = pages.where(F.col("start") <= limit * size)
        place = f"((start - 1) div {size} + 1)"
        return pages.withColumn("batch_no", batch_number(place, batch_size))
    if endpoint.by_id:
        ids = stage_ids(spark, request_type, ids_source, directory, force, workset)
        numbered = number_rows(ids, "id")
        if limit is not None:
            if not numbered.where(F.col("n") > limit).isEmpty():
                logger.warning("Only the first %s ids are fetched", limit)
            numbered = numbered.where(F.col("n") <= limit)
        return plan_ids(
            numbered.withColumn("batch_no", batch_number("n", batch_size)),
            calls.base_url,
            request_type,
            display_columns,
            keep=("batch_no",),
        )
    single = plan_single(spark, calls.base_url, request_type, display_columns)
    if limit is not None and limit < 1:
        logger.warning("The only call is not made, as the limit is %s", limit)
        single = single.limit(0)
    return single.withColumn("batch_no", F.lit(1).cast("bigint"))


def run_stage(
    spark: SparkSession,
    request_type: str,
    run_id: str,
    dest: str,
    calls: CallOptions,
    display_columns: list[str],
    **options,
) -> StageReport:
    """
    Fetch one endpoint and append its responses under `dest`; `options` are `plan_stage`'s.

    The plan is written once, a folder per `CHUNK_BATCHES` batches, so picking a batch opens
    that folder's files and no others. Each batch is settled, then its successes are
    appended in one write and its failures go to the dead-letter table beside the ledger; an
    interrupted run loses one batch. Scratch tables go with the run, also when it fails. The
    ledger is the only resume state. Raises after the
    last batch if any request failed; a stage with nothing left to fetch writes nothing.
    """
    with scratch(spark):
        return _run_stage(spark, request_type, run_id, dest, calls, display_columns, **options)


def _run_stage(
    spark: SparkSession,
    request_type: str,
    run_id: str,
    dest: str,
    calls: CallOptions,
    display_columns: list[str],
    **options,
) -> StageReport:
    directory = target_path(dest, request_type, run_id)
    plan_path = scratch_path(spark, "plan")
    # The source of the ids may be the work of another writer, see READER_BATCH.
    with setting(spark, READER_BATCH, READER_BATCH_ROWS):
        planned = plan_stage(spark, request_type, directory, calls, display_columns, **options)
        chunked = planned.withColumn("chunk", F.expr(f"batch_no div {CHUNK_BATCHES}"))
        chunked.write.partitionBy("chunk").parquet(plan_path)
    plan = spark.read.schema(chunked.schema).parquet(plan_path)
    batches = plan.agg(F.max("batch_no")).first()[0] or 0
    size = rows_for(display_columns, options.get("rows"))
    group_rows = page_group_rows(size) if ENDPOINTS[request_type].paged else BODY_GROUP_ROWS
    written = failed = 0
    first = None
    for batch_no in range(1, batches + 1):
        chunk = plan.where(F.col("chunk") == batch_no // CHUNK_BATCHES).drop("chunk")
        settled = settle(chunk.where(F.col("batch_no") == batch_no), calls, group_rows)
        kept, lost = settled.kept, settled.lost
        if kept:
            append_ledger(to_ledger(settled.outcomes), directory, group_rows)
        if lost:
            letters = dead_letters(settled.outcomes)
            letters.write.mode("append").option("compression", "zstd").parquet(
                hadoop_uri(target_path(dest, request_type, run_id, "api_failures"))
            )
            first = first or letters.select("url", "start", "failure").first()
        delete_path(spark, settled.landing)
        written, failed = written + kept, failed + lost
        logger.info("%s batch %s of %s: %s kept, %s lost", request_type, batch_no, batches, kept, lost)
    if not batches:
        logger.info("%s holds all of %s already", directory, request_type)
    if failed:
        raise IncompleteRunError(
            f"{request_type}: {failed} calls without a response, the first "
            f"{first['url']} (start {first['start']}): {first['failure']}"
        )
    return StageReport(written, batches, failed)


def run_stages(
    spark: SparkSession,
    run_id: str,
    dest: str,
    calls: CallOptions,
    vocabulary: dict[str, list[str]],
    stages: tuple[str, ...] = tuple(ENDPOINTS),
    **options,
) -> dict[str, StageReport]:
    """
    Stages in order under one run id; the by-id ones draw on this run's paged stage. A
    stage that ends incomplete ends the run, and the next run resumes.

    The pages are the bulk of a run, so the ids of all by-id stages are drawn in one pass
    when the first of them is reached, and kept as a narrow table for the others.
    """
    with scratch(spark):
        return _run_stages(spark, run_id, dest, calls, vocabulary, stages, **options)


def _run_stages(
    spark: SparkSession,
    run_id: str,
    dest: str,
    calls: CallOptions,
    vocabulary: dict[str, list[str]],
    stages: tuple[str, ...],
    **options,
) -> dict[str, StageReport]:
    id_columns = sorted({ENDPOINTS[one].id_column for one in stages if ENDPOINTS[one].by_id})
    worksets, reports = None, {}
    for request_type in stages:
        own, id_column = dict(options), ENDPOINTS[request_type].id_column
        if id_column is not None:
            if worksets is None:
                pages = require_ledger(spark, target_path(dest, SOURCE_TYPE, run_id))
                found = create_worksets(pages, id_columns)
                path = scratch_path(spark, "worksets")
                with setting(spark, READER_BATCH, READER_BATCH_ROWS):
                    found.write.parquet(path)
                worksets = spark.read.schema(found.schema).parquet(path)
            own["workset"] = worksets.where(F.col("id_column") == id_column).select("id")
        reports[request_type] = run_stage(
            spark, request_type, run_id, dest, calls, vocabulary[request_type], **own
        )
    return reports

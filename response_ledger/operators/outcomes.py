"""Judging replies: which are responses to keep, which to try again, which to report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from response_ledger.functions.calls import backoff_seconds, body_length, http_class, utf8_text
from response_ledger.operators.records import STRICT_JSON
from response_ledger.schemas import CALL_PAUSES, LEDGER, REQUEST, SUCCESS_MESSAGE, PauseSchedule

OK = "ok"
RETRIABLE = "retriable"
# Outcome classes: ok, retriable, exhausted (out of tries), terminal (HTTP), error (the
# transport raised), undecodable (not UTF-8), malformed (not one JSON object), api (the
# body reports a failure).


def read_envelopes(bodies: DataFrame, content: str = "content") -> DataFrame:
    """
    The status fields of each body as `api_message`, `api_status`, `result_count`, and
    `well_formed`: whether the whole text is exactly one JSON object.

    The text is parsed once, as the first element of a list. The list's second and last
    element holds the text's own digest, which no text can hold: a cut-off body, a list or
    object it closes by itself, and anything behind it keep that element from being second.
    """
    mark = F.md5(F.col(content).cast("binary"))
    listed = F.concat(F.lit("["), F.col(content), F.lit(',{"body_digest":"'), mark, F.lit('"}]'))
    parsed = F.from_json(
        listed,
        "array<struct<MESSAGE:string,STATUSCODE:string,RESULTCOUNT:string,body_digest:string>>",
        STRICT_JSON,
    )
    whole = (
        (F.size("_parsed") == 2)
        & F.get("_parsed", F.lit(0)).isNotNull()
        & F.get("_parsed", F.lit(1))["body_digest"].eqNullSafe(mark)
    )
    return (
        bodies.withColumn("_parsed", parsed)
        .withColumn("well_formed", F.coalesce(whole, F.lit(False)))
        .withColumn("_envelope", F.when(F.col("well_formed"), F.get("_parsed", F.lit(0))))
        .withColumn("api_message", F.col("_envelope.MESSAGE"))
        .withColumn("api_status", F.col("_envelope.STATUSCODE").try_cast("int"))
        .withColumn("result_count", F.col("_envelope.RESULTCOUNT").try_cast("bigint"))
        .drop("_parsed", "_envelope")
    )


def classify(replies: DataFrame, pauses: PauseSchedule = CALL_PAUSES) -> DataFrame:
    """
    Each reply as a call record: `raw` gives way to its digest, length and text, `attempts`
    is counted on, the envelope fields, `outcome` and, for a failure, `failure` are added.

    Land the records before filtering them: Spark pushes a filter on `outcome` below the
    parse it comes from and would read each body again for it.
    """
    tried = (
        replies.withColumn("attempts", F.col("attempts") + 1)
        .withColumn("content_length", body_length(F.col("header_length"), F.col("raw")))
        .withColumn("sha_256", F.sha2("raw", 256))
        .withColumn("content", utf8_text(F.col("raw")))
        .drop("raw", "header_length")
    )
    read = read_envelopes(tried)
    http = http_class(F.col("status"))
    transient = F.when(F.col("error_class").isNull(), http == RETRIABLE).otherwise(
        F.col("error_class") == "transport"
    )
    outcome = (
        F.when(transient & (F.col("attempts") >= len(pauses)), "exhausted")
        .when(transient, RETRIABLE)
        .when(F.col("error_class").isNotNull(), "error")
        .when(http != OK, "terminal")
        .when(F.col("content").isNull(), "undecodable")
        .when(~F.col("well_formed"), "malformed")
        .when(~F.col("api_message").eqNullSafe(SUCCESS_MESSAGE), "api")
        .otherwise(OK)
    )
    status_text = F.concat(F.lit("HTTP "), F.col("status").cast("string"))
    api_text = F.concat(
        F.coalesce("api_message", F.lit("None")),
        F.lit(" (STATUSCODE "),
        F.coalesce(F.col("api_status").cast("string"), F.lit("None")),
        F.lit(")"),
    )
    failure = (
        F.when(F.col("outcome") == OK, F.lit(None).cast("string"))
        .when(F.col("error_class").isNotNull(), F.concat_ws(": ", "error_class", "error_message"))
        .when(F.col("outcome") == "undecodable", "body is not valid UTF-8")
        .when(F.col("outcome") == "malformed", "body is not one JSON object")
        .when(F.col("outcome") == "api", api_text)
        .otherwise(status_text)
    )
    return read.withColumn("outcome", outcome).withColumn("failure", failure)


def to_ledger(outcomes: DataFrame) -> DataFrame:
    """The responses to keep, as ledger rows."""
    return outcomes.where(F.col("outcome") == OK).select(*LEDGER.names)


def dead_letters(outcomes: DataFrame) -> DataFrame:
    """Requests that came to an end without a response, and why."""
    return outcomes.where(~F.col("outcome").isin(OK, RETRIABLE)).select(
        *REQUEST.names, "batch_no", "attempts", "status", "api_status", "outcome", "failure", "fetched_at"
    )


def retry_queue(outcomes: DataFrame, pauses: PauseSchedule = CALL_PAUSES) -> DataFrame:
    """
    Requests to try again, with the tries so far and when the next one is due.

    The jitter below a second is hashed from the request and its tries: it spreads requests
    as a random number would, but a recomputed task finds the same rows again.
    """
    spread = F.pmod(F.xxhash64("url", "start", "attempts"), F.lit(1_000_000)) / 1_000_000
    pause = backoff_seconds(F.col("attempts"), pauses) + spread
    due = F.timestamp_micros(F.unix_micros("fetched_at") + (pause * 1_000_000).cast("bigint"))
    return outcomes.where(F.col("outcome") == RETRIABLE).select(
        *REQUEST.names, "batch_no", "attempts", due.alias("next_attempt_at")
    )


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """Requests per batch and outcome."""
    return outcomes.groupBy("batch_no", "outcome").agg(F.count(F.lit(1)).alias("requests"))


def run_totals(outcomes: DataFrame) -> DataFrame:
    """One row over settled outcomes: written, failed, batches and the first failure."""
    failed = F.col("outcome") != OK
    place = F.struct("batch_no", F.coalesce("path_id", F.col("start").cast("bigint")))
    return outcomes.where(F.col("outcome") != RETRIABLE).agg(
        F.count_if(~failed).alias("written"),
        F.count_if(failed).alias("failed"),
        F.countDistinct("batch_no").alias("batches"),
        F.min_by(F.struct("url", "start", "failure"), F.when(failed, place)).alias("first_failure"),
    )

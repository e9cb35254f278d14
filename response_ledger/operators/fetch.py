"""Making planned calls from inside a Spark job, through a transport the caller brings."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.schemas import (
    COOLDOWN_SECONDS,
    FORM_CONTENT_TYPE,
    MAX_WORKERS,
    REPLY_FIELDS,
)


class Reply(NamedTuple):
    """What a transport answers; `content_length` is the header's value if there is one."""

    status: int
    body: bytes
    content_type: str = ""
    content_length: int | None = None


# A request that got no answer.
_NO_REPLY = Reply(None, None)
_REPLY = "_reply"

# A call as the transport sees it: method, url (signed), content_type and body of a POST.
Send = Callable[[dict], Reply]
Connect = Callable[[], Send]

# Which failures of a transport are worth another try.
Transient = Callable[[Exception], bool]


def is_connection_error(error: Exception) -> bool:
    """Refused, reset, timed out: the standard library's own errors of that kind."""
    return isinstance(error, OSError)


# Replies are handed to the JVM in pieces of about this many body bytes.
_FLUSH_BYTES = 32 << 20

_REPLY_TYPES = pa.schema(
    [
        ("signature", pa.string()),
        ("status", pa.int32()),
        ("content_type", pa.string()),
        ("header_length", pa.int64()),
        ("raw", pa.binary()),
        ("fetched_at", pa.timestamp("us", tz="UTC")),
        ("error_class", pa.string()),
        ("error_message", pa.string()),
    ]
)


def _told(columns: dict[str, list]) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array(columns[one.name], one.type) for one in _REPLY_TYPES], fields=list(_REPLY_TYPES)
    )


def fetch_requests(
    requests: DataFrame,
    connect: Connect,
    max_workers: int = MAX_WORKERS,
    cooldown: tuple[float, float] = COOLDOWN_SECONDS,
    transient: Transient = is_connection_error,
) -> DataFrame:
    """
    One try of every request, failures included: the request's columns plus `REPLY_FIELDS`.

    At most `max_workers` tasks call at a time. Each connects once, at its first call and
    again if that failed, and pauses before every call. An error for which `transient` holds
    is the transport's and worth another try; any other is the request's. A request with `next_attempt_at` also waits until then. Spark may run a task
    again, so a call is made at least once: write the result before using it twice.

    Python is handed what a call is made of and no other column: lists and maps cost more on the
    way there and back than the call's own Python.
    """
    carried = requests.columns
    asked = ["method", "url", "body", *(["next_attempt_at"] if "next_attempt_at" in carried else [])]

    def fetch(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        send = None

        def open_transport() -> Send:
            nonlocal send
            if send is None:
                send = connect()
            return send

        try:
            for batch in batches:
                # Of texts, many times faster than `to_pylist`.
                methods, urls, bodies = (one.to_numpy(zero_copy_only=False).tolist() for one in batch[:3])
                due = batch[3].to_pylist() if len(batch) > 3 and batch[3].is_valid().true_count else [None] * len(urls)
                columns, size = {name: [] for name in _REPLY_TYPES.names}, 0
                signatures, statuses, content_types, lengths, raws, times, classes, messages = columns.values()
                for place, url in enumerate(urls):
                    pause = random.uniform(*cooldown)
                    if due[place] is not None:
                        pause = max(pause, due[place].timestamp() - time.time())
                    if pause > 0:
                        time.sleep(pause)
                    signature, body = str(int(time.time())), bodies[place]
                    call = {
                        "method": methods[place],
                        "url": f"{url}?signature={signature}",
                        "body": body,
                        "content_type": None if body is None else FORM_CONTENT_TYPE,
                    }
                    reply, error_class, error_message = _NO_REPLY, None, None
                    try:
                        reply = open_transport()(call)
                    except Exception as error:  # a failure is this request's, never the batch's
                        error_class = "transport" if transient(error) else type(error).__name__
                        error_message = str(error)
                    signatures.append(signature)
                    statuses.append(reply.status)
                    content_types.append(reply.content_type)
                    lengths.append(reply.content_length)
                    raws.append(reply.body)
                    times.append(time.time_ns() // 1000)
                    classes.append(error_class)
                    messages.append(error_message)
                    size += len(reply.body or b"")
                    if size >= _FLUSH_BYTES:
                        yield _told(columns)
                        size = 0
                        for one in columns.values():
                            one.clear()
                if raws:
                    yield _told(columns)
        finally:
            close = getattr(send, "close", None)
            if close is not None:
                close()

    replies = T.StructType(list(REPLY_FIELDS))
    call = F.arrow_udf(fetch, replies).asNondeterministic()
    # The condition always holds; by it calls are made even if nothing else asks for the replies.
    answered = requests.repartition(max_workers).withColumn(_REPLY, call(*asked)).where(F.col(_REPLY).isNotNull())
    return answered.select(*carried, *[F.col(f"{_REPLY}.{one.name}") for one in REPLY_FIELDS])


def with_attempts(requests: DataFrame) -> DataFrame:
    """Requests before their first try."""
    return requests.withColumn("attempts", F.lit(0)).withColumn(
        "next_attempt_at", F.lit(None).cast("timestamp")
    )

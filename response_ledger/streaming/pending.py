"""
Ids that wait for their response, as the state of a stream over pages, responses and failures.

An id enters the state when a page names it and is requested then. It leaves when its response lands
in the target, so the state holds what is under way and not all that ever was; a row of it holds the
waiting ids of one group, and goes with the last of them. A failure that lands in
the failures table requests the id again, with the tries counted.

An id that is named again after it landed is new to the state; the target still holds it, so the
request is dropped where requests are written, and the id is noted as settled there. These notes are a
source of the stream, too, and take it out of the state with the next run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from response_ledger.operators.workset import id_value, record_ids, remaining
from response_ledger.schemas import ENDPOINTS, LEDGER
from response_ledger.session import READER_BATCH, READER_BATCH_ROWS, setting
from response_ledger.sources.ledger import hadoop_uri, ledger_is_empty, read_ledger
from response_ledger.streaming.worksets import stream_name

# The state has a row per group of ids by hash: a call of the state function takes milliseconds for one
# id or for a thousand. A checkpoint belongs to the number it was begun with.
GROUPS = 1 << 14

_ASKED, _FAILED, _LANDED = "asked", "failed", "landed"

REQUESTED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tries", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("epoch", T.LongType()),
    ]
)
# What is read of responses, of failures and of settled ids.
_ANSWER = T.StructType([T.StructField("request_type", T.StringType()), T.StructField("path_id", T.LongType())])


def read_requested(spark: SparkSession, directory: str) -> DataFrame:
    """Every request that streams have made: the id, which try it is, the stream and its micro-batch."""
    folder = f"{directory.rstrip('/')}/requested"
    if ledger_is_empty(spark, folder):
        return spark.createDataFrame([], REQUESTED)
    return spark.read.schema(REQUESTED).parquet(hadoop_uri(folder))


def _waiting(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A group's news: a response ends an id's wait, a failure starts the next try, a page the first one."""
    news: dict[str, set[int]] = {_ASKED: set(), _FAILED: set(), _LANDED: set()}
    for part in parts:
        for id_, event in zip(part["id"].tolist(), part["event"].tolist()):
            news[event].add(id_)
    waiting = dict(zip(*state.get)) if state.exists else {}
    landed = news[_LANDED]
    requested = {id_: waiting[id_] + 1 for id_ in news[_FAILED] - landed if id_ in waiting}
    requested.update((id_, 1) for id_ in news[_ASKED] - landed if id_ not in waiting)
    gone = landed & waiting.keys()
    if not requested and not gone:
        return
    waiting = {id_: tries for id_, tries in waiting.items() if id_ not in gone} | requested
    if waiting:
        state.update((list(waiting), list(waiting.values())))
    else:
        state.remove()
    if requested:
        yield pd.DataFrame({"id": list(requested), "tries": list(requested.values())})


def _folder(spark: SparkSession, path: str) -> str:
    """A folder that a stream can be started over before anything is in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(hadoop_uri(path))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    return hadoop_uri(path)


def stream_pending(
    spark: SparkSession,
    pages_directory: str,
    target_directory: str,
    failures_directory: str,
    request_type: str,
    requests_directory: str,
    checkpoint_directory: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """
    Request every id a page names until its response lands; `read_requested` reads the requests.

    Of one micro-batch's news about an id a response counts before a failure and a failure before a
    page; a failure of an id that does not wait is no request. An id's events are made distinct
    per task before they are dealt to the state, so a hot id is a few rows. A micro-batch owns its
    `stream=/epoch=` folders and overwrites them, so one that is replayed requests nothing twice.

    Without a session setting of its own the state is in memory; for many ids set the RocksDB provider.
    """
    id_column = ENDPOINTS[request_type].id_column
    if id_column is None:
        raise ValueError(f"{request_type} takes no id")
    root, stream = requests_directory.rstrip("/"), stream_name(checkpoint_directory)

    def read(directory: str, schema: T.StructType) -> DataFrame:
        reader = (
            spark.readStream.schema(schema)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
        )
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(_folder(spark, directory))

    def answers(directory: str, event: str) -> DataFrame:
        ours = (F.col("request_type") == request_type) & F.col("path_id").isNotNull()
        return read(directory, _ANSWER).where(ours).select(F.col("path_id").alias("id"), F.lit(event).alias("event"))

    asked = record_ids(read(pages_directory, LEDGER), id_column).select(
        id_value(F.col(id_column.lower())).alias("id"), F.lit(_ASKED).alias("event")
    )
    news = (
        asked.unionByName(answers(failures_directory, _FAILED))
        .unionByName(answers(target_directory, _LANDED))
        .unionByName(answers(f"{root}/settled", _LANDED))
    )
    requests = (
        distinct_per_task(news)
        .withColumn("group", F.pmod(F.xxhash64("id"), F.lit(GROUPS)))
        .groupBy("group")
        .applyInPandasWithState(
            _waiting, "id long, tries long", "ids array<long>, tries array<long>", "append", GroupStateTimeout.NoTimeout
        )
    )

    def emit(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        own = f"stream={stream}/epoch={epoch}"
        found = f"{hadoop_uri(root)}/found/{own}"
        # Written first: the state must be asked once, and two tables come out of it.
        batch.write.mode("overwrite").parquet(found)
        all_ = session.read.schema(batch.schema).parquet(found)
        left = all_
        if not ledger_is_empty(session, target_directory):
            left = remaining(all_, read_ledger(session, target_directory), request_type)
        left.write.mode("overwrite").parquet(f"{hadoop_uri(root)}/requested/{own}")
        held = all_.join(session.read.schema(left.schema).parquet(f"{hadoop_uri(root)}/requested/{own}"), "id", "left_anti")
        settled = held.select(F.lit(request_type).alias("request_type"), F.col("id").alias("path_id"))
        settled.write.mode("overwrite").parquet(f"{hadoop_uri(root)}/settled/{own}")

    writer = (
        requests.writeStream.foreachBatch(emit)
        .outputMode("append")
        .option("checkpointLocation", hadoop_uri(checkpoint_directory))
        .trigger(availableNow=True)
    )
    # A stream keeps the settings it was started with.
    with setting(spark, READER_BATCH, READER_BATCH_ROWS):
        return writer.start()


def distinct_per_task(news: DataFrame) -> DataFrame:
    """The events of each task without repeats within an Arrow batch, so that a hot id moves few rows."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop_duplicates()

    return news.mapInPandas(distinct, "id long, event string")

"""New ids as paged responses arrive: an incremental workset on a file stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from response_ledger.operators.workset import id_value, record_ids, remaining
from response_ledger.schemas import ENDPOINTS, LEDGER
from response_ledger.session import READER_BATCH, READER_BATCH_ROWS, setting
from response_ledger.sources.ledger import hadoop_uri, ledger_is_empty, read_ledger

EMITTED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("epoch", T.LongType()),
    ]
)


def read_emitted(spark: SparkSession, directory: str) -> DataFrame:
    """The ids streams have emitted so far, each with the stream and micro-batch that found it."""
    if ledger_is_empty(spark, directory):
        return spark.createDataFrame([], EMITTED)
    return spark.read.schema(EMITTED).parquet(hadoop_uri(directory))


def stream_name(checkpoint_directory: str) -> str:
    """What a stream's folders are called: its checkpoint makes it the same stream."""
    return hashlib.sha256(checkpoint_directory.rstrip("/").encode()).hexdigest()[:16]


def stream_workset(
    spark: SparkSession,
    pages_directory: str,
    target_directory: str,
    request_type: str,
    emitted_directory: str,
    checkpoint_directory: str,
    max_files_per_trigger: int | None = None,
    force: bool = False,
) -> StreamingQuery:
    """
    Emit every id the target does not hold yet, once, as source files arrive.

    The stream's own state knows the ids it has seen, so a micro-batch has new ids only and
    does not read what earlier ones emitted. They are anti-joined with the target ledger and
    with what other streams emitted. A micro-batch owns its `stream=/epoch=` folder and
    overwrites it, so one that is replayed after a failure emits the same ids once, and a
    stream with a new checkpoint touches no folder of an earlier one. For many ids set the
    RocksDB state store provider.
    """
    id_column = ENDPOINTS[request_type].id_column
    if id_column is None:
        raise ValueError(f"{request_type} takes no id")
    reader = (
        spark.readStream.schema(LEDGER)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ids = record_ids(reader.parquet(hadoop_uri(pages_directory)), id_column).select(
        id_value(F.col(id_column.lower())).alias("id")
    )
    stream = stream_name(checkpoint_directory)

    def emit(batch: DataFrame, epoch: int) -> None:
        session, fresh = batch.sparkSession, batch
        if not force and not ledger_is_empty(session, target_directory):
            fresh = remaining(fresh, read_ledger(session, target_directory), request_type)
        others = read_emitted(session, emitted_directory).where(F.col("stream") != stream)
        fresh = fresh.join(others.select("id"), "id", "left_anti")
        own = f"{hadoop_uri(emitted_directory)}/stream={stream}/epoch={epoch}"
        fresh.write.mode("overwrite").parquet(own)

    writer = (
        ids.dropDuplicates(["id"])
        .writeStream.foreachBatch(emit)
        .option("checkpointLocation", hadoop_uri(checkpoint_directory))
        .trigger(availableNow=True)
    )
    # A stream keeps the settings it was started with.
    with setting(spark, READER_BATCH, READER_BATCH_ROWS):
        return writer.start()

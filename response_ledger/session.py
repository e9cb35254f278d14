"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache

from pyspark.sql import DataFrame, SparkSession


# Page ledgers of other writers may hold a whole run in one row group. With rows of
# megabytes the reader's default batch of 4,096 does not fit its 2 GB buffer; narrow scans
# measure the same at 32. Ledgers of `append_ledger` read with the default, too.
READER_BATCH = "spark.sql.parquet.columnarReaderBatchSize"
READER_BATCH_ROWS = "32"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs started inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def local_session(cores: str = "8", app: str = "response_ledger") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config(READER_BATCH, READER_BATCH_ROWS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Scratch folders this process wrote and has not removed yet, with the session to do it by.
_written: dict[str, SparkSession] = {}


@atexit.register
def _remove_written() -> None:
    for path, spark in list(_written.items()):
        # Whatever is gone by now, the session or the folder, is no reason to stop.
        with suppress(Exception):
            delete_path(spark, path)


def scratch_root(spark: SparkSession) -> str:
    """
    The shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of its own: on a cluster that
    folder would exist on one machine only. Nothing of the caller's session is changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="response-ledger-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """
    A new path in the scratch folder. Whoever reads the table written there calls
    `delete_path` when done; `scratch` does it for all that is written inside its block, and
    what is left goes when the process ends.
    """
    path = f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table this library wrote."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    _written.pop(path, None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables written inside the block, also when it fails."""
    before = set(_written)
    try:
        yield
    finally:
        for path in _written.keys() - before:
            delete_path(spark, path)


def landed(frame: DataFrame, purpose: str) -> DataFrame:
    """
    A frame written to the scratch folder and read back: evaluated once, its lineage cut,
    and safe against lost executors.
    """
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

"""Landed documentation: pages and spec files, one row per file."""

from __future__ import annotations

import errno
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from response_ledger.functions.text import resolve_link, spec_link
from response_ledger.session import delete_path, landed, setting
from response_ledger.sources.ledger import hadoop_uri

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# What Spark escapes in the names of folders, and how it names that of nulls and empty values.
_FOLDER, _NO_VALUE = b"url=", b"__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(rb"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
_ESCAPE = re.compile(rb"%([0-9A-Fa-f]{2})")
_CHECKSUMS = b"crc\0"
# Texts handed to Python at a time, names handed to the JVM, and about how many bytes of texts.
_TEXT_ROWS, _NAME_ROWS, _FLUSH_BYTES = 256, 10_000, 16 << 20


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files as (`url`, `text`)."""
    return spark.read.text(hadoop_uri(path), wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.col("value").alias("text")
    )


def land_documents(documents: DataFrame, path: str) -> None:
    """
    Append documents (`url`, `text`) as text files, each in a folder named by the address it was
    fetched from, so that links between landed documents can be followed.

    A row is a file, also where an address occurs again. Null texts become empty ones. Stores
    that bound the length of a name, most at 255 bytes, bound that of an encoded address. A call
    that fails before all files are made lands none.
    """
    spark = documents.sparkSession
    # Making a file takes far longer than its bytes, and the rows may all come in one task.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("url", F.col("text").alias("value")).repartition(tasks)
    folder = _local_folder(spark, path)
    if folder is not None:
        _land_locally(rows, folder)
        return
    (
        rows.write.mode("append")
        .partitionBy("url")
        .option("maxRecordsPerFile", 1)
        .text(hadoop_uri(path))
    )


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """What `land_documents` wrote until now, as (`url`, `text`)."""
    folder = _local_folder(spark, path)
    if folder is not None and os.path.isdir(folder):
        files = _read_locally(spark, folder)
    else:
        # Folders are listed by a job, of a task each unless told otherwise.
        with setting(spark, _LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism)):
            files = spark.read.schema("value string, url string").text(hadoop_uri(path), wholetext=True)
    # The writer ends each text with a line feed of its own.
    return files.select("url", F.expr("left(value, length(value) - 1)").alias("text"))


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """
    The folder a path names in the local file system, shared ones mounted there included.

    Hadoop starts processes there for each file it makes, and the driver alone moves and lists
    the folders, so tasks make, move and list them themselves. Other stores are left to Spark.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(hadoop_uri(path))
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() != "file":
        return None
    return place.makeQualified(store.getUri(), store.getWorkingDirectory()).toUri().getPath()


def _folder_name(url: bytes | None) -> bytes:
    return _FOLDER + (_ESCAPED.sub(lambda one: b"%%%02X" % ord(one[0]), url) if url else _NO_VALUE)


def _address(name: bytes) -> bytes | None:
    value = name.removeprefix(_FOLDER)
    return None if value == _NO_VALUE else _ESCAPE.sub(lambda one: chr(int(one[1], 16)).encode(), value)


def _batch(**columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(one, pa.binary()) for one in columns.values()], names=list(columns))


def _checksums(data: bytes, size: int = 512) -> bytes:
    """What Hadoop's local file system keeps beside a file to tell when it is damaged."""
    sums = [zlib.crc32(data[at : at + size]) for at in range(0, len(data), size)]
    return _CHECKSUMS + struct.pack(f">i{len(sums)}I", size, *sums)


def _checked(folder: bytes, name: bytes) -> bytes:
    """A file's bytes, which match its checksums if there are any."""
    with open(os.path.join(folder, name), "rb") as file:
        data = file.read()
    with suppress(FileNotFoundError), open(os.path.join(folder, b".%s.crc" % name), "rb") as file:
        kept = file.read()
        if kept.startswith(_CHECKSUMS) and kept != _checksums(data, int.from_bytes(kept[4:8])):
            raise OSError(f"{os.fsdecode(os.path.join(folder, name))} does not match its checksums")
    return data


def _move(source: bytes, target: bytes) -> None:
    try:
        os.rename(source, target)
    except FileNotFoundError:
        # Another try of the same task may have moved it.
        if os.path.lexists(source):
            raise


def _move_folders(source: bytes, target: bytes) -> None:
    """The folders in `source` to `target`, where one of the same name takes their files."""
    for name in os.listdir(source):
        mine, theirs = os.path.join(source, name), os.path.join(target, name)
        try:
            _move(mine, theirs)
        except OSError as taken:
            if taken.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                raise
            for file in os.listdir(mine):
                _move(os.path.join(mine, file), os.path.join(theirs, file))


def _land_locally(rows: DataFrame, folder: str) -> None:
    """
    Rows (`url`, `value`) as Spark's writer would land them. Each try of a task makes its files in
    a folder of its own, and those of the tries that came to their end are moved to their places.
    """
    spark, run = rows.sparkSession, uuid.uuid4().hex
    staging = f"{folder.rstrip('/')}/_landing-{run}"

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId(), 0
        name = f"{task:05d}-{uuid.uuid4().hex}".encode()
        mine = os.path.join(os.fsencode(staging), name)
        for batch in batches:
            for url, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not count:
                    os.mkdir(mine)
                place = os.path.join(mine, _folder_name(url))
                with suppress(FileExistsError):
                    os.mkdir(place)
                file, data = b"part-%05d-%s.c%03d.txt" % (task, run.encode(), count), (value or b"") + b"\n"
                for part, body in ((file, data), (b".%s.crc" % file, _checksums(data))):
                    with open(os.path.join(place, part), "xb") as opened:
                        opened.write(body)
                count += 1
        if count:
            yield _batch(name=[name])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                _move_folders(os.path.join(os.fsencode(staging), name), os.fsencode(folder))
        yield from ()

    os.makedirs(staging)
    try:
        # Spark hands Python 10,000 rows at a time by default; of long texts that is too much to hold.
        with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(_TEXT_ROWS)):
            texts = rows.select(F.col("url").cast("string").cast("binary"), F.col("value").cast("binary"))
            ended = texts.mapInArrow(made, "name binary").collect()
        if ended:
            tasks = min(len(ended), spark.sparkContext.defaultParallelism)
            names = spark.createDataFrame([(bytes(one["name"]),) for one in ended], "name binary")
            names.repartition(tasks).mapInArrow(moved, "name binary").collect()
        with open(f"{folder}/_SUCCESS", "wb"):
            pass
    finally:
        delete_path(spark, f"file://{staging}")


def _read_locally(spark: SparkSession, folder: str) -> DataFrame:
    """(`url`, `value`) of the files that are there now. They are listed once and read when needed."""
    root = os.fsencode(folder)

    def folders(_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = []
        with os.scandir(root) as found:
            for one in found:
                if one.name.startswith(_FOLDER):
                    names.append(one.name)
                if len(names) == _NAME_ROWS:
                    yield _batch(name=names)
                    names = []
        yield _batch(name=names)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (name, file)
                for name in batch.column(0).to_pylist()
                for file in os.listdir(os.path.join(root, name))
                if not file.startswith((b".", b"_"))
            ]
            yield _batch(name=[name for name, _ in found], file=[file for _, file in found])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, values, held = [], [], 0
            for name, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                value = _checked(os.path.join(root, name), file)
                # Spark's scans pass over files without a byte, too.
                if value:
                    urls.append(_address(name))
                    values.append(value)
                    held += len(value)
                if held >= _FLUSH_BYTES:
                    yield _batch(url=urls, value=values)
                    urls, values, held = [], [], 0
            yield _batch(url=urls, value=values)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = spark.range(0, 1, 1, 1).mapInArrow(folders, "name binary").repartition(tasks)
    listing = landed(names.mapInArrow(files, "name binary, file binary"), "listing")
    # As many tasks again, as a scan puts small files together.
    read = listing.repartition(tasks).mapInArrow(texts, "url binary, value binary")
    return read.select(F.col("url").cast("string"), F.col("value").cast("string"))


def linked_specs(landed: DataFrame) -> DataFrame:
    """
    The spec each landed page loads: (`page_url`, `url`, `text`), the last two of the spec.

    `text` is null where the page names a spec that was not landed. Documents that name none are
    no pages. Only addresses are joined on; a spec that many pages load is read for each of them.
    """
    pages = landed.select(
        F.col("url").alias("page_url"), resolve_link(F.col("url"), spec_link(F.col("text"))).alias("url")
    ).where(F.col("url").isNotNull())
    return pages.join(landed, "url", "left").select("page_url", "url", "text")

"""
Small files of a ledger merged into few large ones, behind a manifest.

By-id stages leave a file per task and batch. `compact` rewrites the small ones, sorted by what was
asked for, into files of about `TARGET_BYTES` (less where a
task would sort more than `SORTED_BYTES` for it), and then records in a manifest which files these
replace. Readers that follow the manifest, `read_compacted`, see either all old files or the new
ones. `vacuum` removes what was replaced, once no reader is left that began before.

`<ledger>/_manifest/version=<n>` lists files as replaced or added, `<ledger>/_compacted/version=<n>`
holds the new ones. Names that begin with an underscore are hidden from Spark's own listing, so
`read_ledger` sees the old files until they are vacuumed. A version counts once its manifest is written
whole. What an interrupted run left is in no manifest, and the next run overwrites it.

One run at a time may compact a ledger; appending to it meanwhile is no harm. Indexes that go by file
names (`current_index`, `held_ids`) know nothing of manifests: a ledger has either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from response_ledger.schemas import LEDGER
from response_ledger.session import delete_path
from response_ledger.sources.ledger import BODY_GROUP_ROWS, PAGE_GROUP_ROWS, append_ledger, hadoop_uri

TARGET_BYTES = 256 << 20
# Bytes of bodies and rows, not compressed, that one task sorts: small bodies compress to a few
# hundredths, so that a file of the target's size can be more than a task's memory.
SORTED_BYTES = 1 << 30
ROW_BYTES = 512
# Files of at least this share of the target stay as they are.
SMALL_SHARE = 0.5

_MANIFEST = "file string, length bigint, state string"
_ORDER = ("request_type", "path_id", "start", "fetched_at")


def _listed(spark: SparkSession, directory: str) -> DataFrame:
    """(file, length) of the parquet files that Spark lists below a directory; none is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(hadoop_uri(directory))
        .select(F.col("path").alias("file"), "length")
    )


def _root(directory: str) -> str:
    return hadoop_uri(directory).rstrip("/")


def manifest_version(spark: SparkSession, directory: str) -> int:
    """The newest whole version of a ledger's manifest, 0 if it was never compacted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_root(directory)}/_manifest")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return 0
    whole = [
        int(one.getPath().getName().split("=")[1])
        for one in store.listStatus(path)
        if store.exists(spark._jvm.org.apache.hadoop.fs.Path(one.getPath(), "_SUCCESS"))
    ]
    return max(whole, default=0)


def _recorded(spark: SparkSession, directory: str, version: int) -> DataFrame:
    folders = [f"{_root(directory)}/_manifest/version={one}" for one in range(1, version + 1)]
    return spark.read.schema(_MANIFEST).parquet(*folders) if folders else spark.createDataFrame([], _MANIFEST)


def live_files(spark: SparkSession, directory: str) -> DataFrame:
    """(file, length) of the files that hold the ledger's rows now."""
    recorded = _recorded(spark, directory, manifest_version(spark, directory))
    added = recorded.where("state = 'added'").select("file", "length")
    replaced = recorded.where("state = 'replaced'")
    return _listed(spark, directory).unionByName(added).join(replaced, "file", "left_anti")


def read_compacted(spark: SparkSession, directory: str) -> DataFrame:
    """Every response of a ledger that may have been compacted."""
    files = sorted(one["file"] for one in live_files(spark, directory).select("file").collect())
    return spark.read.schema(LEDGER).parquet(*files) if files else spark.createDataFrame([], LEDGER)


def compact(spark: SparkSession, directory: str, target_bytes: int = TARGET_BYTES) -> int:
    """Merge a ledger's small files; returns how many were replaced, 0 if there is nothing to gain."""
    files = live_files(spark, directory).where(F.col("length") < target_bytes * SMALL_SHARE).collect()
    small = sum(one["length"] for one in files)
    number = max(1, -(-small // target_bytes))
    # Pages and by-id bodies have row groups of their own size, so they are written apart.
    if len(files) <= 2 * number:
        return 0
    rows = spark.read.schema(LEDGER).parquet(*sorted(one["file"] for one in files))
    held = rows.agg(F.sum(F.coalesce(F.octet_length("content"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    number = max(number, -(-held // SORTED_BYTES))
    if len(files) <= 2 * number:
        return 0
    version = manifest_version(spark, directory) + 1
    new = f"{_root(directory)}/_compacted/version={version}"
    delete_path(spark, new)
    for kind, where, group_rows in (
        ("pages", F.col("start").isNotNull(), PAGE_GROUP_ROWS),
        ("bodies", F.col("start").isNull(), BODY_GROUP_ROWS),
    ):
        sorted_rows = rows.where(where).repartitionByRange(number, *_ORDER).sortWithinPartitions(*_ORDER)
        append_ledger(sorted_rows, f"{new}/{kind}", group_rows)
    _record(spark, directory, version, [(one["file"], one["length"]) for one in files], _listed(spark, new))
    return len(files)


def _record(spark: SparkSession, directory: str, version: int, replaced: list, added: DataFrame) -> None:
    """Write a version's manifest, by which it counts."""
    old = spark.createDataFrame(replaced, "file string, length bigint").withColumn("state", F.lit("replaced"))
    both = old.unionByName(added.withColumn("state", F.lit("added")))
    both.coalesce(1).write.mode("overwrite").parquet(f"{_root(directory)}/_manifest/version={version}")


def vacuum(spark: SparkSession, directory: str) -> int:
    """Remove the files that were replaced; returns how many there still were."""
    recorded = _recorded(spark, directory, manifest_version(spark, directory))
    added = recorded.where("state = 'added'").select("file")
    there = _listed(spark, directory).select("file").unionByName(added)
    gone = there.join(recorded.where("state = 'replaced'").select("file"), "file", "left_semi").distinct().collect()
    removed = 0
    for one in gone:
        removed += _removed(spark, one["file"])
    return removed


def _removed(spark: SparkSession, file: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)

"""
The ids a target already holds, kept beside it in buckets, so that a resume does not shuffle them.

An endpoint's ids lie in a bucketed table with Bloom filters on the id. The anti join of a resume takes
the buckets as they are: only the workset is moved, and a workset that is distributed over as many
partitions as there are buckets is not moved either. The ledger is read once: a refresh
reads the files that are new since the last one and adds their ids.

`<index>/<endpoint>/buckets=<n>/ids` is the table, `.../files` the ledger files it was filled from. A
file is recorded after its ids are written. What an interrupted refresh wrote is written again by
the next one, and an id that is held twice is held all the same.

Catalogs may not outlive a session, so the table is declared over its folder whenever it is used.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.schemas import LEDGER
from response_ledger.sources.current_index import FILES, ledger_files
from response_ledger.sources.ledger import hadoop_uri, scanned_path

_IDS = T.StructType([T.StructField("id", T.LongType())])
# Few ids are looked up with their buckets and Bloom filters, more with the join. Parquet is given
# an `IN` of up to ten values, Spark's own default.
LOOKED_UP = 10


def _folders(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [one.getPath().getName() for one in store.listStatus(path)] if store.exists(path) else []


def _layout(spark: SparkSession, index: str, request_type: str, buckets: int | None = None) -> tuple[str, int]:
    """The folder of an endpoint's ids and its number of buckets, which never changes once it is there."""
    root = f"{hadoop_uri(index).rstrip('/')}/{request_type.lower()}"
    known = [int(name.split("=")[1]) for name in _folders(spark, root) if name.startswith("buckets=")]
    if not known and buckets is None:
        raise FileNotFoundError(f"{index} holds no ids of {request_type}; refresh it first")
    if known and buckets is not None and known[0] != buckets:
        raise ValueError(f"the ids of {request_type} lie in {known[0]} buckets, not {buckets}")
    number = known[0] if known else buckets
    return f"{root}/buckets={number}", number


def _declared(spark: SparkSession, folder: str, buckets: int) -> str:
    """The name under which the session's catalog knows the table."""
    name = f"held_ids_{hashlib.md5(folder.encode()).hexdigest()}"
    location = f"{folder}/ids".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (id BIGINT) USING parquet "
        "OPTIONS ('compression' 'zstd', 'parquet.bloom.filter.enabled#id' 'true') "
        f"CLUSTERED BY (id) SORTED BY (id) INTO {int(buckets)} BUCKETS LOCATION '{location}'"
    )
    spark.catalog.refreshTable(name)
    return name


def refresh_held_ids(
    spark: SparkSession, directory: str, index: str, request_type: str, buckets: int | None = None
) -> int:
    """
    Add the ids of the ledger's new files to an endpoint's index; returns how many files were new.

    `buckets` is given for the first refresh, best as many as the shuffle partitions of the
    resuming jobs. Each refresh adds a file to every bucket it has ids for.
    """
    if buckets is None and not _folders(spark, f"{hadoop_uri(index).rstrip('/')}/{request_type.lower()}"):
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, number = _layout(spark, index, request_type, buckets)
    listed = ledger_files(spark, directory)
    if "files" in _folders(spark, folder):
        listed = listed.join(spark.read.schema(FILES).parquet(f"{folder}/files"), "_file", "left_anti")
    fresh = sorted(one["_file"] for one in listed.collect())
    if not fresh:
        return 0
    name = _declared(spark, folder, number)
    asked = spark.read.schema(LEDGER).parquet(*[scanned_path(spark, one) for one in fresh]).where(
        (F.col("request_type") == request_type) & F.col("path_id").isNotNull()
    )
    # Distinct before they are dealt: a hot id is one row a task, and each bucket gets one file.
    ids = asked.select(F.col("path_id").alias("id")).distinct().repartition(number, "id")
    ids.write.insertInto(name)
    spark.createDataFrame([(one,) for one in fresh], FILES).write.mode("append").parquet(f"{folder}/files")
    return len(fresh)


def held_ids(spark: SparkSession, index: str, request_type: str) -> DataFrame:
    """The ids of the files seen so far, in buckets; an id of several refreshes occurs in each."""
    folder, buckets = _layout(spark, index, request_type)
    return spark.table(_declared(spark, folder, buckets))


def remaining_by_buckets(workset: DataFrame, index: str, request_type: str) -> DataFrame:
    """`operators.workset.remaining` against an index instead of the ledger: the same rows."""
    return workset.join(held_ids(workset.sparkSession, index, request_type), "id", "left_anti")


def held_among(spark: SparkSession, index: str, request_type: str, ids: list[int]) -> DataFrame:
    """
    Which of a few given ids are held: only their buckets are opened, and of these only the
    row groups whose Bloom filters do not rule them out.
    """
    held = held_ids(spark, index, request_type)
    if len(set(ids)) > LOOKED_UP:
        asked = spark.createDataFrame([(one,) for one in set(ids)], _IDS)
        return asked.join(held, "id", "left_semi")
    return held.where(F.col("id").isin(sorted(set(ids)))).distinct()

"""
A position-delete index beside a ledger: which rows of which files are not current, kept from run to
run, so that a refresh reads the files that are new and no others.

A version of the index is a folder with four tables:
- `files`: the ledger files this version has read for the first time;
- `places`: for every key its latest response, the narrow columns of `audit.located` (all versions
  before are summed up in it);
- `earlier`: bitmaps of the rows that this version found superseded by a later one of their key;
- `hidden`: bitmaps of all pages whose set is not the current one, or whose offsets were cut anew.

A page that is hidden can become current again, when its set is completed, so `hidden` is written
whole each time, from `places`; a row in `earlier` stays out for good. A version counts once its
last table, `files`, is written; what an interrupted refresh left is overwritten by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.operators.audit import (
    RESPONSE_KEY,
    bitmaps,
    hidden_pages,
    latest_places,
    located,
    without_rows,
)
from response_ledger.schemas import LEDGER
from response_ledger.session import delete_path, landed
from response_ledger.sources.ledger import hadoop_uri, read_ledger, scanned_path

FILES = T.StructType([T.StructField("_file", T.StringType())])
BITMAPS = "_file string, _bucket bigint, rows_out binary"


def ledger_files(spark: SparkSession, directory: str) -> DataFrame:
    """Names of the ledger's files as scans report them; listed, not opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(hadoop_uri(directory))
    )
    return listing.select(F.col("_metadata.file_path").alias("_file"))


def latest_version(spark: SparkSession, index: str) -> int:
    """The newest whole version of an index, 0 if there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(hadoop_uri(index))
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return 0
    names = [one.getPath().getName() for one in store.listStatus(root)]
    numbers = sorted((int(name.split("=")[1]) for name in names if name.startswith("version=")), reverse=True)
    for number in numbers:
        if store.exists(spark._jvm.org.apache.hadoop.fs.Path(_table(index, number, "files"), "_SUCCESS")):
            return number
    return 0


def _table(index: str, version: int, name: str) -> str:
    return f"{hadoop_uri(index).rstrip('/')}/version={version}/{name}"


def _all_versions(spark: SparkSession, index: str, version: int, name: str, schema: T.StructType | str) -> DataFrame:
    if not version:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_table(index, one, name) for one in range(1, version + 1)])


def unread_files(spark: SparkSession, directory: str, index: str, version: int) -> list[str]:
    """Files that a version of the index does not know; as many as were written since."""
    known = _all_versions(spark, index, version, "files", FILES)
    return sorted(one["_file"] for one in ledger_files(spark, directory).join(known, "_file", "left_anti").collect())


def refresh_index(spark: SparkSession, directory: str, index: str) -> int:
    """Bring an index up to the ledger's present files; returns its version."""
    version = latest_version(spark, index)
    fresh = unread_files(spark, directory, index, version)
    if not fresh:
        return version
    ledger = spark.read.schema(LEDGER).parquet(*[scanned_path(spark, one) for one in fresh])
    new = landed(located(ledger, paged=False).unionByName(located(ledger, paged=True)), "places")
    key = list(RESPONSE_KEY)
    old = (
        spark.read.schema(new.schema).parquet(_table(index, version, "places"))
        if version
        else spark.createDataFrame([], new.schema)
    )
    keys = new.select(*key).distinct()
    touched = landed(old.join(keys, key, "left_semi").unionByName(new), "touched")
    latest = landed(latest_places(touched).select(*new.columns), "latest")
    places = old.join(keys, key, "left_anti").unionByName(latest)
    earlier = touched.join(latest.select("_file", "_row"), ["_file", "_row"], "left_anti")
    after = version + 1
    for name, frame in (("places", places), ("earlier", bitmaps(earlier.select("_file", "_row")))):
        frame.write.mode("overwrite").parquet(_table(index, after, name))
    pages = spark.read.schema(new.schema).parquet(_table(index, after, "places")).where("page_rows > 0")
    bitmaps(hidden_pages(pages)).write.mode("overwrite").parquet(_table(index, after, "hidden"))
    spark.createDataFrame([(one,) for one in fresh], FILES).write.mode("overwrite").parquet(
        _table(index, after, "files")
    )
    # The places before are summed up in the new ones.
    if version:
        delete_path(spark, _table(index, version, "places"))
    return after


def rows_out(spark: SparkSession, index: str, version: int) -> DataFrame:
    """All of a version's bitmaps, those of the same rows merged."""
    earlier = _all_versions(spark, index, version, "earlier", BITMAPS)
    hidden = spark.read.schema(BITMAPS).parquet(_table(index, version, "hidden"))
    return earlier.unionByName(hidden).groupBy("_file", "_bucket").agg(F.bitmap_or_agg("rows_out").alias("rows_out"))


def read_current(spark: SparkSession, directory: str, index: str) -> DataFrame:
    """
    The ledger's current responses as of the index's newest version; files written since are left
    out, as it does not know which of their rows are current.
    """
    version = latest_version(spark, index)
    if not version:
        raise FileNotFoundError(f"{index} holds no index; refresh it first")
    ledger = read_ledger(spark, directory)
    since = unread_files(spark, directory, index, version)
    if since:
        ledger = ledger.where(~F.col("_metadata.file_path").isin(since))
    return without_rows(ledger, landed(rows_out(spark, index, version), "rows_out"))

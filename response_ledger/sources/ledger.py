"""Reading and appending ledgers: parquet directories of verbatim responses."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.schemas import LEDGER, REQUIRED
from response_ledger.session import setting

# Rows per parquet row group. Spark's vectorized reader takes up to 4,096 rows of a row
# group at once and must fit their bodies into one buffer of 2 GB; a page of 2,500 records
# has megabytes, a by-id body kilobytes.
PAGE_GROUP_ROWS = 8
BODY_GROUP_ROWS = 1024
# Records in a row group of pages, as many as `PAGE_GROUP_ROWS` pages of 2,500 have.
PAGE_GROUP_RECORDS = 20_000


def page_group_rows(records: int) -> int:
    """
    Rows per row group for pages of at most `records` records. Every reader of a part of a file reads
    its whole footer, which grows with the row groups, so small pages share one.
    """
    return min(BODY_GROUP_ROWS, max(PAGE_GROUP_ROWS, PAGE_GROUP_RECORDS // max(records, 1)))


def target_path(dest: str, request_type: str, run_id: str, area: str = "api_responses") -> str:
    """Directory of one endpoint's run: `<dest>/raw/<area>/<endpoint>/run_id=<id>`."""
    return f"{dest.rstrip('/')}/raw/{area}/{request_type.lower()}/run_id={run_id}"


def hadoop_uri(path: str) -> str:
    """
    `gs://` buckets keep their scheme, `s3://` becomes the `s3a://` Hadoop knows; anything
    else passes through. Credentials are the session's Hadoop configuration.
    """
    return re.sub(r"^s3://", "s3a://", path)


def scanned_path(spark: SparkSession, file: str) -> str:
    """The path of a file as readers take it; the names that scans report are escaped like addresses."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).toString()


def read_ledger(spark: SparkSession, directory: str, schema: T.StructType = LEDGER) -> DataFrame:
    """
    Every parquet file below a directory, subdirectories included, as one frame.

    The schema is given, so files are united by column name, a column a file lacks reads as
    NULL, no footer is opened to infer anything, and `run_id=` in a path stays a path.
    """
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(hadoop_uri(directory))
    )


def read_runs(spark: SparkSession, dest: str, request_type: str) -> DataFrame:
    """All runs of an endpoint, with `run_id` as a string partition column to prune on."""
    schema = T.StructType([*LEDGER.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(schema).parquet(
        hadoop_uri(f"{dest.rstrip('/')}/raw/api_responses/{request_type.lower()}")
    )


def ledger_is_empty(spark: SparkSession, directory: str) -> bool:
    """Whether no parquet file lies below a directory; other file system errors propagate."""
    path = spark._jvm.org.apache.hadoop.fs.Path(hadoop_uri(directory))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return True
    listing = files.listFiles(path, True)
    base = path.toUri().getPath()
    while listing.hasNext():
        below = listing.next().getPath().toUri().getPath()[len(base):]
        hidden = any(part.startswith(("_", ".")) for part in below.split("/"))
        if below.endswith(".parquet") and not hidden:
            return False
    return True


def require_ledger(spark: SparkSession, directory: str) -> DataFrame:
    """`read_ledger`, but a source without files is an error."""
    if ledger_is_empty(spark, directory):
        raise FileNotFoundError(f"{directory} holds no parquet file")
    return read_ledger(spark, directory)


def enforce_required(rows: DataFrame) -> DataFrame:
    """The rows themselves; a NULL in a required column fails the job in the same pass."""

    def checked(name: str) -> Column:
        failure = F.raise_error(F.lit(f"ledger column {name} must not be null"))
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(
            failure.cast(LEDGER[name].dataType)
        )

    return rows.select(
        *[checked(one.name).alias(one.name) if one.name in REQUIRED else F.col(one.name) for one in LEDGER]
    )


def required_violations(rows: DataFrame) -> DataFrame:
    """Per required column, how many rows break the NOT NULL rule; one pass, one row each."""
    counts = rows.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in REQUIRED])
    return counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).alias("violations")) for name in REQUIRED])
        )
    )


def append_ledger(rows: DataFrame, directory: str, group_rows: int = BODY_GROUP_ROWS) -> None:
    """
    Append rows as ZSTD parquet. Nothing is ever cleared: refetching an id adds a row.

    Row groups are bounded in rows, not only in compressed bytes, so that a reader's batch
    of bodies fits in memory; pages take `page_group_rows`. Timestamps are written as UTC
    microseconds, which other engines read back with a zone.
    """
    with setting(rows.sparkSession, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):
        (
            enforce_required(rows)
            .write.mode("append")
            .option("compression", "zstd")
            .option("parquet.block.row.count.limit", group_rows)
            .parquet(hadoop_uri(directory))
        )

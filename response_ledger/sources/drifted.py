"""
Files whose column types drifted, read as one ledger.

A scan takes one type per column for all its files, so a file whose `path_id` is an `int` or a string
fails a scan that expects a `bigint`. `schema_classes` opens the footers, and nothing else, in a
distributed job and groups files by the names and types they hold. `read_drifted` then scans each class
with its own types, brings the columns to the wanted ones and unites the classes.

A value is brought over if nothing of it is lost: numbers if they are the same number, text if it is the
wanted type's own spelling (integers without leading zeros), anything to text. What does not fit
reads as NULL, and its text is in `rescued`, a map from column to text that is NULL where all fits.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.schemas import LEDGER
from response_ledger.sources.ledger import hadoop_uri

_CLASSES = "columns string, files array<string>"
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def opened(file: str) -> pa.NativeFile:
    """A file by its Hadoop path, for reading at places; remote stores go by their scheme."""
    if file.startswith("file:") or "://" not in file:
        return pafs.LocalFileSystem().open_input_file("/" + file.removeprefix("file:").lstrip("/"))
    store, path = pafs.FileSystem.from_uri(file)
    return store.open_input_file(path)


def schema_classes(spark: SparkSession, directory: str, open_file=opened) -> DataFrame:
    """
    (columns, files): the files below a directory by what their footers hold.

    `open_file` runs in the tasks; bring one for a store that needs credentials of its own.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(hadoop_uri(directory))
        .select(F.col("path").alias("file"))
        .repartition("file")
    )

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(0).to_pylist()
            kinds = []
            for file in files:
                with open_file(file) as source:
                    schema = pq.read_schema(source)
                kinds.append(json.dumps([[one.name, str(one.type)] for one in schema]))
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(files)], names=["columns", "file"])

    return (
        listed.mapInArrow(footers, "columns string, file string")
        .groupBy("columns")
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
    )


def _text(value: Column, kind: T.DataType) -> Column:
    return F.to_json(value) if isinstance(kind, _NESTED) else value.cast("string")


def fitted(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """A value of one type as another, NULL where it does not fit."""
    if kind == wanted:
        return value
    if isinstance(wanted, T.StringType):
        return _text(value, kind)
    if isinstance(wanted, _NESTED):
        return F.from_json(value, wanted, {"mode": "PERMISSIVE"}) if isinstance(kind, T.StringType) else F.lit(None).cast(wanted)
    cast = value.try_cast(wanted)
    if isinstance(kind, T.StringType):
        same = cast.cast("string") == value if isinstance(wanted, _INTEGERS) else cast.isNotNull()
    elif isinstance(kind, _NUMBERS) and isinstance(wanted, _NUMBERS):
        same = cast.try_cast(kind) == value
    elif isinstance(kind, (T.DateType, T.TimestampNTZType)) and isinstance(wanted, (T.TimestampType, T.TimestampNTZType)):
        same = cast.isNotNull()
    else:
        return F.lit(None).cast(wanted)
    return F.when(same, cast)


def _united(scan: DataFrame, schema: T.StructType) -> DataFrame:
    """One class of files under the wanted columns and types."""
    kinds = {one.name.lower(): one for one in scan.schema}
    columns, misfits = [], []
    for field in schema:
        held = kinds.get(field.name.lower())
        if held is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{held.name}`")
        columns.append(fitted(value, held.dataType, field.dataType).alias(field.name))
        if held.dataType != field.dataType:
            lost = value.isNotNull() & columns[-1].isNull()
            misfits.append(F.struct(F.lit(field.name).alias("key"), F.when(lost, _text(value, held.dataType)).alias("value")))
    rescued = F.lit(None).cast("map<string,string>")
    if misfits:
        lost = F.filter(F.array(*misfits), lambda one: one["value"].isNotNull())
        rescued = F.when(F.size(lost) > 0, F.map_from_entries(lost))
    return scan.select(*columns, rescued.alias("rescued"))


def read_drifted(
    spark: SparkSession, directory: str, schema: T.StructType = LEDGER, open_file=opened
) -> DataFrame:
    """
    Every parquet file below a directory under one schema, whatever types its files have, and `rescued`.

    There is one scan a class of files; columns whose types are as wanted are handed through, so
    filters on them reach the files. A column that files lack reads as NULL, one that the schema lacks
    is not read. The names of the files are on the driver, as for every scan of Spark.
    """
    classes = schema_classes(spark, directory, open_file).orderBy("columns").collect()
    if not classes:
        empty = T.StructType([*schema.fields, T.StructField("rescued", T.MapType(T.StringType(), T.StringType()))])
        return spark.createDataFrame([], empty)
    parts = [
        _united(spark.read.option("recursiveFileLookup", "true").parquet(*one["files"]), schema)
        for one in classes
    ]
    return reduce(DataFrame.unionByName, parts)

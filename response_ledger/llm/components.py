"""Connected components of a graph of any size, by rounds of joins over its edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from response_ledger.llm.hot_keys import join_by_key, most_frequent
from response_ledger.session import delete_path, landed, scratch_path


def connected_components(edges: DataFrame) -> DataFrame:
    """
    Edges (a, b) of numbers to (vertex, component), a component's name being its least vertex.

    Rounds of two steps keep every component connected: first each vertex hangs its greater
    neighbours on its least neighbour, then its lesser ones and itself. They end in stars
    around the least vertices after a number of rounds that grows as a logarithm. Each step
    reads a vertex's least neighbour by a partial aggregate and a join that leaves the edges of
    the vertices with most of them where they are, so such a vertex is no single task's work.
    Each round's tables are written and the last round's removed.
    """
    spark = edges.sparkSession
    now = landed(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, hot = neighbours(both, F.least(F.min("v"), F.col("u")))
        hung = join_by_key(both.where("v > u"), least, "u", hot).select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = landed(hung.where("u != v").distinct(), "hung")
        used = [now, least, hot, hung]
        least, hot = neighbours(hung, F.min("v"))
        used += [least, hot]
        lesser = join_by_key(hung, least, "u", hot).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        path = scratch_path(spark, "edges")
        lesser.unionByName(least.select("u", F.col("m").alias("v"))).distinct().write.parquet(path)
        for old in {name.rsplit("/", 1)[0] for one in used for name in one.inputFiles()}:
            delete_path(spark, old)
        now = spark.read.schema(now.schema).parquet(path)
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(roots)


def neighbours(edges: DataFrame, least: Column) -> tuple[DataFrame, DataFrame]:
    """Each vertex with its least neighbour, and the rows of the vertices with most edges."""
    counted = landed(edges.groupBy("u").agg(least.alias("m"), F.count(F.lit(1)).alias("n")), "least")
    return counted.select("u", "m"), most_frequent(counted, "u")

"""Joins and components with keys that hold most rows: the plain join's rows, whatever is hot."""

import pytest
from pyspark.sql import functions as F

from response_ledger.llm import hot_keys
from response_ledger.llm.components import connected_components


@pytest.mark.parametrize("many", [1, 3, 1000])
def test_the_rows_of_the_plain_join(spark, many):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 90).alias("k"),
        "id",
    )
    counted = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("most")).where("n > 1")
    hot = hot_keys.most_frequent(counted, "k", many)
    assert hot.count() == min(many, counted.count()) and hot.where("k = 7").count() == 1
    single = counted.select("k", "most")
    found = hot_keys.join_by_key(rows, single, "k", hot)
    assert found.columns == ["k", "id", "most"]
    assert sorted(found.collect()) == sorted(rows.join(single, "k").collect())


def test_rows_of_hot_keys_are_not_moved(spark):
    rows = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    counted = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys.most_frequent(counted, "k", 2)
    rest = rows.join(F.broadcast(hot.select("k")), "k", "left_anti")
    assert rest.count() == 0
    plan = hot_keys.join_by_key(rows, counted.select("k"), "k", hot)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


@pytest.mark.parametrize("many", [1, 1000])
def test_components_around_hubs(spark, monkeypatch, many):
    monkeypatch.setattr(hot_keys.most_frequent, "__defaults__", (many,))
    hub = [(0, i) for i in range(1, 400)] + [(500, i) for i in range(501, 700)]
    chain = [(i, i + 1) for i in range(1000, 1040)] + [(399, 1000)] + [(2000, 2000), (2001, 2002), (2002, 2001)]
    edges = spark.createDataFrame(hub + chain, "a long, b long")
    found = dict(map(tuple, connected_components(edges).collect()))
    wanted = {i: 0 for i in [*range(400), *range(1000, 1041)]} | {i: 500 for i in range(500, 700)}
    assert found == wanted | {2001: 2001, 2002: 2001}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []

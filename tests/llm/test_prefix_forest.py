"""Nearest neighbours: recall against brute force, exact scores, defined cases."""

import numpy as np

from response_ledger.llm import prefix_forest


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(6000, 64)).astype(np.float32)
    rows = [(i, vectors[i].tolist()) for i in range(len(vectors))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for row in prefix_forest.nearest_neighbours(table).collect():
        found.setdefault(row["query_id"], {})[row["rank"]] = (row["vec_id"], row["score"])
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    hits = 0
    for query in range(0, len(vectors), 50):
        scores = unit @ unit[query]
        scores[query] = -2
        best = set(np.argsort(-scores)[:5].tolist())
        mine = [found[query][rank] for rank in range(1, 6)]
        hits += len(best & {one for one, _ in mine})
        assert [s for _, s in mine] == sorted((s for _, s in mine), reverse=True)
        for one, score in mine:
            assert abs(score - scores[one]) < 1e-12
    assert hits / (len(vectors) // 50 * 5) >= 0.9


def test_ties_go_to_the_smaller_id_over_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "BLOCK_ROWS", 40)
    monkeypatch.setattr(prefix_forest, "BLOCK_QUERIES", 2)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(300)] + [(300 + i, [0.1 * i, 1.0, -1.0]) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for row in prefix_forest.nearest_neighbours(table).orderBy("rank").collect():
        found.setdefault(row["query_id"], []).append(row["vec_id"])
    assert found[0] == [1, 2, 3, 4, 5] and found[50] == [0, 1, 2, 3, 4] and set(found) == set(range(0, 320, 50))


def test_every_length_is_searched_among_its_own(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3 if i % 3 == 0 else 8 if i % 3 == 1 else 1).tolist(), 1, "x") for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, unit string")
    found = {}
    for row in prefix_forest.nearest_neighbours(table).orderBy("query_id", "rank").collect():
        found.setdefault(row["query_id"], []).append(row["vec_id"])
    for query in range(0, 300, 50):
        own = np.array(rows[query][1])
        scores = {
            i: float(own @ np.array(v)) / (np.linalg.norm(own) * np.linalg.norm(v))
            for i, v, _, _ in rows if len(v) == len(own) and i != query
        }
        best = sorted(scores, key=lambda i: (-round(scores[i], 12), i))[:5]
        assert found[query] == best


def test_defined_cases(spark):
    rows = [
        (1, None), (2, [0.0, 0.0]), (3, [1.0, float("nan")]), (4, [float("inf"), 1.0]), (5, [1.0, None]),
        (6, []), (7, [1.0]), (None, [1.0, 1.0]), (50, [1.0, 0.0]), (51, [0.0, 1.0]), (52, [1.0, 1.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(tuple, prefix_forest.nearest_neighbours(table).collect()))
    assert [one[:3] for one in found] == [(50, 1, 52), (50, 2, 51)] and found[1][3] == 0.0
    assert prefix_forest.nearest_neighbours(table.limit(0)).collect() == []
    assert prefix_forest.nearest_neighbours(table.where("vec_id = 50")).collect() == []

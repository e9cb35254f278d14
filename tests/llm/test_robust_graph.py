"""Near-duplicate embeddings against brute force, the graph's search, defined cases."""

import numpy as np
import pytest

from response_ledger.llm import robust_graph as rg


def plain(rows, limit=0.9):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i in range(len(rows))}
    for dim in {len(rows[i][1]) for i in good}:
        mine = [i for i in good if len(rows[i][1]) == dim]
        unit = np.array([rows[i][1] for i in mine], float)
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        for a, b in zip(*np.nonzero(unit @ unit.T >= limit)):
            if a != b:
                links[mine[a]].add(mine[b])
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = set(), [i]
        while todo:
            one = todo.pop()
            if one not in group:
                group.add(one)
                todo += links[one]
        seen |= group
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        for j in group:
            least = min(ids) if ids else None
            out[j] = (rows[j][0], len(links[j]), least, not links[j] or (rows[j][0] is not None and rows[j][0] == least))
    return sorted(out, key=repr)


def found(spark, rows, kind="float", limit=0.9):
    table = spark.createDataFrame([(*one, 5) for one in rows], f"vec_id long, embedding array<{kind}>, n int")
    return sorted(map(tuple, rg.near_duplicates(table.repartition(5), limit).collect()), key=repr)


def scattered(seed, singles, groups, size, noise, dim=32):
    rng = np.random.default_rng(seed)
    vectors = [rng.normal(size=dim) for _ in range(singles)]
    for _ in range(groups):
        centre = rng.normal(size=dim)
        vectors += [centre + noise * rng.normal(size=dim) for _ in range(size)]
    vectors = np.array(vectors, np.float32)
    return vectors[rng.permutation(len(vectors))]


def test_tight_groups_and_copies(spark):
    vectors = scattered(1, 900, 12, 40, 0.05)
    vectors[100:160] = vectors[3]
    rows = [(i, one.astype(float).tolist()) for i, one in enumerate(vectors)]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("noise", [0.24, 0.33])
def test_groups_at_the_limit(spark, noise):
    # Cosines around 0.9: balls overlap in part, so members are compared one by one.
    rows = [(i, one.astype(float).tolist()) for i, one in enumerate(scattered(2, 300, 8, 60, noise))]
    expected, mine = plain(rows), found(spark, rows)
    links, all_links = sum(one[1] for one in mine), sum(one[1] for one in expected)
    assert all_links > 2000 and 0.97 * all_links <= links <= all_links
    by_id = {one[0]: one[1] for one in expected}
    assert all(one[1] <= by_id[one[0]] for one in mine)


def test_many_shards_and_parts(spark, monkeypatch):
    monkeypatch.setattr(rg, "SHARD_ROWS", 100)
    monkeypatch.setattr(rg, "CLUSTERS", 6)
    monkeypatch.setattr(rg, "QUERIES", 16)
    vectors = scattered(3, 1200, 10, 60, 0.12)
    rows = [(i, one.astype(float).tolist()) for i, one in enumerate(vectors)]
    expected, mine = plain(rows), found(spark, rows)
    assert sum(one[1] for one in mine) >= 0.97 * sum(one[1] for one in expected)
    assert len({one[2] for one in mine}) <= 1.05 * len({one[2] for one in expected})


def test_a_failed_audit_widens_the_search(spark, monkeypatch):
    monkeypatch.setattr(rg, "SHARD_ROWS", 60)
    monkeypatch.setattr(rg, "OVERLAP", 1)
    monkeypatch.setattr(rg, "RECALL", 1.01)
    rows = [(i, one.astype(float).tolist()) for i, one in enumerate(scattered(4, 300, 6, 30, 0.28))]
    assert found(spark, rows) == plain(rows)


def test_graph_reaches_every_row():
    unit = rg.unit_rows(scattered(5, 700, 3, 100, 0.01).astype(float))
    lists = rg.built(unit)
    assert rg.reached_from(lists, rg.medoids(unit.astype(np.float32))).all()
    assert lists.max() < len(unit) and all(i not in lists[i] for i in range(len(unit)))


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0]), (10, [5.0]), (11, [-1.0]),
        (None, [1.0, 0.1]), (None, [0.0, 1.0]), (12, [1e300, 1e290]), (13, [1e-300, 0.0]), (14, [-0.0, -3.0]),
        (15, [0.0, -3.0]), (None, None), (16, [0.9, 0.4358898943540673]),
    ]
    mine = found(spark, rows, "double")
    expected = plain([(i, v if i not in (12, 13) else [1.0, 0.0]) for i, v in rows])
    assert mine == expected
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert rg.near_duplicates(empty).collect() == []
    assert found(spark, [(1, None), (None, [0.0])]) == plain([(1, None), (None, [0.0])])

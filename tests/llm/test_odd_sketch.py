"""Near-duplicates against all pairs, blocks far smaller than the groups; components; sketches."""

import collections
import random

import numpy as np
import pytest

from response_ledger.llm import odd_sketch
from response_ledger.llm.components import connected_components


def brute(rows, words=3, percent=85):
    sets = []
    for doc_id, text in rows:
        found = (text or "").encode().lower().split()
        used = min(words, len(found))
        sets.append((doc_id, frozenset(tuple(found[i : i + used]) for i in range(len(found) - used + 1)) if found else frozenset()))
    parent = {doc_id: doc_id for doc_id, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((doc_id, len(one), root(doc_id), root(doc_id) == doc_id) for doc_id, one in sets)


def corpus():
    rng = random.Random(2)
    bases = [" ".join(rng.choice("a b c d e f g h i j k l m n o p q".split()) for _ in range(60)) for _ in range(8)]
    rows = [
        (1, None), (2, ""), (3, "a"), (4, "A"), (5, "a b"), (6, "a  B"), (7, " \n"), (8, "a b c"), (8, "q r s"),
        (9, "q r s"), (10, "a b c d"), (11, "É b c"), (12, "é b c"), (13, "long " * 5000),
    ]
    for i in range(200):
        words = rng.choice(bases).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 5)}"
        rows.append((100 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_groups_against_all_pairs(spark, monkeypatch, words, percent):
    monkeypatch.setattr(odd_sketch, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(odd_sketch, "FAMILY_BLOCK", 8)
    rows = corpus()
    documents = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS kept")
    found = sorted(map(tuple, odd_sketch.near_duplicates(documents, words, percent).collect()))
    assert found == brute(rows, words, percent)


def test_rows_without_id_and_empty_tables(spark):
    documents = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (4, "x y z")], "doc_id long, text string")
    found = sorted(map(tuple, odd_sketch.near_duplicates(documents).collect()), key=repr)
    assert found == [(4, 1, 4, True), (None, 1, None, True), (None, 1, None, True)]
    assert odd_sketch.near_duplicates(documents.limit(0)).collect() == []
    assert odd_sketch.without_near_duplicates(documents).count() == 3


def test_one_document_of_each_group_stays(spark):
    documents = spark.createDataFrame(corpus(), "doc_id long, text string")
    kept = {one[0] for one in brute(corpus(), 5, 80) if one[3]}
    assert {row["doc_id"] for row in odd_sketch.without_near_duplicates(documents, 5, 80).collect()} == kept


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(5)
    sketcher = odd_sketch.Sketcher(7)
    for similarity in (0.85, 0.95):
        differ = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, 400, np.uint64)
            own = int(400 * (1 - similarity) / (2 * similarity))
            pair = [np.concatenate([both, rng.integers(0, 1 << 63, own, np.uint64)]) for _ in range(2)]
            sketches = sketcher.sketches(np.stack([sketcher.samples(one) for one in pair]))
            differ.append(int(np.bitwise_count(sketches[0] ^ sketches[1]).sum()))
        share = 1 - 2 * np.mean(differ) / odd_sketch.SKETCH_BITS
        estimate = 1 + odd_sketch.SKETCH_BITS / (4 * odd_sketch.SAMPLES) * np.log(share)
        assert abs(estimate - similarity) < 0.015 and max(differ) <= odd_sketch.sketch_limit(similarity)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300), (41, 60), (60, 41)]
    random.Random(1).shuffle(edges)
    found = {row["vertex"]: row["component"] for row in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == (
        {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {200 + i: 200 for i in range(9)} | {41: 41, 60: 41}
    )
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_forests_reach_all_that_is_connected():
    rng = np.random.default_rng(3)
    for size in (1, 2, 30, 120):
        alike = rng.random((size, size)) < 1.2 / size
        alike |= alike.T
        labels = odd_sketch.forest(alike)
        parent = collections.defaultdict(set)
        for i, label in enumerate(labels):
            parent[int(label)].add(i)
        for i in range(size):
            for j in np.flatnonzero(alike[i]):
                assert labels[i] == labels[j]
        assert all(min(group) == root for root, group in parent.items())


def test_bands_miss_next_to_nothing():
    assert [odd_sketch.band_rows(similarity) for similarity in (0.95, 0.85, 0.8, 0.5, 0.01)] == [12, 7, 6, 2, 1]
    assert (1 - 0.8**6) ** 42 <= odd_sketch.BAND_MISS


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghijklmnop") for _ in range(60)) for _ in range(5)]
    near = texts[3].rsplit(" ", 1)[0] + " z"
    # By turns: a copied row, one id with two texts, copies without id, near copies with and without.
    rows = [(1, texts[0], "x")] * 3 + [(2, texts[1], "x"), (2, texts[2], "y"), (3, texts[2], "z")]
    rows += [(None, texts[4], "x")] * 3 + [(None, texts[3], "x"), (9, near, "x"), (None, None, "x"), (None, "", "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    kept = odd_sketch.without_near_duplicates(documents, 5, 80, lone=False)
    assert kept.columns == documents.columns
    found = collections.Counter((row["doc_id"], row["text"]) for row in kept.collect())
    two = next(one for one in found if one[0] == 2)
    assert two[1] in texts[1:3]
    assert found == {(1, texts[0]): 1, two: 1, (None, texts[4]): 1, (9, near): 1, (None, None): 1, (None, ""): 1}
    alone = collections.Counter(row["doc_id"] for row in odd_sketch.without_near_duplicates(documents, 5, 80).collect())
    assert alone == {1: 1, 2: 1, 9: 1, None: 6}

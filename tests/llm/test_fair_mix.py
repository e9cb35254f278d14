"""Weighted fair queueing against a plain simulation of one long queue."""

import hashlib
import random
import re

from response_ledger.llm import fair_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows):
    sizes = [len(WORD.findall(text or "")) for _, _, text in rows]
    names = sorted({source for _, source, _ in rows}, key=lambda s: (s is None, s or ""))
    total = {name: sum(n for n, row in zip(sizes, rows) if row[1] == name) for name in names}
    weight = {name: fair_mix.WEIGHTS[i % 3] for i, name in enumerate(names)}
    budget, full = 1.5 * sum(sizes), set()
    while True:
        open_ = [name for name in names if name not in full]
        level = (budget - sum(2 * total[n] for n in full)) / max(1, sum(weight[n] for n in open_))
        more = {n for n in open_ if 2 * total[n] < level * weight[n]}
        if not more:
            break
        full |= more
    target = {n: 2.0 * total[n] if n in full else min(2.0 * total[n], level * weight[n]) for n in names}
    events = []
    for place, name in enumerate(names):
        own = [i for i, row in enumerate(rows) if row[1] == name]
        own.sort(key=lambda i: (hashlib.md5(("" if rows[i][0] is None else str(rows[i][0])).encode()).hexdigest(), sizes[i]))
        done = 0
        for i in own * 2:
            done += sizes[i]
            if sizes[i]:
                events.append((done / target[name], place, i))
    taken, used = [0] * len(rows), 0
    for _, _, i in sorted(events):
        used += sizes[i]
        if used > budget:
            break
        taken[i] += sizes[i]
    return [(row[0], n, total[row[1]], target[row[1]], t) for row, n, t in zip(rows, sizes, taken)]


def corpus():
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "a", "a", "b", "Ü", "z", None]), "w " * rng.randint(0, 40)) for i in range(400)]
    return rows + [(1000, "tiny", "one"), (1001, "a", None), (1002, None, ""), (None, "b", "x y"), (7, "b", "x y"), (7, "b", "x y")]


def test_takes_against_the_plain_queue(spark, monkeypatch):
    monkeypatch.setattr(fair_mix, "SLICE_ROWS", 16)
    rows = corpus()
    documents = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "'x' AS taken")
    found = fair_mix.mix(documents).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected(rows), key=repr)


def test_hot_keys_are_cut_along_the_order(spark, monkeypatch):
    monkeypatch.setattr(fair_mix, "SLICE_ROWS", 8)
    rng = random.Random(4)
    rows = corpus() + [(None, "a", "w " * rng.randint(1, 9) + str(i)) for i in range(300)]
    rows += [(5, "b", f"{i} and so on") for i in range(200)] + [(6, "b", "all the same words")] * 150
    names = "doc_id long, source string, text string, place int, budget string, source_rows int"
    documents = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], names)
    cuts = fair_mix.crowded
    seen = []
    monkeypatch.setattr(fair_mix, "crowded", lambda dealt: seen.append(cuts(dealt)) or seen[-1])
    first = fair_mix.mix(documents).collect()
    # Which of the rows of one key and size are taken is for the hash of the row; the sums are not.
    found, wanted = (sorted((row[0] or -1, *row[1:4], row[4]) for row in some) for some in (
        [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in first], expected(rows)))
    assert found == wanted
    assert seen[0][0].count() >= 3 and seen[0][1].count() == 1
    again = fair_mix.mix(documents.repartition(7)).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))
    assert {(row["place"], row["budget"], row["source_rows"]) for row in first} == {(1, "x", 2)}
    clash = spark.createDataFrame([(*row, 3, 4) for row in rows], "doc_id long, source string, text string, size int, taken int")
    assert {(row["size"], row["taken"]) for row in fair_mix.mixed(clash).collect()} == {(3, 4)}


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    documents = spark.createDataFrame(corpus(), "doc_id long, source string, text string")
    first = [row.asDict() for row in fair_mix.mix(documents).orderBy("doc_id", "taken").collect()]
    again = [row.asDict() for row in fair_mix.mix(documents.repartition(5)).orderBy("doc_id", "taken").collect()]
    assert first == again
    for source in {row["source"] for row in first}:
        own = [row for row in first if row["source"] == source]
        assert abs(sum(row["taken"] for row in own) - own[0]["target"]) <= 80
        assert all(row["taken"] in (0, row["size"], 2 * row["size"]) for row in own)


def test_the_mix_holds_documents_as_often_as_taken(spark):
    documents = spark.createDataFrame(corpus(), "doc_id long, source string, text string")
    copies = {}
    for row in fair_mix.mixed(documents).collect():
        copies[row["doc_id"], row["text"]] = copies.get((row["doc_id"], row["text"]), 0) + 1
    wanted = {}
    for row in fair_mix.mix(documents).where("copies > 0").collect():
        wanted[row["doc_id"], row["text"]] = wanted.get((row["doc_id"], row["text"]), 0) + row["copies"]
    assert copies == wanted


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert fair_mix.mix(empty).collect() == [] and fair_mix.mixed(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, "a", " ")], "doc_id long, source string, text string")
    assert {row["taken"] for row in fair_mix.mix(blank).collect()} == {0}

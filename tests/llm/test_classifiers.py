"""Both classifiers: held-out accuracy, and the defined cases."""

import random
import zlib

import numpy as np
import pytest

from response_ledger.llm import labelled, subword_quality, toxicity_cnn

WORDS = {"en": "the of and river stone light house walk green morning".split(), "de": "der die und Fluss Stein Haus".split()}
BAD = {"en": ["idiot", "scum"], "de": ["lostraan", "lostraei", "lostrach"]}


def corpus(n=500):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        words = [rng.choice(WORDS[lang]) + rng.choice(["", "er", "s"]) for _ in range(rng.randint(20, 80))]
        toxic, low = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(BAD[lang]))
        if low:
            words = [word.upper() + "!!" if rng.random() < 0.7 else word for word in words]
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(not low), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    rows += [(900, None, "en"), (901, "", None), (901, "", None), (902, "x", "fr"), (None, "the idiot", "en")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS score")
    return documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(found, labels, column):
    truth = {row["doc_id"]: row[column] for row in labels.collect()}
    held = [row for row in found if row["held_out"] and row["doc_id"] in truth]
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in found if row["doc_id"] is not None)
    return sum(row["predicted"] == truth[row["doc_id"]] for row in held) / len(held)


@pytest.mark.parametrize(
    ("operator", "column", "limit"), [(toxicity_cnn, "toxic", 0.5), (subword_quality, "quality", 0.3)]
)
def test_held_out_accuracy(tables, operator, column, limit):
    documents, labels = tables
    found = operator.classify(documents, labels).collect()
    assert len(found) == documents.count()
    assert accuracy(found, labels, column) >= 0.95
    for row in found:
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= limit)


@pytest.mark.parametrize("operator", [toxicity_cnn, subword_quality])
def test_without_labels_or_rows(tables, operator):
    documents, labels = tables
    assert {row["score"] for row in operator.classify(documents, labels.limit(0)).collect()} == {0.0}
    assert operator.classify(documents.limit(0), labels).collect() == []


def test_toxicity_is_learned_from_few_rows(spark):
    """45 positive rows in all; plain word log-odds rank with an area of 0.84 here and find 4 of the 6."""
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    found = toxicity_cnn.classify(documents, labels).join(labels, "doc_id").where("held_out AND toxic IN (0, 1)").collect()
    toxic, clean = ([row["score"] for row in found if row["toxic"] == y] for y in (1, 0))
    area = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert area >= 0.84 and sum(one >= 0.5 for one in toxic) >= 4
    assert sum(one >= 0.5 for one in clean) <= 1


def test_scores_are_those_of_a_plain_forward_pass(tables):
    documents, labels = tables
    net = toxicity_cnn.train(labelled.sample(documents, labels, "toxic", 3000, seed=3))
    texts = {"": "", "one": "idiot", "long": " ".join(f"w{i} the idiot" for i in range(20_000)), "n": "a\nb  c"}
    spark = documents.sparkSession
    rows = [(i, text, "en", 1.0, "x") for i, text in enumerate(texts.values())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, threshold double, known string")
    found = {row["doc_id"]: row["score"] for row in toxicity_cnn.score(frame, net).collect()}
    for i, text in enumerate(texts.values()):
        words = text.split()
        vectors = [net.embedding[toxicity_cnn.hashes(word)].sum(0) for word in words]
        vectors += [np.zeros(toxicity_cnn.DIM, np.float32)] * (max(toxicity_cnn.WIDTHS) - len(vectors))
        logit, tap = net.offset, 0
        for k, width in enumerate(toxicity_cnn.WIDTHS):
            for f in range(toxicity_cnn.FILTERS):
                sums = [
                    sum(vectors[at + j] @ net.filters[:, tap + j, f] for j in range(width))
                    for at in range(min(len(vectors) - width + 1, 300))
                ]
                logit += max(0.0, max(sums) + net.bias[k, f]) * net.output[k, f]
            tap += width
        if text != texts["long"]:
            expected = labelled.sigmoid(np.array([net.slope * logit + net.shift]))[0]
            assert abs(found[i] - expected) < 1e-5
        else:
            assert found[i] >= 0.5


def test_thresholds_differ_by_language_and_scores_do_not(tables):
    documents, labels = tables
    first = {row["doc_id"]: row for row in toxicity_cnn.classify(documents, labels).collect()}
    other = documents.selectExpr("doc_id", "text", "if(lang = 'en', 'de', 'en') AS lang")
    net = toxicity_cnn.train(labelled.sample(documents, labels, "toxic", 3000, seed=3))
    assert {None, "de", "en"} <= set(net.thresholds)
    again = {row["doc_id"]: row for row in toxicity_cnn.score(other, net).collect()}
    assert all(first[i]["score"] == again[i]["score"] for i in first)
    assert all(row["flagged"] == (row["score"] >= row["threshold"]) for row in again.values())


def test_the_sample_is_bounded_and_leaves_the_held_out_fold(tables):
    documents, labels = tables
    rows = labelled.sample(documents, labels, "toxic", 60, seed=3)
    assert len(rows) <= 60 and sum(y for _, _, y in rows) == 30
    held = {row["text"] for row in documents.where(labelled.held_out()).collect()}
    assert not held & {text for text, _, _ in rows}


def test_all_labelled_rows_are_learned_from(tables, monkeypatch):
    """Beyond the rows that fit one place a model still comes from all of them."""
    documents, labels = tables
    monkeypatch.setattr(toxicity_cnn, "sample", lambda *a, **k: pytest.fail("a sample was drawn"))
    documents = documents.repartition(3)
    found = toxicity_cnn.classify(documents, labels, rows=100).collect()
    assert len(found) == documents.count() and accuracy(found, labels, "toxic") >= 0.95
    known = labelled.labelled_rows(documents, labels, "toxic", seed=3).cache()
    rows = [(row["text"], row["y"]) for row in known.collect()]
    assert len(rows) == labels.where(~labelled.held_out()).count()
    texts = toxicity_cnn.bucketed([text.split() for text, _ in rows], {})
    counts, share = toxicity_cnn.counted(known.select("text", "y"))
    y = np.array([one for _, one in rows], float)
    assert share == y.mean() and np.allclose(counts, toxicity_cnn.evidence(texts, y))


def test_words_hashed_side_by_side_have_the_hashes_they_have_alone():
    signs = "aAbÄßΣσİΩ中\0é1_😀\u0345'\u00ad."
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list(signs), rng.integers(1, 9))) for _ in range(3_000)]
    found = toxicity_cnn.hashes_of(words)
    assert found.tolist() == [toxicity_cnn.hashes(word) for word in words]
    assert toxicity_cnn.hashes_of([]).shape == (0, 3)
    known: dict[str, int] = {}
    for some in (words[:900], words[500:]):
        assert toxicity_cnn.bucketed([some], known)[0].tolist() == toxicity_cnn.hashes_of(some).tolist()

"""
Quality by supervised subword embeddings.

A word's vector is the mean of the learned vectors of its hashes: the word and its character
3- to 5-grams, in angle brackets. A word equal to the one before it adds a feature of its own,
the word bigram's. A document's vector is the mean over its words, a softmax over it gives
the label. Trained by stochastic gradient descent in numpy, on a bounded sample of labelled
rows, in small batches of sparse rows.

The mean is linear, so for scoring the output layer is folded into the vectors: every distinct
word is one number, worked out once per task, and a document the mean of its words' numbers.

Defined cases: null and empty texts have the zero vector, so the offset alone scores them;
without labels every score is 0; repeated rows are scored each.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from response_ledger.llm.batches import evaluated
from response_ledger.llm.labelled import held_out, platt, sample, sigmoid
from response_ledger.llm.odd_sketch import mixed
from response_ledger.llm.splitting import text_portions

SAMPLE_ROWS = 2_000
BUCKETS, DIM = 1 << 16, 8
GRAMS = (3, 4, 5)
EPOCHS, RATE, BATCH = 5, 40.0, 16
PORTION = 1 << 20
KEPT_WORDS = 200_000
# Bucket 0 is the repeated word's.
_REPEAT = 0
_FACTOR = np.uint64(0x100000001B3)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """
    (place of the word, bucket) of every word and of every character n-gram of every word. The
    n-grams of all words are hashed at once, as sliding windows over their code points.
    """
    marked = [f"<{word}>" for word in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(one) for one in marked], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    whole = np.fromiter((zlib.crc32(one.encode()) for one in marked), np.uint64, len(words))
    owners, hashes = [np.arange(len(words))], [whole]
    for n in GRAMS:
        last = len(codes) - n + 1
        if last > 0:
            inside = (owner[:last] == owner[n - 1 :]) & (sizes[owner[:last]] > n)
            total = np.full(last, n, np.uint64)
            for k in range(n):
                total = total * _FACTOR + codes[k : last + k]
            owners.append(owner[:last][inside])
            hashes.append(mixed(total[inside]))
    found = np.concatenate(hashes) % np.uint64(BUCKETS - 1)
    return np.concatenate(owners), found.astype(np.int64) + 1


def repeats(words: list[str]) -> int:
    return sum(map(str.__eq__, words, words[1:]))


def sparse(text: str, known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A document as (buckets, weights), the weights adding up to 1."""
    words = text.split()
    counts, again = Counter(words), repeats(words)
    total = len(words) + again
    if not total:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    new = list(counts.keys() - known.keys())
    owner, bucket = features(new)
    order = np.argsort(owner, kind="stable")
    known.update(zip(new, np.split(bucket[order], np.cumsum(np.bincount(owner, minlength=len(new)))[:-1])))
    parts = [known[word] for word in counts]
    each = np.repeat([n / len(p) / total for n, p in zip(counts.values(), parts)], [len(p) for p in parts])
    places = np.concatenate([*parts, [_REPEAT]])
    distinct, place = np.unique(places, return_inverse=True)
    return distinct.astype(np.int32), np.bincount(place, np.append(each, again / total)).astype(np.float32)


@dataclass
class Model:
    """The folded model: a number per bucket, and what turns a document's mean into a score."""

    folded: np.ndarray
    offset: float
    slope: float
    shift: float

    def score(self, means: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (means + self.offset) + self.shift)


def train(rows: list[tuple], seed: int = 11) -> Model:
    """A model from (text, lang, label) rows; a fifth is kept back for calibration."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    output = np.zeros((DIM, 2), np.float32)
    offset = np.zeros(2, np.float32)
    known: dict[str, np.ndarray] = {}
    documents = [sparse(text, known) for text, _, _ in rows]
    y = np.array([label for _, _, label in rows], np.int64)
    share = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())])
    weight = (len(y) / 2 / share)[y]
    fold = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~fold)
    steps, total = 0, max(1, EPOCHS * -(-len(learn) // BATCH))
    for _ in range(EPOCHS):
        order = rng.permutation(learn)
        for first in range(0, len(order), BATCH):
            rate = RATE * (1 - steps / total)
            steps += 1
            some = [i for i in order[first : first + BATCH].tolist() if len(documents[i][0])]
            if not some:
                continue
            places = np.concatenate([documents[i][0] for i in some])
            weights = np.concatenate([documents[i][1] for i in some])
            sizes = [len(documents[i][0]) for i in some]
            starts = np.cumsum([0, *sizes[:-1]])
            means = np.add.reduceat(vectors[places] * weights[:, None], starts)
            logits = means @ output + offset
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            p *= weight[some][:, None] / len(some)
            into = p @ output.T
            output -= 0.1 * rate * means.T @ p
            offset -= 0.01 * rate * p.sum(0)
            np.subtract.at(vectors, places, rate * weights[:, None] * np.repeat(into, sizes, axis=0))
    folded = (vectors @ (output[:, 1] - output[:, 0])).astype(np.float64)
    means = np.array([folded[b] @ w for b, w in documents])
    model = Model(folded, float(offset[1] - offset[0]), 1.0, 0.0)
    # The sample may hold one label more often than the corpus: calibrated with equal shares.
    model.slope, model.shift = platt(means[fold] + model.offset, y[fold], weight[fold])
    return model


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """`documents` (doc_id, text) to doc_id, held_out, score and predicted."""
    source = documents.select("doc_id", held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    if model is None:
        return source.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    doc_type = source.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        repeat = float(model.folded[_REPEAT])
        for batch in batches:
            means = []
            for _, _, texts in text_portions(batch.column(2), PORTION):
                if len(known) > KEPT_WORDS:
                    known.clear()
                words = [text.split() for text in texts]
                new = list(set().union(*words).difference(known))
                owner, bucket = features(new)
                sums = np.bincount(owner, model.folded[bucket], len(new))
                known.update(zip(new, (sums / np.bincount(owner, minlength=len(new))).tolist()))
                for one in words:
                    again = repeats(one)
                    total = sum(map(known.__getitem__, one)) + again * repeat
                    means.append(total / max(1, len(one) + again))
            columns = [batch.column(0), batch.column(1), pa.array(model.score(np.array(means)), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score"])

    rows = evaluated(source.mapInArrow(scored, f"doc_id {doc_type}, held_out boolean, score double"), "scored")
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def classify(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every document's quality, learned from at most `rows` labelled rows outside the held-out fold."""
    known = sample(documents, labels, "quality", rows, seed=5)
    return score(documents, train(known) if {0, 1} <= {y for _, _, y in known} else None)

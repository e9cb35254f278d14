"""What the classifiers share: the held-out rule, the bounded sample they learn from, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no label is learned from: crc32 of the doc_id as text leaves 0 over `FOLDS`."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def sample(documents: DataFrame, labels: DataFrame, label: str, rows: int, seed: int) -> list[tuple]:
    """
    (text, lang, label) of at most `rows` labelled documents outside the held-out fold, in a
    fixed order drawn by hash. Ids are drawn from the labels alone, so what is broadcast and
    what comes to the driver is bounded by `rows`; the rarer label fills up to half of it.
    """
    known = labels.where(~held_out() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    order = [F.xxhash64("doc_id", F.lit(seed)), "doc_id"]
    halves = [known.where(F.col("y") == y).orderBy(*order).limit(rows) for y in (0, 1)]
    counts = [half.count() for half in halves]
    most = [min(counts[0], max(rows // 2, rows - counts[1])), 0]
    most[1] = min(counts[1], rows - most[0])
    drawn = halves[0].limit(most[0]).unionByName(halves[1].limit(most[1]))
    texts = documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string").alias("lang"),
    )
    found = texts.join(F.broadcast(drawn), "doc_id").orderBy(*order, "text").limit(rows)
    return [(one["text"], one["lang"], one["y"]) for one in found.select("text", "lang", "y").collect()]


def labelled_rows(documents: DataFrame, labels: DataFrame, label: str, seed: int) -> DataFrame:
    """
    (doc_id, text, lang, y) of all labelled documents outside the held-out fold; each partition in an
    order fixed by hash.
    """
    known = labels.where(~held_out() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    texts = documents.where(~held_out()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    # Merged at any size: what is broadcast would grow with the labels.
    return texts.join(known.hint("merge"), "doc_id").sortWithinPartitions(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "text")


def platt(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make the sigmoid of a logit the share of ones, by Newton steps."""
    slope, offset = 1.0, 0.0
    # One more row of each kind keeps a perfect split finite.
    x = np.concatenate([logits, [logits.min(initial=0.0), logits.max(initial=0.0)]])
    t, w = np.concatenate([y, [1, 0]]).astype(float), np.concatenate([weight, [0.5, 0.5]])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        g = np.array([(w * (p - t) * x).sum() + 1e-3 * (slope - 1), (w * (p - t)).sum()])
        s = w * p * (1 - p)
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - np.clip(step[0], -1, 1), offset - np.clip(step[1], -2, 2)
    return float(max(slope, 1e-3)), float(offset)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

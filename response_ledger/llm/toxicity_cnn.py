"""
Toxicity by a convolutional text classifier.

A word's vector is the sum of the embeddings of its hashes (the word, and its first four and
five letters). Filters of width 1, 2 and 3 slide over the words, each filter's greatest value
goes into a logistic output. It is trained by stochastic gradient descent in numpy, on all
labelled rows, beyond `SAMPLE_ROWS` of them side by side with averages between passes; as only the greatest value of a filter counts, a gradient
touches a few words of a text. From a small random start such gradients seldom find the rare words that
tell a few positive rows apart. So one dimension of the embeddings starts at the evidence of each
bucket, by how many deviations it stands in more positive rows than chance would have it, with
a filter that reads it; and errors of the rarer label weigh more.

A filter is a sum over its taps, so for scoring every distinct word is projected once per task
onto all taps, and a text is a look-up, shifted sums and a maximum.

A fifth of the rows calibrates: logits to probabilities over all languages, and per language
the threshold that separates best. The score itself never sees the language; the threshold
only makes `flagged`.

A text is read whole, however long; beside doc_id, text and lang no column is read, so none can
clash; an empty table gives no rows. Null and empty texts score as a text of padding alone; a null language has the
threshold of all languages; without labels every score is 0; repeated rows are scored each.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from response_ledger.llm.batches import TEXT_ROWS, evaluated
from response_ledger.llm.labelled import held_out, labelled_rows, platt, sample, sigmoid
from response_ledger.llm.splitting import text_portions
from response_ledger.session import landed, scratch_path, setting

SAMPLE_ROWS = 3_000
BUCKETS, DIM = 1 << 15, 16
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, RATE = 5, 0.1
# The start: deviations that make one unit of evidence, the most units, those that count for
# nothing, and the weight of those that count. The most that a row of the rarer label weighs.
DEVIATIONS, UNITS, QUIET, LOUD = 4.0, 2.0, 1.0, 3.0
MOST_WEIGHT = 4.0
PREFIXES = (4, 5)
PORTION = 1 << 20
KEPT_WORDS = 100_000

TAPS = sum(WIDTHS)
_PAD = 0


def hashes(word: str) -> list[int]:
    """The buckets of a word; bucket 0 is the padding's."""
    lower = word.lower()
    parts = [lower, *(f"{lower[:n]}*{n}" for n in PREFIXES if len(lower) > n)]
    found = [1 + zlib.crc32(part.encode()) % (BUCKETS - 1) for part in parts]
    return found + [_PAD] * (1 + len(PREFIXES) - len(found))


class _Starts(dict):
    """The bucket of each beginning of a word, found when first asked for."""

    def __init__(self, n: int) -> None:
        super().__init__()
        self.n = n

    def __missing__(self, start: str) -> int:
        found = self[start] = 1 + zlib.crc32(f"{start}*{self.n}".encode()) % (BUCKETS - 1)
        return found


def hashes_of(words: list[str]) -> np.ndarray:
    """(word, hash): the `hashes` of words without white space, side by side."""
    out = np.full((len(words), 1 + len(PREFIXES)), _PAD, np.int64)
    if not words:
        return out
    joined = "\n".join(words).lower()
    lower = joined.split("\n")
    out[:, 0] = 1 + np.fromiter(map(zlib.crc32, joined.encode().split(b"\n")), np.int64, len(words)) % (BUCKETS - 1)
    wide = np.fromiter(map(len, lower), np.int64, len(words))
    for k, n in enumerate(PREFIXES):
        starts, long = _Starts(n), wide > n
        out[long, 1 + k] = [starts[word[:n]] for word in lower if len(word) > n]
    return out


@dataclass
class Network:
    embedding: np.ndarray  # bucket, dim
    filters: np.ndarray  # dim, tap, filter
    bias: np.ndarray  # width, filter
    output: np.ndarray  # width, filter
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str | None, float] | None = None

    def projections(self, words: list[str]) -> np.ndarray:
        """(word, tap, filter) of distinct words."""
        buckets = hashes_of(words)
        vectors = self.embedding[buckets[:, 0]]
        for k in range(len(PREFIXES)):
            vectors += self.embedding[buckets[:, 1 + k]]
        return (vectors @ self.filters.reshape(DIM, -1)).reshape(-1, TAPS, FILTERS)

    def pooled(self, taps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest value of each filter over a text's (word, tap, filter), and where it is."""
        values, places, tap = np.empty_like(self.bias), np.empty(self.bias.shape, np.int64), 0
        for k, width in enumerate(WIDTHS):
            size = len(taps) - width + 1
            sums = taps[:size, tap]
            for j in range(1, width):
                sums = sums + taps[j : j + size, tap + j]
            places[k] = sums.argmax(0)
            values[k] = sums[places[k], np.arange(FILTERS)]
            tap += width
        return np.maximum(values + self.bias, 0), places

    def logit(self, pooled: np.ndarray) -> float:
        return float((pooled * self.output).sum() + self.offset)


def padded(buckets: np.ndarray) -> np.ndarray:
    """At least as many words as the widest filter takes."""
    short = max(WIDTHS) - len(buckets)
    return np.pad(buckets, ((0, max(short, 0)), (0, 0)))


def evidence(texts: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """For each bucket by how many deviations more positive rows hold it than chance would have it."""
    held, positive = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for buckets, label in zip(texts, y):
        found = np.unique(buckets)
        held[found] += 1
        positive[found] += label
    expected = held * y.mean() if len(y) else held
    out = np.maximum(positive - expected, 0) / np.sqrt(expected + 1)
    out[_PAD] = 0
    return out


def untrained(rng: np.random.Generator) -> Network:
    net = Network(
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
        rng.normal(0, 0.3, (DIM, TAPS, FILTERS)).astype(np.float32),
        np.full((len(WIDTHS), FILTERS), -0.1, np.float32),
        rng.normal(0, 0.3, (len(WIDTHS), FILTERS)).astype(np.float32),
        0.0,
    )
    net.embedding[_PAD] = 0
    return net


def begun(net: Network, found: np.ndarray, share: float) -> tuple[float, float]:
    """Start a network at the evidence and the share of positive rows; what rows of label 0 and 1 weigh."""
    net.embedding[:, 0] = np.minimum(found / DEVIATIONS, UNITS)
    net.filters[0, 0], net.filters[1:, 0, 0] = 0, 0
    net.filters[0, 0, 0], net.bias[0, 0], net.output[0, 0] = 1, -QUIET, LOUD
    share = min(max(share, 1e-3), 1 - 1e-3)
    net.offset = float(np.log(share / (1 - share)))
    return min(MOST_WEIGHT, max(1, share / (1 - share))), min(MOST_WEIGHT, max(1, (1 - share) / share))


def bucketed(texts: list[list[str]], known: dict[str, int]) -> list[np.ndarray]:
    """The buckets of each text's words, (word, hash); `known` keeps those of words met before, a number a word."""
    new = list(set().union(*texts).difference(known))
    shifts = np.arange(1 + len(PREFIXES)) * (BUCKETS - 1).bit_length()
    known.update(zip(new, (hashes_of(new) << shifts).sum(1).tolist()))
    found = []
    for words in texts:
        numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        found.append(padded(numbers[:, None] >> shifts & (BUCKETS - 1)))
    return found


def step(net: Network, buckets: np.ndarray, y: float, weight: float, rate: float, most: float = np.inf) -> None:
    """One step of gradient descent, on one text; a gradient that may be longer than `most` is shortened to it."""
    vectors = net.embedding[buckets].sum(1)
    pooled, places = net.pooled((vectors @ net.filters.reshape(DIM, -1)).reshape(-1, TAPS, FILTERS))
    error = float(sigmoid(np.array(net.logit(pooled)))) - y
    if abs(error) < 0.01:
        return
    error *= weight
    if most < np.inf:
        onto = np.linalg.norm(net.filters) + np.linalg.norm(vectors, axis=1).max()
        rate *= min(1.0, most / (abs(error) * (1 + np.linalg.norm(pooled) + np.linalg.norm(net.output) * onto)))
    back = (error * net.output * (pooled > 0)).astype(np.float32)
    net.output -= rate * error * pooled
    net.offset -= rate * error
    net.bias -= rate * back
    tap = 0
    for k, width in enumerate(WIDTHS):
        for j in range(width):
            at = places[k] + j
            into = back[k][:, None] * net.filters[:, tap].T
            net.filters[:, tap] -= rate * vectors[at].T * back[k]
            for n in range(buckets.shape[1]):
                np.subtract.at(net.embedding, buckets[at, n], rate * into)
            tap += 1
    net.embedding[_PAD] = 0


def train(rows: list[tuple], seed: int = 7) -> Network:
    """A network from (text, lang, label) rows; a fifth is kept back for calibration."""
    rng = np.random.default_rng(seed)
    net = untrained(rng)
    texts = bucketed([text.split() for text, _, _ in rows], {})
    y = np.array([label for _, _, label in rows], float)
    fold = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~fold)
    weight = begun(net, evidence([texts[i] for i in learn], y[learn]), y[learn].mean() if len(learn) else 0.5)
    steps, total = 0, max(1, EPOCHS * len(learn))
    for _ in range(EPOCHS):
        for i in rng.permutation(learn).tolist():
            rate = RATE * (1 - steps / total)
            steps += 1
            step(net, texts[i], y[i], weight[int(y[i] == 1)], rate)
    logits = np.array([net.logit(net.pooled((net.embedding[b].sum(1) @ net.filters.reshape(DIM, -1)).reshape(-1, TAPS, FILTERS))[0]) for b in texts])
    net.slope, net.shift = platt(logits[fold], y[fold], np.ones(int(fold.sum())))
    scores = sigmoid(net.slope * logits + net.shift)
    langs = np.array([lang or "" for _, lang, _ in rows], object)
    net.thresholds = {None: best_threshold(scores[fold], y[fold])}
    for lang in sorted({*langs.tolist()} - {""}):
        mine = fold & (langs == lang)
        if 0 < y[mine].sum() < mine.sum():
            net.thresholds[lang] = best_threshold(scores[mine], y[mine])
    return net


# What a task has learned goes to the average as rows of `DIM` whole numbers, which add up to the same
# in any order: first the embedding's, then those of all else. Row -1 tells how many texts it read.
_UNIT = float(1 << 24)
_LEARNED = "key int, " + ", ".join(f"d{i} long" for i in range(DIM))
# Logits within one of these count as equal in calibration, and those beyond the most as the most.
LOGIT_STEP, MOST_LOGIT = 1 / 256, 30.0
# Where few rows are positive they weigh more than a half of them would, and steps could run away.
MOST_GRADIENT = 20.0


def _flat(net: Network) -> np.ndarray:
    rest = np.concatenate([net.filters.ravel(), net.bias.ravel(), net.output.ravel(), [net.offset]])
    return np.concatenate([net.embedding, np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)]).astype(float)


def _unflat(values: np.ndarray) -> Network:
    rest, size = values[BUCKETS:].ravel(), len(WIDTHS) * FILTERS
    filters, bias, output, offset = np.split(rest, np.cumsum([DIM * TAPS * FILTERS, size, size]))
    shape = (len(WIDTHS), FILTERS)
    return Network(
        values[:BUCKETS].astype(np.float32), filters.reshape(DIM, TAPS, FILTERS).astype(np.float32),
        bias.reshape(shape).astype(np.float32), output.reshape(shape).astype(np.float32), float(offset[0]),
    )


def counted(learn: DataFrame) -> tuple[np.ndarray, float]:
    """`evidence` of all rows (text, y), and their share of positive ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        held, positive, rows = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), np.zeros(2, np.int64)
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for begin, end, texts in text_portions(batch.column(0), PORTION):
                if len(known) > KEPT_WORDS:
                    known: dict[str, int] = {}
                for y, buckets in zip(labels[begin:end], bucketed([text.split() for text in texts], known)):
                    mine = np.unique(buckets)
                    held[mine] += 1
                    positive[mine] += y
                    rows += (1, y)
        at = np.flatnonzero(held)
        columns = [np.append(at, -1), np.append(held[at], rows[0]), np.append(positive[at], rows[1])]
        yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()) for one in columns], names=["bucket", "held", "positive"])

    counts = learn.mapInArrow(count, "bucket long, held long, positive long")
    sums = counts.groupBy("bucket").agg(F.sum("held").alias("held"), F.sum("positive").alias("positive")).toArrow()
    at, held, positive = (sums.column(i).to_numpy().astype(np.int64) for i in range(3))
    total, ones = int(held[at == -1].sum()), int(positive[at == -1].sum())
    share = ones / total if total else 0.5
    whole, hits = np.zeros(BUCKETS), np.zeros(BUCKETS)
    whole[at[at >= 0]], hits[at[at >= 0]] = held[at >= 0], positive[at >= 0]
    out = np.maximum(hits - whole * share, 0) / np.sqrt(whole * share + 1)
    out[_PAD] = 0
    return out, share


def descended(learn: DataFrame, start: Network, weight: tuple[float, float], rates: tuple[float, float], expected: float) -> Network:
    """A pass over all rows (text, y): every task descends from `start` over its own, then their average."""
    first = _flat(start)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, known, done = _unflat(first), {}, 0
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for begin, end, texts in text_portions(batch.column(0), PORTION):
                if len(known) > KEPT_WORDS:
                    known: dict[str, int] = {}
                for y, buckets in zip(labels[begin:end], bucketed([text.split() for text in texts], known)):
                    rate = rates[0] + (rates[1] - rates[0]) * min(1.0, done / expected)
                    step(net, buckets, y, weight[y], rate, MOST_GRADIENT)
                    done += 1
        moved = np.rint((_flat(net) - first) * done * _UNIT).astype(np.int64)
        at = np.flatnonzero(moved.any(1))
        rows = np.concatenate([moved[at], np.full((1, DIM), done, np.int64)])
        keys = pa.array(np.append(at, -1), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [keys, *(pa.array(one, pa.int64()) for one in rows.T)], names=["key", *(f"d{i}" for i in range(DIM))]
        )

    sums = learn.mapInArrow(learned, _LEARNED).groupBy("key").agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(DIM)]).toArrow()
    at = sums.column(0).to_numpy()
    moved = np.stack([sums.column(1 + i).to_numpy() for i in range(DIM)], 1).astype(float)
    total = max(1.0, moved[at == -1].sum() / DIM)
    first = first.copy()
    first[at[at >= 0]] += moved[at >= 0] / (total * _UNIT)
    return _unflat(first)


def calibrated(net: Network, fold: DataFrame) -> Network:
    """Slope, offset and thresholds from all rows (doc_id, text, lang, y) kept back."""
    logits = fold.mapInArrow(logits_of(net, ("lang", "y")), "lang string, y int, logit double")
    most = round(MOST_LOGIT / LOGIT_STEP)
    place = F.greatest(F.lit(-most), F.least(F.lit(most), F.rint(F.col("logit") / LOGIT_STEP).cast("int")))
    bins = landed(
        logits.groupBy("lang", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("ones")), "bins"
    )
    whole = bins.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    found = whole.orderBy("bin").collect()
    x = np.array([one["bin"] * LOGIT_STEP for one in found])
    ones = np.array([one["ones"] for one in found], float)
    zeros = np.array([one["n"] for one in found], float) - ones
    y = np.repeat([1.0, 0.0], len(x))
    net.slope, net.shift = platt(np.concatenate([x, x]), y, np.concatenate([ones, zeros]))
    # The best F1 by language, over its bins from the top; at most as many as there are places.
    keyed = bins.where("lang <> ''").unionByName(whole.withColumn("lang", F.lit("")))
    down = Window.partitionBy("lang").orderBy(F.desc("bin"))
    per = Window.partitionBy("lang")
    f1 = 2 * F.sum("ones").over(down) / (F.sum("n").over(down) + F.greatest(F.sum("ones").over(per), F.lit(1)))
    cut = F.coalesce((F.col("bin") + F.lag("bin").over(Window.partitionBy("lang").orderBy("bin"))) / 2, F.col("bin"))
    best = (
        keyed.select("lang", "bin", f1.alias("f1"), cut.alias("cut"), F.sum("ones").over(per).alias("ones"), F.sum("n").over(per).alias("n"))
        .groupBy("lang").agg(F.max(F.struct("f1", -F.col("bin"), "cut"))["cut"].alias("cut"), F.max("ones").alias("ones"), F.max("n").alias("n"))
    )
    net.thresholds = {None: 0.5}
    for one in best.collect():
        value = float(sigmoid(np.array(net.slope * one["cut"] * LOGIT_STEP + net.shift)))
        if one["lang"] == "" and one["ones"]:
            net.thresholds[None] = value
        elif one["lang"] and 0 < one["ones"] < one["n"]:
            net.thresholds[one["lang"]] = value
    return net


def train_whole(rows: DataFrame, n: int, parts: int, steps: int, seed: int = 7) -> Network:
    """
    A network from all labelled rows (doc_id, text, lang, y), `n` in `parts` partitions; a fifth is kept back.

    Evidence is counted over all rows. Then every task descends over its own, and the average of what
    they learned is the next pass's start; passes go on until at least `steps` rows were stepped on.
    """
    fold = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(5)) == 4
    learn = rows.where(~fold).select("text", "y")
    net = untrained(np.random.default_rng(seed))
    found, share = counted(learn)
    weight = begun(net, found, share)
    passes = max(1, -(-steps // n))
    for one in range(passes):
        rates = (RATE * (1 - one / passes), RATE * (1 - (one + 1) / passes))
        net = descended(learn, net, weight, rates, max(1.0, 0.8 * n / parts))
    return calibrated(net, rows.where(fold))


def best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The threshold of the best F1, in the middle between the scores it separates."""
    order = np.argsort(scores)
    s, t = scores[order], y[order]
    hits = t[::-1].cumsum()[::-1]
    f1 = 2 * hits / (np.arange(len(s), 0, -1) + max(t.sum(), 1)) if len(s) else np.zeros(0)
    if not len(s) or not hits[0]:
        return 0.5
    best = int(f1.argmax())
    return float((s[best - 1] + s[best]) / 2) if best else float(s[0])


def logits_of(net: Network, keep: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For `mapInArrow`: the columns `keep`, and the logit of the column `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        table = np.zeros((1, TAPS, FILTERS), np.float32)
        for batch in batches:
            found = []
            for _, _, texts in text_portions(batch.column("text"), PORTION):
                if len(known) > KEPT_WORDS:
                    known, table = {}, table[:1]
                words = [text.split() for text in texts]
                new = list(set().union(*words).difference(known))
                known.update(zip(new, range(len(table), len(table) + len(new))))
                table = np.concatenate([table, net.projections(new)])
                for one in words:
                    at = np.fromiter(map(known.__getitem__, one), np.int64, len(one))
                    if len(at) < max(WIDTHS):
                        at = np.pad(at, (0, max(WIDTHS) - len(at)))
                    found.append(net.logit(net.pooled(table[at])[0]))
            columns = [*(batch.column(name) for name in keep), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "logit"])

    return run


def score(documents: DataFrame, net: Network | None) -> DataFrame:
    """`documents` (doc_id, text, lang) to doc_id, held_out, score, predicted, threshold, flagged."""
    source = documents.select("doc_id", held_out().alias("held_out"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    if net is None:
        return source.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0.5).alias("threshold"), F.lit(False).alias("flagged"))
    doc_type = source.schema["doc_id"].dataType.simpleString()
    logits = logits_of(net, ("doc_id", "held_out", "lang"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in logits(batches):
            scores = pa.array(sigmoid(net.slope * batch.column(3).to_numpy() + net.shift), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], scores], names=["doc_id", "held_out", "lang", "score"])

    rows = evaluated(
        source.mapInArrow(scored, f"doc_id {doc_type}, held_out boolean, lang string, score double"), "scored"
    )
    threshold = F.lit(net.thresholds[None])
    for lang, value in net.thresholds.items():
        if lang is not None:
            threshold = F.when(F.col("lang") == lang, F.lit(value)).otherwise(threshold)
    return rows.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        threshold.alias("threshold"), (F.col("score") >= threshold).alias("flagged"),
    )


def classify(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """
    Every document's toxicity, learned from all labelled rows outside the held-out fold: up to `rows`
    of them in one place, more of them by `train_whole`.
    """
    if "lang" not in documents.columns:
        documents = documents.withColumn("lang", F.lit(None).cast("string"))
    path = scratch_path(documents.sparkSession, "labelled")
    known = labelled_rows(documents, labels, "toxic", seed=3)
    known.write.option("compression", "zstd").parquet(path)
    known = documents.sparkSession.read.schema(known.schema).parquet(path)
    found = known.agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    if (found["low"], found["high"]) != (0, 1):
        return score(documents, None)
    if found["n"] <= rows:
        return score(documents, train(sample(documents, labels, "toxic", rows, seed=3)))
    with setting(documents.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS)):
        net = train_whole(known, found["n"], known.rdd.getNumPartitions(), EPOCHS * rows)
    return score(documents, net)

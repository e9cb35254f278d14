"""
Quality rules judged by host: documents are measured, rule failures are counted by host, and
a host whose failure rate is high beyond what its number of documents explains is rejected
as a whole.

Rates are shrunk by a beta prior fitted to all hosts (method of moments), so that a host
with a few documents is judged by its kind and a large one by its own rate.

Defined cases: a null text has no words and so fails the base rules; rows with a null source
form one host; repeated rows are judged each and count each; an empty table gives no rows.
Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.llm.batches import evaluated
from response_ledger.llm.splitting import text_portions
from response_ledger.session import landed

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
ADDED = (*MEASURES, "base_failed", "host_rate", "kept")

# White space between words, and the signs that count as symbols.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

# Bytes of text worked on at once.
PORTION = 1 << 20

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
# A host goes when its shrunk share of failing documents is above this.
MAX_HOST_RATE = 0.5
# Bounds of the prior's weight, in documents.
PRIOR_DOCUMENTS = (1.0, 1000.0)


def measure_text(text: str) -> tuple[int, int, int, int, int, int]:
    """The `MEASURES` of one whole text."""
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        starts = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
        covered = np.zeros(len(words), bool)
        for shift in range(3):
            covered[shift : shift + len(starts)] |= starts
        repeated = int(covered.sum())
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` with the `MEASURES` of each whole text."""
    kept = [c for c in documents.columns if c not in ADDED]
    source = documents.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    fields = [T.StructField(name, T.LongType()) for name in MEASURES]
    schema = T.StructType([*documents.select(*kept).schema.fields, *fields])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_portions(batch.column(len(kept)), PORTION)
            found = [measure_text(one) for _, _, some in texts for one in some]
            rows = np.array(found, np.int64).reshape(-1, len(MEASURES))
            columns = [*batch.columns[: len(kept)], *map(pa.array, rows.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(measured, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )


def any_failed() -> Column:
    """
    What counts against a host: the base rules, many symbols, or many repeated lines, both as a
    share of the document itself, so that no length is at a disadvantage.
    """
    symbols = F.col("n_symbols") * 100 > F.col("word_chars") * MAX_SYMBOL_PERCENT
    return base_failed() | symbols | (F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINE_PERCENT)


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """(host, rows, failures, host_rate): one row per host, the rate shrunk by the prior of all."""
    counts = measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(any_failed()).alias("failures")
    )
    counts = landed(counts, "hosts")
    square = F.col("failures") * F.col("failures") / F.col("rows")
    moments = counts.agg(
        F.sum("rows").alias("n"), F.sum("failures").alias("k"), F.sum(square).alias("s")
    ).first()
    if not moments["n"]:
        return counts.withColumn("host_rate", F.lit(0.0))
    mean = moments["k"] / moments["n"]
    spread = moments["s"] / moments["n"] - mean * mean
    least, most = PRIOR_DOCUMENTS
    weight = min(most, max(least, mean * (1 - mean) / spread - 1)) if spread > 0 else most
    rate = (F.col("failures") + F.lit(mean * weight)) / (F.col("rows") + F.lit(weight))
    return counts.withColumn("host_rate", rate)


def judge(documents: DataFrame, text: str = "text", host: str = "source", keep_text: bool = True) -> DataFrame:
    """
    `documents` with the `MEASURES`, `base_failed`, the `host_rate` of its host, and `kept`:
    it passes the base rules and its host is not rejected.

    The measures are written once and serve both the rates and the verdicts; where texts are
    to be kept, they are measured again instead, so that no text is written or moved. The
    hosts' table is written, so the join sees its true size: Spark broadcasts it below its
    threshold, and beyond that sorts and splits a host that holds much of all rows.
    """
    measured = measure(documents, text)
    narrow = evaluated(measured.select(host, *MEASURES) if keep_text else measured.drop(text), "measured")
    rates = landed(host_rates(narrow, host).select(F.col(host).alias("__host"), "host_rate"), "rates")
    rows = measured if keep_text else narrow
    joined = rows.join(rates, F.col(host).eqNullSafe(F.col("__host"))).drop("__host")
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("host_rate") <= MAX_HOST_RATE)
    )

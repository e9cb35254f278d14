"""
Substring dedup by sliding sentence spans: every run of several consecutive sentences is
hashed, runs are joined globally, and the sentences covered by any run that is not the first
of its kind are removed.

A sentence ends with a word that has a mark of `MARKS` behind its last letter or digit, or at
a line feed; marks inside sentences count, too, so that a passage pasted into a sentence loses
little at its edges. A character of a script written without spaces is a word, and so is a
mark of such a script.

A run is at least `RUN` sentences and as many more as make `RUN_WORDS` words; one or two sentences
are a run if they have `FEW_WORDS` words; a text with fewer sentences than `RUN` is one run if it has
`RUN_WORDS`. For passages with fewer whole sentences, any `PASSAGE_WORDS` words that hold no run of
`RUN` sentences, and do not begin with the same word twice, are a run, too; it counts where no
repeated run of sentences overlaps it. Runs are alike if their words are, A-Z in either case,
whatever white space is between them. The first of a kind is the one with the least (doc_id, digest of the
text, position), and a sentence counts as removed if any word of it is. `n_in_spans` counts those that
lie in a repeated run of sentences; the others of `n_removed` went with a run of words alone.

Counting comes first, by partial aggregates of hashes alone. Only occurrences of repeated runs
go on, and these join on the hash, which Spark splits where one run makes up much of all.

Defined cases: a null text has no sentences and stays null; a row whose doc_id is null comes
before all others; of rows that share a doc_id, or have none, and differ in text one is the first;
rows that are equal in both are all first or all not. An empty table gives no rows. Input columns
with the name of an output column are replaced; others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.llm.batches import evaluated, put_back, set_aside
from response_ledger.llm.hot_keys import join_by_key, most_frequent
from response_ledger.llm.odd_sketch import Shingler, mixed
from response_ledger.llm.splitting import text_portions
from response_ledger.session import landed

RUN = 3
RUN_WORDS = 12
FEW_WORDS = 40
PASSAGE_WORDS = 51
MARKS = b".!?,;:|"
# Full stops, question marks, commas and the like of other scripts.
WIDE_MARKS = "。．、，！？：；｡､︒︑؟،؛۔।॥։።፣၊။។៕…"
PORTION = 1 << 20
ADDED = ("n_sentences", "n_removed", "n_in_spans")

_ALNUM = np.array([chr(b).isalnum() or b >= 0x80 for b in range(128)] + [True] * 128)
_MARK = np.zeros(256, bool)
_MARK[list(MARKS)] = True
# Leading bytes, with the least and greatest byte behind them, of the characters that scripts
# without spaces are written in: Thai and Lao, Burmese, Khmer, then kana, Han and full width.
_WIDE = (
    (0xE0, 0xB8, 0xBB), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), *((b, 0x80, 0xBF) for b in range(0xE3, 0xEA)),
    (0xEF, 0xBC, 0xBF), (0xF0, 0xA0, 0xB3),
)


def wide_marks(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of `WIDE_MARKS`: where each mark begins, and how long it is."""
    found, sizes = [], []
    padded = np.append(buffer, np.zeros(3, np.uint8))
    by_lead: dict[int, list[bytes]] = {}
    for mark in WIDE_MARKS:
        by_lead.setdefault(mark.encode()[0], []).append(mark.encode())
    for lead, marks in by_lead.items():
        at = np.flatnonzero(buffer == lead)
        for mark in marks if len(at) else ():
            same = at
            for i, byte in enumerate(mark[1:], 1):
                same = same[padded[same + i] == byte]
            found.append(same)
            sizes.append(np.full(len(same), len(mark)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(sizes)


class Words(Shingler):
    """Words between white space, and the single characters of scripts written without it."""

    def word_edges(self, buffer: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, stops = super().word_edges(buffer, space)
        if not len(buffer) or buffer.max() < 0xE0:
            return starts, stops
        padded = np.append(buffer, np.zeros(1, np.uint8))
        wide = [np.empty(0, np.int64)]
        for lead, least, most in _WIDE:
            at = np.flatnonzero(buffer == lead)
            wide.append(at[(padded[at + 1] >= least) & (padded[at + 1] <= most)])
        wide = np.concatenate(wide)
        if not len(wide):
            return starts, stops
        behind = wide + np.where(buffer[wide] >= 0xF0, 4, 3)
        starts = np.unique(np.concatenate([starts, wide, behind[~space[behind]]]))
        ends = stops[np.searchsorted(stops, starts, "right")]
        return starts, np.minimum(ends, np.append(starts[1:], len(buffer)))


class Found(NamedTuple):
    """
    A text's words (first byte), the first word of each sentence, and the runs: place, hash,
    first word, the word behind the last, and whether the run is of words, not sentences. The
    place counts sentences or words, as the run does.
    """

    starts: np.ndarray
    sentences: np.ndarray
    places: np.ndarray
    hashes: np.ndarray
    run_at: np.ndarray
    run_to: np.ndarray
    of_words: np.ndarray


class Sentences:
    """Words, sentences and runs of texts."""

    def __init__(self, run: int = RUN, run_words: int = RUN_WORDS, few_words: int = FEW_WORDS) -> None:
        self.run, self.run_words, self.few_words, self.passage_words = run, run_words, few_words, PASSAGE_WORDS
        self.hasher = Words(1)
        self.base = self.hasher.base
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self.powers):
            for name, factor in (("powers", self.base), ("inverses", self.hasher.inverse)):
                steps = np.full(2 * size, factor)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def find(self, texts: list[str]) -> list[Found]:
        """Words, sentences and runs of each text."""
        raw = [t.encode() for t in texts]
        buffer, ends, starts, stops, hashes = self.hasher.words_of(raw)
        if not len(starts):
            return [Found(*[np.empty(0, np.int64)] * 7) for _ in raw]
        places = np.arange(len(buffer))
        letters, marks = _ALNUM[buffer], _MARK[buffer]
        if buffer.max() >= 0x80:
            at, sizes = wide_marks(buffer)
            for i in range(3):
                letters[(at + i)[sizes > i]] = False
            marks[at + sizes - 1] = True
        letter = np.maximum.accumulate(np.where(letters, places, -1))[stops - 1]
        mark = np.maximum.accumulate(np.where(marks, places, -1))[stops - 1]
        lines = np.cumsum(buffer == 10)
        following = np.append(starts[1:], len(buffer))
        last = (mark >= starts) & (mark > letter) | (lines[following - 1] > lines[stops - 1])
        cuts = np.searchsorted(starts, ends).tolist()
        # No sentence goes beyond its text: each text has a line feed behind it.
        opens = np.append(True, last[:-1])
        self._grow(len(hashes) + 1)
        found = []
        for a, b, begin in zip([0, *cuts], cuts, [0, *ends.tolist()]):
            first = np.flatnonzero(opens[a:b])
            found.append(Found(starts[a:b] - begin, first, *self._runs(hashes[a:b], first)))
        return found

    def _runs(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """The runs of one text, as in `Found`, given its words' hashes and its sentences' first words."""
        count = len(first)
        if not count:
            return (np.empty(0, np.int64),) * 5
        bounds = np.append(first, len(words))
        spans = [self._spans(bounds)]
        for few in (1, 2):
            at = np.flatnonzero(bounds[few:] - bounds[:-few] >= self.few_words)
            spans.append((at, at + few))
        codes = np.unique(np.concatenate([a * (count + 1) + b for a, b in spans]))
        at, to = codes // (count + 1), codes % (count + 1)
        free = np.arange(max(0, len(words) - self.passage_words + 1))
        # Where the run of sentences from each sentence on ends, if there is one.
        end = np.full(count + 1, len(words) + 1)
        end[spans[0][0]] = bounds[spans[0][1]]
        holds = end[np.searchsorted(bounds, free)] <= free + self.passage_words
        free = free[~holds & (words[free] != words[np.minimum(free + 1, len(words) - 1)])]
        places = np.concatenate([at, free])
        of_words = np.arange(len(places)) >= len(at)
        a = np.concatenate([bounds[at], free])
        b = np.concatenate([bounds[to], free + self.passage_words])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * self.powers[: len(words)], dtype=np.uint64)])
        # Runs of words are a kind of their own, for their places are of another kind.
        kind = (b - a).astype(np.uint64) + (of_words.astype(np.uint64) << np.uint64(63))
        hashes = mixed((sums[b] - sums[a]) * self.inverses[a] + kind).view(np.int64)
        return places, hashes, a, b, of_words

    def _spans(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First sentence, and the one behind the last, of the runs of `run` sentences."""
        count = len(bounds) - 1
        if count < self.run:
            whole = np.zeros(int(bounds[-1] >= self.run_words), np.int64)
            return whole, whole + count
        from_ = np.arange(count - self.run + 1)
        enough = np.searchsorted(bounds, bounds[from_] + self.run_words)
        to = np.maximum(from_ + self.run, enough)
        return from_[to <= count], to[to <= count]

    def _covered(self, one: Found, runs: np.ndarray) -> np.ndarray:
        """Which words lie in any of these runs."""
        change = np.zeros(len(one.starts) + 1, np.int64)
        np.add.at(change, one.run_at[runs], 1)
        np.add.at(change, one.run_to[runs], -1)
        return np.cumsum(change[:-1]) > 0

    def remove(self, text: str, places: list[int], hashes: list[int]) -> tuple[str, int, int, int]:
        """
        The text less the words of the runs at `places` that have these hashes, the number of its
        sentences, of those that lost a word, and of those that a run of sentences covers.
        """
        (one,) = self.find([text])
        wanted = set(zip(places, hashes))
        hit = np.array([run in wanted for run in zip(one.places.tolist(), one.hashes.tolist())], bool)
        if not hit.any():
            return text, len(one.sentences), 0, 0
        gone = self._covered(one, hit & ~one.of_words)
        in_spans = int(np.logical_or.reduceat(gone, one.sentences).sum())
        before = np.append(0, np.cumsum(gone))
        gone |= self._covered(one, hit & one.of_words & (before[one.run_to] == before[one.run_at]))
        raw = text.encode()
        # Stretches of words that stay or go as a whole.
        turns = np.flatnonzero(np.diff(gone)) + 1
        bounds = [0, *one.starts[turns].tolist(), len(raw)]
        outs = [bool(gone[0]), *gone[turns].tolist()]
        kept = b"".join(raw[a:b] for a, b, out in zip(bounds, bounds[1:], outs) if not out)
        return kept.decode(), len(one.sentences), int(np.logical_or.reduceat(gone, one.sentences).sum()), in_spans


def runs(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, digest, runs): place and hash of each of a whole text's runs."""
    source = documents.where(F.col(text).isNotNull()).select(
        "doc_id", F.xxhash64(text).alias("digest"), F.col(text).alias("text")
    )
    doc_type = source.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = Sentences()
        for batch in batches:
            for first, last, texts in text_portions(batch.column(2), PORTION):
                found = sentences.find(texts)
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(one.hashes) for one in found], out=offsets[1:])
                places, hashes = (pa.array(np.concatenate([one[i] for one in found])) for i in (2, 3))
                each = pa.StructArray.from_arrays([places, hashes], names=["place", "run"])
                lists = pa.ListArray.from_arrays(pa.array(offsets), each)
                columns = [*batch.slice(first, last - first).columns[:2], lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "runs"])

    return source.mapInArrow(hashed, f"doc_id {doc_type}, digest long, runs array<struct<place: long, run: long>>")


def later_runs(documents: DataFrame, text: str = "text") -> DataFrame:
    """
    (doc_id, digest, __places, __hashes): the runs of each text that are not the first of their
    kind. Rows may share a doc_id or have none, so the digest of the text tells them apart.
    """
    known = evaluated(runs(documents, text), "runs")
    each = known.select("doc_id", "digest", F.inline("runs"))
    counted = landed(each.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    hot = most_frequent(counted, "run")
    # Written, so that what follows reads few rows. Texts' runs of frequent kinds are not moved.
    often = counted.select("run")
    again = landed(join_by_key(each, often.hint("merge"), "run", hot), "again")
    names = ("doc_id", "digest", "place")
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), *[F.col(name) for name in names])
    first = landed(again.groupBy("run").agg(F.min(order).alias("first")), "first")
    firsts = landed(first.join(F.broadcast(hot.select("run")), "run"), "firsts")
    later = join_by_key(again, first.hint("merge"), "run", firsts).where(order != F.col("first"))
    # Equal rows have equal runs: made distinct first, so that a list is never longer than its text.
    later = later.select("doc_id", "digest", "place", "run").distinct()
    return later.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("place", "run")).alias("later")).select(
        "doc_id", "digest", F.col("later.place").alias("__places"), F.col("later.run").alias("__hashes")
    )


def without_repeats(documents: DataFrame, text: str = "text") -> DataFrame:
    """
    `documents` with repeated sentences taken out of `text`, and with `n_sentences` and
    `n_removed` and `n_in_spans` of each text. Rows and other columns stay as they are.
    """
    kept = [c for c in documents.columns if c not in ADDED]
    later = later_runs(documents, text).withColumnsRenamed({"doc_id": "__doc", "digest": "__digest"})
    # One plan for any size: left to itself Spark broadcasts a small table of runs.
    joined = documents.select(*kept).join(
        later.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__digest")),
        "left",
    ).select(*kept, "__places", "__hashes")
    fields = documents.select(*kept).schema.fields
    fields += [T.StructField(name, T.LongType()) for name in ADDED]
    names = [field.name for field in fields]
    at = kept.index(text)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = Sentences()
        for batch in batches:
            for first, last, texts in text_portions(batch.column(at), PORTION):
                part = batch.slice(first, last - first)
                places, hashes = (part.column(len(kept) + i).to_pylist() for i in (0, 1))
                counts = [len(one.sentences) for one in sentences.find([t or "" for t in texts])]
                rows = [
                    (t, n, 0, 0) if p is None or t is None else sentences.remove(t, p, h)
                    for t, n, p, h in zip(texts, counts, places, hashes)
                ]
                columns = part.columns[: len(kept)]
                columns[at] = pa.array([row[0] for row in rows], pa.string())
                columns += [pa.array([row[i] for row in rows], pa.int64()) for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(cleaned, T.StructType(fields))


def cleaned_documents(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` with repeated sentences removed, less those of which nothing is left."""
    clean = without_repeats(set_aside(documents, ADDED), text)
    left = clean.where((F.col("n_removed") == 0) | (F.trim(text) != ""))
    return put_back(left, documents.columns, ADDED)

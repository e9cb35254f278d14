"""
Token counts of texts of any length, with the tokenizers library's own vocabulary.

Short texts are counted whole. A huge one is cut into chunks that overlap, the chunks are
counted in different tasks, and neighbours are spliced where both cut the text alike:

- In a chunk a boundary between pieces is proven if it lies so far before the chunk's end
  that no piece or special string beginning before it can reach beyond that end. Pieces are
  found from left to right, so behind a true boundary every further one is true, too.
- A boundary of the next chunk need not be true, as that chunk may begin inside a piece. But
  what follows a boundary depends on the text behind it alone. So from the first position
  that is proven on the left and a boundary on the right, the right one's boundaries are true.

If an overlap holds no such position, both chunks are counted again with it made four times
as wide; an overlap as wide as a chunk joins the two chunks to one. So the loop ends, at the
latest with the whole text as one chunk.

A null text counts as empty. Each row is counted on its own, repeated doc_ids included.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from response_ledger.llm.batches import LONG_TEXT_ROWS, evaluated
from response_ledger.llm.splitting import Splitter, text_portions
from response_ledger.session import landed

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
WIDEN = 4
PORTION = 1 << 20
KEPT_PIECES = 150_000
# Pieces the library encodes at once; its results are large.
LIBRARY_PIECES = 2_048
# An ending behind an apostrophe has two letters; one more shows that a run is over.
LOOK_AHEAD = 4


class PieceCounter:
    """How many tokens the library makes of a piece; known pieces are kept."""

    def __init__(self, tokenizer_path: str, kept: int = KEPT_PIECES) -> None:
        # A task has one core; the library would start a thread, with memory of its own, for each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.splitter, self.kept = Splitter(), kept
        self.known: dict[str, int] = {}
        # The library looks for these before it cuts pieces; each is one token.
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.margin = LOOK_AHEAD + max(map(len, self.specials), default=0)

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) > self.kept:
            self.known.clear()
        new = list(pieces.difference(self.known))
        for i in range(0, len(new), LIBRARY_PIECES):
            some = new[i : i + LIBRARY_PIECES]
            self.known.update(zip(some, self._encoded(some)))

    def _encoded(self, pieces: list[str]) -> list:
        """What is kept of each piece's encoding."""
        return list(map(len, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)))

    def _sections(self, text: str) -> list[str]:
        """A text cut around special strings: what is between them, and they, in turns."""
        sections = [text]
        for special in self.specials:
            cut: list[str] = []
            for i, section in enumerate(sections):
                if i % 2:
                    cut.append(section)
                    continue
                for j, part in enumerate(section.split(special)):
                    cut.extend([special, part] if j else [part])
            sections = cut
        return sections

    def boundaries(self, text: str) -> tuple[list[int], list[int]]:
        """The starts of the pieces and special strings, and the tokens before each; ends included."""
        starts, before, at, tokens = [], [], 0, 0
        sections = self._sections(text)
        cut = self.splitter.pieces(sections[::2])
        self._learn(set().union(*cut))
        for i, section in enumerate(sections):
            pieces = [section] if i % 2 else cut[i // 2]
            for piece in pieces:
                starts.append(at)
                before.append(tokens)
                at += len(piece)
                tokens += 1 if i % 2 else self.known[piece]
        return [*starts, at], [*before, tokens]

    def counts(self, texts: list[str]) -> list[int]:
        """The tokens of whole texts."""
        sections = [self._sections(text) for text in texts]
        cut = self.splitter.pieces([part for one in sections for part in one[::2]])
        self._learn(set().union(*cut))
        place, counts = iter(cut), []
        for one in sections:
            plain = sum(sum(map(self.known.__getitem__, next(place))) for _ in one[::2])
            counts.append(plain + len(one) // 2)
        return counts


_CHUNK = "__row long, start long, stop long, overlap long, last boolean, text string"
_ENDS = (
    "__row long, start long, stop long, overlap long, last boolean, "
    "tokens long, head_at array<long>, head_before array<long>, tail_at array<long>, tail_before array<long>"
)


def cut_chunks(long_texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(__row, text) as chunks [start, stop + overlap) of the text; stop is the next one's start."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, text in zip(batch["__row"], batch["text"]):
                for start in range(0, len(text), chunk):
                    stop = min(start + chunk, len(text))
                    yield pd.DataFrame(
                        {
                            "__row": [row], "start": [start], "stop": [stop], "overlap": [overlap],
                            "last": [stop == len(text)], "text": [text[start : stop + overlap]],
                        }
                    )

    return long_texts.select("__row", "text").mapInPandas(cut, _CHUNK)


def encode_chunks(chunks: DataFrame, tokenizer_path: str) -> DataFrame:
    """
    Each chunk's tokens and, in positions of the whole text, the boundaries it may be spliced
    at: `head` within an overlap's width from its start, `tail` the proven ones from `stop` on.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = None
        for batch in batches:
            counter = counter or PieceCounter(tokenizer_path)  # not for a task without rows
            rows = []
            for one in batch.itertuples(index=False):
                at, before = counter.boundaries(one.text)
                places = [one.start + p for p in at]
                proven = one.start + len(one.text) - counter.margin
                head = [i for i, p in enumerate(places) if p < one.start + one.overlap]
                tail = [i for i, p in enumerate(places) if not one.last and one.stop <= p <= proven]
                rows.append(
                    (
                        one[0], one.start, one.stop, one.overlap, one.last, before[-1],
                        [places[i] for i in head], [before[i] for i in head],
                        [places[i] for i in tail], [before[i] for i in tail],
                    )
                )
            names = [field.split()[0] for field in _ENDS.split(", ")]
            yield pd.DataFrame(rows, columns=names)

    return chunks.mapInPandas(encode, _ENDS)


def splice(encoded: DataFrame) -> DataFrame:
    """
    Each chunk with `from_tokens`, its tokens before the splice to its predecessor, and
    `to_tokens`, those before the splice to its successor; null where none was found.

    Neighbours meet by an equi-join on (row, position), so a text of thousands of chunks is no
    hot key.
    """
    right = encoded.select(
        "__row", F.col("start").alias("stop"), F.col("head_at").alias("next_at"),
        F.col("head_before").alias("next_before"),
    )
    pairs = encoded.where(~F.col("last")).join(right, ["__row", "stop"])
    common = F.array_min(F.array_intersect("tail_at", "next_at"))
    seams = pairs.select(
        "__row", "start", "stop", common.alias("at"),
        F.get("tail_before", (F.array_position("tail_at", common) - 1).cast("int")).alias("to_tokens"),
        F.get("next_before", (F.array_position("next_at", common) - 1).cast("int")).alias("next_from"),
    )
    left = seams.select("__row", "start", "to_tokens")
    entered = seams.select("__row", F.col("stop").alias("start"), F.col("next_from").alias("from_tokens"))
    return (
        encoded.select("__row", "start", "stop", "overlap", "last", "tokens")
        .join(left, ["__row", "start"], "left")
        .join(entered, ["__row", "start"], "left")
        .withColumn("from_tokens", F.when(F.col("start") == 0, F.lit(0)).otherwise(F.col("from_tokens")))
        .withColumn("to_tokens", F.when(F.col("last"), F.col("tokens")).otherwise(F.col("to_tokens")))
    )


def widened(spliced: DataFrame, chunk: int) -> DataFrame:
    """
    New chunk ranges for the texts with a failed splice: (row, start, stop, overlap, last).

    Overlaps widen; where one would exceed a chunk, the two chunks become one instead. A text
    has at most 2 GB and so some ten thousand chunks: its window is small.
    """
    open_rows = spliced.where(F.col("to_tokens").isNull()).select("__row").distinct()
    by_start = Window.partitionBy("__row").orderBy("start")
    broken = spliced.join(open_rows, "__row", "left_semi").withColumn(
        "wide", F.max("overlap").over(Window.partitionBy("__row")) * WIDEN
    )
    joins = F.col("from_tokens").isNull() & (F.col("wide") > chunk)
    groups = broken.withColumn("part", F.sum(F.when(joins, 0).otherwise(1)).over(by_start))
    return groups.groupBy("__row", "part").agg(
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.max(F.least("wide", F.lit(chunk))).alias("overlap"),
        F.max("last").alias("last"),
    ).drop("part")


def count_long(long_texts: DataFrame, tokenizer_path: str, chunk: int, overlap: int) -> DataFrame:
    """(__row, text) of huge texts to (__row, n_tokens)."""
    if overlap > chunk:
        raise ValueError("an overlap can't be wider than a chunk")
    chunks = evaluated(cut_chunks(long_texts, chunk, overlap), "cut", LONG_TEXT_ROWS)
    # Without a number of partitions Spark joins small ones, as those of a later round.
    chunks = chunks.repartition("__row", "start")
    counted = None
    while True:
        spliced = landed(splice(evaluated(encode_chunks(chunks, tokenizer_path), "chunks", LONG_TEXT_ROWS)), "spliced")
        failed = spliced.where(F.col("to_tokens").isNull()).select("__row").distinct()
        sums = (
            spliced.join(failed, "__row", "left_anti").groupBy("__row")
            .agg(F.sum(F.col("to_tokens") - F.col("from_tokens")).alias("n_tokens"))
        )
        counted = sums if counted is None else counted.unionByName(sums)
        if failed.isEmpty():
            return counted
        ranges = landed(widened(spliced, chunk), "widened")
        again = long_texts.select("__row", "text").join(ranges, "__row")
        text = F.expr("substring(text, int(start + 1), int(stop + overlap - start))")
        chunks = again.select("__row", "start", "stop", "overlap", "last", text.alias("text"))
        chunks = chunks.repartition("__row", "start")


def count_tokens(
    documents: DataFrame,
    tokenizer_path: str,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    limit: int = 1024,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens and whether the tokens exceed `limit`."""
    whole = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.length("text") > chunk

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or PieceCounter(tokenizer_path)
            texts = text_portions(batch.column(2), PORTION)
            counts = [n for _, _, some in texts for n in counter.counts(some)]
            columns = [batch.column(0), batch.column(1), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    n_bytes = F.octet_length("text").cast("bigint").alias("n_bytes")
    doc_type = whole.schema["doc_id"].dataType.simpleString()
    short = whole.where(~is_long).select("doc_id", n_bytes, "text").mapInArrow(
        count, f"doc_id {doc_type}, n_bytes long, n_tokens long"
    )
    # Rows are told apart by number, written once, as doc_ids may repeat.
    long_texts = landed(
        whole.where(is_long).withColumn("__row", F.monotonically_increasing_id()), "long"
    )
    counted = count_long(long_texts, tokenizer_path, chunk, overlap)
    joined = long_texts.select("__row", "doc_id", n_bytes).join(counted, "__row")
    short = evaluated(short, "short")
    both = short.unionByName(joined.select("doc_id", "n_bytes", "n_tokens"))
    return both.withColumn("over_limit", F.col("n_tokens") > limit)

"""
Byte-level BPE, both ways.

Texts are cut into pieces by `splitting.Splitter` (no regular expression), each distinct
piece is merged once per task and kept, and a text's ids are the kept ids of its pieces.
With each id the end of its bytes in the text is returned, which decoding uses to place them.

A null text is read as empty. Rows stay as they are and in number: repeated rows are encoded
each. Input columns that have the name of an output column are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.llm.splitting import Splitter, text_portions

# Bytes of text worked on at once: bounds a task's memory, not what a text may have.
PORTION = 1 << 20
# Distinct pieces a task keeps; when full it starts anew.
KEPT_PIECES = 150_000
# From this length on a piece is merged with a queue, as scanning for the best pair is quadratic.
LONG_PIECE = 128


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: each token's bytes and its id, which is its merge rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PieceEncoder:
    """
    Merges pieces by rank; ids of known pieces are kept as packed 32-bit integers.

    New pieces of one length are merged side by side: a row per piece, in each round every
    row joins its first pair of lowest rank, and only the two pairs beside it are ranked anew.
    """

    def __init__(self, ranks: dict[bytes, int], kept: int = KEPT_PIECES) -> None:
        self.ranks, self.kept = ranks, kept
        self.known: dict[str, bytes] = {}
        self.of_byte = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.int64)
        # Every two tokens that join to a token, as one number each, sorted.
        pairs = {
            ranks[token[:i]] << 32 | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.none = max(ranks.values(), default=0) + 1
        # The last key is above any pair.
        self.pairs = np.array([*sorted(pairs), 1 << 62], np.int64)
        self.joined = np.array([*(pairs[p] for p in self.pairs[:-1].tolist()), self.none], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        place = self.pairs.searchsorted(wanted)
        return np.where(self.pairs[place] == wanted, self.joined[place], self.none)

    def _merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of pieces that all have the same length, two bytes at least."""
        size = len(pieces[0])
        ids = np.full((len(pieces), size + 1), -1, np.int64)
        ids[:, :size] = self.of_byte[
            np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), size)
        ]
        ranks = np.full((len(pieces), size + 1), self.none, np.int64)
        ranks[:, : size - 1] = self._rank(ids[:, : size - 1], ids[:, 1:size])
        # Places of the neighbours; place `size` stands for none on either side.
        after = np.tile(np.minimum(np.arange(1, size + 2), size), (len(pieces), 1))
        before = np.tile(np.r_[size, np.arange(size)], (len(pieces), 1))
        rows = np.arange(len(pieces))
        while len(rows):
            at = ranks[rows].argmin(1)
            best = ranks[rows, at]
            going = best < self.none
            rows, at, best = rows[going], at[going], best[going]
            gone = after[rows, at]
            follower, leader = after[rows, gone], before[rows, at]
            ids[rows, at], ids[rows, gone] = best, -1
            ranks[rows, gone] = self.none
            after[rows, at], before[rows, follower] = follower, at
            right, left = ids[rows, follower], ids[rows, leader]
            ranks[rows, at] = np.where(follower < size, self._rank(best, right), self.none)
            ranks[rows, leader] = np.where(leader < size, self._rank(left, best), self.none)
        alive = ids >= 0
        packed = ids[alive].astype("<u4").tobytes()
        ends = (np.cumsum(alive.sum(1)) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges from a queue of (rank, place); entries that no longer hold are skipped."""
        get, size = self.ranks.get, len(piece)
        after, before = list(range(1, size + 2)), list(range(-1, size))
        alive = [True] * size
        queue: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < size:
                end = after[after[i]]
                rank = get(piece[i:end])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, end))

        for i in range(size - 1):
            offer(i)
        while queue:
            _, i, end = heapq.heappop(queue)
            middle = after[i] if alive[i] else size
            if middle >= size or after[middle] != end:
                continue
            alive[middle] = False
            after[i] = end
            if end < size:
                before[end] = i
            offer(i)
            offer(before[i])
        return [i for i in range(size) if alive[i]] + [size]

    def _merge(self, pieces: list[str]) -> None:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            token = piece.encode()
            if token in self.ranks:
                self.known[piece] = self.ranks[token].to_bytes(4, "little")
            elif len(token) >= LONG_PIECE:
                cuts = self._merge_long(token)
                ids = [self.ranks[token[a:b]] for a, b in zip(cuts, cuts[1:])]
                self.known[piece] = np.array(ids, "<u4").tobytes()
            else:
                by_size.setdefault(len(token), []).append((piece, token))
        for group in by_size.values():
            names, tokens = zip(*group)
            self.known.update(zip(names, self._merge_rows(list(tokens))))

    def encode(self, pieces: list[str]) -> bytes:
        """The packed ids of the pieces, one after another."""
        return b"".join(map(self.known.__getitem__, pieces))

    def encode_texts(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The ids of each text, given its pieces."""
        if len(self.known) > self.kept:
            self.known.clear()
        self._merge(list(set().union(*texts).difference(self.known)))
        return [np.frombuffer(self.encode(pieces), "<u4") for pieces in texts]


class Vocabulary:
    """The bytes of every id, end to end, for decoding and for offsets."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of `ids`, which end at `ends`."""
        if not len(ids):
            return b""
        starts = ends - self.lengths[ids]
        shift = np.repeat(self.places[ids] - starts, self.lengths[ids])
        return self.bytes[shift + np.arange(ends[-1])].tobytes()


def list_array(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """An Arrow list column out of all its elements and the size of each list."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode_batches(batches: Iterator[pa.RecordBatch], ranks_path: str) -> Iterator[pa.RecordBatch]:
    """Batches whose last column is the text, with it replaced by `ids` and `byte_ends`."""
    ranks = read_ranks(ranks_path)
    splitter, encoder, lengths = Splitter(), PieceEncoder(ranks), Vocabulary(ranks).lengths
    for batch in batches:
        kept = batch.num_columns - 1
        names = [*batch.schema.names[:kept], "ids", "byte_ends"]
        for first, last, texts in text_portions(batch.column(kept), PORTION):
            ids = encoder.encode_texts(splitter.pieces(texts))
            ends = [np.cumsum(lengths[one]) for one in ids]
            sizes = np.array([len(one) for one in ids])
            columns = batch.slice(first, last - first).columns[:kept]
            columns += [list_array(np.concatenate(one), sizes) for one in (ids, ends)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def decode_batches(batches: Iterator[pa.RecordBatch], ranks_path: str) -> Iterator[pa.RecordBatch]:
    """Batches with `ids` and `byte_ends`, with `decoded` added."""
    vocabulary = Vocabulary(read_ranks(ranks_path))
    for batch in batches:
        ids, ends = (batch.column(batch.schema.get_field_index(c)) for c in ("ids", "byte_ends"))
        cuts = ids.offsets.to_numpy()
        flat, flat_ends = (one.values.to_numpy(zero_copy_only=False) for one in (ids, ends))
        texts = [vocabulary.decode(flat[a:b], flat_ends[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        names = [*batch.schema.names, "decoded"]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=names)


def _with_text_last(documents: DataFrame, text: str, added: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    kept = [c for c in documents.columns if c not in added]
    return documents.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text")), kept


_INTEGERS = T.ArrayType(T.IntegerType(), False)


def encode_documents(documents: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """
    `documents` with `ids`, the token ids of the whole text, and `byte_ends`, the end of each
    id's bytes in the text.
    """
    source, kept = _with_text_last(documents, text, ("ids", "byte_ends"))
    fields = documents.select(*kept).schema.fields
    fields += [T.StructField("ids", _INTEGERS), T.StructField("byte_ends", _INTEGERS)]
    return source.mapInArrow(lambda batches: encode_batches(batches, ranks_path), T.StructType(fields))


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """`encoded`, which has `ids` and `byte_ends`, with the text's bytes as `decoded`."""
    source = encoded.drop("decoded")
    fields = [*source.schema.fields, T.StructField("decoded", T.BinaryType())]
    return source.mapInArrow(lambda batches: decode_batches(batches, ranks_path), T.StructType(fields))


def round_trip(documents: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """
    `documents` less the text, with its `ids` and the bytes they were `decoded` to: both
    operators in one task, so that offsets never leave it.
    """
    source, kept = _with_text_last(documents, text, (text, "ids", "decoded"))
    fields = documents.select(*kept).schema.fields
    fields += [T.StructField("ids", _INTEGERS), T.StructField("decoded", T.BinaryType())]
    names = [field.name for field in fields]

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decode_batches(encode_batches(batches, ranks_path), ranks_path):
            yield batch.select(names)

    return source.mapInArrow(both, T.StructType(fields))


def digests(decoded: DataFrame) -> DataFrame:
    """Per document the number of its ids, and hashes of the ids and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

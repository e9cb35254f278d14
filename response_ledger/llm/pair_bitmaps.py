"""
Alignment of two tokenizers by inverted bitmaps of the id pairs that they link.

Every text is cut by both vocabularies; byte offsets where both cut make groups, and tokens whose
bytes overlap are linked. Documents are taken in blocks of at most `BLOCK_DOCS`. For each id pair
a block has a posting: bit planes over its documents, plane p holding those in which bit p of the
pair's number of links is set. A plane is compressed, as sorted 16-bit places while that is
shorter, else as a bitmap. OR-merged, a posting's planes are the bitmap of its documents; blocks
hold different documents, so a pair's documents are the population counts added over its
blocks, and its links those of the planes, each times 2^p. Those sums are Spark aggregates over
(a, b); no pair and no list of pairs is ever whole in the driver.

Scores go back the other way: postings meet their pair's score in a join, return to their
block, and a block adds the scores up over the documents that its planes name.

Texts are cut in units that begin with a space behind something else than white space. Neither
vocabulary has a token across such a place (for the second this is checked when it is read; else
texts are one unit), so tokens, groups and links of a unit are found once per task and kept.

Defined cases: null and empty texts, and those whose tokens' bytes are not those of a space and
the text, have no tokens: zeros and an empty digest. Rows are counted each, rows that repeat a
doc_id or have none included. Only doc_id and the text are read, so other columns clash with
nothing; texts are taken whole, however long; an empty table gives no rows. Ties for a B id's
greatest count are all best.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from response_ledger.llm.batches import TEXT_ROWS, evaluated
from response_ledger.llm.splitting import text_portions

# A block is closed with the text that brings it to so many documents or bytes.
BLOCK_DOCS = 4_096
BLOCK_BYTES = 8 << 20
PORTION = 1 << 20
# Units a task keeps, and the longest of them.
KEPT_UNITS, KEPT_CHARS = 300_000, 256
LIBRARY_UNITS = 2_048
# Units that the first library is given as one text.
JOINED_UNITS = 512
_PLACE_BITS = 12
_BITMAP_BYTES = BLOCK_DOCS // 8

_UNIT_ENDS = re.compile(r"(?<=\S)(?= +[^ ])")
_SIGN_BEFORE_SPACE = re.compile(r"[^\S ] ")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, the other way round."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def units_of(text: str) -> list[str]:
    """A space and the text, cut into units; each less the space that it begins with."""
    doubtful = text[:1].isspace() or text[-1:].isspace() or "  " in text or _SIGN_BEFORE_SPACE.search(text)
    if not doubtful:
        return text.split(" ")
    return [unit[1:] for unit in _UNIT_ENDS.split(" " + text)]


class TokenBytes:
    """The bytes of every id of a vocabulary, end to end."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(one) for one in tokens], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.places[ids] - (ends - sizes), sizes)
        return self.bytes[shift + np.arange(ends[-1] if len(ends) else 0)]


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, … of many ranges, one range after another."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Aligner:
    """Tokens, groups and links of texts under two vocabularies; known units are kept."""

    def __init__(self, a_path: str, b_path: str, kept: int = KEPT_UNITS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, self.kept = byte_letters(), kept
        tokens = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, one in self.a.get_vocab(with_added_tokens=True).items():
            known = all(letter in letters for letter in token)
            tokens[one] = bytes(letters[letter] for letter in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = TokenBytes(tokens)
        self.b_bytes = TokenBytes(
            [
                bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
                for i, piece in enumerate(pieces)
            ]
        )
        # Tokens that hold a space behind another sign would reach across units.
        self.cuts = not any("▁" in piece.lstrip("▁") for piece in pieces)
        self.b_size = len(pieces)
        names = [str(i) for i in range(max(len(tokens), len(pieces)))]
        self.names = pa.array([name + mark for mark in ",|;" for name in names], pa.binary())
        self.width = len(names)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.stats = np.empty((0, 4), np.int64)
        self.valid = np.empty(0, bool)
        self.first = np.empty(0, np.int64)
        self.codes = np.empty(0, np.int64)
        self.again = np.empty(0, bool)

    def _forget_rest(self) -> None:
        """Keep the units that came again since they were learned; if they are many, none."""
        kept = {unit: i for unit, i in self.index.items() if self.again[i]}
        if len(kept) > self.kept // 2:
            return self._forget()
        places = np.fromiter(kept.values(), np.int64, len(kept))
        many = self.stats[places, 3]
        self.index = dict(zip(kept, range(len(kept))))
        self.groups = [self.groups[i] for i in places.tolist()]
        self.codes = self.codes[ragged(self.first[places], many)]
        self.first = np.cumsum(many) - many
        self.stats, self.valid = self.stats[places], self.valid[places]
        self.again = np.zeros(len(kept), bool)

    def first_library(self, units: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """
        A's ids of all units, and their number by unit. Units that do not end in white space are cut
        the same in one text as alone, and one text is cut faster; their bytes tell them apart.
        """
        alone = [i for i, unit in enumerate(units) if not unit or unit[-1].isspace() or not self.cuts]
        wide = np.array([len(one) for one in raw])
        left = np.ones(len(units), bool)
        left[alone] = False
        whole, sizes = np.flatnonzero(left), np.zeros(len(units), np.int64)
        found: list[tuple[np.ndarray, list[int]]] = []
        for i in range(0, len(whole), JOINED_UNITS):
            some = whole[i : i + JOINED_UNITS]
            text = "".join([" " + units[k] for k in some.tolist()])
            ids = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends, stops = np.cumsum(self.a_bytes.lengths[ids]), np.cumsum(wide[some])
            last = np.minimum(np.searchsorted(ends, stops), len(ids) - 1)
            if len(ids) and ends[-1] == stops[-1] and (ends[last] == stops).all():
                sizes[some] = np.diff(last, prepend=-1)
                found.append((ids, some.tolist()))
            else:
                alone.extend(some.tolist())
        for i in range(0, len(alone), LIBRARY_UNITS):
            some = alone[i : i + LIBRARY_UNITS]
            cut = [one.ids for one in self.a.encode_batch_fast([" " + units[k] for k in some], add_special_tokens=False)]
            sizes[some] = [len(one) for one in cut]
            found.append((np.fromiter(chain.from_iterable(cut), np.int64, sum(map(len, cut))), some))
        ids, order = (np.concatenate([np.asarray(one[k], np.int64) for one in found]) for k in (0, 1))
        at = np.empty(len(units), np.int64)
        at[order] = np.cumsum(sizes[order]) - sizes[order]
        return ids[ragged(at, sizes)], sizes

    def second_library(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """B's ids of all units, and their number by unit; that library puts the space before itself."""
        found = list(chain.from_iterable(
            self.b.encode(units[i : i + LIBRARY_UNITS], num_threads=1) for i in range(0, len(units), LIBRARY_UNITS)
        ))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())), sizes

    def learn(self, units: list[str]) -> None:
        if units:
            self._add(units)

    def _add(self, units: list[str]) -> None:
        raw = [b" " + unit.encode() for unit in units]
        wide = np.array([len(one) for one in raw])
        flat, sizes = zip(self.first_library(units, raw), self.second_library(units))
        valid = np.ones(len(units), bool)
        owner = [np.repeat(np.arange(len(units)), n) for n in sizes]
        for side, ids, whose in zip((self.a_bytes, self.b_bytes), flat, owner):
            valid &= np.bincount(whose, side.lengths[ids], len(units)).astype(np.int64) == wide
        text = np.frombuffer(b"".join(one for one, good in zip(raw, valid) if good), np.uint8)
        for side, ids, whose in zip((self.a_bytes, self.b_bytes), flat, owner):
            own = np.repeat(np.flatnonzero(valid), wide[valid])
            wrong = side.joined(ids[valid[whose]])
            # Of units valid so far the lengths agree, so unequal bytes stand at their own unit.
            keep = valid[own]
            valid[own[(wrong != text) & keep]] = False
            if not valid[own].all():
                text = text[valid[own]]
        a_ids, b_ids = (ids[valid[whose]] for ids, whose in zip(flat, owner))
        stats, codes, groups = self._aligned(a_ids, b_ids, wide[valid])
        stats[:, 0], stats[:, 1] = sizes[0][valid], sizes[1][valid]
        whole = np.zeros((len(units), 4), np.int64)
        whole[valid] = stats
        held = len(self.codes)
        self.first = np.concatenate([self.first, held + np.cumsum(whole[:, 3]) - whole[:, 3]])
        self.codes = np.concatenate([self.codes, codes])
        self.stats = np.concatenate([self.stats, whole])
        self.valid = np.concatenate([self.valid, valid])
        self.again = np.concatenate([self.again, np.zeros(len(units), bool)])
        self.index.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        if valid.all():
            self.groups.extend(groups)
        else:
            named = iter(groups)
            self.groups.extend([next(named) if good else b"" for good in valid.tolist()])

    def _aligned(
        self, a: np.ndarray, b: np.ndarray, wide: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of units side by side: (…, n_groups, n_links) of each, all links, each one's groups."""
        total = int(wide.sum())
        ends = [np.cumsum(side.lengths[ids]) - 1 for side, ids in ((self.a_bytes, a), (self.b_bytes, b))]
        cut = np.zeros((2, total), bool)
        cut[0, ends[0]], cut[1, ends[1]] = True, True
        before = np.cumsum(cut, axis=1) - cut
        # Each stretch between two cuts of either side lies in one token of each.
        links = np.flatnonzero(cut[0] | cut[1])
        codes = a[before[0, links]] * self.b_size + b[before[1, links]]
        shared = np.flatnonzero(cut[0] & cut[1])
        unit_ends = np.cumsum(wide) - 1
        stats = np.zeros((len(wide), 4), np.int64)
        for column, places in ((2, shared), (3, links)):
            stats[:, column] = np.diff(np.searchsorted(places, unit_ends, "right"), prepend=0)
        # A group is its A ids, then its B ids; the last of each carries another mark.
        group = [np.searchsorted(shared, one) for one in ends]
        many = [np.bincount(one, minlength=len(shared)) for one in group]
        a_at = np.arange(len(a)) + (np.cumsum(many[1]) - many[1])[group[0]]
        b_at = np.arange(len(b)) + np.cumsum(many[0])[group[1]]
        names = np.empty(len(a) + len(b), np.int64)
        names[a_at], names[b_at] = a, b
        if len(shared):
            names[a_at[np.cumsum(many[0]) - 1]] += self.width
            names[b_at[np.cumsum(many[1]) - 1]] += 2 * self.width
        written = self.names.take(pa.array(names))
        offsets = np.frombuffer(written.buffers()[1], np.int32, len(names) + 1)
        data = written.buffers()[2].to_pybytes() if len(names) else b""
        last = np.searchsorted(shared, unit_ends)
        stops = offsets[np.cumsum(many[0] + many[1])[last]].tolist() if len(wide) else []
        return stats, codes, [data[i : j - 1] for i, j in zip([0, *stops], stops)]

    def _whole(self, text: str) -> bool:
        """Whether a text with a unit in doubt is right as a whole; it is learned as one unit then."""
        if text not in self.index:
            self.learn([text])
        return bool(self.valid[self.index[text]])

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """
        (n_a, n_b, n_groups, n_links) and the groups' digest of each text, and all links: the
        text's place and the pair's code.
        """
        cut = [(units_of(text) if self.cuts else [text]) if text else [] for text in texts]
        wanted = set().union(*cut)
        new = wanted.difference(self.index)
        if len(self.index) + len(new) > self.kept and self.index:
            self._forget_rest()
            new = wanted.difference(self.index)
        held = len(self.groups)
        self.learn(list(new))
        known = []
        for text, units in zip(texts, cut):
            places = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
            if not self.valid[places].all():
                places = np.array([self.index[text]] if self._whole(text) else [], np.int64)
            known.append(places)
        sizes = np.array([len(places) for places in known])
        flat = np.concatenate(known)
        self.again[flat[flat < held]] = True
        owner = np.repeat(np.arange(len(texts)), sizes)
        stats = np.zeros((len(texts), 4), np.int64)
        for column in range(4):
            stats[:, column] = np.bincount(owner, self.stats[flat, column], len(texts)).astype(np.int64)
        digests, at = [], 0
        for n in sizes.tolist():
            joined = b";".join(map(self.groups.__getitem__, flat[at : at + n].tolist()))
            digests.append(hashlib.sha256(joined).hexdigest() if n else "")
            at += n
        many = self.stats[flat, 3]
        places, codes = np.repeat(owner, many), self.codes[ragged(self.first[flat], many)]
        long = [unit for unit in {*wanted, *texts} if len(unit) > KEPT_CHARS and unit in self.index]
        for unit in long:
            self.groups[self.index.pop(unit)] = b""
        return stats, digests, places, codes


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the counts of equal ones added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def packed(containers: np.ndarray, places: np.ndarray, many: int) -> pa.Array:
    """`many` compressed bitmaps, from (container, place) of their bits, sorted."""
    sizes = np.bincount(containers, minlength=many)
    dense = sizes * 2 >= _BITMAP_BYTES
    lengths = np.where(dense, _BITMAP_BYTES, sizes * 2)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    data = np.zeros(offsets[-1], np.uint8)
    rank = np.arange(len(places)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = ~dense[containers]
    at = offsets[containers[sparse]] + 2 * rank[sparse]
    data[at], data[at + 1] = places[sparse] & 0xFF, places[sparse] >> 8
    whole = np.flatnonzero(dense)
    of_dense = np.cumsum(dense) - 1
    for first in range(0, len(whole), 1024):
        some = whole[first : first + 1024]
        bits = np.zeros((len(some), BLOCK_DOCS), bool)
        mine = dense[containers] & (containers >= some[0]) & (containers <= some[-1])
        bits[of_dense[containers[mine]] - first, places[mine]] = True
        data[offsets[some][:, None] + np.arange(_BITMAP_BYTES)] = np.packbits(bits, axis=1, bitorder="little")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), many, buffers)


def unpacked(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(container, place) of all bits of compressed bitmaps."""
    if not len(bitmaps):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    buffer = bitmaps.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    offsets = offsets.astype(np.int64)
    lengths = np.diff(offsets)
    dense = lengths == _BITMAP_BYTES
    sparse = np.flatnonzero(~dense)
    at = ragged(offsets[sparse], lengths[sparse])
    low, high = data[at[0::2]].astype(np.int64), data[at[1::2]].astype(np.int64)
    whole = np.flatnonzero(dense)
    rows = data[offsets[whole][:, None] + np.arange(_BITMAP_BYTES)]
    row, place = np.nonzero(np.unpackbits(rows, axis=1, bitorder="little"))
    return (
        np.concatenate([np.repeat(sparse, lengths[sparse] // 2), whole[row]]),
        np.concatenate([low | high << 8, place]),
    )


class Block:
    """The documents of a block so far, and how often each holds each pair."""

    def __init__(self, number: int) -> None:
        self.number, self.docs, self.bytes = number, 0, 0
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, stats: np.ndarray, places: np.ndarray, codes: np.ndarray, size: int) -> None:
        keys = codes << _PLACE_BITS | (self.docs + places)
        keys, counts = counted(keys, np.ones(len(keys), np.int64))
        self.keys, self.counts = counted(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        self.docs += len(stats)
        self.bytes += size

    def postings(self, b_size: int) -> pa.RecordBatch:
        codes, places = self.keys >> _PLACE_BITS, self.keys & (BLOCK_DOCS - 1)
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        pair = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(codes)))
        most = np.maximum.reduceat(self.counts, starts) if len(starts) else self.counts
        planes = np.floor(np.log2(np.maximum(most, 1))).astype(np.int64) + 1
        base = np.concatenate([[0], np.cumsum(planes)])
        containers, bits = [], []
        for plane in range(int(planes.max(initial=0))):
            held = np.flatnonzero(self.counts >> plane & 1)
            containers.append(base[pair[held]] + plane)
            bits.append(places[held])
        containers, bits = (np.concatenate(one) if one else np.empty(0, np.int64) for one in (containers, bits))
        order = np.lexsort((bits, containers))
        lists = pa.ListArray.from_arrays(
            pa.array(base.astype(np.int32)), packed(containers[order], bits[order], int(base[-1]))
        )
        a, b = np.divmod(codes[starts], b_size)
        columns = {
            "block": np.full(len(starts), self.number), "a": a, "b": b, "planes": lists,
            "docs": np.diff(starts, append=len(codes)),
            "links": np.add.reduceat(self.counts, starts) if len(starts) else self.counts,
        }
        return _filled(columns, len(starts))


_ROWS = {
    "block": pa.int64(), "place": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
    "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "a": pa.int32(), "b": pa.int32(),
    "docs": pa.int64(), "links": pa.int64(), "planes": pa.list_(pa.binary()),
}
_SCHEMA = (
    "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, docs long, links long, planes array<binary>"
)


def _filled(columns: dict, rows: int) -> pa.RecordBatch:
    """A batch of all columns of the written table; those not given are null."""
    arrays = [
        columns[name] if isinstance(columns.get(name), pa.Array)
        else pa.array(columns[name], kind) if name in columns else pa.nulls(rows, kind)
        for name, kind in _ROWS.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(_ROWS))


def inverted(documents: DataFrame, a_path: str, b_path: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """
    The documents (block, place, doc_id, n_a, n_b, n_groups, n_links, groups_sha256) and the
    postings (block, a, b, docs, links, planes), written once, so that a row's place is settled.
    """
    source = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            aligner = aligner or Aligner(a_path, b_path)
            for first, last, texts in text_portions(batch.column(1), PORTION):
                # Batches have fewer rows than a block; one that would not fit begins the next.
                if block.docs and (block.docs + last - first > BLOCK_DOCS or block.bytes >= BLOCK_BYTES):
                    yield block.postings(aligner.b_size)
                    number += 1
                    block = Block(number)
                stats, digests, places, codes = aligner.align([one or "" for one in texts])
                columns = {
                    "block": np.full(last - first, number), "place": np.arange(block.docs, block.docs + last - first),
                    "doc_id": batch.column(0).slice(first, last - first), "n_a": stats[:, 0], "n_b": stats[:, 1],
                    "n_groups": stats[:, 2], "n_links": stats[:, 3], "groups_sha256": digests,
                }
                yield _filled(columns, last - first)
                block.add(stats, places, codes, sum(map(len, filter(None, texts))))
        if block.docs:
            yield block.postings(aligner.b_size)

    written = evaluated(source.mapInArrow(blocks, _SCHEMA), "alignment", TEXT_ROWS)
    names = ["block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    return (
        written.where(F.col("a").isNull()).select(*names),
        written.where(F.col("a").isNotNull()).select("block", "a", "b", "docs", "links", "planes"),
    )


def pair_scores(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, count, best): a pair's documents and links, and whether no pair of b has more."""
    pairs = postings.groupBy("a", "b").agg(F.sum("docs").alias("n_docs"), F.sum("links").alias("count"))
    # One row per id of the second vocabulary at most, so its size does not grow with the texts.
    most = F.broadcast(pairs.groupBy("b").agg(F.max("count").alias("most")))
    return pairs.join(most, "b").select("a", "b", "n_docs", "count", (F.col("count") == F.col("most")).alias("best"))


def returned(postings: DataFrame, scores: DataFrame) -> DataFrame:
    """(block, place, n_best, count_sum): a pair's score, added up over the documents of its planes."""
    scored = postings.join(scores.select("a", "b", "count", "best"), ["a", "b"])
    dealt = scored.select("block", "planes", "count", "best").repartition("block").sortWithinPartitions("block")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros((2, BLOCK_DOCS), np.int64)

        def done() -> Iterator[pa.RecordBatch]:
            places = np.flatnonzero(sums[1])
            columns = [np.full(len(places), now), places, sums[0, places], sums[1, places]]
            arrays = [pa.array(one, kind) for one, kind in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "place", "n_best", "count_sum"])

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
                if first == last:
                    continue
                if now is not None and blocks[first] != now:
                    yield from done()
                    sums[:] = 0
                now = int(blocks[first])
                part = batch.slice(first, last - first)
                planes = part.column("planes")
                containers, places = unpacked(planes.flatten())
                many = np.asarray(planes.value_lengths()).astype(np.int64)
                row = np.repeat(np.arange(last - first), many)
                plane = ragged(np.zeros(len(many), np.int64), many)
                links = np.int64(1) << plane[containers]
                count = part.column("count").to_numpy()[row[containers]]
                best = part.column("best").to_numpy(zero_copy_only=False)[row[containers]]
                np.add.at(sums[0], places[best], links[best])
                np.add.at(sums[1], places, links * count)
        if now is not None:
            yield from done()

    return dealt.mapInArrow(added, "block long, place int, n_best long, count_sum long")


def align(documents: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Per document its tokens, groups and links under both vocabularies, and its links' scores."""
    rows, postings = inverted(documents, a_path, b_path, text)
    scores = returned(postings, pair_scores(postings))
    zero = F.lit(0).cast("bigint")
    return rows.join(scores, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )

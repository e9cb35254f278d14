"""
Token ids in compressed binary segments: an adaptive context-mixing range coder.

Every id is coded with one probability, mixed out of three predictions: the id that followed the
last two ids before (order 2), the one that followed the last id (order 1), and the
adaptive frequencies of id ranges (order 0). The shares of the three adapt in the context of how
sure the first two were of late; an id that order 1 or 2 foretells has their shares, any other
one its part of what is left to order 0. All numbers are integers, so a reader on any machine repeats
the writer's steps.

Ids are cut into blocks of `BLOCK` ids, each coded from a fresh start and with a checksum. As
blocks do not depend on each other, those of many segments are coded side by side, a column
of numpy operations per position.

A segment is one binary value: whole documents, in order, and the blocks of their ids.
Segments are stored as rows of a Parquet table (`shard`, `segment`, `start`, `n_docs`,
`n_tokens`, `payload`), so that Spark's commit protocol guards them and any store will do.

Layout of a payload, little-endian:
magic "MXRC", documents u32, ids u64, blocks u32, size of the index u32;
the index, deflated: per document a flag whether it has an id u8, then doc_id i64, then ids u32;
per block: ids u32, bytes u32, crc32 of the bytes u32; the blocks' bytes.

Defined cases: a null text has the end id alone; rows that share a doc_id are stored each, the
lesser text first; rows without doc_id come first; an empty table gives no rows; other columns are
not read, so their names clash with nothing.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from response_ledger.llm.batches import TEXT_ROWS, evaluated
from response_ledger.llm.resync_counts import LIBRARY_PIECES, PieceCounter
from response_ledger.llm.splitting import portions

MAGIC = b"MXRC"
BLOCK = 4_096
# A segment is closed with the document that brings it to so many ids.
SEGMENT = 1 << 18
# Blocks coded side by side, and at most half as many more.
LANES = 2_048
# Bytes of text whose units are looked up at once.
PORTION = 1 << 23
END_ID = 0
# Units whose ids are put together at once.
GATHERED = 1 << 17
# Units a task keeps the ids of, and the longest that the library is given whole.
KEPT_UNITS, LONGEST_UNIT = 800_000, 4_096
# Characters by which texts of one doc_id are told apart when they are dealt to shards.
ORDERED_CHARS = 64
# Units that the library gets as one text, and how many.
_WORD_UNIT, JOINED_UNITS = r"^ [^\s]+$", 64

_TOTAL_BITS = 28
_TOTAL = 1 << _TOTAL_BITS
# Orders 1 and 2 share a table, so that a lane's next ids lie side by side: a line has a cell for order 1 and more for order 2.
_LINES, _CELLS = 1 << 9, 4
_SURE = 4
# What order 0 is left is dealt to id ranges in slots, anew after `_DEALT` ids and, at first, sooner; it counts
# the ids of `_STRIDE` positions at once.
_SLOT_BITS = 9
_SLOTS_0 = 1 << _SLOT_BITS
_DEALT, _STRIDE, _SOONER = 256, 128, (8, 16, 32, 64)
_STEP_0, _MOST_0 = 2, 1 << 10
# Shares move by 1 / 2 ** _RATE of the way, in 16 bits.
_RATE = 5


def ranges() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id ranges of order 0: range of each id, first id and log2 width of each range."""
    first, bits = list(range(0, 256, 32)), [5] * 8
    for octave in range(8, 16):
        for quarter in range(4):
            first.append((1 << octave) + (quarter << (octave - 2)))
            bits.append(octave - 2)
    of_id = np.repeat(np.arange(len(first)), [1 << b for b in bits])
    return of_id.astype(np.int64), np.array(first, np.int32), np.array(bits, np.int32)


_RANGE, _FIRST, _BITS = ranges()
_N_RANGES = len(_FIRST)
_COLUMNS = _N_RANGES + 1

_FULL = (1 << 16 >> _RATE) - 1
# What the shares of orders 1 (high half) and 2 are credited: nobody, 1, 2 or both were right.
_CREDIT = np.array([0, _FULL << 16, _FULL, _FULL >> 1 << 16 | _FULL >> 1], np.uint32)
_FADE, _HALF = np.uint32(_FULL << 16 | _FULL), np.uint32(0xFFFF)
_AT_FIRST = np.uint32(13_000 << 16 | 26_000)
# A sixteenth at least is left to order 0.
_SHARE = np.int32((_TOTAL >> 16) - (_TOTAL >> 20))


def _mix(one: np.ndarray, other: np.ndarray, mask: np.ndarray) -> None:
    """Puts `other` into `one` where the mask has all bits."""
    one ^= (one ^ other) & mask


def _mask(flags: np.ndarray) -> np.ndarray:
    return -flags.astype(np.int32)


def _sections(longest: int) -> list[tuple[int, int, bool]]:
    """Positions between which order 0 stays as it is, and whether it is dealt out anew before."""
    cuts = [0, *(t for t in _SOONER if t < longest), *range(_STRIDE, longest, _STRIDE), longest]
    return [(a, b, a <= _STRIDE or a % _DEALT == 0) for a, b in zip(cuts, cuts[1:])] if longest else []


class Model:
    """The state of many blocks, one per lane; lanes only ever end from the back."""

    def __init__(self, lanes: int) -> None:
        self.lane = np.arange(lanes)
        # An id that followed, and in the low two bits how sure that is.
        self.table = np.empty(lanes * _LINES * _CELLS, np.int32)
        self.table.fill(0)
        # Per lane and context, in the halves: the shares of orders 1 and 2.
        self.mix = np.full(lanes * _SURE * _SURE, _AT_FIRST)
        self.counts = np.ones((lanes, _N_RANGES), np.int32)
        self.total_0 = _N_RANGES

    def live(self, lanes: int) -> None:
        """Only the first `lanes` go on."""
        lane = self.lane[:lanes]
        self.base, self.base_mix = lane * (_LINES * _CELLS), lane * (_SURE * _SURE)

    def learn(self, kinds: np.ndarray) -> None:
        """Order 0 counts some positions' id ranges, those of live lanes."""
        lanes = kinds.shape[1]
        counts = self.counts[:lanes]
        at = (kinds + self.lane[:lanes] * _N_RANGES).reshape(-1)
        counts += np.bincount(at, minlength=counts.size).reshape(counts.shape).astype(np.int32) * _STEP_0
        self.total_0 += _STEP_0 * len(kinds)
        if self.total_0 > _MOST_0:
            counts += 1
            counts >>= 1
            self.total_0 >>= 1

    def deal(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """The first slot of each lane's ranges, and how many slots each has; one at least."""
        below = np.zeros((lanes, _COLUMNS), np.int32)
        np.cumsum(self.counts[:lanes], axis=1, out=below[:, 1:])
        total = below[:, -1:].copy()
        below *= _SLOTS_0 - _N_RANGES
        below //= total
        below += np.arange(_COLUMNS, dtype=np.int32)
        return below[:, :-1], np.diff(below, axis=1)

    def lines(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells of order 1 and 2 behind the last id `one` and the one before, `two`; products may wrap."""
        mixed = one * 40503
        at_1 = (mixed >> 4 & _LINES - 1) * _CELLS + self.base[: one.shape[-1]]
        mixed += two * 90033
        return at_1, np.maximum(mixed >> 9 & _CELLS - 1, 1) + at_1

    def predict(self, at_1: np.ndarray, at_2: np.ndarray) -> None:
        """The two predicted ids and the three shares, given the cells."""
        self.at_1, self.at_2 = at_1, at_2
        self.cell_1, self.cell_2 = self.table.take(at_1), self.table.take(at_2)
        self.guess_1, self.guess_2 = self.cell_1 >> 2, self.cell_2 >> 2
        self.trust_1, self.trust_2 = self.cell_1 & 3, self.cell_2 & 3
        self.context = self.trust_2 * _SURE + self.trust_1 + self.base_mix
        self.mixed = self.mix.take(self.context)
        self.share_1 = (self.mixed >> 16).view(np.int32) * _SHARE
        share_2 = (self.mixed & _HALF).view(np.int32) * _SHARE
        self.shares = self.share_1 + share_2
        self.unit = (_TOTAL - self.shares) >> _SLOT_BITS
        # The same guess twice is one with both shares.
        self.share_1 += share_2 & _mask(self.guess_1 == self.guess_2)

    def place(self, ids: np.ndarray, slot: np.ndarray, slots: np.ndarray, bits: np.ndarray, offset: np.ndarray):
        """Where the mixture puts ids: below, and width."""
        width = slots * self.unit >> bits
        below = slot * self.unit
        below += offset * width
        below += self.shares
        self.hit_1, self.hit_2 = _mask(ids == self.guess_1), _mask(ids == self.guess_2)
        self.settle(below, width, self.hit_1, self.hit_2)
        return below, width

    def settle(self, below: np.ndarray, width: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        """Places of predicted ids instead of those of order 0: order 1's id first, then order 2's, then the rest."""
        _mix(below, self.share_1, second)
        _mix(width, self.shares - self.share_1, second)
        below &= ~first
        _mix(width, self.share_1, first)

    def find(self, value: np.ndarray, kinds: np.ndarray, dealt: np.ndarray, rows: list[np.ndarray]):
        """The ids whose places hold the values, and their places."""
        rest = value - self.shares
        level = (np.maximum(rest, 0) / self.unit).astype(np.int64)
        level += rows[0]
        kind = kinds.take(level).astype(np.int64)
        at = dealt.take(kind + rows[1])
        width = (at & 1023) * self.unit >> _BITS.take(kind)
        below = (at >> 10) * self.unit
        offset = ((rest - below) / width).astype(np.int32)
        below += offset * width
        below += self.shares
        ids = _FIRST.take(kind) + offset
        first, second = (value - self.share_1) >> 31, rest >> 31
        _mix(ids, self.guess_2, second)
        _mix(ids, self.guess_1, first)
        self.settle(below, width, first, second)
        self.hit_1, self.hit_2 = first, _mask(ids == self.guess_2)
        return ids, below, width

    def update(self, ids: np.ndarray) -> None:
        mixed = self.mixed
        mixed -= mixed >> _RATE & _FADE
        mixed += _CREDIT.take(-(self.hit_1 + self.hit_2 + self.hit_2))
        self.mix[self.context] = mixed
        fresh = ids << 2
        for at, cell, trust, hit in (
            (self.at_1, self.cell_1, self.trust_1, self.hit_1),
            (self.at_2, self.cell_2, self.trust_2, self.hit_2),
        ):
            # A hit is all trust; each miss takes some, and the last one the place.
            sure = hit & 3
            trust |= sure
            trust -= 1
            trust >>= 31
            cell |= sure
            cell += ~hit
            _mix(cell, fresh, trust)
            self.table[at] = cell


_WORD, _LEAST = 16, 1 << 32
_WIDE = (1 << 48) - 1
_TILE = 64


def _by_lane(table: np.ndarray) -> Iterator[np.ndarray]:
    """A table's columns, read some side by side as they lie."""
    for i in range(0, table.shape[1], _TILE):
        yield from np.ascontiguousarray(table[:, i : i + _TILE].T)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block's bytes."""
    if not blocks:
        return []
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    longest, step = int(sizes.max(initial=0)), len(blocks)
    # Two positions before the first stand for what went before: ids 0.
    ids = np.zeros((longest + 2, step), np.uint16)
    for lane in range(0, step, _TILE):
        some = np.zeros((_TILE, longest), np.uint16)
        for one, i in zip(some, order[lane : lane + _TILE]):
            one[: len(blocks[i])] = blocks[i]
        ids[2:, lane : lane + _TILE] = some[: step - lane].T
    model = Model(step)
    low, wide = np.zeros(step, np.int64), np.full(step, _WIDE)
    # A word's carry stays above its 16 bits until the end; words of one place stand side by side.
    words, place = np.zeros((longest * 2 + 8) * step, np.int32), np.arange(step)
    living = np.searchsorted(-sizes, -np.arange(longest), "left").tolist()
    for first, last, anew in _sections(longest):
        lanes = living[first]
        model.live(lanes)
        if first:
            model.learn(kinds[:, :lanes])
        some = ids[first : last + 2, :lanes].astype(np.int32)
        at_1, at_2 = model.lines(some[1:-1], some[:-2])
        now = some[2:]
        kinds = _RANGE.take(now)
        at = kinds + np.arange(lanes) * _N_RANGES
        if anew:
            dealt = [np.ascontiguousarray(one).reshape(-1) for one in model.deal(lanes)]
        slot, slots = (one.take(at) for one in dealt)
        bits, offset = _BITS.take(kinds), now - _FIRST.take(kinds)
        for k in range(last - first):
            if living[first + k] < lanes:
                lanes = living[first + k]
                model.live(lanes)
            model.predict(at_1[k, :lanes], at_2[k, :lanes])
            below, width = model.place(
                now[k, :lanes], slot[k, :lanes], slots[k, :lanes], bits[k, :lanes], offset[k, :lanes]
            )
            part_low, part_wide, part = low[:lanes], wide[:lanes], place[:lanes]
            unit = part_wide >> _TOTAL_BITS
            part_low += unit * below
            np.multiply(unit, width, out=part_wide)
            top = part_low >> 32
            words[part] = top
            short = (part_wide < _LEAST).astype(np.int64)
            part += short * step
            # What was written leaves `low`.
            top *= short
            top <<= 32
            part_low -= top
            short <<= 4
            part_low <<= short
            part_wide <<= short
            again = np.flatnonzero(part_wide < _LEAST)
            while len(again):
                words[part[again]] = part_low[again] >> 32
                part[again] += step
                part_low[again] = (part_low[again] & _LEAST - 1) << _WORD
                part_wide[again] <<= _WORD
                again = again[part_wide[again] < _LEAST]
            model.update(now[k, :lanes])
    for _ in range(3):
        words[place] = low >> 32
        place += step
        low = (low & _LEAST - 1) << _WORD
    words = words[: int((place // step).max()) * step]
    over = np.flatnonzero(words >> _WORD)
    while len(over):
        words[over] &= (1 << _WORD) - 1
        over -= step
        words[over] += 1
        over = over[words[over] >> _WORD > 0]
    found: list[bytes] = [b""] * step
    for i, one, end in zip(order, _by_lane(words.reshape(-1, step)), (place // step).tolist()):
        found[i] = one[:end].astype("<u2").tobytes()
    return found


def decode_blocks(blocks: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block, given how many it has."""
    if not blocks:
        return []
    order = sorted(range(len(blocks)), key=lambda i: -sizes[i])
    counts = np.array([sizes[i] for i in order])
    longest, step = int(counts.max(initial=0)), len(blocks)
    words = np.zeros((max((len(b) // 2 for b in blocks), default=0) + 8, step), np.uint16)
    for lane in range(0, step, _TILE):
        some = np.zeros((_TILE, len(words)), np.uint16)
        for one, i in zip(some, order[lane : lane + _TILE]):
            one[: len(blocks[i]) // 2] = np.frombuffer(blocks[i], "<u2")
        words[:, lane : lane + _TILE] = some[: step - lane].T
    code = np.zeros(step, np.int64)
    for k in range(3):
        code = code << _WORD | words[k]
    words, place = words.reshape(-1), np.arange(step) + 3 * step
    model = Model(step)
    wide = np.full(step, _WIDE)
    ids = np.zeros((longest, step), np.uint16)
    one = two = np.zeros(step, np.int32)
    living = np.searchsorted(-counts, -np.arange(longest), "left").tolist()
    names = np.tile(np.arange(_N_RANGES, dtype=np.uint8), step)
    start = 0
    for first, last, anew in _sections(longest):
        lanes = living[first]
        model.live(lanes)
        if first:
            model.learn(_RANGE.take(ids[start:first, :lanes]))
        start = first
        if anew:
            slot, slots = model.deal(lanes)
            kinds = np.repeat(names[: slots.size], slots.reshape(-1))
            dealt = (slot << 10 | slots).reshape(-1)
        rows = [np.arange(lanes) * _SLOTS_0, np.arange(lanes) * _N_RANGES]
        for t in range(first, last):
            if living[t] < lanes:
                lanes = living[t]
                model.live(lanes)
                rows = [one[:lanes] for one in rows]
            one, two = one[:lanes], two[:lanes]
            model.predict(*model.lines(one, two))
            part_code, part_wide, part = code[:lanes], wide[:lanes], place[:lanes]
            unit = part_wide >> _TOTAL_BITS
            # Exact, as both are below 2 ** 48.
            value = (part_code / unit).astype(np.int32)
            now, below, width = model.find(value, kinds, dealt, rows)
            ids[t, :lanes] = now
            part_code -= unit * below
            np.multiply(unit, width, out=part_wide)
            short = (part_wide < _LEAST).astype(np.int64)
            by = short << 4
            part_code <<= by
            part_wide <<= by
            part_code += words.take(part) & -short
            part += short * step
            again = np.flatnonzero(part_wide < _LEAST)
            while len(again):
                part_code[again] = part_code[again] << _WORD | words[part[again]]
                part_wide[again] <<= _WORD
                part[again] += step
                again = again[part_wide[again] < _LEAST]
            model.update(now)
            one, two = now, one
    found = [np.empty(0, np.uint16)] * step
    for i, one in zip(order, _by_lane(ids)):
        found[i] = one[: sizes[i]]
    return found


def cut(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]


def pack(doc_ids: list[int | None], sizes: list[int], blocks: list[bytes], counts: list[int]) -> bytes:
    """A segment's payload."""
    index = zlib.compress(
        np.array([d is not None for d in doc_ids], np.uint8).tobytes()
        + np.array([d or 0 for d in doc_ids], "<i8").tobytes()
        + np.array(sizes, "<u4").tobytes()
    )
    head = struct.pack("<4sIQII", MAGIC, len(doc_ids), sum(sizes), len(blocks), len(index))
    directory = b"".join(struct.pack("<III", n, len(b), zlib.crc32(b)) for b, n in zip(blocks, counts))
    return b"".join([head, index, directory, *blocks])


def unpack(payload: bytes) -> tuple[list[int | None], list[int], list[bytes], list[int]]:
    """What `pack` was given; a damaged payload is an error."""
    magic, docs, total, n_blocks, size = struct.unpack_from("<4sIQII", payload)
    if magic != MAGIC:
        raise ValueError("this is no segment of token ids")
    at = struct.calcsize("<4sIQII")
    index = zlib.decompress(payload[at : at + size])
    known = np.frombuffer(index, np.uint8, docs)
    doc_ids = np.frombuffer(index, "<i8", docs, docs).tolist()
    sizes = np.frombuffer(index, "<u4", docs, docs * 9).tolist()
    at += size
    directory = [struct.unpack_from("<III", payload, at + 12 * i) for i in range(n_blocks)]
    at += 12 * n_blocks
    blocks = []
    for _, length, check in directory:
        blocks.append(payload[at : at + length])
        at += length
        if zlib.crc32(blocks[-1]) != check:
            raise ValueError("a block of token ids is damaged")
    counts = [n for n, _, _ in directory]
    if sum(counts) != total or sum(sizes) != total or at != len(payload):
        raise ValueError("a segment of token ids is cut off")
    return [d if k else None for d, k in zip(doc_ids, known.tolist())], sizes, blocks, counts


def _byte_marks() -> tuple[np.ndarray, np.ndarray]:
    """For each byte, in bits, the cuts it may stand left and right of; see `unit_starts`."""
    left, right = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    signs, white = np.arange(0x21, 0x7F), [*range(0x09, 0x0E), 0x20]
    letters = np.array([byte for byte in signs if chr(byte).isalpha()])
    marks = np.array([byte for byte in signs if not chr(byte).isalnum()])
    # First bytes of signs beyond ASCII; the four left out begin white space as well.
    begin = np.array([*signs, *(byte for byte in range(0xC3, 0xF5) if byte not in (0xE1, 0xE2, 0xE3))])
    left[signs] |= 1
    right[white] |= 1
    left[letters] |= 2
    right[marks] |= 2
    left[white[:-1]] |= 4
    right[begin] |= 4
    left[white] |= 8
    right[begin] |= 8
    return left, right


_LEFT, _RIGHT = _byte_marks()


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where units begin in the UTF-8 of texts, which begin at `bounds`."""
    cuts = _LEFT.take(data[:-1]) & _RIGHT.take(data[1:])
    # What ends one text and what begins the next are no neighbours.
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    cuts[inner - 1] = 0
    found = np.zeros(len(data), bool)
    found[1:] = cuts & 7 > 0
    # The last white space ahead of a sign, which a space joins.
    found[:-1] |= cuts & 8 > 0
    found[bounds[bounds < len(data)]] = True
    return np.flatnonzero(found)


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of these sizes, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    places = np.arange(int(ends[-1]) if len(ends) else 0)
    places += np.repeat(first - ends + sizes, sizes)
    return places


class LibraryEncoder(PieceCounter):
    """
    The library's ids of texts; ids of known units are kept.

    Texts are cut to units where the library cuts pieces, whatever stands around: between a sign
    and white space, before and behind the last white space (a space joins what follows) ahead of
    a sign, and between a letter and a punctuation mark. No piece reaches across, and what a piece is
    depends on nothing beyond: only the ends of white space are found by looking ahead.
    """

    def __init__(self, tokenizer_path: str, kept: int = KEPT_UNITS) -> None:
        super().__init__(tokenizer_path, kept)
        # A letter of a token stands for a byte.
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, one in self.tokenizer.get_vocab().items():
            self.widths[one] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.units = pa.array([], pa.large_string())
        self.first, self.sizes = np.empty(0, np.int32), np.empty(0, np.int32)
        self.store, self.again = np.empty(0, np.uint16), np.empty(0, bool)

    def _forget_rest(self) -> None:
        """Keep the units that came again since they were learned; if they are many, none."""
        places = np.flatnonzero(self.again)
        if len(places) > self.kept // 2:
            return self._forget()
        units, sizes = self.units.take(pa.array(places)), self.sizes[places]
        store = self.store[_ragged(self.first[places], sizes)]
        self._forget()
        self._keep(units, sizes, store)

    def _keep(self, units: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.units = pa.concat_arrays([self.units, units])
        self.store = np.concatenate([self.store, ids])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.first = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        self.again = np.concatenate([self.again, np.zeros(len(units), bool)])

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _alone(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, and their number by unit."""
        alone = self._library(units.to_pylist())
        sizes = np.fromiter(map(len, alone), np.int64, len(alone))
        return np.fromiter(chain.from_iterable(alone), np.uint16, int(sizes.sum())), sizes

    def _together(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of units of a space and signs, joined as one text is cut faster than many."""
        cuts = np.append(np.arange(0, len(units), JOINED_UNITS, np.int32), np.int32(len(units)))
        lists = pa.ListArray.from_arrays(pa.array(cuts), units)
        texts = pc.binary_join(lists, pa.scalar("", pa.large_string())).to_pylist()
        ids = np.array(list(chain.from_iterable(self._library(texts))), np.uint16)
        ends, stops = np.cumsum(self.widths[ids]), np.cumsum(pc.binary_length(units).to_numpy())
        last = np.searchsorted(ends, stops)
        # Tokens that reach across units, if a vocabulary has any, are no units' own.
        if len(ids) and ends[-1] == stops[-1] and (ends[last] == stops).all():
            return ids, np.diff(last, prepend=-1)
        return self._alone(units)

    def _pieces(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of long units; what the library makes of much text at once takes much memory."""
        parts, sizes = [], []
        for unit in units.to_pylist():
            pieces = pa.array(self.splitter.pieces([unit])[0], pa.large_string())
            some = [self._alone(pieces.slice(i, LIBRARY_PIECES))[0] for i in range(0, len(pieces), LIBRARY_PIECES)]
            sizes.append(sum(map(len, some)))
            parts += some
        return np.concatenate(parts), np.array(sizes)

    def _learn(self, units: pa.Array) -> np.ndarray:
        """New units' ids are kept; in which order the units are."""
        is_long = pc.greater(pc.binary_length(units), LONGEST_UNIT).to_numpy(zero_copy_only=False)
        is_word = pc.match_substring_regex(units, _WORD_UNIT).to_numpy(zero_copy_only=False) & ~is_long
        kinds = [np.flatnonzero(kind) for kind in (is_word, ~is_word & ~is_long, is_long)]
        order = np.concatenate(kinds)
        units, found = units.take(pa.array(order)), []
        start = 0
        for kind, encode in zip(kinds, (self._together, self._alone, self._pieces)):
            for i in range(start, start + len(kind), LIBRARY_PIECES):
                found.append(encode(units.slice(i, min(LIBRARY_PIECES, start + len(kind) - i))))
            start += len(kind)
        ids, sizes = (np.concatenate([one[k] for one in found]) for k in (0, 1))
        self._keep(units, sizes, ids)
        return order

    def _places(self, units: pa.Array) -> np.ndarray:
        """Where the ids of distinct units are kept."""
        if len(self.units) > self.kept:
            self._forget_rest()
        held = len(self.units)
        places = pc.fill_null(pc.index_in(units, value_set=self.units), -1).to_numpy().copy()
        new = np.flatnonzero(places < 0)
        self.again[places[places >= 0]] = True
        if len(new):
            order = self._learn(units.take(pa.array(new)))
            places[new[order]] = np.arange(held, held + len(new))
        return places

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts without special strings."""
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if not len(texts) or bounds[0] == bounds[-1]:
            return [np.empty(0, np.uint16)] * len(texts)
        data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        starts = unit_starts(data, bounds)
        ends = pa.py_buffer(np.append(starts, len(data)))
        units = pa.LargeStringArray.from_buffers(len(starts), ends, pa.py_buffer(data)).dictionary_encode()
        places = self._places(units.dictionary)
        places = places[units.indices.to_numpy()]
        sizes = self.sizes[places]
        ids = np.concatenate(
            [
                self.store[_ragged(self.first[places[i : i + GATHERED]], sizes[i : i + GATHERED])]
                for i in range(0, len(places), GATHERED)
            ]
        )
        before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(before.tolist(), before[1:].tolist())]

    def _cut_up(self, text: str) -> np.ndarray:
        """Ids of a text with special strings."""
        sections = self._sections(text)
        plain = iter(self._plain(pa.array(sections[::2], pa.large_string())))
        special = (np.array([self.tokenizer.token_to_id(one)], np.uint16) for one in sections[1::2])
        return np.concatenate([next(special if i % 2 else plain) for i in range(len(sections))])

    def ids(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Each text's ids and the end id."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        marked = np.zeros(len(column), bool)
        for special in self.specials:
            marked |= pc.match_substring(column, special).to_numpy(zero_copy_only=False)
        plain = iter(self._plain(column.filter(pa.array(~marked)) if marked.any() else column))
        end = np.array([END_ID], np.uint16)
        return [
            np.concatenate([self._cut_up(column[i].as_py()) if odd else next(plain), end])
            for i, odd in enumerate(marked.tolist())
        ]


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The two columns of batches in portions of about `PORTION` bytes of text."""
    waiting, held = [], 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_pylist()
        for first, last in portions(sizes, PORTION):
            waiting.append(batch.slice(first, last - first))
            held += sum(sizes[first:last])
            if held >= PORTION:
                yield tuple(pa.concat_arrays([one.column(k) for one in waiting]) for k in (0, 1))
                waiting, held = [], 0
    if waiting:
        yield tuple(pa.concat_arrays([one.column(k) for one in waiting]) for k in (0, 1))


def _segments(documents: Iterator[tuple[int | None, np.ndarray]]) -> Iterator[tuple[list, list]]:
    """Whole documents in segments: (doc_ids, ids of each)."""
    doc_ids, ids, held = [], [], 0
    for doc_id, one in documents:
        doc_ids.append(doc_id)
        ids.append(one)
        held += len(one)
        if held >= SEGMENT:
            yield doc_ids, ids
            doc_ids, ids, held = [], [], 0
    if doc_ids:
        yield doc_ids, ids


def _groups(segments: Iterator[tuple], blocks: int) -> Iterator[list[tuple]]:
    """Segments, whose blocks stand at place `blocks`, in groups of about `LANES` blocks, or what is left."""
    waiting: list[tuple] = []
    held = 0
    for one in segments:
        waiting.append(one)
        held += len(one[blocks])
        if held > LANES + LANES // 2:
            group, taken = [], 0
            while taken < LANES:
                group.append(waiting.pop(0))
                taken += len(group[-1][blocks])
            held -= taken
            yield group
    if waiting:
        yield waiting


def _coded(segments: Iterator[tuple[list, list]]) -> Iterator[tuple[list, list, list, list]]:
    """Segments with their blocks coded, those of several segments side by side."""
    ready = ((doc_ids, [len(one) for one in ids], cut(np.concatenate(ids))) for doc_ids, ids in segments)
    for group in _groups(ready, 2):
        done = iter(encode_blocks([block for _, _, blocks in group for block in blocks]))
        for doc_ids, sizes, blocks in group:
            yield doc_ids, sizes, [next(done) for _ in blocks], [len(block) for block in blocks]


def shards(documents: DataFrame) -> int:
    """
    A fourth of the shuffle partitions, but one a core where there are as many: units and lanes
    cost the less the more text a task has.
    """
    spark = documents.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(most // 4, min(most, spark.sparkContext.defaultParallelism))


def write_tokens(documents: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """
    The segments of all documents in ascending doc_id order, written to the scratch folder and
    read back: (shard, segment, start, n_docs, n_tokens, payload), `start` counted in the shard.

    The texts are range-partitioned by doc_id and how they begin, so that rows without doc_id or of
    the same one are no hot key, and sorted; a partition is a shard.
    """
    source = documents.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    begin = F.substring("text", 1, ORDERED_CHARS)
    ordered = source.repartitionByRange(shards(documents), "doc_id", begin).sortWithinPartitions("doc_id", "text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = LibraryEncoder(tokenizer_path), TaskContext.get().partitionId()

        def each() -> Iterator[tuple[int | None, np.ndarray]]:
            for doc_ids, texts in _portions(batches):
                yield from zip(doc_ids.to_pylist(), encoder.ids(texts))

        start = 0
        for i, (doc_ids, sizes, blocks, counts) in enumerate(_coded(_segments(each()))):
            row = [shard, i, start, len(doc_ids), sum(sizes), pack(doc_ids, sizes, blocks, counts)]
            start += sum(sizes)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            columns = [pa.array([value], kind) for value, kind in zip(row, kinds)]
            names = ["shard", "segment", "start", "n_docs", "n_tokens", "payload"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "shard int, segment int, start long, n_docs int, n_tokens long, payload binary"
    return evaluated(ordered.mapInArrow(encoded, schema), "tokens", TEXT_ROWS)


def read_tokens(segments: DataFrame, with_ids: bool = True) -> DataFrame:
    """
    Each stored document: doc_id, `start` (ids of all documents before it), n_tokens, the crc32
    of its ids as 32-bit integers, and, if asked for, the `ids`.
    """
    sums = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, and there are as many as shuffle partitions.
    bases = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = "shard int, doc_id long, place long, n_tokens long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stored() -> Iterator[tuple]:
            for batch in batches:
                for shard, start, payload in zip(*batch.columns):
                    yield shard.as_py(), start.as_py(), *unpack(payload.as_py())

        for group in _groups(stored(), 4):
            done = iter(
                decode_blocks([block for one in group for block in one[4]], [n for one in group for n in one[5]])
            )
            for shard, start, doc_ids, sizes, blocks, _ in group:
                ids = np.concatenate([next(done) for _ in blocks]).astype("<u4")
                ends = np.cumsum(sizes)
                parts = [ids[end - size : end] for end, size in zip(ends, sizes)]
                columns = [
                    pa.array([shard] * len(doc_ids), pa.int32()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(start + ends - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(part) for part in parts], pa.int64()),
                ]
                if with_ids:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                names = ["shard", "doc_id", "place", "n_tokens", "ids_crc32", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = segments.select("shard", "start", "payload").mapInArrow(decoded, schema)
    extra = ["ids"] if with_ids else []
    return rows.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *extra
    )

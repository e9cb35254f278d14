"""
Pre-tokenisation without regular expressions: where the pieces of byte-level BPE begin.

Every code point gets a class, a little look-ahead folded in. Over these classes a
finite automaton with eight states decides where a piece begins. The automaton's steps are
functions from state to state, and composing functions is associative, so the states of all
positions come from a blocked scan: compose the functions of each block, carry the state
from block to block, then replay all blocks side by side.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The code points Unicode calls White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
)
# The endings that follow an apostrophe in one piece with it.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

# Letters and numbers of Unicode 16, which the tokenizer libraries know but
# Python's tables may not yet.
NEWER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEWER_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)

# Beyond stands no letter or number.
_ASSIGNED = 0x33480
_SENTINEL = 0x110000

LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_ON, SPACE_JOINS, SPACE_ENDS, END = range(9)
IN_LETTERS, IN_NUMBERS, IN_OTHERS, PENDING, IN_SPACE, ONE_MORE, TWO_MORE, FRESH = range(8)
_STATES = 8


def code_point_classes() -> np.ndarray:
    """The class of every code point; white space is `SPACE_ON` until its successor is known."""
    table = np.full(_SENTINEL + 1, OTHER, np.uint8)
    major = {"L": LETTER, "N": NUMBER}
    table[:_ASSIGNED] = [major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(_ASSIGNED)]
    for kind, ranges in ((LETTER, NEWER_LETTERS), (NUMBER, NEWER_NUMBERS)):
        for first, last in ranges:
            table[first : last + 1] = kind
    table[list(WHITE_SPACE)] = SPACE_ON
    table[_SENTINEL] = END
    return table


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """For (state, class): the next state, and whether a piece begins at that code point."""
    step = np.empty((_STATES, 9), np.uint8)
    begins = np.ones((_STATES, 9), bool)
    for kind, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        step[:, kind] = state
        begins[[state, PENDING], kind] = False
    # An ending belongs to its apostrophe, the letter behind it begins anew.
    step[ONE_MORE], begins[ONE_MORE] = FRESH, False
    step[TWO_MORE], begins[TWO_MORE] = ONE_MORE, False
    for kind, state in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        step[:, kind] = state
        # Behind other signs or a space that joins, an apostrophe is one more sign.
        step[[IN_OTHERS, PENDING], kind] = IN_OTHERS
        begins[[IN_OTHERS, PENDING], kind] = False
    # White space runs on; its last sign before a word stands alone, or joins the word if a space.
    step[:, SPACE_ON] = IN_SPACE
    begins[IN_SPACE, SPACE_ON] = False
    step[:, SPACE_JOINS], step[:, SPACE_ENDS] = PENDING, FRESH
    step[:, END] = FRESH
    return step, begins


class Splitter:
    """Finds the pieces of texts; holds the tables, so make one per task."""

    def __init__(self, columns: int = 256) -> None:
        self.columns = columns
        self.classes = code_point_classes()
        self.step, self.begins = automaton()
        # All functions the classes' steps can compose to, and their composition table.
        functions = [tuple(int(x) for x in self.step[:, k]) for k in range(9)]
        functions.insert(0, tuple(range(_STATES)))
        index = {f: i for i, f in reversed(list(enumerate(functions)))}
        known = list(functions)
        for f in known:
            for g in functions:
                h = tuple(g[s] for s in f)
                if h not in index:
                    index[h] = len(known)
                    known.append(h)
        # Flat look-up tables; what is looked up next is stored times the width of its table.
        self.identity = 0
        self.apply = np.array(known, np.uint8)
        self.compose = np.array([[index[tuple(g[s] for s in f)] for g in known] for f in known], np.intp)
        by_class = [index[f] for f in functions[1:]]
        self.append_class = (self.compose[:, by_class] * 9).reshape(-1)
        self.step_flat = (self.step.astype(np.intp) * 9).reshape(-1)
        self.begins_flat = self.begins.reshape(-1)

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        """Classes with look-ahead; `codes` ends in a sentinel."""
        kinds = self.classes[codes]
        spaces = np.flatnonzero(kinds == SPACE_ON)
        after = kinds[np.minimum(spaces + 1, len(codes) - 1)]
        last = spaces[(after != SPACE_ON) & (after != END)]
        kinds[last] = np.where(codes[last] == 0x20, SPACE_JOINS, SPACE_ENDS)
        quotes = np.flatnonzero(codes[:-1] == 0x27)
        if len(quotes):
            one = codes[quotes + 1]
            two = codes[np.minimum(quotes + 2, len(codes) - 1)]
            short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
            long = np.zeros(len(quotes), bool)
            for a, b in LONG_ENDINGS:
                long |= (one == ord(a)) & (two == ord(b))
            kinds[quotes[short]] = SHORT
            kinds[quotes[long]] = LONG
        return kinds

    def _entering(self, totals: np.ndarray) -> np.ndarray:
        """The state before each block, from the composed function of each: the same scan again."""
        if len(totals) <= self.columns:
            states = np.empty(len(totals), np.uint8)
            state = FRESH
            for i, f in enumerate(totals):
                states[i] = state
                state = self.apply[f, state]
            return states
        rows = -(-len(totals) // self.columns)
        padded = np.full(rows * self.columns, self.identity, np.intp)
        padded[: len(totals)] = totals
        blocks = np.ascontiguousarray(padded.reshape(rows, self.columns).T)
        running = np.full(rows, self.identity, np.intp)
        for block in blocks:
            running = self.compose[running, block]
        state = self._entering(running)
        states = np.empty((self.columns, rows), np.uint8)
        for j, block in enumerate(blocks):
            states[j] = state
            state = self.apply[block, state]
        return states.T.reshape(-1)[: len(totals)]

    def starts(self, codes: np.ndarray) -> np.ndarray:
        """The positions in `codes` (ending in a sentinel) at which a piece, or a sentinel, stands."""
        kinds = self._kinds(codes)
        rows = -(-len(kinds) // self.columns)
        padded = np.full(rows * self.columns, END, np.uint8)
        padded[: len(kinds)] = kinds
        blocks = np.ascontiguousarray(padded.reshape(rows, self.columns).T)
        totals = np.full(rows, self.identity, np.intp)
        for block in blocks:
            totals = self.append_class.take(totals + block, mode="clip")
        state = self._entering(totals // 9).astype(np.intp) * 9
        found = np.empty((self.columns, rows), bool)
        for j, block in enumerate(blocks):
            place = state + block
            self.begins_flat.take(place, out=found[j], mode="clip")
            state = self.step_flat.take(place, mode="clip")
        return np.flatnonzero(found.T.reshape(-1)[: len(kinds)])

    def split(self, texts: list[str]) -> list[list[int]]:
        """For each text the starts of its pieces, in code points, and its length at the end."""
        sizes = np.array([len(t) + 1 for t in texts])
        codes = np.full(sizes.sum(), _SENTINEL, np.uint32)
        ends = np.cumsum(sizes)
        for text, end, size in zip(texts, ends, sizes):
            codes[end - size : end - 1] = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = self.starts(codes)
        cuts = np.searchsorted(starts, ends)
        offsets = ends - sizes
        return [
            (starts[a:b] - offset).tolist()
            for a, b, offset in zip([0, *cuts[:-1]], cuts, offsets)
        ]

    def pieces(self, texts: list[str]) -> list[list[str]]:
        """The pieces of each text, in order; joined they are the text."""
        return [
            [text[a:b] for a, b in zip(bounds, bounds[1:])]
            for text, bounds in zip(texts, self.split(texts))
        ]


def portions(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges of consecutive texts of about `most` in size together, one text at least."""
    cuts, held = [0], 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            cuts.append(i)
            held = 0
        held += size + 1
    return list(zip(cuts, [*cuts[1:], len(sizes)])) if sizes else []


def text_portions(texts: pa.Array, most: int) -> Iterator[tuple[int, int, list[str]]]:
    """A column's texts in portions of about `most` bytes, so that few are Python strings at a time."""
    for first, last in portions(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most):
        yield first, last, texts.slice(first, last - first).to_pylist()

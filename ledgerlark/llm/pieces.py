"""Pieces of texts that tokenizers treat alone, and a table of what was made of each distinct one.

A tokenizer's work on a piece does not depend on its neighbours if pieces end where no token can
reach across. Texts repeat their pieces, so a task makes each distinct piece once and looks up the
others by a 64-bit hash of its bytes; hits are compared with the kept bytes, and pieces beyond
SHORT bytes are made anew each time. Everything per piece is numpy on the bytes of Arrow columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from ledgerlark.llm.words import mix

SHORT, KEYED = 48, 23
#: Bytes that leave room for their number in 64 bits, and the masks of the first bytes of 64 bits.
_FITS = 7
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)

_byte = np.arange(256)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_LETTER = ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122))
_SIGN = (_byte > 32) & (_byte < 127) & ~_DIGIT & ~_LETTER & (_byte != 39)


def _shifted(data: np.ndarray, by: int) -> np.ndarray:
    """The byte `by` places earlier, 0 before the first."""
    out = np.zeros_like(data)
    out[by:] = data[:-by] if len(data) > by else data[:0]
    return out


def after_no_space(data: np.ndarray) -> np.ndarray:
    """Places whose character before is surely no white space (in doubt False)."""
    return _no_space(*(_shifted(data, k) for k in (1, 2, 3, 4)))


def _no_space(one: np.ndarray, two: np.ndarray, three: np.ndarray, four: np.ndarray) -> np.ndarray:
    """The same, from the bytes one to four places earlier."""
    doubtful = (one <= 0x8A) | (one == 0x9F) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)
    plain = (one > 0x20) & (one < 0x7F)
    double = (one >= 0x80) & (two >= 0xC3) & (two < 0xE0)
    triple = (one >= 0x80) & (two >= 0x80) & (two < 0xC0) & (three >= 0xE0) & (three < 0xF0)
    triple &= ~(((three >= 0xE1) & (three <= 0xE3)) & doubtful)
    return plain | double | triple | ((one >= 0x80) & (two >= 0x80) & (three >= 0x80) & (four >= 0xF0))


def _pairs() -> np.ndarray:
    """For two bytes in a row (the first one low): 1 for a border of `word_pieces` between them, 2 where earlier bytes tell."""
    before, here = _byte[None, :], _byte[:, None]
    cut = _LETTER[before] & (here < 128) & ~_LETTER[here]
    cut |= _DIGIT[before] & (here < 128) & ~_DIGIT[here]
    cut |= _SIGN[before] & (_LETTER[here] | _DIGIT[here])
    cut |= (here == 0x20) & (before > 0x20) & (before < 0x7F)
    return np.where((before >= 0x80) & (here < 128) & ~_LETTER[here], 2, cut).astype(np.uint8).reshape(-1)


_PAIRS = _pairs()


def blank_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of pieces that end before a blank behind a character that is no space."""
    cut = (data == 0x20) & after_no_space(data)
    return _between(cut, offsets)


def word_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of finer pieces, for tokenizers that split texts by `'s|...| ?\\p{L}+| ?\\p{N}+| ?other+|\\s+`.

    Besides `blank_pieces`' borders, these are borders in all of that pattern's matches: from a letter to
    an ASCII sign that is none, from an ASCII digit to another ASCII sign, and from a sign to a letter
    or digit, but not behind an apostrophe or a blank.
    """
    if len(data) < 2:
        return _between(np.zeros(len(data), bool), offsets)
    pairs = _PAIRS.take(np.ndarray(len(data) - 1, "<u2", data.tobytes(), strides=(1,)))
    cut = np.zeros(len(data), bool)
    cut[1:] = pairs == 1
    # Behind a byte of a longer character, the bytes before it tell.
    doubtful = np.flatnonzero(pairs == 2) + 1
    one, two = data[doubtful - 1], data[np.maximum(doubtful - 2, 0)]
    letter = (two == 0xC3) & (one != 0x97) & (one != 0xB7) & (doubtful > 1)
    cut[doubtful[letter]] = True
    blank = doubtful[data[doubtful] == 0x20]
    near = np.maximum(blank[:, None] + np.arange(-4, 0), 0)
    around = np.where(blank[:, None] + np.arange(-4, 0) < 0, 0, data[near]).astype(np.uint8)
    cut[blank] |= _no_space(*around.T[::-1])
    return _between(cut, offsets)


def _between(cut: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(cut):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut[offsets[:-1][offsets[:-1] < len(cut)]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(cut))
    return start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))


class Ragged:
    """Rows of numbers of one type, one row after the other."""

    def __init__(self, dtype):
        self.values, self.used = np.zeros(1 << 16, dtype), 0

    def add(self, values: np.ndarray) -> int:
        """Appends and returns where the new values begin."""
        first, self.used = self.used, self.used + len(values)
        if self.used > len(self.values):
            grown = np.zeros(2 * self.used, self.values.dtype)
            grown[:first] = self.values[:first]
            self.values = grown
        self.values[first : self.used] = values
        return first


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start[i] : start[i] + size[i]] of all i, one after the other."""
    total = int(size.sum())
    if not total:
        return values[:0]
    begins = np.cumsum(size) - size
    return values[np.repeat(start - begins, size) + np.arange(total)]


class PieceTable:
    """Numbers of pieces in a table that `add` extends by rows for pieces not met before.

    `add(texts)` is called with lists of bytes and must append one row for each of them.
    `clear()` is called when the table holds more than `limit` rows; rows are counted anew then.

    Pieces of up to KEYED bytes are found by numpy in an open table of slots. A mark names a piece: its
    bytes and length, where these fit in 64 bits, else a hash, and then its bytes are compared too.
    Longer pieces are found in a dict.
    """

    def __init__(self, add: Callable[[list[bytes]], None], clear: Callable[[], None], limit: int):
        self.add, self.clear, self.limit = add, clear, limit
        self._empty()

    def _empty(self) -> None:
        self.rows, self.held = 0, 0
        self.long: dict[bytes, int] = {}
        self.slots = np.full(1 << 16, -1, np.int64)
        self.marks, self.bytes = np.zeros(1 << 15, np.uint64), np.zeros((1 << 15, 3), np.uint64)

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The row of each piece data[start : end]."""
        if self.rows > self.limit:
            self._empty()
            self.clear()
        raw, size = data.tobytes(), end - start
        out = np.zeros(len(start), np.int64)
        short = size <= KEYED
        chosen = np.flatnonzero(short)
        marks, content = _marks(raw, start[chosen], size[chosen])
        rows, new = self._find(marks, content, size[chosen]), []
        lost = np.flatnonzero(rows < 0)
        if len(lost):
            # Among the lost ones, the first of each; pieces whose marks meet by chance are told apart by their bytes.
            order = lost[np.lexsort((lost, *content[lost].T, marks[lost]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (marks[order[1:]] != marks[order[:-1]]) | (content[order[1:]] != content[order[:-1]]).any(axis=1)
            rows[order] = self.rows + np.cumsum(fresh) - 1
            first = order[fresh]
            new = [raw[a:b] for a, b in zip(start[chosen[first]].tolist(), end[chosen[first]].tolist(), strict=True)]
            self._keep(marks[first], content[first])
        out[chosen] = rows
        own: dict[bytes, int] = {}
        for k in np.flatnonzero(~short).tolist():
            text = raw[start[k] : end[k]]
            kept = self.long if len(text) <= SHORT else own
            if text not in kept:
                kept[text] = self.rows + len(new)
                new.append(text)
            out[k] = kept[text]
        self._extend(new)
        return out

    def _slot(self, marks: np.ndarray) -> np.ndarray:
        return (marks * _ODD >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _find(self, marks: np.ndarray, content: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The rows of pieces, -1 where there is none."""
        at, last = self._slot(marks), len(self.slots) - 1
        rows = self.slots.take(at)
        other = (self.marks.take(rows, mode="clip") != marks) & (rows >= 0)
        hashed = np.flatnonzero((size > _FITS) & (rows >= 0))
        other[hashed] |= (self.bytes[rows[hashed]] != content[hashed]).any(axis=1)
        left = np.flatnonzero(other)
        while len(left):
            at[left] = (at[left] + 1) & last
            held = self.slots[at[left]]
            rows[left] = held
            left = left[(held >= 0) & ((self.marks[held] != marks[left]) | (self.bytes[held] != content[left]).any(axis=1))]
        return rows

    def _keep(self, marks: np.ndarray, content: np.ndarray) -> None:
        """Gives the next rows to pieces that are not there."""
        rows = self.rows + np.arange(len(marks))
        need = self.rows + len(marks)
        if need > len(self.marks):
            self.marks = np.concatenate([self.marks[: self.rows], np.zeros(2 * need - self.rows, np.uint64)])
            self.bytes = np.concatenate([self.bytes[: self.rows], np.zeros((2 * need - self.rows, 3), np.uint64)])
        self.marks[rows], self.bytes[rows] = marks, content
        self.held += len(marks)
        if 2 * self.held > len(self.slots):
            old = self.slots[self.slots >= 0]
            self.slots = np.full(1 << (2 * self.held).bit_length(), -1, np.int64)
            self._place(old)
        self._place(rows)

    def _place(self, rows: np.ndarray) -> None:
        at, last = self._slot(self.marks[rows]), len(self.slots) - 1
        while len(rows):
            free = self.slots[at] < 0
            self.slots[at[free]] = rows[free]
            left = self.slots[at] != rows
            rows, at = rows[left], (at[left] + 1) & last

    def _extend(self, new: Sequence[bytes], step: int = 20_000) -> None:
        for low in range(0, len(new), step):
            self.add(new[low : low + step])
        self.rows += len(new)


def _marks(raw: bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a mark of each piece, its bytes in three numbers), for pieces of at most KEYED bytes."""
    eight = np.ndarray(len(raw) + 17, "<u8", raw + bytes(24), strides=(1,))
    content = np.zeros((len(start), 3), np.uint64)
    content[:, 0] = eight[start] & _FIRST[np.minimum(size, 8)]
    marks = content[:, 0] | size.astype(np.uint64) << np.uint64(56)
    more = np.flatnonzero(size > _FITS)
    begin, length = start[more], size[more]
    two = eight[begin + 8] & _FIRST[np.clip(length - 8, 0, 8)]
    three = eight[begin + 16] & _FIRST[np.clip(length - 16, 0, 8)]
    three |= length.astype(np.uint64) << np.uint64(56)
    content[more, 1], content[more, 2] = two, three
    marks[more] = mix(mix(mix(content[more, 0]) + two) + three) | np.uint64(1 << 63)
    return marks, content

"""An adaptive context-mixing range coder for token ids, over many lanes at a time.

A block is up to BLOCK ids with a model of its own that starts afresh, so blocks decode
independently. It is cut into lanes, runs of about STEPS ids that are range-coded apart; numpy codes
the t-th id of all lanes in one go. The lanes share the block's model: it predicts the t-th ids from
all ids before them in their lanes and then learns from all of the t-th ids. Each id is predicted in
three orders:

* order 2: the id that last followed the two ids before it; order 1: the one that last followed the
  id before it. The chance that either is right mixes two adaptive estimates, one without context and
  one in the context of both predictions' confidence.
* order 0: how often each of the block's different ids has occurred so far.

As in prediction by partial matching, order 0 learns from every id that reaches it and not from
those that a higher order has predicted.

Ranges are whole numbers below 2 ** 48 held as 64-bit floats, which numpy computes on many at a time.
Sums, products and shifts of them are exact, and a quotient is too far from the next whole number to be
rounded up to it, so encoder and decoder agree on any machine.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1 << 22
STEPS = 512
_WORD, _LEAST, _MOST = float(1 << 16), float(1 << 32), float(1 << 48)
#: Chances of predictions are shares of 1 << 12.
_BITS = 12
_WHOLE = 1 << _BITS
_SHARE = 1.0 / _WHOLE
#: Order 2 has this many slots at most; counts take effect after this many steps.
_SLOTS, _EACH = 1 << 17, 16
_MAGIC, _VERSION = b"LLTK", 3
_HEAD = struct.Struct("<4sBIIQ")
_BLOCK = struct.Struct("<IIIIII")


class Damaged(ValueError):
    """A block or segment whose checksum does not fit its content."""


class _Encoder:
    """The interval of every lane: its lower end, its size, and the 16-bit words moved out, with carries not yet added."""

    def __init__(self, lanes: int, room: int):
        self.low, self.span = np.zeros(lanes), np.full(lanes, _MOST - 1)
        self.room = room
        self.out, self.at = np.zeros(lanes * room, np.uint32), np.arange(lanes) * room

    def settle(self) -> None:
        """Moves out the upper words of small intervals."""
        ready = np.flatnonzero(self.span < _LEAST)
        while len(ready):
            low, at = self.low[ready], self.at[ready]
            word = np.floor(low / _LEAST)
            self.out[at] = word
            self.at[ready] = at + 1
            self.low[ready] = (low - word * _LEAST) * _WORD
            span = self.span[ready] * _WORD
            self.span[ready] = span
            ready = ready[span < _LEAST]

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """(words of each lane, all words): one more word names a number of the interval, zeros follow."""
        self.out[self.at] = np.ceil(self.low / _LEAST)
        sizes = self.at + 1 - np.arange(len(self.at)) * self.room
        rows = self.out.reshape(-1, self.room)[:, : int(sizes.max())]
        out = rows[np.arange(rows.shape[1]) < sizes[:, None]]
        while (carried := np.flatnonzero(out > 0xFFFF)).size:
            out[carried] &= 0xFFFF
            out[carried - 1] += 1
        return sizes, out.astype("<u2")


class _Decoder:
    """The size of every lane's interval, and how far in it the coded number lies."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        lanes = len(sizes)
        # A lane reads two words beyond its own, which are zeros.
        ends = np.cumsum(sizes + 2)
        self.words = np.zeros(int(ends[-1]))
        inner = np.ones(len(self.words), bool)
        inner[ends - 1] = inner[ends - 2] = False
        self.words[inner] = words
        self.at = ends - sizes - 2
        self.span, self.value = np.full(lanes, _MOST - 1), np.zeros(lanes)
        for _ in range(3):
            self.value = self.value * _WORD + self.words[self.at]
            self.at += 1

    def settle(self) -> None:
        ready = np.flatnonzero(self.span < _LEAST)
        while len(ready):
            at = self.at[ready]
            self.value[ready] = self.value[ready] * _WORD + self.words.take(at)
            self.at[ready] = at + 1
            span = self.span[ready] * _WORD
            self.span[ready] = span
            ready = ready[span < _LEAST]


class _Model:
    """What the lanes of a block share. A table entry is an id's number and, in two bits, its confidence.

    Where lanes meet in a slot, the last one's entry stays, as numpy says for repeated indices. Entries
    change after every step; counts after the steps 1, 2, 4, 8, 16 and then every _EACH.
    """

    def __init__(self, lanes: int, steps: int, kinds: int):
        self.kinds = kinds
        slots = 1 << min(_SLOTS.bit_length() - 1, max(8, int(lanes * steps).bit_length()))
        self.mask = slots - 1
        self.second, self.first = np.full(slots, -4), np.full(kinds + 1, -4)
        # How often each order was right, by the confidence of both.
        self.met = np.zeros((16, 4))
        self.met[:, :3] = 0.25, 0.25, 1.5
        # Order 0: how often each id occurred, as shares of 1 << fine; one more row is no id, with all shares.
        self.fine = max(16, kinds.bit_length() + 1)
        self.part = 1.0 / (1 << self.fine)
        self.counts = np.zeros(kinds + 1, np.int64)
        self.cum, self.freq = np.zeros(kinds + 1), np.full(kinds + 1, float(1 << self.fine))
        self.keys, self.plain = np.zeros((_EACH, lanes), np.int64), np.zeros((_EACH, lanes), np.int64)
        self.pending, self.step, self.due = 0, 0, 1
        self.one, self.two = np.full(lanes, kinds), np.full(lanes, kinds)
        self._chances()
        self._shares()

    def _chances(self) -> None:
        """The parts of a range for order 2, order 1 and order 0, by four times the confidence of both and the order."""
        met, every = self.met, self.met.sum(axis=0)
        share = np.floor(_WHOLE * (every[:2] / every.sum() + 3 * met[:, :2] / met.sum(axis=1, keepdims=True)) / 4)
        share = np.clip(share, 8, _WHOLE // 2 - 32)
        lower, upper = share[:, 0], share.sum(axis=1)
        none, whole = np.zeros(16), np.full(16, float(_WHOLE))
        self.begin = np.stack([none, lower, upper, whole], axis=1).reshape(-1)
        self.width = np.stack([lower, upper - lower, whole - upper, none], axis=1).reshape(-1)

    def _shares(self) -> None:
        kinds, whole = self.kinds, 1 << self.fine
        counts = self.counts[:-1]
        freq = 1 + counts * (whole - kinds) // max(1, int(counts.sum()))
        freq[int(np.argmax(freq))] += whole - int(freq.sum())
        self.freq[:-1] = freq
        self.cum[:-1] = np.cumsum(freq) - freq
        self.whose = np.repeat(np.arange(kinds), freq)

    def predict(self) -> np.ndarray:
        """Four times the confidence of both predictions."""
        self.slots = (self.one * 0x9E3779B1 + self.two * 0x85EBCA6B >> 9) & self.mask
        self.by_two, self.by_one = self.second.take(self.slots), self.first.take(self.one)
        self.sure_two, self.sure_one = self.by_two & 3, self.by_one & 3
        return (self.sure_two << 2 | self.sure_one) << 2

    def right(self, actual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether order 2 and order 1 predict the id."""
        return self.by_two >> 2 == actual, self.by_one >> 2 == actual

    def learn(self, actual: np.ndarray, right: tuple[np.ndarray, np.ndarray], key: np.ndarray, plain: np.ndarray) -> None:
        """key: four times the confidence and the order that was right; plain: what order 0 coded, else no id."""
        fresh = (actual << 2) + 1
        for table, slots, held, sure, same in (
            (self.second, self.slots, self.by_two, self.sure_two, right[0]), (self.first, self.one, self.by_one, self.sure_one, right[1])
        ):
            table[slots] = np.where(same | (sure < 2), fresh + np.minimum(sure, 2) * same, held - 1)
        self.two, self.one = self.one, actual
        self.keys[self.pending], self.plain[self.pending] = key, plain
        self.pending += 1
        self.step += 1
        if self.step == self.due:
            self.met += np.bincount(self.keys[: self.pending].ravel(), minlength=64).reshape(16, 4)
            self.counts += np.bincount(self.plain[: self.pending].ravel(), minlength=self.kinds + 1)
            self.pending, self.due = 0, self.step + min(_EACH, self.step)
            self._chances()
            self._shares()


def _encode_lanes(numbers: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    lanes, steps = numbers.shape
    model = _Model(lanes, steps, kinds)
    coder = _Encoder(lanes, (steps * (2 * _BITS + model.fine) >> 4) + 8)
    for column in np.ascontiguousarray(numbers.T):
        actual = column.astype(np.int64)
        sure = model.predict()
        right = two, one = model.right(actual)
        guessed = two | one
        key = sure + (2 - guessed.view(np.int8) - two.view(np.int8))
        step = np.floor(coder.span * _SHARE)
        coder.low += step * model.begin.take(key)
        step *= model.width.take(key)
        plain = np.where(guessed, kinds, actual)
        coder.span = np.floor(step * model.part)
        coder.low += coder.span * model.cum.take(plain)
        coder.span *= model.freq.take(plain)
        coder.settle()
        model.learn(actual, right, key, plain)
    return coder.finish()


def _decode_lanes(sizes: np.ndarray, words: np.ndarray, steps: int, kinds: int) -> np.ndarray:
    lanes = len(sizes)
    coder, model = _Decoder(sizes, words), _Model(lanes, steps, kinds)
    columns = np.zeros((steps, lanes), np.int32)
    top = (1 << model.fine) - 1
    for t in range(steps):
        sure = model.predict()
        step = np.floor(coder.span * _SHARE)
        beyond = coder.value >= step * model.width.take(sure)
        rest = coder.value >= step * model.begin.take(sure + 2)
        key = sure + (beyond.view(np.int8) + rest.view(np.int8))
        coder.value -= step * model.begin.take(key)
        step *= model.width.take(key)
        step = np.floor(step * model.part)
        own = model.whose.take(np.minimum((coder.value / step).astype(np.int64), top))
        plain = np.where(rest, own, kinds)
        coder.value -= step * model.cum.take(plain)
        coder.span = step * model.freq.take(plain)
        actual = np.where(rest, own, np.where(beyond, model.by_one, model.by_two) >> 2)
        coder.settle()
        columns[t] = actual
        model.learn(actual, model.right(actual), key, plain)
    return columns.T


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the different ids in order, each id's number among them)."""
    if int(ids.max()) >= 1 << 22:
        known, numbers = np.unique(ids, return_inverse=True)
        return known, numbers.astype(np.int32)
    there = np.zeros(int(ids.max()) + 1, bool)
    there[ids] = True
    return np.flatnonzero(there).astype(np.uint32), (np.cumsum(there) - 1).astype(np.int32)[ids]


def _encode_block(ids: np.ndarray) -> tuple[bytes, bytes]:
    """(what its head says of a block, its bytes)."""
    known, numbers = _numbered(ids)
    lanes = -(-len(ids) // STEPS)
    steps = -(-len(ids) // lanes)
    padded = np.zeros(lanes * steps, np.int32)
    padded[: len(ids)] = numbers
    sizes, words = _encode_lanes(padded.reshape(lanes, steps), len(known))
    table = zlib.compress(np.diff(known, prepend=np.uint32(0)).astype("<u4").tobytes() + sizes.astype("<u4").tobytes(), 1)
    data = table + words.tobytes()
    return _BLOCK.pack(len(ids), len(known), len(table), len(data), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(data)), data


def _decode_block(data: bytes, n: int, kinds: int, table: int) -> np.ndarray:
    lanes = -(-n // STEPS)
    steps = -(-n // lanes)
    numbers = np.frombuffer(zlib.decompress(data[:table]), "<u4")
    known = np.cumsum(numbers[:kinds], dtype=np.uint32)
    decoded = _decode_lanes(numbers[kinds:].astype(np.int64), np.frombuffer(data, "<u2", offset=table), steps, kinds)
    return known[decoded.reshape(-1)[:n]]


def encode_segment(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment: whole documents' ids (`counts` of each, one after the other) in coded blocks.

    Layout, little-endian: magic, version, documents, blocks, ids; per document its id (int64) and
    count (uint64); per block as uint32 its ids, its different ids, bytes of its table, all its bytes,
    and CRC-32 of the ids (uint32) and of the bytes; CRC-32 of all that; the blocks' bytes. These are a
    zlib table of the steps between the different ids and of the lanes' numbers of words, and the words.
    No ids make no blocks.
    """
    ids = np.ascontiguousarray(ids, np.uint32)
    if len(ids) and ids.max() >= 1 << 29:
        raise ValueError("ids must be below 2 ** 29")
    block = min(block, BLOCK)
    made = [_encode_block(ids[low : low + block]) for low in range(0, len(ids), block)]
    head = _HEAD.pack(_MAGIC, _VERSION, len(doc_ids), len(made), len(ids))
    head += np.asarray(doc_ids, "<i8").tobytes() + np.asarray(counts, "<u8").tobytes() + b"".join(says for says, _ in made)
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(data for _, data in made)


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, counts, ids) of a segment; raises Damaged if a checksum does not fit."""
    if len(data) < _HEAD.size + 4:
        raise Damaged("a segment is shorter than its head")
    magic, version, docs, blocks, total = _HEAD.unpack_from(data)
    end = _HEAD.size + 16 * docs + _BLOCK.size * blocks
    if magic != _MAGIC or version != _VERSION or len(data) < end + 4 or zlib.crc32(data[:end]) != struct.unpack_from("<I", data, end)[0]:
        raise Damaged("a segment's head does not fit its checksum")
    doc_ids = np.frombuffer(data, "<i8", docs, _HEAD.size)
    counts = np.frombuffer(data, "<u8", docs, _HEAD.size + 8 * docs).astype(np.int64)
    at, parts = end + 4, [np.zeros(0, np.uint32)]
    for i, (n, kinds, table, size, sum_ids, sum_data) in enumerate(_BLOCK.iter_unpack(data[_HEAD.size + 16 * docs : end])):
        coded = data[at : at + size]
        at += size
        if zlib.crc32(coded) != sum_data:
            raise Damaged(f"block {i} does not fit its checksum")
        parts.append(_decode_block(coded, n, kinds, table))
        if zlib.crc32(parts[-1].astype("<u4").tobytes()) != sum_ids:
            raise Damaged(f"the ids of block {i} do not fit their checksum")
    ids = np.concatenate(parts)
    if len(ids) != total or counts.sum() != total:
        raise Damaged("a segment's ids do not fit its head")
    return doc_ids, counts, ids

"""A block coder for token ids: mixed order-0, -1 and -2 predictions and a range coder, in numpy.

A block's ids are cut into lanes of equal length that are coded side by side,
each by a range coder of its own, against one model that learns from all lanes
after every step. The model starts empty in each block:

* order 2 and order 1 each predict one id for a context of two or one ids, with
  a confidence that grows when the prediction holds and shrinks when not;
* the share of either prediction is what predictions of that confidence have
  earned so far in the block;
* order 0 spreads the rest over all ids by their counts so far.

Block layout, little-endian: magic, number of ids, alphabet, lanes, CRC-32 of
the ids (all u32), the words of each lane (u32), and the lanes' words (u32).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = 0x314B5457
HEADER = "<5I"
HEADER_SIZE = struct.calcsize(HEADER)
# An id's share of the coder's range is counted in units of 2^-TOTAL_BITS.
TOTAL_BITS = 24
TOTAL = 1 << TOTAL_BITS
# Every id keeps at least this many units at order 0, and order 0 at least this many in all.
FLOOR_BITS = 6
FLOOR, REST = 1 << FLOOR_BITS, 1 << 18
CONFIDENCE = 16
CONTEXT_BITS = 16
# Steps after which the order-0 counts are turned into shares again.
REFRESH = 32
MAX_LANES, LANE_IDS = 4096, 64
MAX_ALPHABET = TOTAL // (4 * FLOOR)
_U = np.uint64


# A prediction is kept as id * CONFIDENCE + confidence. What is added to it when
# it fails (one step towards half the confidence) and when it holds, by confidence.
_CHANGE = np.array([n // 2 - n for n in range(CONFIDENCE)] + [min(n + 1, CONFIDENCE - 1) - n for n in range(CONFIDENCE)],
                   dtype=np.int64)


class _Model:
    """What a block has shown so far. One instance codes, another one decodes, with equal states."""

    def __init__(self, alphabet: int, lanes: int):
        if not 0 < alphabet <= MAX_ALPHABET:
            raise ValueError(f"the alphabet must have 1 to {MAX_ALPHABET} ids")
        self.alphabet = alphabet
        self.table2 = np.zeros(1 << CONTEXT_BITS, np.int64)
        self.table1 = np.zeros(alphabet, np.int64)
        self.held = np.tile(np.arange(CONFIDENCE) / CONFIDENCE * 4 + 0.1, (2, 1))
        self.tries = np.full((2, CONFIDENCE), 5.0)
        self.counts = np.zeros(alphabet, np.int64)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.recent, self.steps = [], 0
        self._weigh()
        self._spread()

    def _weigh(self):
        """The shares of both predictions for each pair of confidences: what such predictions have earned."""
        p2, p1 = (self.held / self.tries)
        self.shares2 = np.repeat((p2 * (TOTAL - REST)).astype(np.int64), CONFIDENCE)
        self.shares1 = (np.outer(1 - p2, p1) * (TOTAL - REST)).astype(np.int64).ravel()

    def _spread(self):
        """The order-0 shares, as running sums."""
        if self.recent:
            self.counts += np.bincount(np.concatenate(self.recent), minlength=self.alphabet)
            self.recent = []
        room = TOTAL - FLOOR * self.alphabet
        self.sums = np.zeros(self.alphabet + 1, np.int64)
        np.cumsum(FLOOR + self.counts * room // max(1, int(self.counts.sum())), out=self.sums[1:])
        self.steps_of = None

    def predict(self, lanes: int):
        """For the next id of each lane: both guesses, and their shares; order 0 has the rest."""
        last = self.last[:lanes]
        self.context = ((self.before[:lanes] * 0x9E3779B1 + last) * 0x85EBCA77 >> 12) & ((1 << CONTEXT_BITS) - 1)
        self.entry2, self.entry1 = self.table2[self.context], self.table1[last]
        self.sure2, self.sure1 = self.entry2 & (CONFIDENCE - 1), self.entry1 & (CONFIDENCE - 1)
        self.guess2, self.guess1 = self.entry2 >> 4, self.entry1 >> 4
        pair = self.sure2 * CONFIDENCE + self.sure1
        share2, share1 = self.shares2[pair], self.shares1[pair]
        both = share1 * (self.guess1 == self.guess2)  # where the orders agree, their shares add up
        return self.guess2, self.guess1, share2 + both, share1 - both

    def found(self, shares: np.ndarray) -> np.ndarray:
        """The id at each place of the order-0 shares; only in a damaged block is a place beyond them."""
        shares = np.minimum(shares, self.sums[-1] - 1)
        if self.steps_of is None:
            # Every id has FLOOR units or more, so from step to step of FLOOR units it is the next one at most.
            begins = -(-self.sums // FLOOR)
            self.steps_of = np.repeat(np.arange(self.alphabet), np.diff(begins))
        ids = self.steps_of[shares >> FLOOR_BITS]
        return ids + (self.sums[ids + 1] <= shares)

    def learn(self, ids: np.ndarray):
        replaced = ids * CONFIDENCE + 1
        for order, (table, at, entry, guess, sure) in enumerate((
                (self.table2, self.context, self.entry2, self.guess2, self.sure2),
                (self.table1, self.last[:len(ids)], self.entry1, self.guess1, self.sure1))):
            kind = sure + CONFIDENCE * (guess == ids)
            seen = np.bincount(kind, minlength=2 * CONFIDENCE).reshape(2, CONFIDENCE)
            self.held[order] += seen[1]
            self.tries[order] += seen.sum(axis=0)
            table[at] = np.where(kind == 0, replaced, entry + _CHANGE[kind])
        self.before, self.last = self.last[:len(ids)], ids
        self.recent.append(ids)
        self.steps += 1
        if self.steps < 32 or self.steps % 8 == 0:
            self._weigh()
        if self.steps % REFRESH == 0 or self.steps < REFRESH and self.steps & (self.steps - 1) == 0:
            self._spread()


def _lanes(n: int) -> int:
    return max(1, min(MAX_LANES, n // LANE_IDS))


def _steps(n: int, lanes: int):
    """The number of lanes that still have an id, step by step. Lane l holds ids l * ceil(n / lanes) on."""
    length = -(-n // lanes) if n else 0
    for step in range(length):
        yield step, (n - step + length - 1) // length


def encode(ids: np.ndarray, alphabet: int) -> bytes:
    """One block; ids below `alphabet`, any number of them."""
    ids = np.ascontiguousarray(ids, dtype=np.int64)
    n = len(ids)
    if n and not (0 <= ids.min() and ids.max() < alphabet):
        raise ValueError("an id is outside the alphabet")
    lanes = _lanes(n)
    length = -(-n // lanes) if n else 0
    model = _Model(alphabet, lanes)
    low, span = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    grid = np.zeros(lanes * length, np.int32)  # an alphabet has MAX_ALPHABET ids at most
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, length).T)
    digits, used = np.zeros((length + 3, lanes), np.int64), np.ones(lanes, np.int64)  # row 0 takes a first carry
    every = np.arange(lanes)
    for step, live in _steps(n, lanes):
        x = grid[step, :live].astype(np.int64)
        c2, c1, share2, share1 = model.predict(live)
        is2 = x == c2
        start, width = share2 * ~is2, share1 + (share2 - share1) * is2
        far = np.flatnonzero(~is2 & (x != c1))
        taken, y = (share2 + share1)[far], x[far]
        bottom, top = model.sums[y] * (TOTAL - taken) >> TOTAL_BITS, model.sums[y + 1] * (TOTAL - taken) >> TOTAL_BITS
        start[far], width[far] = taken + bottom, top - bottom
        unit = span[:live] >> _U(TOTAL_BITS)
        sum_ = low[:live] + start.view(_U) * unit
        over = sum_ < low[:live]
        if over.any():
            lane = every[:live][over]
            digits[used[lane] - 1, lane] += 1
        wide = width.view(_U) * unit
        out = wide < _U(1 << 32)
        lane = np.flatnonzero(out)
        digits[used[lane], lane] = sum_[lane] >> _U(32)
        used[:live] += out
        shift = out * _U(32)
        np.left_shift(sum_, shift, out=low[:live])
        np.left_shift(wide, shift, out=span[:live])
        model.learn(x)
    for shift in (32, 0):
        digits[used, every] = (low >> _U(shift) & _U(0xFFFFFFFF)).astype(np.int64)
        used += 1
    while (over := digits >> 32).any():
        digits &= 0xFFFFFFFF
        digits[:-1] += over[1:]
    used -= 1
    words = digits[1:].T[np.arange(length + 2)[None, :] < used[:, None]].astype("<u4")
    data = ids.astype("<u4").tobytes()
    return (struct.pack(HEADER, MAGIC, n, alphabet, lanes, zlib.crc32(data)) + used.astype("<u4").tobytes() + words.tobytes())


def decode(block: bytes) -> np.ndarray:
    """The ids of a block as u32; ValueError if the block is damaged."""
    with np.errstate(divide="ignore"):  # a damaged block may leave a lane without a range
        return _decode(block)


def _decode(block: bytes) -> np.ndarray:
    if len(block) < HEADER_SIZE:
        raise ValueError("not a block of ids")
    magic, n, alphabet, lanes, check = struct.unpack_from(HEADER, block)
    if magic != MAGIC or lanes != _lanes(n) or len(block) < HEADER_SIZE + 4 * lanes:
        raise ValueError("not a block of ids")
    used = np.frombuffer(block, "<u4", lanes, HEADER_SIZE).astype(np.int64)
    words = np.frombuffer(block, "<u4", offset=HEADER_SIZE + 4 * lanes).astype(_U)
    if used.sum() != len(words) or (used < 2).any():
        raise ValueError("the block is damaged")
    words = np.concatenate([words, np.zeros(1, _U)])
    at = np.cumsum(used) - used
    length = -(-n // lanes) if n else 0
    model = _Model(alphabet, lanes)
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    value = words[at] << _U(32) | words[at + 1]
    at = at + 2
    grid = np.zeros((length, lanes), np.int64)
    for step, live in _steps(n, lanes):
        c2, c1, share2, share1 = model.predict(live)
        unit = span[:live] >> _U(TOTAL_BITS)
        slot = np.minimum(value[:live] // unit, _U(TOTAL - 1)).view(np.int64)
        is2 = slot < share2
        x = c1 + (c2 - c1) * is2
        start, width = share2 * ~is2, share1 + (share2 - share1) * is2
        both = share2 + share1
        far = np.flatnonzero(slot >= both)
        taken = both[far]
        left = TOTAL - taken
        y = model.found((((slot[far] - taken + 1) << TOTAL_BITS) - 1) // left)
        bottom, top = model.sums[y] * left >> TOTAL_BITS, model.sums[y + 1] * left >> TOTAL_BITS
        x[far], start[far], width[far] = y, taken + bottom, top - bottom
        value_ = value[:live] - start.view(_U) * unit
        wide = width.view(_U) * unit
        out = wide < _U(1 << 32)
        shift = out * _U(32)
        np.left_shift(value_, shift, out=value[:live])
        np.left_shift(wide, shift, out=span[:live])
        lane = np.flatnonzero(out)
        value[lane] |= words[np.minimum(at[lane], len(words) - 1)]
        at[:live] += out
        grid[step, :live] = x
        model.learn(x)
    ids = np.ascontiguousarray(grid.T).ravel()[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != check:
        raise ValueError("the checksum of the block differs")
    return ids

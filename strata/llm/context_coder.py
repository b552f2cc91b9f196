"""Adaptive context-mixing range coder for blocks of token ids.

The next id is predicted by three models that learn from the block itself: how often each id came
(order 0), which id last followed the one before (order 1), and which followed the two before
(order 2). Their predictions are mixed with weights that are learned for each state of confidence
of the models, and the mix drives a range coder. A block starts with nothing learned, so it can be
read alone, and ends with a checksum.

A block is cut into lanes of consecutive ids, which are coded in step, as vectors. All lanes share
the models; a step is coded with what the steps before have taught. All arithmetic is on integers,
so the reader repeats the writer's steps exactly.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"SCM1"
MOST_LANES = 6144
LANE_LENGTH = 256
LONG_LANES, LONG_LENGTH = 4096, 640  # lanes beyond so many are at least so long: larger blocks learn in more steps

_U = np.uint64
_TOP, _BOTTOM, _SHIFT, _HEAD = _U(1 << 48), _U(1 << 40), _U(16), _U(48)
_HALF, _WIDTH = 32, (1 << 32) - 1
_SIGN = 63  # shifted by it, a negative number is a mask of ones and any other one of zeros
_SCALE = 1024  # sum of the three weights
_MOST_COUNT = 1 << 22  # of ids seen; beyond it, older ones count less
_SLOTS = 1 << 17
_MOST_UNITS = 64
_CONTEXT_BITS = 18
_SURE_BITS, _CONFIDENT = 3, 7
_REFRESH = 8
_STEPS = 16  # laid out by step at once: a cache line of each lane
_WITHIN = "wrap"  # for look-ups at places that are always within the table: spares their checks


class _Mixer:
    """The three models and their weights.

    All are learned at every step. The counts of order 0 and the weights take effect every
    ``_REFRESH`` steps, and sooner in the first ones. Order 0 is kept as a row of about ``_SLOTS``
    slots, of which each id seen so far has its share, so the id at a place is looked up and not
    searched. Behind them, in what is left for ids not seen yet, each id has one unit.

    Places and sizes are below 2**53, so they are signed integers and what holds or not is a mask.
    """

    def __init__(self, vocabulary: int, lanes: int, reading: bool = False):
        self.reading = reading
        self.seen, self.rows = np.zeros(vocabulary, np.int32), []  # ids of the steps not in it yet
        self.known = np.zeros(0, np.int64)  # ids in it
        self.kind = np.uint16 if vocabulary <= 1 << 16 else np.int32  # of ids in slots
        # Guesses of order 2, by context, and behind them of order 1, by the last id; each has its
        # confidence in the lowest bits. Arrays with two rows have one for each of these orders, 1 first.
        self.guess = np.zeros((1 << _CONTEXT_BITS) + vocabulary, np.int32)
        self.at = np.full((2, lanes), 1 << _CONTEXT_BITS, np.int64)  # where the guesses are
        # Of each state, how often order 2 was right, else order 1, and neither; the fourth is unused.
        self.outcomes = np.ones(2 * (_CONFIDENT + 1) ** 2 * 4, np.int64)
        self.hits = self.outcomes.reshape(-1, 4)[:, :3]
        self.last1 = self.last2 = np.zeros(lanes, np.uint32)
        self.vocabulary = vocabulary
        self.unseen = (np.arange(vocabulary, dtype=np.int64) << _HALF) + 1
        self.age, self.before = 0, (0, 0)  # ids seen and known at the last refresh

    def _refresh(self) -> None:
        if self.rows:
            np.add.at(self.seen, np.concatenate(self.rows), np.int32(1))
            self.rows.clear()
        if np.count_nonzero(self.seen) > len(self.known):  # once seen, an id stays so
            self.known = np.flatnonzero(self.seen > 0)
        known = self.known
        seen = self.seen.take(known).astype(np.int64)
        n, n_known = int(seen.sum()), len(known)
        recent, new = n - self.before[0] + 2, n_known - self.before[1] + 1
        if n > _MOST_COUNT:
            seen = (seen + 1) // 2
            self.seen[known] = seen
            n = int(seen.sum())
        self.before = (n, n_known)
        full = self.hits.sum(1) > 1 << 16
        self.hits[full] = (self.hits[full] + 1) // 2
        # Quotients of integers below 2**53 by ones below 2**24: rounding never reaches the next integer.
        shares = np.maximum((seen * _SLOTS / max(1, n)).astype(np.int64), 1)
        upto = np.cumsum(shares)
        self.n_slots = n_slots = int(upto[-1]) if n_known else 0
        if self.reading:
            self.slots = np.append(np.repeat(known.astype(self.kind), shares), self.kind(0))
        # Units of a slot: the more, the fewer ids of late were new.
        unit = self.vocabulary * (recent - new) // (new * (n_slots + 1))
        self.unit = max(1, min(_MOST_UNITS, unit))
        self.head = self.unit * n_slots
        self.end = self.head + self.vocabulary
        # Where each id's share starts, and in the lower 32 bits how wide it is: one look-up for both.
        self.spans = self.unseen + (self.head << _HALF)
        self.spans[known] = self.unit * (((upto - shares) << 32) + shares)
        self.total = _U(_SCALE * self.end)
        share = 1 + self.hits[:, :2] * (_SCALE - 4) // self.hits.sum(1, keepdims=True)
        weights = np.ascontiguousarray(share[:, ::-1].T)
        self.rests, self.shares = _SCALE - weights.sum(0), weights * self.end

    def predict(self) -> None:
        if self.age % _REFRESH == 0 or self.age in (1, 2, 4, 8):
            self._refresh()
        self.age += 1
        # The bits that are used are the same in 32 bits as in 64.
        context = self.last2 * np.uint32(0x2545F491)
        context += self.last1 * np.uint32(0x9E3779B1)
        context >>= np.uint32(7)
        np.bitwise_and(context, np.uint32((1 << _CONTEXT_BITS) - 1), out=self.at[1])
        self.old = self.guess.take(self.at, mode=_WITHIN)
        self.sure = self.old & _CONFIDENT
        self.guessed = (self.old >> _SURE_BITS).astype(np.int64)
        self.compared = None
        state = self.sure[1] << _SURE_BITS
        state += self.sure[0]
        state <<= 1
        state += self.guessed[0] == self.guessed[1]
        self.state = state.astype(np.int64)
        self.rest = self.rests.take(self.state, mode=_WITHIN)
        self.mass = self.shares.take(self.state, axis=1, mode=_WITHIN)
        self.span = self.spans.take(self.guessed, mode=_WITHIN)
        self.first = self.span >> _HALF

    def _right(self, ids: np.ndarray) -> np.ndarray:
        """Which guesses are the ids; compared once for each step's array of ids."""
        if self.compared is not ids:
            self.compared, self.right = ids, self.guessed == ids
        return self.right

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids' intervals start and how large they are."""
        size = self.spans.take(ids)
        first = size >> _HALF
        before = self.first - first
        before >>= _SIGN
        before &= self.mass
        start = self.rest * first
        start += before[0]
        start += before[1]
        size &= _WIDTH
        size *= self.rest
        own = self._right(ids).astype(np.int64)
        np.negative(own, out=own)
        own &= self.mass
        size += own[0]
        size += own[1]
        return start.view(np.uint64), size.view(np.uint64)

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids whose intervals hold the values."""
        value, mass = value.view(np.int64), self.mass
        ahead = np.empty_like(self.first)  # of each guess: whether the other one's share is before its own
        np.subtract(self.first[1], self.first[0], out=ahead[0])
        np.negative(ahead[0], out=ahead[1])
        ahead >>= _SIGN
        same = ~(ahead[0] | ahead[1])
        start = self.rest * self.first
        start += np.bitwise_and(ahead, mass[::-1], out=ahead)
        size = self.span & _WIDTH
        size *= self.rest
        size += mass
        size[0] += np.bitwise_and(same, mass[1], out=same)  # of two equal guesses, the first one has it all
        # Before the start, a difference is negative; unsigned, it is beyond any size.
        np.subtract(value, start, out=start)
        guessed = start.view(np.uint64) < size.view(np.uint64)
        # Neither guess: without their masses, the place in order 0. Of guesses it is not used.
        before = start
        before >>= _SIGN
        np.invert(before, out=before)
        before &= mass
        place = value - before[0]
        place -= before[1]
        # Quotients of integers below 2**53 by ones up to 2**16: rounding never reaches the next integer.
        slot = (place / (self.rest * self.unit)).astype(np.int64)
        found = self.slots.take(slot, mode="clip").astype(np.int64)
        late = (slot >= self.n_slots).nonzero()[0]
        found[late] = np.minimum(place.take(late) // self.rest.take(late), self.end - 1) - self.head
        return np.where(guessed[0], self.guessed[0], np.where(guessed[1], self.guessed[1], found))

    def learn(self, ids: np.ndarray) -> None:
        right = self._right(ids)
        wrong = ~right
        outcome = self.state << 2
        outcome += wrong[1].view(np.int8) + (wrong[0] & wrong[1]).view(np.int8)
        self.outcomes += np.bincount(outcome, minlength=len(self.outcomes))
        short = ids.astype(np.uint32)
        fresh = (short << np.uint32(_SURE_BITS)).view(np.int32)
        # Right: surer by one, up to the most. Wrong: half as sure, or the id itself in place of an unsure guess.
        weaker = self.sure + 1
        weaker >>= 1
        change = 2 * _CONFIDENT - self.sure
        change >>= _SURE_BITS
        change += weaker
        learned = right.astype(np.int32)
        learned *= change
        learned -= weaker
        learned += self.old
        self.guess[self.at] = np.where(wrong & (self.sure == 0), fresh, learned)
        self.rows.append(ids)
        self.last2, self.last1 = self.last1, short
        np.add(ids, 1 << _CONTEXT_BITS, out=self.at[0])


def _lanes(n: int) -> int:
    return max(1, min(LONG_LANES, n // LANE_LENGTH), min(MOST_LANES, n // LONG_LENGTH))


def _settled(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Lanes whose first 16 bits are settled. Too narrow lanes are cut off so that they are, too."""
    settled = low + width
    settled ^= low
    settled = settled < _TOP
    narrow = ((width < _BOTTOM) > settled).nonzero()[0]
    if len(narrow):
        width[narrow] = (_U(0) - low[narrow]) & (_BOTTOM - _U(1))
        settled[narrow] = True
    return settled


def _shift(settled: np.ndarray, *numbers: np.ndarray) -> None:
    """Shift 16 bits out of the settled lanes, in place."""
    by = settled.astype(np.uint64)
    by <<= _U(4)
    for x in numbers:
        x <<= by


def _moves(low: np.ndarray, width: np.ndarray, settled: np.ndarray):
    """Shift out what is still settled after a first shift; yields the lanes and the 16 bits of each."""
    # Wider lanes reach into other first 16 bits.
    left = (settled & (width < _TOP)).nonzero()[0]
    while len(left):
        part_low, part_width = low.take(left), width.take(left)
        settled = _settled(part_low, part_width)
        move = settled.nonzero()[0]
        yield left.take(move), part_low.take(move) >> _HEAD
        _shift(settled, part_low, part_width)
        low[left], width[left] = part_low, part_width
        left = left[settled & (part_width < _TOP)]


def _rows(ids: np.ndarray, lanes: int) -> Iterator[np.ndarray]:
    """The ids of each step; lanes that have ended go on with 0."""
    steps = -(-len(ids) // lanes)
    padded = np.zeros(lanes * steps, np.uint32)
    padded[:len(ids)] = ids
    padded = padded.reshape(lanes, steps)
    for at in range(0, steps, _STEPS):
        yield from padded[:, at:at + _STEPS].T.astype(np.int64, order="C")


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    lanes = _lanes(len(ids))
    mixer = _Mixer(vocabulary, lanes)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    of, words = [], []
    for row in _rows(ids, lanes):
        mixer.predict()
        start, size = mixer.interval(row)
        unit = width // mixer.total
        low += unit * start
        width = unit * size
        settled = _settled(low, width)
        move = settled.nonzero()[0]
        of.append(move.astype(np.uint16))
        words.append((low.take(move) >> _HEAD).astype("<u2"))
        _shift(settled, low, width)
        for move, bits in _moves(low, width, settled):
            of.append(move.astype(np.uint16))
            words.append(bits.astype("<u2"))
        mixer.learn(row)
    for _ in range(4):
        of.append(np.arange(lanes, dtype=np.uint16))
        words.append((low >> _HEAD).astype("<u2"))
        low <<= _SHIFT
    of, words = np.concatenate(of), np.concatenate(words)
    lengths = np.bincount(of, minlength=lanes).astype("<u4")
    head = struct.pack("<III", len(ids), lanes, vocabulary)
    return head + lengths.tobytes() + words[np.argsort(of, kind="stable")].tobytes()


def decode(data: bytes) -> np.ndarray:
    n, lanes, vocabulary = struct.unpack_from("<III", data)
    lengths = np.frombuffer(data, "<u4", lanes, 12).astype(np.int64)
    words = np.frombuffer(data, "<u2", offset=12 + 4 * lanes)
    words = np.append(words, np.zeros(4, "<u2"))
    at = np.cumsum(lengths) - lengths
    code = np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _SHIFT) | words[at]
        at += 1
    mixer = _Mixer(vocabulary, lanes, reading=True)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    steps = -(-n // lanes)
    found, rows = np.empty((lanes, steps), np.uint32), np.empty((_STEPS, lanes), np.uint32)
    for step in range(steps):
        mixer.predict()
        unit = width // mixer.total
        ids = mixer.find(np.minimum((code - low) // unit, mixer.total - _U(1)))
        rows[step % _STEPS] = ids
        if step % _STEPS == _STEPS - 1 or step == steps - 1:
            first = step // _STEPS * _STEPS
            found[:, first:step + 1] = rows[:step + 1 - first].T
        start, size = mixer.interval(ids)
        low += unit * start
        width = unit * size
        settled = _settled(low, width)
        _shift(settled, low, width, code)
        code += words.take(at, mode=_WITHIN).astype(np.uint64) * settled
        at += settled
        for move, _ in _moves(low, width, settled):
            place = at.take(move)
            code[move] = (code.take(move) << _SHIFT) | words.take(place)
            at[move] = place + 1
        mixer.learn(ids)
    return found.ravel()[:n]


def pack_block(documents: list[tuple[int | None, np.ndarray]], vocabulary: int) -> bytes:
    """A block of whole documents, as pairs of id and token ids."""
    ids = np.concatenate([x for _, x in documents]) if documents else np.zeros(0, np.uint32)
    table = np.array([(0 if i is None else i, i is None, len(x)) for i, x in documents], np.int64)
    table = zlib.compress(table.reshape(-1, 3).T.astype("<i8").tobytes(), 6)
    body = MAGIC + struct.pack("<II", len(documents), len(table)) + table + encode(ids, vocabulary)
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(data: bytes) -> list[tuple[int | None, np.ndarray]]:
    body, checksum = data[:-4], struct.unpack("<I", data[-4:])[0]
    if body[:4] != MAGIC or zlib.crc32(body) != checksum:
        raise ValueError("the block is damaged")
    n_documents, size = struct.unpack_from("<II", body, 4)
    table = np.frombuffer(zlib.decompress(body[12:12 + size]), "<i8").reshape(3, n_documents)
    ids, cuts = decode(body[12 + size:]), np.cumsum(table[2])
    parts = np.split(ids, cuts[:-1]) if n_documents else []
    return [(None if null else int(i), x) for i, null, x in zip(table[0], table[1], parts)]

"""Token ids of many texts at once.

Pre-tokens are found on the bytes of all texts of a chunk, by the rules of the tokenizer's splitting
pattern, hashed, and looked up in a table of ids that each worker keeps. Only pre-tokens that the
table lacks go to the tokenizer library. The table is bounded and starts over when full.

This holds for texts of common signs (see ``pretokens``); other texts, those with special strings and
very long ones are encoded one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from strata.llm import pretokens
from strata.llm.common import worker_tables
from strata.llm.hash_index import HashIndex, checks_of
from strata.llm.shingles import hash_spans

CHUNK_BYTES = 1 << 20
LONGEST_BYTES = 1 << 23
TABLE_BITS = 21

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER
_CLASSES = _CLASS.tobytes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Byte-level vocabularies write each byte as a sign: printable ones as themselves, the others, in
# order, as the signs from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SIGNS = np.arange(256, dtype="<u2")
_SIGNS[sorted({*range(256)} - _PRINTABLE)] = 256 + np.arange(256 - len(_PRINTABLE))
_LEAD = 0xC3  # first byte of all accented letters of plain texts


class _Table(HashIndex):
    """Ids of pre-tokens."""

    def __init__(self, bits: int):
        super().__init__(bits)
        self.ids = np.zeros(self.room, np.uint32)
        self.first = np.zeros(self.room + 1, np.int64)

    def add_ids(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        at = self.first[self.size]
        end = at + len(ids)
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(end, len(self.ids)), np.uint32)])
        self.ids[at:end] = ids
        self.first[self.size + 1:self.size + 1 + len(keys)] = at + np.cumsum(counts)
        self.add(keys, checks)


class BatchEncoder:
    def __init__(self, path: str, table_bits: int = TABLE_BITS):
        self.encoder = pretokens.encoder(path)
        self.single = pretokens.CachedIds(self.encoder, 10_000)
        self.table = _Table(table_bits)

    def chunks(self, texts: list[str], other: Callable[[int, str], None]) -> Iterator[list[tuple[int, bytes]]]:
        """Positions and bytes of texts, some together; texts not of common signs go to ``other``."""
        held, size = [], 0
        for i, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass")
            if len(data) > LONGEST_BYTES or "<|" in text or not pretokens.is_plain(text):
                other(i, text)
                continue
            if held and size + len(data) > CHUNK_BYTES:
                yield held
                held, size = [], 0
            held.append((i, data))
            size += len(data)
        yield held

    def spans(self, held: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of a chunk, where its texts are cut, and where pre-tokens start and end."""
        cuts = np.cumsum([0] + [len(x) for _, x in held])
        data = np.frombuffer(b"".join(x for _, x in held), np.uint8)
        if not len(data):
            return data, cuts, cuts[:0], cuts[:0]
        if not self.encoder.byte_level:
            upper = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == _LEAD)
            data = _LOWER[data]
            data[1:][upper] += 0x20
        return data, cuts, *self._pieces(data, cuts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found: list = [None] * len(texts)

        def other(i: int, text: str) -> None:
            found[i] = np.frombuffer(self.single.encode(text), "<u4")

        for held in self.chunks(texts, other):
            self._encode_chunk(held, found)
        return found

    def _encode_chunk(self, held: list[tuple[int, bytes]], found: list) -> None:
        data, cuts, starts, ends = self.spans(held)
        if not len(data):
            for i, _ in held:
                found[i] = np.zeros(0, np.uint32)
            return
        entries = self._entries(data, starts, ends)
        # All places are within the tables; wrapping spares the look-ups their checks.
        first = self.table.first.take(entries, mode="wrap")
        counts = self.table.first.take(entries + 1, mode="wrap")
        counts -= first
        upto = np.concatenate(([0], np.cumsum(counts)))
        first -= upto[:-1]
        place = np.repeat(first, counts)
        place += np.arange(upto[-1])
        ids = self.table.ids.take(place, mode="wrap")
        for (i, _), part in zip(held, np.split(ids, upto[np.searchsorted(starts, cuts[1:-1])])):
            found[i] = part

    def _pieces(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        kind = np.frombuffer(data.tobytes().translate(_CLASSES), np.uint8)
        flag = np.ones(n + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=flag[1:n])
        flag[cuts] = True
        inside = np.ones(n + 1, bool)
        inside[cuts] = False
        # An apostrophe that is a run of its own and not the end of its text.
        apostrophe = np.flatnonzero((data == 39) & flag[:-1] & flag[1:] & inside[1:])
        if self.encoder.byte_level:
            # The last blank before a run of other signs goes with it if it is a space; else it stands
            # alone. Blanks at the end of a text stay together.
            last = kind == _SPACE
            last &= flag[1:]
            last &= inside[1:]
            flag[:-1] |= last
            last &= data == 32
            flag[1:] &= ~last
            apostrophe = apostrophe[flag[apostrophe]]
        else:
            flag[:n][kind == _DIGIT] = True
        # 's and its like are cut off from what follows.
        padded = np.append(data, np.zeros(2, np.uint8))
        one, two = padded[apostrophe + 1], padded[apostrophe + 2]
        pair = ((two == ord("e")) & np.isin(one, list(b"rv"))) | ((one == ord("l")) & (two == ord("l")))
        pair &= inside[np.minimum(apostrophe + 2, n)]
        single = np.isin(one, list(b"stmd"))
        cut = np.where(single, 1, np.where(pair, 2, 0))
        of, cut = apostrophe[cut > 0], cut[cut > 0]
        flag[of + 1] = False
        flag[of + 1 + cut] = True
        starts = np.flatnonzero(flag[:n])
        ends = np.append(starts[1:], n)
        if not self.encoder.byte_level:
            wanted = kind[starts] != _SPACE
            starts, ends = starts[wanted], ends[wanted]
        return starts, ends

    def _entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys = hash_spans(data, starts, ends)
        checks = checks_of(data, starts, ends)
        entries = self.table.find(keys, checks)
        missing = np.flatnonzero(entries < 0)
        if self.table.size + len(missing) > self.table.room:
            self.table.clear()
            if len(keys) > self.table.room:
                self.table = _Table(len(keys).bit_length() + 1)
            missing = np.arange(len(keys))
        while len(missing):  # more than once only where two pieces share a hash
            _, first = np.unique(keys[missing], return_index=True)
            new = missing[first]
            self._learn(data, keys[new], checks[new], starts[new], ends[new])
            entries[missing] = self.table.find(keys[missing], checks[missing])
            missing = missing[entries[missing] < 0]
        return entries

    def _learn(self, data, keys, checks, starts, ends) -> None:
        ids, counts = [], []
        for found in self.merged(data, starts, ends):
            counts.append(len(found))
            for x in found:
                ids.append(x.id)
        self.table.add_ids(keys, checks, np.array(ids, np.uint32), np.array(counts, np.int64))

    def merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[list]:
        """The library's tokens of each pre-token."""
        signs, merge = _SIGNS[data].tobytes().decode("utf-16-le"), self.encoder.tokenizer.model.tokenize
        return (merge(signs[a:b]) for a, b in zip(starts.tolist(), ends.tolist()))


_ENCODERS: dict[str, BatchEncoder] = worker_tables("batch_encoder")


def batch_encoder(path: str) -> BatchEncoder:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]

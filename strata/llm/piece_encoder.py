"""Ids of many texts by a SentencePiece vocabulary, with the library's own result for each segment.

Where the vocabulary has no piece with a blank after another sign, and none with a line break, no
merge reaches over the begin of a run of spaces or the end of a line. Texts are cut there, the
segments are hashed, and looked up in a table of ids that each worker keeps; the library encodes
only segments that the table lacks. The table is bounded and starts over when full. A vocabulary
without that property, or one that rewrites its input, encodes whole texts by the library.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from strata.llm.batch_encoder import _Table
from strata.llm.common import worker_tables
from strata.llm.hash_index import checks_of
from strata.llm.shingles import hash_spans

CHUNK_BYTES = 1 << 20
TABLE_BITS = 19

_BLANK = "▁"  # how pieces write a space
_NOT_ALIKE = re.compile(f"[^{_BLANK}]{_BLANK}|[\n ]")
_REWRITTEN = "ﬁ  \t Ａ½İé \n x "  # any normal form but the identity changes it
_SEGMENT = re.compile(rb"(?<! ) |(?<=\n)[^ ]")


class PieceEncoder:
    def __init__(self, path: str, table_bits: int = TABLE_BITS):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_ids = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(self.n_ids)]
        self.is_byte = np.array([self.library.is_byte(i) for i in range(self.n_ids)])
        alike = self.library.normalize(_REWRITTEN) == _BLANK + _REWRITTEN.replace(" ", _BLANK)
        self.splits = alike and not any(map(_NOT_ALIKE.search, self.pieces))
        # A segment inside a line is encoded behind a line break, whose ids are cut off again.
        self.break_ids = len(self._library(["\n"])[0])
        self.table = _Table(table_bits)

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        return [
            bytes([int(x[3:5], 16)]) if byte else x.replace(_BLANK, " ").encode("utf-8")
            for x, byte in zip(self.pieces, self.is_byte.tolist())
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; an empty one has none."""
        if not self.splits:
            return [np.array(x, np.uint32) for x in self._library(texts)]
        found: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0
        for i, text in enumerate(texts):
            if _BLANK in text:  # merges with spaces
                found[i] = [np.array(self._library([text])[0], np.uint32)]
                continue
            for part in self._parts(b" " + text.encode("utf-8", "surrogatepass") if text else b""):
                if held and size + len(part) > CHUNK_BYTES:
                    self._encode_chunk(held, found)
                    held, size = [], 0
                held.append((i, part))
                size += len(part)
        if held:
            self._encode_chunk(held, found)
        return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, np.uint32), *x]) for x in found]

    def _library(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    @staticmethod
    def _parts(data: bytes):
        """A long text in several parts, each of whole segments."""
        at = 0
        while at < len(data):
            cut = _SEGMENT.search(data, at + CHUNK_BYTES) if len(data) - at > CHUNK_BYTES else None
            end = cut.start() if cut else len(data)
            yield data[at:end]
            at = end

    def _encode_chunk(self, held: list[tuple[int, bytes]], found: list) -> None:
        cuts = np.cumsum([0] + [len(x) for _, x in held])
        data = np.frombuffer(b"".join(x for _, x in held), np.uint8)
        flag = np.zeros(len(data), bool)
        flag[1:] = ((data[1:] == 32) & (data[:-1] != 32)) | (data[:-1] == 10)
        flag[cuts[:-1]] = True
        starts = np.flatnonzero(flag)
        ends = np.append(starts[1:], len(data))
        entries = self._entries(data, starts, ends)
        first = self.table.first[entries]
        counts = self.table.first[entries + 1] - first
        upto = np.concatenate(([0], np.cumsum(counts)))
        ids = self.table.ids[np.repeat(first - upto[:-1], counts) + np.arange(upto[-1])]
        for (i, _), part in zip(held, np.split(ids, upto[np.searchsorted(starts, cuts[1:-1])])):
            found[i].append(part)

    def _entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys, checks = hash_spans(data, starts, ends), checks_of(data, starts, ends)
        entries = self.table.find(keys, checks)
        missing = np.flatnonzero(entries < 0)
        if self.table.size + len(missing) > self.table.room:
            self.table.clear()
            if len(keys) > self.table.room:
                self.table = _Table(len(keys).bit_length() + 1)
            missing = np.arange(len(keys))
        while len(missing):  # more than once only where two segments share a hash
            _, first = np.unique(keys[missing], return_index=True)
            new = missing[first]
            self._learn(data, keys[new], checks[new], starts[new], ends[new])
            entries[missing] = self.table.find(keys[missing], checks[missing])
            missing = missing[entries[missing] < 0]
        return entries

    def _learn(self, data, keys, checks, starts, ends) -> None:
        whole = data.tobytes()
        segments = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        # The library puts a space before what it gets.
        texts = [(x[1:] if x[:1] == b" " else b"\n" + x).decode("utf-8", "surrogatepass") for x in segments]
        made = [
            (ids if x[:1] == b" " else ids[self.break_ids:]) if text else self._blank()
            for x, text, ids in zip(segments, texts, self._library(texts))
        ]
        counts = np.array([len(x) for x in made], np.int64)
        self.table.add_ids(keys, checks, np.fromiter(chain.from_iterable(made), np.uint32), counts)

    def _blank(self) -> list[int]:
        """One space on its own, as before a line break; alone it is an empty text to the library."""
        return self._library(["\n"])[0][:1]


_ENCODERS: dict[str, PieceEncoder] = worker_tables("piece_encoder")


def piece_encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]

"""Encoding by pre-tokens, with the library's own result for each of them.

Texts of common signs are split by a pattern of Python's ``re``. What lies outside is split by
the tokenizer library itself, since letters and blanks are classes that differ between regular
expression engines.
"""

from __future__ import annotations

import json
import re

import numpy as np

from strata.llm.common import worker_tables

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\t\n\x0b\x0c\r -~{_LETTERS}]*")
_SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"
# The two splitting patterns, over the classes of plain texts.
_BYTE_LEVEL = re.compile(
    rf"{_SUFFIX}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
)
_WORD_LEVEL = re.compile(rf"{_SUFFIX}|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def is_plain(text: str) -> bool:
    return _PLAIN.fullmatch(text) is not None


class Encoder:
    """One tokenizer file. ``byte_level`` texts keep case and blanks, others lose both."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self.byte_level = made["normalizer"] is None
        special = [(x["content"], x["id"]) for x in made["added_tokens"]]
        self.special = dict(special)
        # Special strings are cut out first; the longer of two that begin alike wins.
        strings = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, strings))) if strings else None

    def parts(self, text: str) -> list[str]:
        """The text between special strings."""
        return self._special.split(text) if self._special else [text]

    def specials(self, text: str) -> list[int]:
        """The ids of the special strings, in order."""
        return [self.special[x] for x in self._special.findall(text)] if self._special else []

    def pieces(self, part: str) -> list[str]:
        """The pre-tokens of a part without special strings."""
        if is_plain(part):
            if self.byte_level:
                return _BYTE_LEVEL.findall(part)
            return _WORD_LEVEL.findall(part.lower())
        splitter = self.tokenizer.pre_tokenizer
        if not self.byte_level:
            part = self.tokenizer.normalizer.normalize_str(part)
        return [part[a:b] for _, (a, b) in splitter.pre_tokenize_str(part)]

    def ids(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids


class CachedIds(dict):
    """Ids of whole texts, as unsigned 32-bit integers, by a bounded cache of pre-tokens."""

    def __init__(self, encoder: Encoder, size: int):
        super().__init__()
        self.encoder, self.size = encoder, size

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.size:
            self.clear()
        found = self[piece] = np.array(self.encoder.ids(piece), "<u4").tobytes()
        return found

    def encode(self, text: str) -> bytes:
        parts = self.encoder.parts(text)
        found = b"".join(map(self.__getitem__, self.encoder.pieces(parts[0])))
        for special, part in zip(self.encoder.specials(text), parts[1:]):
            found += np.uint32(special).astype("<u4").tobytes()
            found += b"".join(map(self.__getitem__, self.encoder.pieces(part)))
        return found


_ENCODERS: dict[str, Encoder] = worker_tables("pretokens")


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]

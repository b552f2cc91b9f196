"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that powers of it can be inverted modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = 0xD6E8FEB86659FD93
_CHUNK = 1 << 20  # bytes hashed at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A permutation of the 64-bit integers that looks random."""
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """Powers of a base from 0 to ``size``; kept, as most calls need as many."""
    found = _POWERS.get(base)
    if found is None or len(found) <= size:
        found = np.full(max(size, _CHUNK) + 1, base, np.uint64)
        found[0] = 1
        np.cumprod(found, out=found)
        if size <= 2 * _CHUNK:
            _POWERS[base] = found
    return found


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each span, as a polynomial in its bytes."""
    size = len(data)
    sums = np.zeros(size + 1, np.uint64)
    np.add(data, np.uint64(1), out=sums[1:], dtype=np.uint64)
    sums[1:] *= _powers(_BASE, size)[:size]
    np.cumsum(sums, out=sums)
    found = (sums[ends] - sums[starts]) * _powers(_INVERSE, size)[starts]
    return mix(found + (ends - starts).astype(np.uint64) * np.uint64(_STEP))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and the number of words of each text."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    lengths = np.array([len(x) + 1 for x in texts], np.int64)
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths)))))
    found, at = [], 0
    while at < len(starts):
        base = starts[at]
        until = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, "right")))
        found.append(hash_spans(data[base:ends[until - 1]], starts[at:until] - base, ends[at:until] - base))
        at = until
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; a shorter text is one shingle."""
    words, counts = word_hashes([(x or "").encode("utf-8", "surrogatepass") for x in texts])
    step = np.uint64(_STEP)
    rolled = mix(words[:max(0, len(words) - width + 1)], 1)
    for i in range(1, width):
        rolled = mix(rolled * step + words[i:len(words) - width + 1 + i], 1)
    found, at = [], 0
    for count in counts:
        if count >= width:
            found.append(np.unique(rolled[at:at + count - width + 1]))
        elif count:
            whole = np.uint64(count)
            for word in words[at:at + count]:
                whole = mix(np.array([whole], np.uint64) * step + word, 2)[0]
            found.append(np.array([whole], np.uint64))
        else:
            found.append(np.zeros(0, np.uint64))
        at += count
    return found

"""Nearest neighbours by collision counting over single projections.

Each of ``m`` random projections keeps the vectors of a chunk in a sorted array. A query opens a
window around its own projected value in every array; a vector collides once for each window that
holds it. If too few vectors have enough collisions, all windows grow (virtual rehashing: the arrays
stay, only the windows change, and what they held before is not read again). Vectors that reach the
threshold are verified by their distance.

Where a chunk has no more vectors than are to be verified at least (``least`` and ``share``), all of
them are verified, without any window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Settings:
    projections: int = 96
    threshold: float = 0.62  # of the projections
    growth: float = 1.1  # of the windows from one level to the next
    skip: int = 3  # levels at a time until the first vector reaches the threshold
    least: int = 250  # vectors of a chunk to be verified, at least
    share: float = 0.1  # and this share of the chunk
    seed: int = 3


class Chunk:
    """The sorted arrays of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings):
        self.ids, self.vectors, self.settings = ids, vectors, settings
        rng = np.random.default_rng(settings.seed)
        self.directions = rng.standard_normal((settings.projections, vectors.shape[1]))
        values = self.directions @ vectors.T
        self.order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, 1)
        # The first windows hold a hundredth of the middle of the values.
        spread = np.subtract(*np.percentile(values, [75, 25])) if len(ids) else 0.0
        self.first_width = max(spread / 50, 1e-12)

    def candidates(self, query: np.ndarray) -> np.ndarray:
        """Positions of the vectors that collide often enough."""
        s, n = self.settings, len(self.ids)
        wanted = min(n, s.least + int(s.share * n))
        if wanted >= n:
            return np.arange(n)
        enough = int(np.ceil(s.threshold * s.projections))
        center = self.directions @ query
        reach = max(np.abs(self.sorted[:, [0, -1]] - center[:, None]).max(), self.first_width)
        n_levels = 2 + int(np.log(reach / self.first_width) / np.log(s.growth))
        widths = self.first_width * s.growth ** np.arange(n_levels)
        # Where each window begins and ends at each level: one search per array.
        lows = [np.searchsorted(a, c - widths).tolist() for a, c in zip(self.sorted, center)]
        highs = [np.searchsorted(a, c + widths, "right").tolist() for a, c in zip(self.sorted, center)]
        counts = np.zeros(n, np.int16)
        low = [int(np.searchsorted(a, c)) for a, c in zip(self.sorted, center)]
        high, level, found = low.copy(), -1, ()
        while level < n_levels - 1:
            level = min(n_levels - 1, level + (1 if len(found) else s.skip))
            for j, order in enumerate(self.order):
                a, b = lows[j][level], highs[j][level]
                if a < low[j]:
                    counts[order[a:low[j]]] += 1
                    low[j] = a
                if b > high[j]:
                    counts[order[high[j]:b]] += 1
                    high[j] = b
            found = np.flatnonzero(counts >= enough)
            if len(found) >= wanted:
                return found
        return np.arange(n)

    def nearest(self, query_id, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the ``k`` nearest candidates; ties go to the smaller id."""
        at = self.candidates(query)
        at = at[self.ids[at] != query_id]
        if len(at) < k < len(self.ids):
            at = np.flatnonzero(self.ids != query_id)
        distance = np.sqrt(((self.vectors[at] - query) ** 2).sum(1))
        best = np.lexsort((self.ids[at], distance))[:k]
        return self.ids[at][best], distance[best]

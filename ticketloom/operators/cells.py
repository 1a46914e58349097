"""Cells of a vector table around pivots, and which of them a query can do without.

Every vector belongs to the cell of its nearest pivot.  By Cauchy's inequality no member of a cell scores
above ``q . pivot + |q| * radius``; a cell whose bound stays below a score that ``k`` vectors reach is
skipped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAX_PIVOTS = 4096
# Cells of one distance matrix: 32 MiB of float64.
AT_ONCE = 4 << 20


def distinct_rows(sample: np.ndarray) -> np.ndarray:
    """Pivots of a sample: copies of a vector make one."""
    return np.unique(sample, axis=0)


def assign(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each vector and the distance to it."""
    cell = np.empty(len(vectors), np.int64)
    half = (pivots * pivots).sum(1) / 2
    step = max(1, AT_ONCE // len(pivots))
    for at in range(0, len(vectors), step):
        cell[at:at + step] = np.argmin(half - vectors[at:at + step] @ pivots.T, axis=1)
    # Taken from the difference itself: an expanded square would be off where both are close.
    return cell, np.sqrt(((vectors - pivots[cell]) ** 2).sum(1))


@dataclass(frozen=True)
class Cells:
    pivots: np.ndarray
    radius: np.ndarray  # of empty cells: anything
    rows: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """What no member's score exceeds, rounding included; minus infinity for empty cells."""
        norm = np.sqrt((queries * queries).sum(1))[:, None]
        reach = np.sqrt((self.pivots * self.pivots).sum(1)) + self.radius
        bound = queries @ self.pivots.T + norm * self.radius + 1e-9 * norm * reach + 1e-8
        return np.where(self.rows > 0, bound, -np.inf)

    def home(self, queries: np.ndarray, k: int) -> np.ndarray:
        """The cells to ask first: those with the best pivots, until they hold ``k`` vectors."""
        score = np.where(self.rows > 0, queries @ self.pivots.T, -np.inf)
        order = np.argsort(-score, axis=1, kind="stable")
        held = self.rows[order]
        first = (np.cumsum(held, axis=1) - held < k) & (held > 0)
        out = np.zeros(score.shape, bool)
        np.put_along_axis(out, order, first, axis=1)
        return out

    def left_open(self, queries: np.ndarray, floors: np.ndarray, k: int) -> np.ndarray:
        """The cells still to ask once ``k`` vectors are known to score ``floors`` at least."""
        return (self.bounds(queries) >= floors[:, None]) & ~self.home(queries, k)

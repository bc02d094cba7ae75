"""Sequences of unequal length side by side, for steps that run over all of them at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def blocks(lengths: np.ndarray, rows: int = 512, cells: int = 1 << 20) -> Iterator[np.ndarray]:
    """Places of sequences, shortest first, in blocks of bounded rows and padded cells."""
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    start = 0
    while start < len(order):
        stop = min(start + rows, len(order))
        while stop > start + 1 and lengths[order[stop - 1]] * (stop - start) > cells:
            stop = start + max(1, (stop - start) // 2)
        yield order[start:stop]
        start = stop


def padded(firsts: np.ndarray, lengths: np.ndarray, fill: int) -> np.ndarray:
    """Positions ``first, first + 1, …`` of each sequence as a column, ``fill`` below its end."""
    steps = np.arange(lengths.max())[:, None]
    return np.where(steps < lengths, firsts + steps, fill)

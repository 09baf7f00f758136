"""Places along a Hilbert curve, for whole arrays of points (Skilling, 2004)."""

from __future__ import annotations

import numpy as np

KEY_BITS = 62


def grid(x: np.ndarray, reach: float) -> tuple[np.ndarray, int]:
    """Cells of values in -reach..reach (what lies beyond goes to the outer cells), and the bits of a cell number."""
    x = x[:, :KEY_BITS]  # more axes than a key has bits: the first ones order the points
    bits = max(1, min(16, KEY_BITS // max(1, x.shape[1])))
    cells = np.floor((x + reach) * ((1 << bits) / (2.0 * reach + 1)))
    return np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` along the curve through a grid of 2**bits cells per axis."""
    x = [cells[:, i].copy() for i in range(cells.shape[1])]
    if not x:
        return np.zeros(len(cells), np.int64)
    for b in range(bits - 1, 0, -1):  # undo the turns of the sub-cubes
        low = (1 << b) - 1
        for i in range(len(x)):
            set_ = (x[i] >> b) & 1
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> b) & 1)
    return key

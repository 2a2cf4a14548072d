"""Arithmetic in GF(2^8) for erasure coding, vectorised over whole blocks of bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

POLYNOMIAL = 0x11D
ROWS, COLUMNS = 9, 6


@lru_cache(maxsize=1)
def _product_table() -> np.ndarray:
    """256 x 256 products, by shift-and-add over the eight bits of one factor."""
    a = np.arange(256, dtype=np.int32)[:, None]
    b = np.arange(256, dtype=np.int32)[None, :]
    total = np.zeros((256, 256), dtype=np.int32)
    shifted = np.broadcast_to(a, (256, 256)).copy()
    for bit in range(8):
        total ^= np.where((b >> bit) & 1, shifted, 0)
        shifted <<= 1
        shifted ^= np.where(shifted & 0x100, POLYNOMIAL, 0)
    return total.astype(np.uint8)


def multiply(matrix: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Matrix product: (r x k) times (k x n bytes)."""
    table = _product_table()
    out = np.zeros((matrix.shape[0], block.shape[1]), dtype=np.uint8)
    for r in range(matrix.shape[0]):
        for k in range(matrix.shape[1]):
            if matrix[r, k] == 1:
                out[r] ^= block[k]
            elif matrix[r, k]:
                out[r] ^= table[matrix[r, k]][block[k]]
    return out


def invert(matrix: np.ndarray) -> np.ndarray:
    """Inverse by elimination; rows that are swapped in always exist for coding matrices."""
    table = _product_table()
    n = matrix.shape[0]
    work = np.concatenate([matrix.astype(np.uint8), np.eye(n, dtype=np.uint8)], axis=1)
    for col in range(n):
        pivot = col + int(np.flatnonzero(work[col:, col])[0])
        work[[col, pivot]] = work[[pivot, col]]
        work[col] = table[int(np.flatnonzero(table[work[col, col]] == 1)[0])][work[col]]
        for row in range(n):
            if row != col and work[row, col]:
                work[row] ^= table[work[row, col]][work[col]]
    return work[:, n:]


@lru_cache(maxsize=1)
def coding_matrix() -> np.ndarray:
    """Systematic 9 x 6 matrix: powers of the row number, scaled so the top is the identity.

    Any six of its rows are independent, since they are rows of a Vandermonde matrix times one
    fixed invertible matrix.
    """
    table = _product_table()
    powers = np.ones((ROWS, COLUMNS), dtype=np.uint8)
    for c in range(1, COLUMNS):
        powers[:, c] = table[powers[:, c - 1], np.arange(ROWS)]
    return multiply(powers, invert(powers[:COLUMNS]))

"""Sparse vectors in Arrow columns: usable spectra as sums per bin, in flat NumPy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """values (NaN for null), lengths, null mask of a list column."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    null = col.is_null().to_numpy(zero_copy_only=False)
    lengths = np.diff(col.offsets.to_numpy()) if len(col) else np.zeros(0, np.int64)
    lengths = np.where(null, 0, lengths)
    v = col.flatten()
    v = v.cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.asarray(v, float), lengths.astype(np.int64), null


def binned(mz: pa.Array, intensity: pa.Array, width: float = 0.1, least_peaks: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """row, offsets, bins, weights of the usable spectra among the rows.

    A spectrum is usable if both lists are there, equally long and hold at least `least_peaks` peaks whose two numbers
    are finite and above zero; other peaks are ignored. Bins ascend within a spectrum; weights have length one.
    """
    m, lm, nm = _flat(mz)
    i, li, ni = _flat(intensity)
    good = (lm == li) & ~nm & ~ni
    row_m, row_i = np.repeat(np.arange(len(lm)), lm), np.repeat(np.arange(len(li)), li)
    m, row, i = m[good[row_m]], row_m[good[row_m]], i[good[row_i]]
    with np.errstate(invalid="ignore"):
        peak = np.isfinite(m) & np.isfinite(i) & (m > 0) & (i > 0)
    m, row, i = m[peak], row[peak], i[peak]
    enough = np.bincount(row, minlength=len(lm)) >= least_peaks
    keep = enough[row]
    m, row, i = m[keep], row[keep], i[keep]
    b = np.floor(m / width).astype(np.int64)
    order = np.lexsort((b, row))
    row, b, i = row[order], b[order], i[order]
    start = np.ones(len(b), bool)
    start[1:] = (row[1:] != row[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(start)
    w = np.add.reduceat(i, at) if len(at) else np.zeros(0)
    row, b = row[at], b[at]
    rows, first = np.unique(row, return_index=True)
    # scaled by the largest before squaring, as intensities come on any scale
    if len(rows):
        size = np.diff(np.append(first, len(row)))
        w = w / np.repeat(np.maximum.reduceat(w, first), size)
        w = w / np.repeat(np.sqrt(np.add.reduceat(w * w, first)), size)
    return rows, np.append(first, len(row)).astype(np.int64), b, w


def strongest(offsets: np.ndarray, bins: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """The m strongest bins of each vector in ascending order, -1 where there are fewer; of equal weights the smaller bin."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    order = np.lexsort((bins, -np.round(weights, 9), row))
    rank = np.arange(len(order)) - np.repeat(offsets[:-1], np.diff(offsets))
    top = rank < m
    out = np.full((n, m), -1, np.int64)
    out[row[order][top], rank[top]] = bins[order][top]
    return np.sort(out, axis=1)


def as_binary(offsets: np.ndarray, bins: np.ndarray, weights: np.ndarray) -> pa.Array:
    """Each vector as bytes: its bins as int32, then its weights as float64."""
    b, w = bins.astype("<i4"), weights.astype("<f8")
    return pa.array([b[s:e].tobytes() + w[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())


def from_binary(rows: list[bytes], kind: str = "<f8") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """offsets, bins, weights of vectors written by as_binary, or the like with weights of another kind."""
    n = np.array([len(r) // (4 + np.dtype(kind).itemsize) for r in rows], np.int64)
    off = np.append(0, np.cumsum(n))
    b = np.empty(off[-1], np.int64)
    w = np.empty(off[-1])
    for k, r in enumerate(rows):
        c = n[k]
        b[off[k] : off[k + 1]] = np.frombuffer(r, "<i4", c)
        w[off[k] : off[k + 1]] = np.frombuffer(r, kind, c, 4 * c)
    return off, b, w

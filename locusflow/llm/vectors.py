"""Vector columns as matrices inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def usable(column: pa.Array) -> np.ndarray:
    """Which rows hold a vector without null or non-finite components."""
    lists = column.cast(pa.list_(pa.float64()))
    flat = lists.flatten()
    bad = ~np.isfinite(pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(bad)])[np.concatenate([[0], np.cumsum(sizes)])]
    return (np.diff(ends) == 0) & pc.is_valid(column).to_numpy(zero_copy_only=False)


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors as rows, in double precision; shorter ones are filled up with zeros."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    width = max(width or 0, int(sizes.max(initial=0)))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    """``m`` with zero columns added up to ``width``."""
    return m if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))

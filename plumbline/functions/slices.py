"""Batches of texts in slices, so that what Python makes of them at once follows bytes, not rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def in_slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of a batch, cut where ``size`` bytes of text are reached, so that what is made of them at once stays small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield at, texts.slice(at, to - at)
        at = to

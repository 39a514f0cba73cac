"""Words of whole texts as Arrow and numpy arrays.

A word is ``[^\\x20\\x09-\\x0D]+``.  A null or empty text has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that a worker turns into words at a time (a longer text is alone in its slice).
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``most`` bytes of texts each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(flat words, offsets): words ``offsets[i]:offsets[i + 1]`` are those of text ``i``."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False).astype(bool)
    if not real.all():  # blanks at the ends of a text leave empty parts
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        flat = flat.filter(pa.array(real))
    return flat, bounds


def join(flat: pa.Array, bounds: np.ndarray, keep: np.ndarray | None = None) -> pa.Array:
    """The words of each text joined by one space; with ``keep``, only those it marks."""
    if keep is not None and not keep.all():
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        flat = flat.filter(pa.array(keep))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)
    return pc.binary_join(lists, pa.scalar(" ", flat.type))

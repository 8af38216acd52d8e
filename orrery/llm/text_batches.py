"""Arrow batches of texts cut into parts of bounded size (inside Arrow tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def parts(batches, text: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in parts whose ``text`` holds about ``most_bytes``
    bytes, but one row at least. A long text is never cut."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < b.num_rows:
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + most_bytes, side="right")))
            yield b.slice(start, stop - start)
            start = stop


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A batch of ``schema`` from arrays or lists in its order."""
    cols = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(cols, schema=schema)


class Numbers(dict):
    """Numbers things by their first look-up; ``new`` holds those numbered since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, x) -> int:
        self[x] = n = len(self)
        self.new.append(x)
        return n

    def of(self, xs, count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, xs), np.int64, count)

    def keep(self, chosen: np.ndarray) -> None:
        """Forget all but those whose numbers are ``chosen`` (ascending), numbered anew."""
        things = list(self)
        self.clear()
        for i in chosen.tolist():
            self[things[i]] = len(self)


def often(uses: np.ndarray, most: int) -> np.ndarray:
    """Numbers of at most ``most`` of the things that were used more than once, the most used."""
    again = np.flatnonzero(uses > 1)
    return again if len(again) <= most else np.sort(again[np.argsort(uses[again])[-most:]])


def take_runs(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches ``flat[starts[i]:starts[i] + sizes[i]]`` one after another."""
    return flat[np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)]

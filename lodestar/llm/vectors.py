"""What both vector operators need: which vectors take part, and runs of equal keys in a sorted stream."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def takes_part(vector: str) -> Column:
    """Not null, not zero, and each component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def units(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length 1; first to a largest component of 1, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the rows that agree in the first `keys` columns, from batches in which such rows are adjacent."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)

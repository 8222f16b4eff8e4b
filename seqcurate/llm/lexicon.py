"""Runs of letters in texts, as exact strings, and their counts within a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import LOWER, utf8

#: Rows of counts that a task gathers before it adds up equal ones.
GATHER = 1 << 19


def tokens(column: pa.Array, inside: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The maximal runs of bytes that `inside` marks, A-Z in lower case: of each run the code of its string and the number of its text; and the strings by code."""
    data, at = utf8(column)
    keep = inside(data)
    n = len(data)
    begins, ends = keep.copy(), keep.copy()
    begins[1:] &= ~keep[:-1]
    ends[:-1] &= ~keep[1:]
    edge = at[(at > 0) & (at < n)]  # a run ends with its text
    begins[edge] |= keep[edge]
    ends[edge - 1] |= keep[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    strings = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[keep]])])
    coded = strings.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, np.searchsorted(at, start, "right") - 1


def per_text(codes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code, times) of the distinct codes of each text; codes are below `size`."""
    key, times = np.unique(doc * max(size, 1) + codes, return_counts=True)
    return key // max(size, 1), key % max(size, 1), times


def summed(tables: Iterator[pa.Table], keys: list[str], sums: list[str]) -> Iterator[pa.RecordBatch]:
    """The tables with rows of equal keys added up, as far as GATHER rows at once allow."""
    held: list[pa.Table] = []

    def added() -> pa.Table:
        table = pa.concat_tables(held).group_by(keys).aggregate([(s, "sum") for s in sums])
        return table.select([*keys, *(f"{s}_sum" for s in sums)]).rename_columns([*keys, *sums])

    for table in tables:
        held.append(table)
        if sum(map(len, held)) > GATHER:
            one = added()
            held = [one]
            if len(one) > GATHER // 2:
                yield from one.to_batches(max_chunksize=1 << 16)
                held = []
    if held:
        yield from added().to_batches(max_chunksize=1 << 16)


def strings_of(dictionary: pa.Array, codes: np.ndarray) -> pa.Array:
    return pc.take(dictionary, pa.array(codes)).cast(pa.string())

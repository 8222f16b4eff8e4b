"""Connected components by contraction of links in parts, and jumps to the next node above."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_counted

#: Links that a task contracts at once.
CHUNK = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between u and v: each node that reaches a smaller one by them, and the smallest that it reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]
    below = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[below], nodes[low[below]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v), u > v, contracted to stars, CHUNK of them at once. Of links sorted by u, those of one u all come to the same star, however many they are."""

    def out(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    held, size = [], 0
    for batch in batches:
        if len(batch):
            held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
            size += len(batch)
        if size >= CHUNK:
            last = held[-1][0][-1]  # its next links may be still to come
            u, v = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield out(u[u != last], v[u != last])
            held, size = [(u[u == last], v[u == last])], 1
    if held:
        yield out(*stars(*(np.concatenate(x) for x in zip(*held, strict=True))))


def components(links: DataFrame, roots: bool = True) -> DataFrame:
    """links: (a, b), of longs. Returns (node, component), component being the smallest node reachable, for every node of a link; without `roots` only nodes that are not their component themselves.

    Each task contracts what links it has, so a node with very many leaves as many as there are tasks at most; these meet by their larger node, are contracted again, and
    each then jumps to the node above the one it is linked with, by a join with a row for each node. Links only ever go to smaller nodes, so once a step changes none, each node is linked to
    its component only, after about the logarithm of the longest path. Each step is written to the shared folder."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    before = None
    while True:
        near = edges.mapInArrow(_contract, "u long, v long").repartition("u").sortWithinPartitions("u").mapInArrow(_contract, "u long, v long")
        above = near.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("w"))
        edges, now = cut_counted(near.join(above, "v", "left").select("u", F.coalesce("w", "v").alias("v")), n=F.count(F.lit(1)), of=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        if now == before or not now["n"]:
            break
        before = now
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    if not roots:
        return found
    return found.unionByName(edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))

"""Approximate nearest neighbours by a forest of sorted hash strings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import search, usable

#: Trees, bits of a hash string, and how many vectors a query looks at in a shard: so many times the root of (k times the shard's vectors).
TREES, BITS, WIDTH = 256, 16, 6.0
#: Queries whose spans are held at once.
ASKED = 256


class PrefixForest:
    """In each tree, every vector has a string of bits: the signs of its projections on random directions. The strings
    are kept as sorted arrays of numbers, so all that share a prefix with a query stand together."""

    def __init__(self, matrix: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.size, self.bits = len(matrix), bits
        self.planes = rng.standard_normal((trees, matrix.shape[1], bits))
        self.center = matrix.mean(0)
        self.weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        self.sorted, self.rows = [], np.empty((trees, self.size), np.int32)
        for t in range(trees):
            code = self.codes(matrix, t)
            self.rows[t] = np.argsort(code, kind="stable")
            self.sorted.append(code[self.rows[t]])

    def codes(self, matrix: np.ndarray, tree: int) -> np.ndarray:
        return ((matrix - self.center) @ self.planes[tree] > 0) @ self.weights

    def spans(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, number of low bits left out and tree: where the vectors with the same prefix begin and end."""
        low = np.arange(self.bits + 1, dtype=np.int64)
        begin = np.empty((len(queries), self.bits + 1, len(self.rows)), np.int32)
        end = np.empty_like(begin)
        for t, codes in enumerate(self.sorted):
            first = (self.codes(queries, t)[:, None] >> low) << low
            begin[:, :, t] = np.searchsorted(codes, first.ravel()).reshape(first.shape)
            end[:, :, t] = np.searchsorted(codes, (first + (np.int64(1) << low)).ravel()).reshape(first.shape)
        return begin, end

    def candidates(self, begin: np.ndarray, end: np.ndarray, wanted: int) -> np.ndarray:
        """begin, end: the spans of one query. Descends to the longest prefixes, then ascends in all trees at once, a bit at a
        time, until `wanted` different vectors are met; of the last level, tree by tree. Levels whose spans together are
        too few to hold that many are passed at once."""
        wanted = min(wanted, self.size)
        seen, flat = np.zeros(self.size, bool), self.rows.ravel()
        lengths = end - begin
        for level in range(int(np.flatnonzero(lengths.sum(1) >= wanted)[0]), self.bits + 1):
            n = lengths[level]
            at = np.repeat(begin[level] + np.arange(len(n)) * self.size - (np.cumsum(n) - n), n) + np.arange(n.sum())
            new = flat[at]
            new = new[~seen[new]]
            room = wanted - np.count_nonzero(seen)
            first = np.unique(new, return_index=True)[1]
            seen[new[np.sort(first)[:room]]] = True
            if len(first) >= room:
                break
        return np.flatnonzero(seen)


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed component by component, so equal vectors have equal scores wherever they stand."""
    out = np.zeros(len(rows))
    for d in range(len(query)):
        out += rows[:, d] * query[d]
    return out


def _within(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    forest = PrefixForest(matrix)
    wanted = max(k + 1, int(WIDTH * (k * len(ids)) ** 0.5))
    place, found, value = [], [], []
    for start in range(0, len(queries), ASKED):
        begin, end = forest.spans(queries[start : start + ASKED])
        for j, q in enumerate(queries[start : start + ASKED]):
            near = forest.candidates(begin[j], end[j], wanted)
            near = near[ids[near] != query_ids[start + j]]
            rough = matrix[near] @ q
            if len(near) > k:
                cut = np.partition(rough, len(rough) - k)[len(rough) - k]
                near = near[rough >= cut - 1e-9 * (1 + abs(cut))]
            score = inner(matrix[near], q)
            best = np.lexsort((ids[near], -score))[:k]
            place.append(np.full(len(best), start + j))
            found.append(ids[near][best])
            value.append(score[best])
    return np.concatenate(place), np.concatenate(found), np.concatenate(value)


def approximate_top_k(vectors: DataFrame, query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20) -> DataFrame:
    """Each query's k nearest found, by largest inner product: query_id, rank int, vec_id, score double (exactly, of the vectors as given).

    Queries are the rows of which `query` holds, once for each id; candidates every row with another id. All candidates, if there
    are fewer than k; ties to the smaller id. Rows without an id and vectors that are null, empty, zero or hold null, NaN or infinite components take no
    part; vectors of another length than the query's are no candidates. An empty table gives no rows.

    Every row is in the index: a hash-prefix forest for each shard (see blocks.search). A query looks at WIDTH * sqrt(k * n) of a shard's n vectors,
    by one rule at every size: those with the longest prefixes in common in any tree. Of a shard of 36 * k or fewer that is all."""
    clean = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), query.alias("asked"))
    clean = clean.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).where(F.exists("v", lambda x: x != 0))
    return search(clean, F.coalesce(F.col("asked"), F.lit(False)), k, _within, "double")

"""Exact top-k search by inner product: best-first search in an M-tree."""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import search, usable

#: Entries of a page.
PAGE = 128


class MTree:
    """Paged metric tree over points whose distance is Euclidean.

    A page has a routing object (the one of its points that is nearest to their mean), a covering radius and the distance of each entry to that object. To make the largest inner
    product the nearest point, each vector x gets the component sqrt(M^2 - |x|^2), M the largest norm, and a query gets 0:
    distance^2 = M^2 + |q|^2 - 2 q.x, and the triangle inequality holds."""

    def __init__(self, matrix: np.ndarray, page: int = PAGE):
        norms = (matrix**2).sum(1)
        self.top = float(norms.max())
        self.points = np.column_stack([matrix, np.sqrt(np.maximum(self.top - norms, 0))])
        self.pages: list[dict] = []
        self.root = self._build(np.arange(len(matrix)), page)

    def _build(self, rows: np.ndarray, page: int) -> int:
        mean = self.points[rows].mean(0)
        center = self.points[rows[int(((self.points[rows] - mean) ** 2).sum(1).argmin())]]
        away = np.sqrt(((self.points[rows] - center) ** 2).sum(1))
        node = {"center": center, "radius": float(away.max())}
        if len(rows) <= page or node["radius"] == 0:
            order = np.argsort(away, kind="stable")
            node |= {"rows": rows[order], "away": away[order]}
        else:
            far = self.points[rows[int(away.argmax())]]
            other = self.points[rows[int(((self.points[rows] - far) ** 2).sum(1).argmax())]]
            side = np.argsort(self.points[rows] @ (other - far), kind="stable")
            groups = np.array_split(side, min(8, -(-len(rows) // page)))
            node["children"] = [self._build(rows[np.sort(g)], page) for g in groups]
            node["away"] = np.array([np.sqrt(((self.pages[c]["center"] - center) ** 2).sum()) for c in node["children"]])
            node["reach"] = np.array([self.pages[c]["radius"] for c in node["children"]])
            node["centers"] = np.stack([self.pages[c]["center"] for c in node["children"]])
        self.pages.append(node)
        return len(self.pages) - 1

    def nearest(self, matrix: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k rows (score, id) of largest inner product, ties to smaller ids, but those whose id is `own`. matrix holds whole numbers."""
        q = np.append(query, 0.0)
        base = self.top + float(query @ query)
        slack = 1e-7 * (1 + base)
        best: list[tuple[float, int]] = []  # a heap of (score, -id)
        bound = np.inf  # squared distance of the k-th
        at = float(np.sqrt(((q - self.pages[self.root]["center"]) ** 2).sum()))
        queue = [(max(0.0, at - self.pages[self.root]["radius"]), self.root, at)]
        while queue:
            low, number, at = heapq.heappop(queue)
            if low * low > bound + slack:
                break
            node = self.pages[number]
            limit = np.sqrt(bound + slack)
            if "rows" in node:
                near = node["rows"][np.abs(at - node["away"]) <= limit] if np.isfinite(limit) else node["rows"]
                near = near[ids[near] != own]
                value = matrix[near] @ query
                if len(near) > k:
                    order = np.lexsort((ids[near], -value))[:k]
                    near, value = near[order], value[order]
                for s, i in zip(value.tolist(), ids[near].tolist(), strict=True):
                    entry = (s, -i)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    bound = base - 2 * best[0][0]
            else:
                open_ = np.flatnonzero(np.abs(at - node["away"]) - node["reach"] <= limit)  # by stored distances, nothing computed
                away = np.sqrt(((node["centers"][open_] - q) ** 2).sum(1))
                for c, d in zip(open_.tolist(), away.tolist(), strict=True):
                    low = max(0.0, d - float(node["reach"][c]))
                    if low * low <= bound + slack:
                        heapq.heappush(queue, (low, node["children"][c], d))
        return [(int(s), -i) for s, i in sorted(best, key=lambda x: (-x[0], -x[1]))]


def _within(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    tree = MTree(matrix)
    place, found, value = [], [], []
    for j, q in enumerate(queries):
        for s, i in tree.nearest(matrix, ids, q, int(query_ids[j]), k):
            place.append(j)
            found.append(i)
            value.append(s)
    return np.array(place, np.int64), np.array(found, np.int64), np.array(value, np.int64)


def exact_top_k(vectors: DataFrame, query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5, scale: float = 256.0) -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank int, vec_id, score long.

    A component x counts as floor(scale * x), x as double; products of whole numbers below 2^53 are exact. Queries are the rows of which
    `query` holds, once for each id; candidates every row with another id, so a row that repeats under another query's id can
    come up twice. Fewer candidates give fewer rows; ties go to the smaller id. Rows without an id and vectors that are null, empty or hold null, NaN or
    infinite components take no part; vectors of another length than the query's are no candidates. An empty table gives no rows.

    Every shard of the vectors has an M-tree of its own (see blocks.search), searched best-first."""
    clean = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), query.alias("asked")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    whole = clean.select("vec_id", "asked", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("double")).alias("v"))
    return search(whole, F.coalesce(F.col("asked"), F.lit(False)), k, _within, "long")

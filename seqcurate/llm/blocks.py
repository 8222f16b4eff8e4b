"""A query set against all vectors, in blocks: what exact and approximate vector search share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of an index shard and queries of a block, on average; a task holds one of each. Blocks are large, as a shard is sent and indexed once for each.
SHARD, QUERIES = 8192, 32_768
#: Partitions of the search at most; with more pairs of shard and block a task has several, one after the other.
TASKS = 50_000


def usable(embedding: Column) -> Column:
    """Whether a vector has components, none of them null or not finite. Never null."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(embedding) > 0) & fine, F.lit(False))


def search(vectors: DataFrame, query: Column, k: int, within: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]], score: str, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """vectors: (vec_id long, v array<double>). Returns query_id, rank, vec_id, score: the k best of each query over all shards.

    The rows are dealt by hash into shards of about `shard`; the queries (rows of which `query` holds, once for each id) into blocks
    of about `queries`. Every block meets every shard in one task, by a join key of the two numbers, and
    within(ids, matrix, query ids, query matrix, k) gives at most k rows for a query there: (place of the query, vec_id, score).
    The k rows of each shard are then ranked by score, falling, and vec_id."""
    counts = vectors.agg(F.count(F.lit(1)), F.count(F.when(query, 1))).first()
    shards, blocks = max(1, -(-counts[0] // shard)), max(1, -(-counts[1] // queries))
    rows = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = vectors.where(query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(own) and len(asking):
            own, asking = own.sort_values("vec_id", kind="mergesort"), asking.sort_values("vec_id")
            for width in sorted({len(v) for v in asking["v"]}):  # vectors of another length have no inner product
                a, b = own[own["v"].str.len() == width], asking[asking["v"].str.len() == width]
                if len(a):
                    ids = b["vec_id"].to_numpy()
                    place, found, value = within(a["vec_id"].to_numpy(), np.stack(a["v"].to_list()).astype(float), ids, np.stack(b["v"].to_list()).astype(float), k)
                    parts.append(pd.DataFrame({"query_id": ids[place], "vec_id": found, "score": value}))
        return pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    parts = min(shards * blocks, TASKS)
    rows, asked = rows.repartition(parts, "shard", "block"), asked.repartition(parts, "shard", "block")
    found = rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(run, f"query_id long, vec_id long, score {score}")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

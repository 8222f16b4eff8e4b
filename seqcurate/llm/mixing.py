"""Mixing sources to target weights: repeats from water-filled targets, the rest by balanced (cube) sampling."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, word_count

#: Units of a block of the flight phase; what is left of BLOCK // 2 blocks makes a block of the next round.
BLOCK = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes: (source, size). Returns a row for each source: source, source_size long, n_docs long, target double.

    Sources in the order of their code points, null last, take the weights in turn. `share` of all sizes is divided by weight; a
    target stops at `most` times its source's size and the excess goes to the others by weight. Solved in closed form: with the
    sources in the order in which they fill up, the level is (rest - capacities filled) / (weights left) at the first source it
    does not fill."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    one = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    df = total.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = one.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, left = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.lit(float(share)) * F.sum("source_size").over(one) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(left)
    df = df.withColumn("level", level).withColumn("fits", F.col("cap") <= F.col("level") * F.col("weight"))
    final = F.max(F.when(~F.col("fits"), F.col("level"))).over(one)  # from the first source that is not filled on, levels fall; sources that fill up alike are one step
    target = F.least("cap", F.coalesce(final * F.col("weight"), F.col("cap")))
    return df.select("source", "source_size", "n_docs", target.alias("target"))


def _uniform(seed: int, *columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def fly(p: list[float], size: list[float], draw: list[float]) -> list[float]:
    """Flight phase over one block, in the order given.

    Keeps the sum of p (documents) and of p * size (tokens) while it moves p: three open units leave a one-dimensional null-space
    of the two constraints; a step along it ends where a unit reaches 0 or 1, in a direction drawn so that every p keeps its mean.
    At most two units stay open, but for ties of size, which need one constraint only and so close further."""
    p = list(p)
    open_: list[int] = []
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        open_.append(i)
        while len(open_) > 1:
            same = next(((a, b) for k, a in enumerate(open_) for b in open_[k + 1 :] if size[a] == size[b]), None)
            if same:
                move = [(same[0], 1.0), (same[1], -1.0)]
            elif len(open_) == 3:
                a, b, c = open_
                move = [(a, size[c] - size[b]), (b, size[a] - size[c]), (c, size[b] - size[a])]
            else:
                break
            up = min((1 - p[k]) / u if u > 0 else p[k] / -u for k, u in move)
            down = min(p[k] / u if u > 0 else (1 - p[k]) / -u for k, u in move)
            step = up if draw[i] * (up + down) < down else -down
            draw[i] = (draw[i] * 7919.0 + 0.6180339887) % 1.0
            for k, u in move:
                p[k] += step * u
                if p[k] < 1e-9:
                    p[k] = 0.0
                elif p[k] > 1 - 1e-9:
                    p[k] = 1.0
            open_ = [k for k in open_ if 0.0 < p[k] < 1.0]
    return p


def _fly_block(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["order", "unit", "size"], kind="mergesort")
    group["p"] = fly(group["p"].tolist(), group["size"].astype(float).tolist(), group["draw"].tolist())
    return group[["unit", "source_no", "size", "p"]]


def cube_sample(units: DataFrame, seed: int = 0) -> DataFrame:
    """units: (unit long, source_no long, size long, p double). Returns (unit, chosen boolean) for each.

    Rounds of flights: units are dealt by hash into blocks of a source, every block closes all but about two of its units, and what
    stays open meets in fewer blocks, until a source has one. Landing: what that leaves, a few units of a source, is decided by a
    draw each. A source of any size is thus many blocks, and a task never holds more than a block of about BLOCK units."""
    closed, rest, round_ = [], units, 0
    while True:
        per = rest.where("p > 0 and p < 1").groupBy("source_no").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        dealt = rest.join(per, "source_no", "left").withColumn("block", F.pmod(F.xxhash64(F.lit(seed + round_), "unit"), F.coalesce("blocks", F.lit(1))))
        dealt = dealt.withColumn("order", F.xxhash64(F.lit(seed + 101 + round_), "unit")).withColumn("draw", _uniform(seed + 201 + round_, "unit"))
        dealt = dealt.repartition("source_no", "block")  # or the join's partitions by source would serve, one task for a source
        flown = cut(dealt.groupBy("source_no", "block").applyInPandas(_fly_block, "unit long, source_no long, size long, p double"))
        open_ = flown.where("p > 0 and p < 1")
        most = per.agg(F.max("blocks")).first()[0] or 1
        if most <= 1:
            return _union([*closed, flown]).select("unit", (F.col("p") > _uniform(seed + 301, "unit")).alias("chosen"))
        closed.append(flown.where("p <= 0 or p >= 1"))
        rest, round_ = open_, round_ + 1


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """A row for each document: doc_id, size, source, source_size, target, copies int, taken long (size * copies).

    Each document of a source is taken floor(target / source_size) times, and once more if balanced sampling chooses it with the
    fraction left as its probability, so that both the words and the documents taken from a source stay at the target but for
    one or two documents. Size: words of the text (null or empty: 0; such documents are never taken). A null source is a source of its own. Documents that
    agree in id, source and size are told apart by a running number, so repeated rows each have a result; an empty table gives an
    empty result. Reruns agree: every draw is a hash of those values and the seed."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    sizes = cut(rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")).select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("nth")))
    targets = cut(source_targets(sizes.select("source", "size"), weights, share, most))
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(times + 1e-12)
    joined = joined.withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(0).cast("int")).withColumn("p", F.when(F.col("size") > 0, F.greatest(F.lit(0.0), times - whole)).otherwise(0.0))
    joined = joined.withColumn("unit", F.xxhash64("doc_id", "source", "size", "nth"))
    open_ = joined.where("p > 0").select("unit", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()).alias("source_no"), "size", "p")
    chosen = cube_sample(open_, seed)
    out = joined.join(chosen, "unit", "left").withColumn("copies", F.col("whole") + F.coalesce(F.col("chosen"), F.lit(False)).cast("int"))
    return out.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))

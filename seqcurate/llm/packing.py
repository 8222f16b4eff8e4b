"""Best-fit packing into bins of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, word_count

#: Pieces that a block holds on average. A block is packed by one task, so it leaves a few half-filled bins, not more.
BLOCK = 4096
#: Tasks that pack at most; with more blocks than that a task has several.
TASKS = 50_000


def _pack(sizes: Sequence[int], opening: Callable[[int, int], int]) -> list[list]:
    """Best-fit decreasing. opening(size, words still to come) gives the capacity of a new bin. Returns [capacity, used, items]."""
    bins: list[list] = []
    free: list[tuple[int, int]] = []
    left = sum(sizes)
    for item, size in enumerate(sizes):
        at = bisect_left(free, (size, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = opening(size, left), len(bins)
            bins.append([room, 0, []])
        bins[b][1] += size
        bins[b][2].append(item)
        left -= size
        if room > size:
            insort(free, (room - size, b))
    return bins


def pack_block(sizes: Sequence[int], capacities: Sequence[int], costs: Sequence[float]) -> list[list]:
    """Packs sizes (falling) so that the sum of the bins' costs is least among these rules for opening a bin:
    the least cost for the words that can still go in, or always one of the capacities (a larger one if an item needs it).
    Every bin is then cut down to the cheapest capacity that holds its contents."""
    pairs = list(zip(capacities, costs, strict=True))

    def least_cost(size: int, left: int) -> int:
        return min((cost / min(c, left), c) for c, cost in pairs if c >= size)[1]

    def always(first: int) -> Callable[[int, int], int]:
        return lambda size, left: first if first >= size else min(c for c in capacities if c >= size)

    best, best_cost = None, float("inf")
    for rule in (least_cost, *map(always, capacities)):
        bins = _pack(sizes, rule)
        total = 0.0
        for b in bins:
            cost, b[0] = min((cost, c) for c, cost in pairs if c >= b[1])
            total += cost
        if total < best_cost:
            best, best_cost = bins, total
    return best or []


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str | None = "text", size: str | None = None, capacities: Sequence[int] = (512, 1024, 2048, 4096), costs: Sequence[float] | None = None, seed: int = 0) -> DataFrame:
    """A row for each piece of a document: doc_id, copy long, piece int, start long (first word of the piece, from 0), n_words long,
    bin_id long, capacity int, bin_words long, bin_offset long.

    Size: the column `size`, or the words of the text. A document longer than the largest capacity is cut into pieces of that
    length and a rest; none is dropped. A document with null or no text has no piece. costs: of a bin of each capacity; its length if not given, and 16 more.
    Pieces are dealt by hash into blocks of about BLOCK, so any number of rows of any kind spreads over tasks; each block is
    packed on its own, longest first, ties by document, copy and piece. Documents that agree in id and size are numbered by
    `copy`, from 1; a null id is an id like others, and ids are never changed. Other columns are left out, so their names can't clash. An empty table gives an empty result. Reruns agree."""
    capacities = sorted(set(capacities))
    costs = list(costs) if costs else [c + 16.0 for c in capacities]
    longest = capacities[-1]
    length = F.col(size).cast("long") if size else word_count(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), length.alias("total")).where("total > 0").groupBy("doc_id", "total").agg(F.count(F.lit(1)).alias("n"))
    copies = rows.select("doc_id", "total", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.col("total") - 1) / longest).cast("int"))).alias("piece")
    pieces = copies.select("doc_id", "copy", "total", piece).withColumn("start", F.col("piece").cast("long") * longest)
    pieces = cut(pieces.select("doc_id", "copy", "piece", "start", F.least(F.col("total") - F.col("start"), F.lit(longest).cast("long")).alias("n_words")))
    blocks = max(1, -(-pieces.count() // BLOCK))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "copy", "piece", "n_words"), F.lit(blocks)))
    kind = dict(pieces.dtypes)["doc_id"]
    dealt = dealt.repartition(min(blocks, TASKS), "block")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("copy", "ascending"), ("piece", "ascending")])
        sizes = group.column("n_words").to_pylist()
        bin_id, capacity, used, offset = ([0] * len(sizes) for _ in range(4))
        base = group.column("block")[0].as_py() << 20
        for k, (room, words, items) in enumerate(pack_block(sizes, capacities, costs)):
            at = 0
            for i in items:
                bin_id[i], capacity[i], used[i], offset[i] = base + k, room, words, at
                at += sizes[i]
        new = (pa.array(bin_id, pa.int64()), pa.array(capacity, pa.int32()), pa.array(used, pa.int64()), pa.array(offset, pa.int64()))
        for name, column in zip(("bin_id", "capacity", "bin_words", "bin_offset"), new, strict=True):
            group = group.append_column(name, column)
        return group.drop_columns("block")

    return dealt.groupBy("block").applyInArrow(run, f"doc_id {kind}, copy long, piece int, start long, n_words long, bin_id long, capacity int, bin_words long, bin_offset long")

"""Near-duplicate documents by an LSH forest of sorted MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, cut_counted, mix, pieces, rolling, utf8, words
from .components import components

#: Of so many pairs at the threshold one shares no region of any tree; a region's size up to which all neighbours are candidates.
MISS, REGION = 85_000, 16
#: Bits of a label, and pairs of one document that its set is sent to one task for.
BITS, LOT = 60, 64
#: Parts in which the rows of a large region are joined with what is known of the region.
SALTS = 16
#: Pairs that a rare difference (see settle) may make at once; beyond it, its documents are first compared with one of them.
BUCKET = 1024
#: Ids (of 8 bytes) that are broadcast to find their documents; if more are asked for, texts and ids are shuffled.
BROADCAST = 1 << 20
_BASE = 0xD6E8FEB86659FD93


def forest(percent: int) -> tuple[int, int]:
    """Trees, and minima that a region of a tree shares: of pairs at the threshold about 35 % share a tree's region, and all but one in MISS some tree's."""
    s = min(max(percent, 1), 95) / 100  # regions for 95 % hold the pairs of stricter thresholds, too
    depth = max(1, round(math.log(0.35) / math.log(s)))
    return math.ceil(math.log(MISS) / -math.log1p(-(s**depth))), depth


def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of n orders."""
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """Of every text the sorted distinct hashes of its k-word shingles, in lower case (A-Z); fewer words are one shingle."""
    h, _, _, doc = words(data, at, lower=True)
    edge = np.searchsorted(doc, np.arange(len(at)))
    long = rolling(h, k, _BASE)
    out = []
    for a, b in zip(edge, edge[1:], strict=False):
        if b - a >= k:
            out.append(np.unique(long[a : b - k + 1]))
        elif b > a:
            out.append(rolling(h[a:b], b - a, _BASE) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The signature of a set: under each of many orders of its members (see _orders), the least."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(low), 4096):
        h = (low[None, begin : begin + 4096] ^ offsets[:, None]) * factors[:, None]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out = np.minimum(out, h.min(1))
    return out


def _sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """docs: (doc_id, text). Adds n, the fingerprint (f1, f2) of the set, and its signature: for each tree a label of `depth` minima side by side, cut to
    the same number of bits, so that labels sort like the minima in turn and two share as many minima as their first bits."""
    trees, depth = forest(percent)
    factors, offsets = _orders(trees * depth)
    bits = min(32, BITS // depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                n, f1, f2, labels = [], [], [], []
                for s in shingle_sets(*utf8(part.column("text")), k):
                    n.append(len(s))
                    f1.append(mix(s + np.uint64(1)).sum(dtype=np.uint64))
                    f2.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    m = mix(minima(s, factors, offsets).astype(np.uint64)) >> np.uint64(64 - bits)  # mixed, as the least of many are small numbers
                    label = np.zeros(trees, np.uint64)
                    for level in range(depth):
                        label = (label << np.uint64(bits)) | m[level::depth]
                    labels.append(label.view(np.int64))
                if not n:
                    continue
                flat = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(x)), trees).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)), flat(labels)], names=["doc_id", "n", "f1", "f2", "labels"])

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, labels array<long>")


def _fits(percent: int):
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def regions(reps: DataFrame, percent: int) -> DataFrame:
    """reps: (rep, n, copies, labels). Returns (tree, label, further, rep, n, m, hub, hub_n): each document's place in each tree's order, if another shares its label.

    The orders of the forest are one signature, begun at each tree's minima in turn: an order's sort key is the tree's own label, then `further`, the next
    tree's. Documents with the same label are a region of m documents, those that stand together in the order with a common prefix of `depth` minima at
    least. Its hub is the document with most exact copies."""
    trees = forest(percent)[0]
    rows = reps.select("rep", "n", "copies", "labels", F.posexplode("labels").alias("tree", "label"))
    rows = rows.select("rep", "n", "copies", "tree", "label", F.element_at("labels", F.pmod(F.col("tree") + 1, F.lit(trees)) + 1).alias("further"))
    hub = F.max(F.struct("copies", (-F.col("rep")).alias("other"), "n"))
    shared = rows.groupBy("tree", "label").agg(F.count(F.lit(1)).alias("m"), hub.alias("hub")).where("m > 1")
    return rows.join(shared, ["tree", "label"]).select("tree", "label", "further", "rep", "n", "m", (-F.col("hub.other")).alias("hub"), F.col("hub.n").alias("hub_n"))


def neighbours(rows: DataFrame, percent: int) -> DataFrame:
    """rows: (tree, label, further, rep, n, m, component). Returns pairs (x, y) of different components that are neighbours in a tree's sorted order.

    Range partitions hold a stretch of an order each, sorted by the whole prefix. From a region's label on, the prefix is made longer until at most REGION
    documents share it, each region as deep as it needs; those are each other's neighbours, and everyone has at least the next one in the order, with whom
    its common prefix is longest. A region of at most REGION documents stays in one partition; a larger one may lie across several, where neighbours at the border are not met (see settle)."""
    depth = forest(percent)[1]
    bits = min(32, BITS // depth)
    names = ["tree", "label", "further", "rep", "n", "m", "component"]

    def pairs(t: dict[str, np.ndarray]) -> pa.RecordBatch:
        size = len(t["rep"])
        lcp = np.full(size + 1, -1)  # minima after the label that a row shares with the one before; -1 in another region
        same = (t["tree"][1:] == t["tree"][:-1]) & (t["label"][1:] == t["label"][:-1])
        apart = (t["further"][1:] ^ t["further"][:-1]).view(np.uint64)
        lcp[1:size] = np.where(same, sum((apart >> np.uint64(bits * (depth - level)) == 0).astype(np.int64) for level in range(1, depth + 1)), -1)
        reach, open_ = np.arange(1, size + 1), np.ones(size, bool)
        for level in range(depth + 1):
            run = np.cumsum(lcp[:size] < level) - 1
            length = np.bincount(run, minlength=1)
            fits = open_ & (length[run] <= REGION) & ((t["m"] <= REGION) | (level > 0))  # of a large region only a part may be here
            reach[fits] = np.cumsum(length)[run[fits]]
            open_ &= ~fits
        reach = np.maximum(reach, np.arange(1, size + 1) + (lcp[1:] >= 0))
        count = reach - np.arange(1, size + 1)
        x = np.repeat(np.arange(size), count)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
        low, high = np.minimum(t["n"][x], t["n"][y]), np.maximum(t["n"][x], t["n"][y])
        good = (t["component"][x] != t["component"][y]) & (low * 100 >= high * percent)
        return pa.RecordBatch.from_arrays([pa.array(t["rep"][x[good]]), pa.array(t["rep"][y[good]])], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = {c: batch.column(c).to_numpy() for c in names}
            if held is not None:
                t = {c: np.concatenate([held[c], t[c]]) for c in names}
            if not len(t["rep"]):
                continue
            last = int(np.flatnonzero((t["tree"] != t["tree"][-1]) | (t["label"] != t["label"][-1]))[-1:].sum() + 1) if (t["tree"][0], t["label"][0]) != (t["tree"][-1], t["label"][-1]) else 0
            whole = last if t["m"][-1] <= REGION else len(t["rep"])
            yield pairs({c: t[c][:whole] for c in names})
            begin = last if whole == last else max(last, whole - REGION)
            held = {c: t[c][begin:] for c in names}
        if held is not None and len(held["rep"]):
            yield pairs(held)

    wide = F.col("m") > REGION
    ordered = rows.select(*names).repartitionByRange("tree", "label", F.when(wide, F.col("further")), F.when(wide, F.col("rep"))).sortWithinPartitions("tree", "label", "further", "rep")
    return ordered.mapInArrow(run, "x long, y long")


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """rows: see regions. Returns pairs (x, y, m): neighbours in small regions, and in larger ones, of m documents, each y and the region's hub x.

    Pairs whose sizes alone exclude the similarity are left out."""
    near = neighbours(rows.where(F.col("m") <= REGION).withColumn("component", F.col("rep")), percent).withColumn("m", F.lit(1).cast("long"))
    star = rows.where((F.col("m") > REGION) & (F.col("rep") != F.col("hub"))).select(F.col("hub").alias("x"), F.col("rep").alias("y"), "m", F.col("n").alias("na"), F.col("hub_n").alias("nb")).where(_fits(percent)).select("x", "y", "m")
    return _once(near.unionByName(star))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair (x, y, m) once, whichever of its two is x: the one of the largest m."""
    one = pairs.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.max(F.struct("m", "x")).alias("top"))
    return one.select(F.col("top.x").alias("x"), F.when(F.col("top.x") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("y"), F.col("top.m").alias("m"))


def _binary_sets(docs: DataFrame, asked: DataFrame, few: bool, k: int) -> DataFrame:
    """(doc_id, s): the shingle hashes of the documents asked for, as bytes. few: the ids asked for are BROADCAST at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(*utf8(part.column("text")), k)], pa.binary())], names=["doc_id", "s"])

    # a shuffle of the texts to pick a part of them is what costs most
    return docs.join(F.broadcast(asked) if few else asked, "doc_id", "left_semi").mapInArrow(run, "doc_id long, s binary")


def _compare(docs: DataFrame, pairs: DataFrame, k: int, judge, more: list[str], schema: str) -> DataFrame:
    """pairs: (x, y, lots, *more). The rows that judge(set of x, set of y) gives for each: (x, y, *more, its value).

    x may be in very many pairs: these are dealt to `lots` lots by hash of y, and its set is sent to each lot once, where it stands before the sets of its
    y; no row holds two sets, and no task all the pairs of an x. y must not be in many pairs. docs may be a function of (asked, few) instead, see _binary_sets."""
    pairs, seen = cut_counted(pairs.withColumn("lot", F.pmod(F.xxhash64("y"), F.col("lots"))).drop("lots"), n=F.count(F.lit(1)))
    few = 2 * seen["n"] <= BROADCAST
    asked = pairs.select(F.explode(F.array("x", "y")).alias("doc_id"))
    asked = asked if few else asked.distinct()
    sets = docs(asked, few) if callable(docs) else _binary_sets(docs, asked, few, k)
    sent = pairs.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))  # x's set to each lot, and y's to its own
    sent = sent.select(F.when(F.col("own"), F.col("x")).otherwise(F.col("y")).alias("doc_id"), "lot", "x", *(F.when(~F.col("own"), F.col(c)).alias(c) for c in ("y", *more))).distinct()
    names = ["x", "y", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            place, found = [], []
            for i, (y, s) in enumerate(zip(batch.column("y"), batch.column("s"), strict=True)):
                s = np.frombuffer(s.as_buffer(), np.uint64)
                if not y.is_valid:
                    own = s
                    continue
                value = judge(own, s)
                if value is not None:
                    place.append(i)
                    found.append(value)
            kept = batch.take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in names), pa.array(found, kind)], names=[*names, "value"])

    both = sent.join(sets, "doc_id").select("lot", *names, "s").repartition("x", "lot").sortWithinPartitions("x", "lot", F.col("y").isNotNull())
    kind = pa.list_(pa.int64()) if schema.endswith("array<long>") else pa.bool_()
    return both.mapInArrow(run, schema)


def confirm(docs: DataFrame, pairs: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs (x, y, m) with 100 * |X and Y| >= percent * |X or Y|, counted on the full sets, as (a, b). docs: (doc_id, text), one row for each id."""

    def judge(x: np.ndarray, y: np.ndarray) -> bool | None:
        both = np.sort(np.concatenate([x, y]))
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= percent * (len(both) - common) or None

    pairs = pairs.select("x", "y", F.ceil(F.col("m") / LOT).cast("int").alias("lots"))
    return _compare(docs, pairs, k, judge, [], "x long, y long, value boolean").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, k: int = 5) -> DataFrame:
    """A row for each document: doc_id, n_shingles long, component_id long, kept boolean.

    Words are those of `common.WORD`, A-Z in lower case; the set of a document its distinct k-word shingles, or with fewer words all of them as one; of
    a null or empty text empty, and linked with nothing. Documents with 100 * intersection >= percent * union are linked; component_id
    is the smallest id that links reach, its own included; kept: the two are equal, so of repeated ids each row is kept. Rows without an id have no component and are kept; they
    link nothing. An empty table gives an empty result.

    Documents with equal sets are one class from the start, found by a fingerprint of 128 bits and a pre-aggregated minimum, however many they are. The smallest id
    of each goes into the forest (see regions), where neighbours in the sorted orders are candidates, and pairs are confirmed on full sets. A pair at the
    threshold shares no region of the forest once in MISS. Large regions are linked to their hubs first; where that leaves them in several components, neighbours
    with longer common prefixes follow (see deepen), and what is open then is settled exactly (see settle)."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = given.where(F.col("doc_id").isNotNull())
    sets = cut(_sets(known, k, percent))
    classes = sets.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels"))
    classes = cut(classes)
    rows, seen = cut_counted(regions(classes, percent), large=F.count_if(F.col("m") > REGION))
    texts = known.groupBy("doc_id").agg(F.min("text").alias("text")) if _repeats(sets) else known
    links = cut(confirm(texts, candidates(rows, percent), percent, k))
    found = components(links, roots=False)
    rows = rows.where(F.col("m") > REGION)
    if seen["large"]:
        links = cut(deepen(texts, rows, found, percent, k))
        found = settle(texts, cut(rows.where("rep <> hub").select("hub", "hub_n", "rep", "n").distinct()), links, found, percent, k)
    member = classes.select("f1", "f2", "n", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", "n", F.coalesce("component", "rep").alias("component"))
    out = sets.select("doc_id", "n", "f1", "f2").join(member, ["f1", "f2", "n"], "left")
    component = F.coalesce("component", "doc_id")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
    return out.unionByName(_sets(given.where(F.col("doc_id").isNull()), k, percent).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def _repeats(sets: DataFrame) -> bool:
    return not sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()


def deepen(docs: DataFrame, rows: DataFrame, found: DataFrame, percent: int, k: int) -> DataFrame:
    """The links of neighbours in those large regions that are not of one component (see found). rows: of large regions (see regions)."""
    rows = rows.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = rows.groupBy("tree", "label").agg(F.min("component").alias("one"), F.max("component").alias("other")).where("one <> other").select("tree", "label")
    # a region's rows are joined in SALTS parts, so that one of very many documents is not one task's
    salted = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).join(salted, ["tree", "label", "salt"], "left_semi")
    near = neighbours(rows, percent).withColumn("m", F.lit(1).cast("long"))
    return confirm(docs, _once(near), percent, k)


def _differences(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """members (hub, hub_n, rep, n, component, ours) with d, the sorted hashes of the shingles that only one of rep and hub has."""
    more = ["hub_n", "n", "component", "ours"]
    pairs = members.select(F.col("hub").alias("x"), F.col("rep").alias("y"), *more, F.lit(LOT).alias("lots"))
    judge = lambda x, y: np.setxor1d(x, y, assume_unique=True).view(np.int64)
    return _compare(docs, pairs, k, judge, more, "x long, y long, hub_n long, n long, component long, ours boolean, value array<long>").withColumnsRenamed({"x": "hub", "y": "rep", "value": "d"})


def _merge(large: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """large with fewer hubs: where a hub is itself a member of larger regions, their largest one's hub takes its members over (two steps up).
    And (hub, top) of all hubs there were, and whether these are so few that they may be broadcast.

    A document in the regions of several hubs of one group is then compared with one of them, not with each."""
    size, seen = cut_counted(large.groupBy("hub").agg(F.struct(F.count(F.lit(1)).alias("m"), (-F.col("hub")).alias("other"), F.max("hub_n").alias("n")).alias("top")), n=F.count(F.lit(1)))
    few = seen["n"] * 8 <= BROADCAST
    some = F.broadcast if few else (lambda df: df)
    above = large.join(some(size), "hub").select(F.col("rep").alias("hub"), "top").join(some(size.select("hub")), "hub", "left_semi")
    root = cut(size.unionByName(above).groupBy("hub").agg(F.max("top").alias("top")))
    for _ in range(2):
        large = large.join(some(root), "hub").select((-F.col("top.other")).alias("hub"), F.col("top.n").alias("hub_n"), "rep", "n")
    return large.where("rep <> hub").distinct(), root, few


def settle(docs: DataFrame, large: DataFrame, links: DataFrame, found: DataFrame, percent: int, k: int) -> DataFrame:
    """The components once the pairs of large regions that no component holds together are compared. large: (hub, hub_n, rep, n), without hubs.

    Of sets x and y in a hub's region let a and b be the numbers of shingles in which they differ from the hub. They differ from each other in a + b less
    twice what those differences share, and similar sets differ in h = (100 - percent) / (100 + percent) of their sizes' sum at most. So they share
    t = (a + b - h) / 2 differences, and in one order of all differences, rarest first, one of the first a - t + 1 and b - t + 1 (a prefix filter).
    If t is 0 or less, both are linked with the hub. Documents that changed a text in different ways share only frequent differences, and meet nowhere.

    Hubs are merged first, so hub and member may not have been compared yet; those that prove similar are linked, too.
    found: the components (see components, without roots) before deepen's links, which are `links`. Where the hub's component has all members of its regions, nothing is open. Elsewhere a difference counts only if a member outside that component has it,
    since one of two members to compare is outside; the others are left out of the sets before these are ordered, which takes no shared one away.

    A difference with which more than BUCKET pairs would meet is put off: first its documents are compared with the least of them,
    then those that are still in different components with each other."""
    same = found.withColumnRenamed("node", "rep")
    c = (100 - percent) / (100 + percent)
    members, hubs, few = _merge(large)
    some = F.broadcast if few else (lambda df: df)
    of_hub = same.select(F.col("rep").alias("hub"), F.col("component").alias("hub_component")).join(some(hubs.select("hub")), "hub", "left_semi")
    members = members.join(same, "rep", "left").withColumn("component", F.coalesce("component", "rep")).join(some(of_hub), "hub", "left")
    members = cut(members.withColumn("ours", F.col("component") == F.coalesce("hub_component", "hub")).drop("hub_component"))
    members = members.join(some(members.where("not ours").select("hub").distinct()), "hub", "left_semi")
    rows = cut(_differences(docs, members, k).select("hub", "hub_n", "rep", "n", "component", "ours", F.size("d").alias("d"), F.explode("d").alias("e")))
    common = (F.col("n") + F.col("hub_n") - F.col("d")) / 2
    new = rows.where(~F.col("ours") & (100 * common >= percent * (F.col("n") + F.col("hub_n") - common))).select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    joined = F.col("node").alias("a"), F.col("component").alias("b")  # what holds a component together
    links = links.unionByName(found.select(*joined)).unionByName(cut(new))
    often = rows.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("m"), F.count_if(~F.col("ours")).alias("outside")).where("m > 1 and outside > 0")
    left = F.row_number().over(Window.partitionBy("hub", "rep").orderBy(F.desc("m"), F.desc("e")))  # differences from here on, rarest first
    rows = rows.join(often, ["hub", "e"]).withColumn("left", left)
    most = F.floor(F.col("n") * (100 - percent) / percent)  # differences from any similar set
    # Of two components one is not the hub's, and a set outside it has more differences than c of its size and the hub's.
    shared = F.when(F.col("ours"), F.ceil((F.floor(F.col("d") + c * (F.col("hub_n") - F.col("n")) - 1e-6) + 1) / 2)).otherwise(F.ceil((2 * F.col("d") - most) / 2))
    rows = rows.withColumn("small", F.col("left") >= F.greatest(shared, F.lit(1))).withColumn("wide", F.col("left") >= F.greatest(F.col("d") - most, F.lit(1)))
    rows = cut(rows.where("small or wide").select("hub", "e", "rep", "n", "d", "left", "component", "small", "wide"))
    met = rows.groupBy("hub", "e").agg((F.count_if("small") * F.count_if("wide")).alias("pairs"), F.min("rep").alias("least"), F.min_by("n", "rep").alias("least_n"))
    rows = rows.join(met.where("pairs > 0"), ["hub", "e"])
    crowded, put_off = cut_counted(rows.where(F.col("pairs") > BUCKET), n=F.count(F.lit(1)))
    star = crowded.where("rep <> least").select(F.least("rep", "least").alias("a"), F.greatest("rep", "least").alias("b"), F.col("n").alias("na"), F.col("least_n").alias("nb")).where(_fits(percent)).select("a", "b")
    more = cut(_meet(rows.where(F.col("pairs") <= BUCKET), percent, c).unionByName(star).distinct())
    lone = lambda pairs: pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), F.lit(LOT * 16).cast("long").alias("m"))
    found = components(links.unionByName(cut(confirm(docs, lone(more), percent, k))), roots=False)
    if not put_off["n"]:
        return found
    crowded = crowded.drop("component").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    last, seen = cut_counted(_meet(crowded, percent, c).distinct().join(more, ["a", "b"], "left_anti"), n=F.count(F.lit(1)))
    return components(found.select(*joined).unionByName(cut(confirm(docs, lone(last), percent, k))), roots=False) if seen["n"] else found


def _meet(rows: DataFrame, percent: int, c: float) -> DataFrame:
    """Pairs (a, b) of different components that share a difference early enough in both (see settle)."""
    side = lambda x, test: rows.where(test).select("hub", "e", *(F.col(y).alias(x + y) for y in ("rep", "n", "d", "left", "component")))
    t = F.greatest(F.ceil((F.col("x_d") + F.col("y_d") - F.floor(c * (F.col("x_n") + F.col("y_n")) + 1e-6)) / 2), F.lit(1))
    ordered: Column = (F.col("x_d") < F.col("y_d")) | ((F.col("x_d") == F.col("y_d")) & (F.col("x_rep") < F.col("y_rep")))
    early = (F.col("x_left") >= t) & (F.col("y_left") >= t)
    fits = F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent
    x, y = side("x_", "small"), side("y_", "wide").withColumnsRenamed({"hub": "y_hub", "e": "y_e"})
    near = (F.col("hub") == F.col("y_hub")) & (F.col("e") == F.col("y_e")) & ordered & (F.col("x_component") != F.col("y_component")) & fits & early
    return x.join(y, near).select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b"))

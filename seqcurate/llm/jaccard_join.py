"""Exact joins of documents whose shingle sets are similar, by adaptive prefixes in which several tokens must match."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, cut_counted, mix, pieces, utf8
from .components import components
from .near_dedup import _fits, _once, confirm, settle, shingle_sets

#: Documents of a token's prefix group up to which all pairs are counted; those of larger groups are compared with one of them first.
GROUP = 16
#: Tokens that a document's prefix is lengthened by at most.
LENGTHEN = 8
#: Cost of comparing one shingle of a candidate, where a joined row costs 1.
COMPARE = 1 / 16
#: Documents that are looked at to find hot tokens, at most (about); a token is hot if HOT of them have it, and so many are hot at most.
LOOKED_AT, HOT, HOT_TOKENS = 1 << 14, 32, 1 << 20
#: Tokens that a task holds before it deals them to buckets, and tokens of a bucket on average.
CHUNK, BUCKET = 1 << 21, 1 << 22
#: Place of hot tokens in the order of all: after the others.
_LAST = 1 << 30


def _prints(s: np.ndarray) -> tuple[int, int]:
    """A fingerprint of a set, of twice 64 bits."""
    one, two = mix(s + np.uint64(1)).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def _parts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in pieces(batch, "text", 2 << 20):
            yield part, shingle_sets(*utf8(part.column("text")), k)


def _profiles(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, f1, f2): size and fingerprint of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _parts(batches, k):
            prints = np.array([_prints(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1])], names=["doc_id", "n", "f1", "f2"])

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long")


def _hot(docs: DataFrame, k: int, known: int, tokens: int) -> dict[int, int]:
    """Tokens that very many documents have, and how many of those looked at have them; what a few documents have is never among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _parts(batches, k):
            token, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    share = max(1, known // LOOKED_AT)
    least = max(HOT, 2 * tokens // share // HOT_TOKENS)
    looked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
    found = looked.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return {r["token"]: r["n"] for r in found.collect()}


def _dealt(hot: np.ndarray, buckets: int, k: int):
    """Blocks (bucket, tokens, owners, sizes): of a chunk of documents the tokens of one bucket, by owner: fingerprints, and how many tokens each has there."""

    def block(owners: np.ndarray, tokens: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(t) for t in tokens])
        token, owner = np.concatenate(tokens), np.repeat(np.arange(len(owners)), size)
        bucket = (token % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        token, owner, bucket = token[order], owner[order], bucket[order]
        edge = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
        rows: list[tuple] = []
        for a, b in zip(edge, edge[1:], strict=False):
            if b > a:
                first = np.concatenate(([0], np.flatnonzero(np.diff(owner[a:b])) + 1))
                rows.append((int(bucket[a]), token[a:b].tobytes(), owners[owner[a:b][first]].tobytes(), np.diff(first, append=b - a).astype(np.uint32).tobytes()))
        for begin in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[begin : begin + 256], strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "tokens", "owners", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        total = 0
        for _, sets in _parts(batches, k):
            for s in sets:
                if len(s) and (key := _prints(s)) not in held:
                    held[key] = s[~np.isin(s, hot)] if len(hot) else s
                    total += len(s)
            if total > CHUNK:
                yield from block(np.array([f for f, _ in held], np.int64), list(held.values()))
                held, total = {}, 0
        if held:
            yield from block(np.array([f for f, _ in held], np.int64), list(held.values()))

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by bucket (see _dealt). Returns (f, token, df) of each token that several sets have: a row for each set f that has it."""

    def counted(tokens: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(token, kind="stable")
        sorted_ = token[order]
        same = np.concatenate(([False], sorted_[1:] == sorted_[:-1], [False]))
        order = order[same[:-1] | same[1:]]  # the others stand alone
        token, owner = token[order], owner[order]
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])  # equal sets of different chunks
        token, owner = token[new], owner[new]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
        size = np.diff(first, append=len(token))
        df = np.repeat(size, size).astype(np.int32)
        several = df > 1
        columns = [pa.array(owner[several]), pa.array(token[several].view(np.int64)), pa.array(df[several])]
        yield from pa.Table.from_arrays(columns, names=["f", "token", "df"]).to_batches(max_chunksize=1 << 16)

    bucket, tokens, owners = None, [], []
    for batch in batches:
        for b, t, o, s in zip(*batch.columns, strict=True):
            if b.as_py() != bucket:
                if tokens:
                    yield from counted(tokens, owners)
                bucket, tokens, owners = b.as_py(), [], []
            tokens.append(np.frombuffer(t.as_buffer(), np.uint64))
            owners.append(np.repeat(np.frombuffer(o.as_buffer(), np.int64), np.frombuffer(s.as_buffer(), np.uint32)))
    if tokens:
        yield from counted(tokens, owners)


def _hot_rows(docs: DataFrame, hot: dict[int, int], k: int) -> DataFrame:
    """(f, token, df) as _repeated, of the hot tokens."""
    token = np.array(sorted(hot), np.int64)
    df = np.array([hot[t] for t in token.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _parts(batches, k):
            for s in sets:
                found = np.flatnonzero(np.isin(token, s.view(np.int64))) if len(s) else np.zeros(0, np.int64)
                if len(found):
                    columns = [pa.array(np.full(len(found), _prints(s)[0])), pa.array(token[found]), pa.array((_LAST + df[found]).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["f", "token", "df"])

    return docs.mapInArrow(run, "f long, token long, df int").distinct()


def prefixes(repeated: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """repeated: (f, token, df), the tokens that several sets have, each with its place in one order of all, rarest first; classes: (cls, f1, n, copies).
    Returns (token, cls, n, copies, l): the prefix of each set, without the tokens that it alone has (which stand first), and how many must match.

    A similar set shares at least o = ceil(n * percent / 100) tokens, and so one of the first n - o + 1, or l of the first n - o + l. A longer prefix joins
    more rows, but fewer pairs share l tokens. Each set takes the l for which an estimate of the cost is least: rows joined, J, no more than GROUP for a token, and at
    most J / l candidates, each to be compared shingle by shingle. Of two sets the smaller l must match, as the longer prefix begins with the shorter."""
    least = F.ceil(F.col("n") * percent / 100)  # exact: n * percent is an integer far below 2^53
    own = Window.partitionBy("cls")
    sets = repeated.join(classes.withColumnRenamed("f1", "f"), "f").withColumn("shared", F.count(F.lit(1)).over(own)).where(F.col("shared") >= least)
    ordered = own.orderBy("df", "token")
    place = F.row_number().over(ordered)
    rows = F.sum(F.least(F.col("df") - 1, F.lit(GROUP))).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    sets = sets.withColumn("l", place - (F.col("shared") - least)).withColumn("rows", rows)  # place = (n - least + l) - (n - shared)
    valid = (F.col("l") >= 1) & (F.col("l") <= F.least(F.lit(LENGTHEN), least))
    cost = F.col("rows") * (1 + F.col("n") * COMPARE / F.col("l"))
    best = F.min(F.when(valid, F.struct(cost.alias("cost"), F.col("l")))).over(own)
    chosen = sets.withColumn("best", best).where(F.col("l") <= F.col("best.l"))
    return chosen.select("token", "cls", "n", "copies", F.col("best.l").cast("int").alias("l"))


def candidates(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """rows: see prefixes. Returns pairs (x, y, m) to compare, and of larger groups (hub, hub_n, rep, n): each member and its hub.

    In groups of GROUP sets at most all pairs meet, and those that meet often enough are candidates. In a larger group, of m sets, each is one with its hub, the one with
    most exact copies; what that leaves open is settled later (see near_dedup.settle). A pair whose matches are partly in larger groups has a hub in common."""
    hub = F.max(F.struct("copies", (-F.col("cls")).alias("other"), "n"))
    groups = rows.groupBy("token").agg(F.count(F.lit(1)).alias("m"), hub.alias("hub")).where("m > 1")
    rows = cut(rows.join(groups, "token"))
    small = rows.where(F.col("m") <= GROUP)
    x = small.select("token", F.col("cls").alias("x"), F.col("n").alias("na"), F.col("l").alias("la"))
    y = small.select("token", F.col("cls").alias("y"), F.col("n").alias("nb"), F.col("l").alias("lb"))
    met = x.join(y, "token").where("x < y").where(_fits(percent)).groupBy("x", "y").agg(F.count(F.lit(1)).alias("times"), F.min(F.least("la", "lb")).alias("l"))
    near = met.where("times >= l").select("x", "y", F.lit(1).cast("long").alias("m"))
    large = rows.where((F.col("m") > GROUP) & (-F.col("hub.other") != F.col("cls"))).select((-F.col("hub.other")).alias("hub"), F.col("hub.n").alias("hub_n"), F.col("cls").alias("rep"), "n", "m")
    star = large.withColumnsRenamed({"n": "na", "hub_n": "nb"}).where(_fits(percent)).select(F.col("hub").alias("x"), F.col("rep").alias("y"), "m")
    return _once(near.unionByName(star)), large.drop("m").distinct()


def _sets_of(docs: DataFrame, classes: DataFrame, k: int) -> Callable[[DataFrame, bool], DataFrame]:
    """sets(asked, few): (doc_id, s), the shingle hashes, as bytes, of the classes asked for, whose numbers are in doc_id. few: they may be broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _parts(batches, k):
            prints = np.array([_prints(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "f1", "f2", "s"])

    def sets(asked: DataFrame, few: bool) -> DataFrame:
        asked, named = asked.withColumnRenamed("doc_id", "cls"), classes.select("cls", "rep", "f1", "f2")
        some = F.broadcast if few else (lambda df: df)
        wanted = named.join(F.broadcast(asked), "cls", "left_semi") if few else cut(named.join(asked, "cls", "left_semi"))
        texts = docs.join(some(wanted.select(F.col("rep").alias("doc_id"))), "doc_id", "left_semi")
        found = texts.mapInArrow(run, "rep long, f1 long, f2 long, s binary").join(some(wanted), ["rep", "f1", "f2"])
        return found.select(F.col("cls").alias("doc_id"), "s").dropDuplicates(["doc_id"])

    return sets


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, k: int = 5) -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id longs, n_links long: other classes of equal sets that its own is known to be linked with.

    Words are those of `common.WORD`, A-Z in lower case; the set of a document its distinct k-word shingles, or with fewer words all of them as one; of
    a null or empty text empty, and linked with nothing. Documents with 100 * intersection >= percent * union are linked; component_id is the smallest id that links reach,
    its own included. Ids may repeat, with equal or different texts: each row counts. Rows without an id have no component and link nothing. Links inside a component that others already
    hold together need not be looked for, so n_links is a lower bound, and at least 1 wherever the component has other sets. An empty table gives an empty result. Sets agree if a
    fingerprint of 128 bits does, shingles if 64 bits of hashes do.

    (1) Documents of equal sets are one class. (2) Tokens (shingles) are ordered by the number of classes that have them, rarest first: tasks deal out their
    tokens in blocks by hash, the number of classes is counted there, and of tokens that several have each class is told; a token of very many documents is found by looking at
    some of them, takes no part in this and stands last in the order. (3) A class with fewer such tokens than it must share has no partner. The others' prefixes are lengthened as far as it pays
    (see prefixes), and pairs that match often enough are compared on full sets. (4) Large groups are linked to their hubs, and what is open then is settled exactly."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = given.where(F.col("doc_id").isNotNull())
    profiles = cut(_profiles(known, k))
    classes = cut(profiles.where("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))).withColumn("cls", F.monotonically_increasing_id())
    rows, tokens = profiles.agg(F.count(F.lit(1)), F.sum("n")).first()
    hot = _hot(known, k, rows, tokens or 0)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-(tokens or 0) // BUCKET))
    dealt = known.select("text").mapInArrow(_dealt(np.array(sorted(hot), np.int64).view(np.uint64), buckets, k), "bucket int, tokens binary, owners binary, sizes binary")
    repeated = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_repeated, "f long, token long, df int")
    if hot:
        repeated = repeated.unionByName(_hot_rows(known.select("text"), hot, k))
    pairs, large = candidates(prefixes(repeated, classes.select("cls", "f1", "n", "copies"), percent), percent)
    (large, groups), sets = cut_counted(large, n=F.count(F.lit(1))), _sets_of(known, classes, k)
    links = cut(confirm(sets, pairs, percent, k))
    found = components(links, roots=False)
    if groups["n"]:
        found = settle(sets, large, links.where(F.lit(False)), found, percent, k)
    linked = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    reached = cut(classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls")))
    least = reached.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("sets"))
    member = reached.join(least, "component").join(linked, "cls", "left")
    n_links = F.greatest(F.coalesce("n_links", F.lit(0)), (F.col("sets") > 1).cast("long"))
    out = profiles.join(member.select("f1", "f2", "n", "component_id", n_links.alias("n_links")), ["f1", "f2", "n"], "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return out.unionByName(_profiles(given.where(F.col("doc_id").isNull()), k).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(0).cast("long").alias("n_links")))

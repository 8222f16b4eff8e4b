"""Repeated passages by a relative Lempel-Ziv parse: texts are factored greedily against reference blocks that index the whole corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, pieces, rolling, sliding, utf8, words

#: Words of an anchor. Every window has one: of all anchors in it, the one with the least hash.
ANCHOR = 10
_ONE, _TWO, _THREE = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3


class Parsed:
    """Words and windows of some texts: of each window, whether it lies in one text, the hash of its anchor, and two of its words."""

    def __init__(self, column: pa.Array, window: int, anchor: int):
        self.data, self.at = utf8(column)
        self.hash, self.start, self.end, self.doc = words(self.data, self.at)
        self.edge = np.searchsorted(self.doc, np.arange(len(column) + 1))
        self.window, n = window, len(self.hash)
        if n < window:
            self.inside, self.least, self.grams = np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        else:
            self.inside = self.doc[: n - window + 1] == self.doc[window - 1 :]
            self.grams = rolling(self.hash, anchor, _ONE)
            self.least = sliding(self.grams, window - anchor + 1, np.minimum)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every anchor, once for each place."""
        width = len(self.grams) - len(self.least) + 1
        if not len(self.least):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        low = np.where(self.inside, self.least, np.uint64(0))
        reach = sliding(np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), width, np.maximum)
        place = np.flatnonzero((reach == self.grams) & (self.grams > 0))
        return self.doc[place], self.grams[place]

    def shared(self, lists: list[np.ndarray]) -> np.ndarray:
        """Whether each window's anchor is in the list of its text."""
        out = np.zeros(len(self.least), bool)
        for i, known in enumerate(lists):
            a, b = self.edge[i], self.edge[i + 1] - self.window + 1
            if len(known) and b > a:
                out[a:b] = np.isin(self.least[a:b], known)
        return out

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        return rolling(self.hash, self.window, _TWO).view(np.int64), (rolling(mix(self.hash + np.uint64(1)), self.window, _THREE) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def spans_of(parsed: list[dict]) -> list[dict]:
    """The stretches of words that factors cover, as {start, end, factors}; factors, in order, that touch or overlap are of one stretch."""
    out: list[dict] = []
    for factor in parsed:
        if out and factor["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], factor["end"])
            out[-1]["factors"].append(factor)
        else:
            out.append({"start": factor["start"], "end": factor["end"], "factors": [factor]})
    return out


def lookups(repeated: np.ndarray, window: int) -> np.ndarray:
    """The windows of a text whose reference places a parse asks for: of each run of recurring windows the first, every `window`-th from there, and the last."""
    flags = np.concatenate(([False], repeated, [False]))
    begin, end = np.flatnonzero(~flags[:-1] & flags[1:]), np.flatnonzero(flags[:-1] & ~flags[1:])
    return np.concatenate([np.zeros(0, np.int64), *(np.unique(np.append(np.arange(a, b, window), b - 1)) for a, b in zip(begin, end, strict=True))])


def factors(places: list[tuple[int, int, int]], window: int) -> list[dict]:
    """places: (window, source, place in the source) of a text's lookups, in order. The greedy parse: a factor goes on as long as the next
    window asked for touches it and stands as far on in its source; else the next factor begins there."""
    out: list[dict] = []
    for at, source, source_at in places:
        last = out[-1] if out else None
        if last and at <= last["end"] and source == last["source"] and source_at - last["source_start"] == at - last["start"]:
            last["end"] = at + window
        else:
            out.append({"start": at, "end": at + window, "source": source, "source_start": source_at})
    return out


SPANS = "array<struct<start:int,end:int,factors:array<struct<start:int,end:int,source:long,source_start:int>>>>"


def remove_repeats(docs: DataFrame, text: str = "text", window: int = 35, anchor: int = ANCHOR) -> DataFrame:
    """docs with the text cut, and n_words, n_removed (longs), spans array<struct<start,end,factors>> (words; factors: array<struct<start,end,source,
    source_start>>) and kept_sha256 string.

    A window is `window` consecutive words of a row; each word is removed that a window covers whose word sequence also starts at any other
    place of the table, the same row included, judged on the input. The rest keeps its own white space, but for what stood after a removed word. kept_sha256 is of the kept words
    joined by one space. A null text stays null, and counts as no words, like an empty one. Repeated rows repeat each other, so they lose all windows. Other columns stay, whatever
    their names, except those four and any that begin with `__rlz_`. An empty table gives an empty result.

    Texts that are equal are one, with a weight, from the start. The reference is the whole corpus, indexed in blocks: the shuffle partitions that its anchors,
    and then its windows, are hashed to, each with a hash array of its windows, their numbers and the first place of each (in the order of the texts' hashes). (1) Anchors, a
    fourteenth of the places, are counted, map-side first. Only windows around an anchor that recurs can recur. (2) Each text gets its recurring anchors. (3) The windows around
    them are counted in their blocks, and those that stand alone are told to their texts: no factor reaches over them, so they are what is checked at a factor's ends. (4) Each text is parsed
    greedily between them: it asks the blocks for the reference place of the first window, and of one window's length further on, and so on; a factor is as long as
    its text goes on like the place at which it began. `source` is the xxhash64 of that place's text; the text that has the first place itself is its own source. (5) A factor has
    `window` words at least, so the words of all factors are removed, and nothing else: a span is what factors that touch cover. Texts agree if 128 bits of hashes do, windows if 96 bits of hashes of their words do."""
    docs = docs.drop("n_words", "n_removed", "spans", "kept_sha256")
    key = ["__rlz_1", "__rlz_2"]
    keyed = docs.withColumn(key[0], F.xxhash64(text)).withColumn(key[1], F.xxhash64(F.lit(42), text, F.length(text)))
    texts = keyed.where(F.col(text).isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first(text).alias("text"))

    def anchors(counted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text", 2 << 20):
                    doc, h = Parsed(part.column("text"), window, anchor).anchors()
                    copies = part.column("n").to_numpy()[doc]
                    order = np.lexsort((h, doc))
                    doc, h, copies = doc[order], h[order], copies[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
                    if counted:
                        h, where = np.unique(h, return_inverse=True)
                        n = np.bincount(where, np.minimum(copies, 2), len(h))
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32))], names=["h", "n"])
                    else:
                        own = [pa.array(part.column(k).to_numpy()[doc[new]]) for k in key]
                        yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), *own], names=["h", *key])

        return run

    recurring = texts.mapInArrow(anchors(True), "h long, n int").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    held = texts.mapInArrow(anchors(False), f"h long, {key[0]} long, {key[1]} long").join(recurring, "h", "left_semi").groupBy(*key).agg(F.collect_set("h").alias("anchors"))
    joined = texts.join(held, key, "left")

    def lists(column: pa.Array) -> list[np.ndarray]:
        return [np.asarray(x.values, np.int64).view(np.uint64) if x.is_valid else np.zeros(0, np.uint64) for x in column]

    def recurs(p: Parsed, part: pa.RecordBatch) -> list[np.ndarray]:
        """For each text, whether each of its windows recurs."""
        known, out = lists(part.column("anchors")), []
        shared = p.shared(known) if any(map(len, known)) else np.zeros(len(p.least), bool)
        for i, alone_at in enumerate(part.column("alone")):
            own = shared[p.edge[i] : max(p.edge[i], p.edge[i + 1] - window + 1)]
            if len(own) and alone_at.is_valid:
                own[np.asarray(alone_at.values, np.int64)] = False
            out.append(own)
        return out

    def windows(asking: bool):
        """All windows around recurring anchors, or of those that recur the ones that a parse asks for."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text", 1 << 20):
                    p = Parsed(part.column("text"), window, anchor)
                    if asking:
                        at = np.concatenate([np.zeros(0, np.int64), *(p.edge[i] + lookups(own, window) for i, own in enumerate(recurs(p, part)))])
                    else:
                        at = np.flatnonzero(p.shared(lists(part.column("anchors"))))
                    if len(at):
                        one, two = p.fingerprints()
                        doc = p.doc[at]
                        own = [pa.array(part.column(k).to_numpy()[doc]) for k in key]
                        copies = np.minimum(part.column("n").to_numpy()[doc], 2).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(one[at]), pa.array(two[at]), pa.array(copies), *own, pa.array((at - p.edge[doc]).astype(np.int32))], names=["w", "c", "n", *key, "at"])

        return run

    row = f"w long, c int, n int, {key[0]} long, {key[1]} long, at int"
    first = F.col(key[0]).bitwiseAND(F.lit(-(1 << 20))).bitwiseOR(F.least("at", F.lit((1 << 20) - 1)).cast("long"))  # order of places: text, place in it
    found = joined.where(F.col("anchors").isNotNull()).mapInArrow(windows(False), row).where("w is not null and c is not null").withColumn("first", first)
    index = found.groupBy("w", "c").agg(F.sum("n").alias("n"), *(F.min_by(k, "first").alias(k) for k in (*key, "at")))
    alone = index.where("n = 1").groupBy(*key).agg(F.collect_list("at").alias("alone"))
    flagged = joined.join(alone, key, "left").select(*key, "n", "text", "anchors", "alone")
    asked = flagged.where(F.col("anchors").isNotNull()).mapInArrow(windows(True), row).drop("n")
    # both uses of the index ask for the same columns and rows (key[1]; no nulls, as a join wants), so they are one plan and share its exchange
    places = index.where(F.col(key[1]).isNotNull() & (F.col("n") > 1)).select("w", "c", F.col(key[0]).alias("source"), F.col("at").alias("source_at"))
    places = asked.join(places, ["w", "c"]).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", "source", "source_at"))).alias("places"))
    factor_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())]))
    names = [*key, "__rlz_cut", "n_words", "n_removed", "spans", "kept_sha256"]
    spans_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("factors", factor_kind)]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                data, at = utf8(part.column("text"))
                _, start, _, doc = words(data, at)
                edge = np.searchsorted(doc, np.arange(len(at)))
                raw, out = data.tobytes(), ([], [], [], [], [])
                for i, told in enumerate(part.column("places").to_pylist()):
                    a, b = edge[i], edge[i + 1]
                    spans = spans_of(factors([(x["at"], x["source"], x["source_at"]) for x in told or ()], window))
                    body = raw[at[i] : at[i + 1]]
                    kept = body.split()
                    if spans:
                        tokens, begin, cut, kept, parts = kept, 0, 0, [], []
                        for span in spans:
                            s, e = span["start"], span["end"]
                            kept += tokens[begin:s]
                            parts.append(raw[at[i] + cut : start[a + s]])
                            begin, cut = e, (start[a + e] if a + e < b else at[i + 1]) - at[i]
                        kept += tokens[begin:]
                        parts.append(raw[at[i] + cut : at[i + 1]])
                        body = b"".join(parts)
                    line = (body.decode(), b - a, sum(x["end"] - x["start"] for x in spans), spans, hashlib.sha256(b" ".join(kept)).hexdigest())
                    for column, x in zip(out, line, strict=True):
                        column.append(x)
                new = [pa.array(x, k) for x, k in zip(out, (pa.string(), pa.int64(), pa.int64(), spans_kind, pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in key), *new], names=names)

    # n stays, so that all uses of `texts` are one plan and share its exchange
    parsed = texts.join(places, key, "left").select(*key, "n", "text", "places")
    parsed = parsed.mapInArrow(parse, f"{key[0]} long, {key[1]} long, __rlz_cut string, n_words long, n_removed long, spans {SPANS}, kept_sha256 string")
    rest = [c for c in docs.columns if c != text]
    known = F.col(text).isNotNull()
    back = keyed.where(known).select(*rest, *key).join(parsed, key, "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    new = {"n_words": F.coalesce("n_words", F.lit(0).cast("long")), "n_removed": F.coalesce("n_removed", F.lit(0).cast("long")), "spans": F.coalesce("spans", F.array().cast(SPANS)), "kept_sha256": F.coalesce("kept_sha256", none)}
    out = back.select(*(F.col("__rlz_cut").alias(c) if c == text else F.col(c) for c in docs.columns), *(v.alias(k) for k, v in new.items()))
    # null texts would all be one key of the join
    void = {"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "kept_sha256": none}
    return out.unionByName(docs.where(~known).select("*", *(v.alias(k) for k, v in void.items())))

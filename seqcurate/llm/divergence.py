"""How the sources of a language differ in their words: divergence of each two sources, and the terms that set a source apart, by a dominance skyband."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, pieces
from .lexicon import per_text, strings_of, summed, tokens

#: Shares are whole numbers of so many parts.
PARTS = 1_000_000_000
#: Sources whose pairs a task adds up at once (about); with more the pairs are dealt out in blocks.
SOURCES = 512
#: Cells of terms by sources that are looked at together.
CELLS = 1 << 20
#: Rows of skybands that a task holds before it passes them on.
HELD = 1 << 17

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _letters(data: np.ndarray) -> np.ndarray:
    return _LETTER[data]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, d): of what a task reads, occurrences and documents of each term in each group."""

    def tables() -> Iterator[pa.Table]:
        for batch in batches:
            for part in pieces(batch, "text"):
                codes, strings, doc = tokens(part.column("text"), _letters)
                group = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"])
                named = {g: i for i, g in enumerate(dict.fromkeys((x["lang"], x["source"]) for x in group.to_pylist()))}
                of = np.array([named[x["lang"], x["source"]] for x in group.to_pylist()], np.int64)
                row, code, times = per_text(codes, doc, len(strings))
                key, where = np.unique(of[row] * max(len(strings), 1) + code, return_inverse=True)
                names = list(named)
                at = key // max(len(strings), 1)
                lang, source = (pa.array([x[i] for x in names], pa.string()).take(pa.array(at)) for i in (0, 1))
                n, d = np.bincount(where, times, len(key)).astype(np.int64), np.bincount(where, minlength=len(key)).astype(np.int64)
                yield pa.table({"lang": lang, "source": source, "term": strings_of(strings, key % max(len(strings), 1)), "n": n, "d": d})

    yield from summed(tables(), ["lang", "source", "term"], ["n", "d"])


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * n / total) for 0 <= n <= total < 2^53, by long division in base 1,000."""
    total = np.maximum(total, 1)
    out, rest = n // total, n % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def skyband(n: np.ndarray, lang_n: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """The rows that fewer than k others dominate, by a higher or equal n, a lower or equal lang_n and an earlier place.

    In the order of n falling, lang_n and place every dominating row stands before what it dominates, and if k rows dominate one, k of the retained do."""
    order = np.lexsort((place, lang_n, -n))
    low, early = np.zeros(0, np.int64), np.zeros(0, np.int64)
    kept: list[np.ndarray] = []
    for begin in range(0, len(order), 256):
        block = order[begin : begin + 256]
        m, at = lang_n[block][:, None], place[block][:, None]
        over = ((low <= m) & (early < at)).sum(1) + np.tril((m.T <= m) & (at.T < at), -1).sum(1)
        kept.append(block[over < k])
        low, early = np.concatenate([low, lang_n[kept[-1]]]), np.concatenate([early, place[kept[-1]]])
    return np.concatenate([np.zeros(0, np.int64), *kept])


def _edges(table: pa.Table | pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Where one of the columns changes: the first row of each run of equal ones, and the number of rows."""
    new = np.zeros(len(table), bool)
    for c in columns:
        column = table.column(c)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate(([0] if len(table) else [], np.flatnonzero(new), [len(table)])).astype(np.int64)


def _skybands(k: int):
    """The skyband of each (lang, source) among the rows that a task reads."""
    names = ["lang", "source", "term", "n", "lang_n"]

    def shrunk(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("source", "ascending"), ("term", "ascending")])  # strings sort by their bytes
        edge = _edges(table, ["lang", "source"])
        n, lang_n = table.column("n").to_numpy(), table.column("lang_n").to_numpy()
        found = [a + skyband(n[a:b], lang_n[a:b], np.arange(b - a), k) for a, b in zip(edge, edge[1:], strict=False) if b > a]
        return table.take(pa.array(np.concatenate([np.zeros(0, np.int64), *found])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]).select(names))
            if sum(map(len, held)) > 2 * HELD:
                held = [shrunk(pa.concat_tables(held))]
                if len(held[0]) > HELD:
                    yield from held[0].to_batches(max_chunksize=1 << 16)
                    held = []
        if held:
            yield from shrunk(pa.concat_tables(held)).to_batches(max_chunksize=1 << 16)

    return run


class _Pairs:
    """Divergences of each two sources of one language, over terms that are told in order. Sources are told first: rows whose term is null."""

    def __init__(self) -> None:
        self.heads: list[pa.RecordBatch] = []
        self.value: np.ndarray | None = None
        self.cells: list[np.ndarray] = []  # term, source and n of rows that are not summed up yet
        self.term, self.last = -1, None

    def _begin(self) -> None:
        heads = pa.Table.from_batches(self.heads)
        self.names = heads.column("source").combine_chunks()
        self.block, self.total = heads.column("block").to_numpy(), heads.column("total").to_numpy()
        self.zero = shares(np.full(len(heads), 2), self.total)  # the share of a term that a source does not have
        self.value = np.zeros((len(heads), len(heads)), np.int64)

    def tell(self, rows: pa.RecordBatch) -> None:
        heads = rows.filter(pc.is_null(rows.column("term")))
        if len(heads):
            self.heads.append(heads)
        rows = rows.slice(len(heads))
        if not len(rows):
            return
        if self.value is None:
            self._begin()
        term = np.zeros(len(rows), np.int64)
        term[0] = rows.column("term")[0].as_py() != self.last
        term[_edges(rows, ["term"])[1:-1]] = 1
        term = self.term + np.cumsum(term)
        self.term, self.last = int(term[-1]), rows.column("term")[-1].as_py()
        source = pc.index_in(rows.column("source"), value_set=self.names).to_numpy()
        self.cells.append(np.stack([term, source, rows.column("n").to_numpy()]))
        if (self.term - self.cells[0][0, 0]) * len(self.names) > CELLS:
            self._sum(self.term)

    def _sum(self, end: int) -> None:
        """Adds the terms before `end`; the last one told may have more rows."""
        cells = np.concatenate([np.zeros((3, 0), np.int64), *self.cells], 1)
        whole = cells[0] < end
        self.cells = [cells[:, ~whole]] if not whole.all() else []
        if not whole.any():
            return
        term, source, n = cells[:, whole]
        p = np.repeat(self.zero[None, :], end - term[0], 0)
        p[term - term[0], source] = shares(n + 2, self.total[source])
        p = np.ascontiguousarray(p.T)
        for i in range(len(p) - 1):
            a, b = p[i], p[i + 1 :]
            self.value[i, i + 1 :] += ((a - b) * (a - b) // (a + b)).sum(1)

    def result(self, lang: str, blocks: tuple[int, int]) -> pa.RecordBatch:
        """Of the pairs whose sources are of these two blocks."""
        if self.value is None:
            self._begin()
        self._sum(self.term + 1)
        i, j = np.triu_indices(len(self.names), 1)
        wanted = (np.minimum(self.block[i], self.block[j]) == blocks[0]) & (np.maximum(self.block[i], self.block[j]) == blocks[1])
        i, j = i[wanted], j[wanted]
        columns = [pa.array([lang] * len(i), pa.string()), self.names.take(pa.array(i)), self.names.take(pa.array(j)), pa.array(self.value[i, j], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "value"])


def _divergences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, one, other, lang, term, source, block, n, total), sorted by the first five; a null term (first) is a source and its total.
    Returns (lang, source, item, value): of each two sources of blocks one and other the divergence, summed over this part's terms."""
    key, pairs = None, _Pairs()
    for batch in batches:
        edge = _edges(batch, ["part", "one", "other", "lang"])
        for a, b in zip(edge, edge[1:], strict=False):
            rows = batch.slice(a, b - a)
            own = tuple(rows.column(i)[0].as_py() for i in range(4))
            if own != key:
                if key:
                    yield pairs.result(key[3], key[1:3])
                key, pairs = own, _Pairs()
            pairs.tell(rows)
    if key:
        yield pairs.result(key[3], key[1:3])


def share(n: str, total: str) -> Column:
    """p of source_divergence, of a count n of a group with this total."""
    return F.expr(f"1 + cast({PARTS} as decimal(10,0)) * cast({n} + 2 as decimal(20,0)) div cast({total} as decimal(20,0))")


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item strings, value long, rank int: how each source of a language differs from the others, and by which terms.

    Null lang, source and text are ''. Terms are the maximal runs of ASCII letters and non-ASCII code points, A-Z in lower case; a language keeps those in
    `least_docs` of its documents (rows) at least, V in number. A group is a (lang, source) that occurs, or a whole language; with count occurrences of a term and N of
    all kept ones its share is p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)), and of two groups a term gives floor((p - q)^2 / (p + q)).
    part `pair`: item is each other source of the language, value the sum over all kept terms (0 without any), all ranks.
    part `term`: item is each term of the group with p above the language's, value what these two give, ranks to `top`.
    Ranks are by value, falling, then by item in UTF-8 order. Repeated rows count each. A language of one source has no pairs, one without kept terms no
    terms; an empty table gives no rows. Other columns are not looked at. N + 2 * V may be 9 * 10^15. A text is held whole in its task.

    (1) Tasks count terms of the texts they read, then counts meet by (lang, term), so that neither a hot source nor a hot language is one task's. (2) Pairs:
    every part of the terms gets the list of the sources and sums over its terms all pairs of sources at once (in blocks of SOURCES). (3) Terms:
    value rises with the group's count and falls with the language's, so what `top` terms dominate (see skyband) can't be among the first `top`. Partitions keep
    the skybands of their terms; these are merged, in two steps, and only then values are worked out and ranked."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]
    given = docs.select(*filled)
    counted = given.mapInArrow(_counted, "lang string, source string, term string, n long, d long").repartition("lang", "term")
    of_term = Window.partitionBy("lang", "term")
    counts = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    counts = counts.withColumns({"docs": F.sum("d").over(of_term), "lang_n": F.sum("n").over(of_term), "first": F.min("source").over(of_term) == F.col("source")})
    kept = cut(counts.where(F.col("docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", "first"))
    langs = kept.where("first").groupBy("lang").agg((F.sum("lang_n") + 2 * F.count(F.lit(1))).alias("lang_total"), (2 * F.count(F.lit(1))).alias("twice"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = given.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = cut(groups.select("lang", "source", (F.coalesce("own", F.lit(0)) + F.coalesce("twice", F.lit(0))).alias("total"), "lang_total"))

    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    blocks = math.ceil(most / SOURCES)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("lang", "term"), F.lit(parts)).cast("int")
    heads = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("part", "lang", F.lit(None).cast("string").alias("term"), "source", F.lit(0).cast("long").alias("n"), "total")
    cells = kept.select(part.alias("part"), "lang", "term", "source", "n", F.lit(0).cast("long").alias("total"))
    dealt = heads.unionByName(cells).withColumn("block", block).withColumn("with", every)
    dealt = dealt.select("part", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"), "lang", "term", "source", "block", "n", "total")
    dealt = dealt.repartition("part", "one", "other").sortWithinPartitions("part", "one", "other", "lang", "term")
    summed_up = dealt.mapInArrow(_divergences, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = summed_up.unionByName(summed_up.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")).withColumn("part", F.lit("pair"))

    row = "lang string, source string, term string, n long, lang_n long"
    lots = math.ceil(math.sqrt(parts))
    near = kept.select("lang", "source", "term", "n", "lang_n").mapInArrow(_skybands(top), row)
    near = near.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(lots))).mapInArrow(_skybands(top), row)
    p, q = share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q")
    terms = near.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p, q).where("p > q")
    terms = terms.select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value")).withColumn("part", F.lit("term"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs, terms = pairs.withColumn("rank", rank), terms.withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")

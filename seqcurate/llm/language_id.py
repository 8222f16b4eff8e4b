"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import bisect
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, mix, pieces, shared_folder

ORDER = 4
#: Rows of a model (grams and contexts of all orders) that are read at once, by the driver to broadcast them and by a worker to look grams up.
SHARD = 1 << 21
#: The share of a language's learning documents whose cross-entropies, each left out of the model, are within its calibration.
WITHIN = 0.9
#: Nats by which the cross-entropy of a text may be higher by chance, times the root of its characters.
SHORT = 6.0
#: Bytes of text (or one text) that a worker looks at at once; its arrays take some hundred times as much.
PIECE = 1 << 20
#: Characters that a text counts as in its score, at most.
TEMPER = 40

_letters: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For every code point the 16-bit code of its lower-case letter, or of a space if it is no letter."""
    if not _letters:
        codes = np.full(0x110000, 32, np.uint16)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = ord(c.lower()[0])
                codes[i] = low if low < 0x10000 else 0xE000 + low % 0x1900
        _letters.append(codes)
    return _letters[0]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Four-grams of all texts as packed 64-bit numbers, the end of each text's share of them, and each text's number of letters.

    Runs of other characters than letters count as one space; three spaces stand before a text."""
    texts = [t or "" for t in texts]
    raw = np.frombuffer("".join("\0\0\0" + t.replace("\0", " ") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes, pad = _fold()[raw], raw == 0
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32) | pad[1:]
    doc = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts)))
    letters = np.bincount(doc, codes != 32, len(texts)).astype(np.int64)
    a, own, doc = codes[keep].astype(np.uint64), ~pad[keep], doc[keep]
    g = a.copy()
    for back in (1, 2, 3):
        g[back:] |= a[:-back] << np.uint64(16 * back)
    return g[own], np.cumsum(np.bincount(doc[own], minlength=len(texts))), letters


def _table(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The hashes of the keys, sorted, and the values in their order."""
    h = mix(keys)
    order = np.argsort(h)
    return h[order], *(v[order] for v in values)


def _look(table: tuple[np.ndarray, ...], keys: np.ndarray) -> list[np.ndarray]:
    """The values of each key, 0 where the table has none."""
    hashes, *values = table
    h = mix(keys)
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    hit = hashes[at] == h
    return [np.where(hit, v[at], 0) for v in values]


def _low(g: np.ndarray, n: int) -> np.ndarray:
    return g & np.uint64((1 << 16 * n) - 1)


def _context(g: np.ndarray, n: int) -> np.ndarray:
    return _low(g, n) >> np.uint64(16) if n > 1 else np.zeros(len(g), np.uint64)


def statistics(shards, g: np.ndarray) -> list[np.ndarray]:
    """For orders 1 to ORDER of each gram: its count, and its context's total and kinds.

    A shard has under n a table of grams with counts and under -n one of contexts with totals and kinds; each key is in one shard."""
    out = [np.zeros((3, len(g)), np.int64) for _ in range(ORDER)]
    for shard in shards:
        for n in range(1, ORDER + 1):
            if n in shard:
                out[n - 1][0] += _look(shard[n], _low(g, n))[0]
            if -n in shard:
                out[n - 1][1:] += _look(shard[-n], _context(g, n))
    return out


def interpolate(found: list[np.ndarray], discounts: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney probabilities from statistics()."""
    p = np.full(found[0].shape[1], 2.0**-16)
    for (count, total, kinds), d in zip(found, discounts, strict=True):
        some = np.maximum(total, 1e-300)
        p = np.maximum(count - d, 0) / some + np.where(total > 0, d * kinds / some, 1.0) * p
    return p


def discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


class KneserNey:
    """Interpolated Kneser-Ney over packed four-grams in memory: what fit() counts in Spark, as one shard."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.shard, self.discounts = {}, np.zeros(ORDER)
        for n in range(ORDER, 0, -1):
            self.discounts[n - 1] = discount((counts == 1).sum(), (counts == 2).sum())
            context, first, kinds = np.unique(_context(keys, n), return_inverse=True, return_counts=True)
            self.shard[n], self.shard[-n] = _table(keys, counts), _table(context, np.bincount(first, counts).astype(np.int64), kinds)
            keys, counts = np.unique(_low(keys, n - 1), return_counts=True)

    def prob(self, g: np.ndarray) -> np.ndarray:
        return interpolate(statistics([self.shard], g), self.discounts)


class Model:
    """A language's discounts and broadcast shards; unless `cached`, one shard at a time is in a worker's memory."""

    def __init__(self, discounts: np.ndarray, shards: list, cached: bool):
        self.discounts, self.shards, self.cached = discounts, shards, cached

    def read(self):
        for shard in self.shards:
            yield shard.value
            if not self.cached:
                shard.__dict__.pop("_value", None)

    def statistics(self, g: np.ndarray) -> list[np.ndarray]:
        return statistics(self.read(), g)

    def prob(self, g: np.ndarray) -> np.ndarray:
        return interpolate(self.statistics(g), self.discounts)


def _kinds(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams, and which of them each is."""
    kinds = np.unique(g)
    slots = np.zeros(1 << 20, np.int64)
    slots[(mix(kinds) >> np.uint64(44)).astype(np.int64)] = np.arange(len(kinds))
    at = slots[(mix(g) >> np.uint64(44)).astype(np.int64)] if len(kinds) else np.zeros(0, np.int64)
    if len(kinds):
        wrong = np.flatnonzero(kinds[at] != g)
        at[wrong] = np.searchsorted(kinds, g[wrong])
    return kinds, at


def scores(models: list, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy (nats a character) of every text under every model, its characters and its letters."""
    g, ends, letters = grams(texts)
    kinds, at = _kinds(g)
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    n = ends - begins
    out = np.zeros((len(texts), len(models)))
    for k, model in enumerate(models):
        total = np.concatenate(([0.0], np.cumsum(-np.log(model.prob(kinds))[at])))
        out[:, k] = (total[ends] - total[begins]) / np.maximum(n, 1)
    return out, n, letters


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id, as text, leaves 2 when divided by 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def count_grams(docs: DataFrame) -> DataFrame:
    """docs: (text, lang). Returns (lang, gram, n) over all of them; tasks count their own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

        def rows(lang, parts):
            keys, n = merged(parts)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                lang = np.array(part.column("lang").to_pylist(), object)
                texts = part.column("text").to_pylist()
                for name in set(lang):
                    own = [t for t, x in zip(texts, lang, strict=True) if x == name]
                    parts = held.setdefault(name, [])
                    parts.append(np.unique(grams(own)[0], return_counts=True))
                    if len(parts) >= 12:
                        parts[:] = [merged(parts)]
                if sum(len(p[0]) for parts in held.values() for p in parts) > 6_000_000:
                    yield from (rows(k, v) for k, v in held.items())
                    held = {}
        yield from (rows(k, v) for k, v in held.items() if v)

    return docs.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class LanguageModels:
    """Languages in the order of their code points, a Kneser-Ney model of each, and for the rejection the cross-entropy
    within which WITHIN of its learning documents are, each under the model of the others."""

    def __init__(self, names: list[str], models: list[Model]):
        self.names, self.models = names, models
        self.highest = np.full(len(names), np.inf)


def _learn(counts: DataFrame) -> tuple[list[str], list[Model]]:
    """counts: (lang, gram, n). The languages and their models, over every gram: discounts, totals and kinds are aggregates in Spark, of lower orders
    over the distinct continuations. A model's rows are dealt by hash to shards of about SHARD rows, as many as they need, broadcast one by one."""
    spark, key = counts.sparkSession, F.col("key")
    level, rows, seen = counts.withColumnRenamed("gram", "key"), [], {}
    for n in range(ORDER, 0, -1):
        level = cut(level)
        for r in level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect():
            seen.setdefault(r.lang, np.zeros(ORDER))[n - 1] = discount(r.ones, r.twos)
        context = (F.shiftrightunsigned(key, 16) if n > 1 else F.lit(0).cast("long")).alias("key")
        rows.append(level.select("lang", F.lit(n).alias("order"), "key", "n", F.lit(0).cast("long").alias("kinds")))
        rows.append(level.groupBy("lang", context).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).select("lang", F.lit(-n).alias("order"), "key", "n", "kinds"))
        level = level.groupBy("lang", key.bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    names = sorted(seen)
    if not names:
        return [], []
    table = cut(functools.reduce(DataFrame.unionByName, rows))
    size = {r.lang: r.m for r in table.groupBy("lang").agg(F.count(F.lit(1)).alias("m")).collect()}
    shards = [-(-size[x] // SHARD) for x in names]
    at = (F.array_position(F.array(*map(F.lit, names)), F.col("lang")) - 1).cast("int")
    folder = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
    dealt = table.withColumn("at", at).withColumn("shard", F.pmod(F.xxhash64("key"), F.element_at(F.array(*map(F.lit, shards)), F.col("at") + 1)).cast("int"))
    dealt.drop("lang").write.partitionBy("at", "shard").parquet(folder)
    stored, models = spark.read.parquet(folder), []
    for k, name in enumerate(names):
        own = [spark.sparkContext.broadcast(_shard(stored.where((F.col("at") == k) & (F.col("shard") == i)))) for i in range(shards[k])]
        models.append(Model(seen[name], own, sum(size.values()) <= SHARD))
    return names, models


def _shard(rows: DataFrame) -> dict[int, tuple[np.ndarray, ...]]:
    rows = rows.select("order", "key", "n", "kinds").toArrow()
    order, key, n, kinds = (rows.column(c).to_numpy() for c in rows.column_names)
    key, out = key.view(np.uint64), {}
    for o in np.unique(order):
        own = order == o
        out[int(o)] = _table(key[own], n[own]) if o > 0 else _table(key[own], n[own], kinds[own])
    return out


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModels:
    """Learns from every document with text and language that held_out() leaves; ids, sources and other columns are no inputs.

    The models hold every four-gram of these texts."""
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull()).where(~held_out(F.col("doc_id")))
    out = LanguageModels(*_learn(count_grams(known.select("text", "lang"))))
    names = out.names
    if names:
        found = _left_out(known.select("text", "lang"), out).groupBy("at").agg(F.percentile_approx("entropy", WITHIN, 10_000).alias("highest"))
        for r in found.collect():
            out.highest[r["at"]] = r.highest
    return out


def left_out(model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy (nats a character) of every text under the model without the text's own counts, and its letters.

    A text takes away its count of each four-gram; at lower orders, the continuations that no other text has."""
    g, ends, letters = grams(texts)
    kinds, at = _kinds(g)
    n = np.diff(ends, prepend=0)
    if not len(g):
        return np.zeros(len(texts)), letters
    known = model.statistics(kinds)
    pair, removed = np.unique(np.repeat(np.arange(len(texts)), n) * len(kinds) + at, return_counts=True)
    doc, gram, times = pair // len(kinds), pair % len(kinds), removed
    row, found = np.arange(len(pair)), []  # the row of each pair among those of an order: text, a gram that has the part, what is removed
    row_doc, row_gram = doc, gram
    for order in range(ORDER, 0, -1):
        count, total, sorts = known[order - 1][:, row_gram]
        gone = (count <= removed) & (removed > 0)
        _, context = np.unique(_context(kinds, order), return_inverse=True)
        _, where = np.unique(row_doc * len(kinds) + context[row_gram], return_inverse=True)
        left = count - removed, total - np.bincount(where, removed)[where], sorts - np.bincount(where, gone)[where]
        found.append(np.stack([x[row] for x in left]))
        if order > 1:
            _, part = np.unique(_low(kinds, order - 1), return_inverse=True)
            _, first, where = np.unique(row_doc * len(kinds) + part[row_gram], return_index=True, return_inverse=True)
            row_doc, row_gram, removed, row = row_doc[first], row_gram[first], np.bincount(where, gone).astype(np.int64), where[row]
    h = -np.log(interpolate(found[::-1], model.discounts))
    return np.bincount(doc, h * times, len(texts)) / np.maximum(n, 1), letters


def _left_out(docs: DataFrame, fitted: LanguageModels) -> DataFrame:
    """docs: (text, lang). Returns (at, entropy): of each text with letters its language's place, and its cross-entropy (see left_out)."""
    names, models = fitted.names, fitted.models

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                texts, lang = part.column("text").to_pylist(), np.array(part.column("lang").to_pylist(), object)
                for name in set(lang):
                    k = bisect.bisect_left(names, name)
                    h, letters = left_out(models[k], [t for t, x in zip(texts, lang, strict=True) if x == name])
                    h = h[letters > 0]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k, np.int32)), pa.array(h)], names=["at", "entropy"])

    return docs.mapInArrow(run, "at int, entropy double")


def _scored(docs: DataFrame, fitted: LanguageModels, keep: list[str], text: str = "text") -> DataFrame:
    models = fitted.models
    docs = docs.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("__at", T.IntegerType()), T.StructField("__entropy", T.DoubleType()), T.StructField("__chars", T.LongType()), T.StructField("__letters", T.LongType()), T.StructField("__score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "__text", PIECE):
                h, n, letters = scores(models, part.column("__text").to_pylist())
                best = h.argmin(1)
                low = h[np.arange(len(h)), best]
                certain = 1 / np.exp((low[:, None] - h) * np.minimum(n, TEMPER)[:, None]).sum(1)
                columns = [pa.array(best.astype(np.int32)), pa.array(low), pa.array(n.astype(np.int64)), pa.array(letters), pa.array(np.clip(certain, 0, 1))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, fitted: LanguageModels, keep: list[str], text: str = "text", margin: float = 1.5) -> DataFrame:
    """The columns in `keep`, with lang_pred string, score double (0 to 1), cross_entropy double, rejected boolean. A column in `keep` with one of
    these names gives way to the new one. score: the language's share of likelihood among all learned, over TEMPER characters at most, as more would make it 0 or 1.

    lang_pred: the language with the lowest cross-entropy per character over the whole text, the first of equal ones; `und`, with
    score 0, if the text is null, empty or without letters, or no language was learned. rejected: und, or a cross-entropy over its language's
    calibration (see LanguageModels) by more than `margin` nats a character, wider by SHORT over the root of the text's characters, which is text unlike any learned."""
    keep = [c for c in keep if c not in ("lang_pred", "score", "cross_entropy", "rejected")]
    if not fitted.names:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    scored = _scored(docs, fitted, keep, text)
    pick = lambda values: F.element_at(F.array(*(F.lit(x) for x in values)), F.col("__at") + 1)
    known = F.col("__letters") > 0
    far = F.col("__entropy") > pick(map(float, fitted.highest)) + margin + SHORT / F.sqrt(F.greatest("__chars", F.lit(1)))
    return scored.select(*keep, F.when(known, pick(fitted.names)).otherwise("und").alias("lang_pred"), F.when(known, F.col("__score")).otherwise(0.0).alias("score"), F.when(known, F.col("__entropy")).alias("cross_entropy"), (~known | far).alias("rejected"))

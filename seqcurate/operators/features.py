"""Features of sequences: k-mers, their document frequencies and weights, codon and composition signals; models on them."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CODE = np.full(256, 4, np.uint8)
for _i, _pair in enumerate(("Aa", "Cc", "Gg", "Tt")):
    _CODE[[ord(c) for c in _pair]] = _i
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[97:123] -= 32
#: Letters of the sequences that a task takes at once.
LETTERS = 4 << 20


def kmer_text(code: Column, k: int) -> Column:
    """The letters of a k-mer's code: two bits each, in the order A, C, G, T, the first letter highest."""
    return F.array_join(F.transform(F.sequence(F.lit(k - 1), F.lit(0), F.lit(-1)), lambda i: F.substr(F.lit("ACGT"), F.call_function("shiftright", code, 2 * i).bitwiseAND(F.lit(3)).cast("int") + 1, F.lit(1))), "")


def _codes(texts: list[str | None], k: int) -> np.ndarray:
    """The codes of all windows of k letters of the texts that hold A, C, G and T of either case only, with the text's number in the bits above 2 k."""
    texts = [t or "" for t in texts]
    raw = np.frombuffer("\n".join(texts).encode("latin-1", "replace"), np.uint8)  # one byte for each letter
    base = _CODE[raw]
    if len(base) < k:
        return np.zeros(0, np.int64)
    n = len(base) - k + 1
    code, wrong = np.zeros(n, np.int64), np.zeros(n, np.int64)
    broken = np.concatenate(([0], np.cumsum(base > 3)))
    wrong = broken[k:] - broken[:-k]
    for j in range(k):
        code = (code << 2) | (base[j : j + n] & 3)
    text = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[:n]
    good = wrong == 0
    return code[good] | (text[good] << (2 * k))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    sizes = [len(x) if x else 0 for x in batch.column(column).to_pylist()]
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > LETTERS:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)


def kmer_counts(df: DataFrame, id_: str, seq: str, ks: int | Sequence[int]) -> DataFrame:
    """(id, k, code, n): the k-mers of each row, for one k or several in one scan. Counted within the row, so nothing is shuffled; rows with the same id are
    counted apart. A null sequence has none."""
    ks = [ks] if isinstance(ks, int) else list(ks)
    source = df.select(F.col(id_).alias("id"), F.col(seq).alias("seq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                texts, ids = part.column(1).to_pylist(), part.column(0)
                for k in ks:
                    keys, n = np.unique(_codes(texts, k), return_counts=True)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(keys >> (2 * k))), pa.array(np.full(len(keys), k, np.int32)), pa.array(keys & ((1 << 2 * k) - 1)), pa.array(n.astype(np.int64))], names=["id", "k", "code", "n"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, k int, code long, n long")


def doc_freq(df: DataFrame, seq: str, ks: int | Sequence[int]) -> DataFrame:
    """(k, code, df): in how many rows each k-mer occurs. Tasks add up their own rows first: 4^k numbers at most."""
    ks = [ks] if isinstance(ks, int) else list(ks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(4**k, np.int64) for k in ks}
        for batch in batches:
            for part in _slices(batch, 0):
                texts = part.column(0).to_pylist()
                for k in ks:
                    total[k] += np.bincount(np.unique(_codes(texts, k)) & ((1 << 2 * k) - 1), minlength=4**k)
        for k in ks:
            seen = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), k, np.int32)), pa.array(seen), pa.array(total[k][seen])], names=["k", "code", "df"])

    return df.select(seq).mapInArrow(run, "k int, code long, df long").groupBy("k", "code").agg(F.sum("df").alias("df"))


def idf(freq: DataFrame, documents: int, ks: int | Sequence[int]) -> DataFrame:
    """(k, code, df, idf) of every k-mer, seen or not: ln((documents + 1) / (df + 1)) + 1."""
    ks, spark = [ks] if isinstance(ks, int) else list(ks), freq.sparkSession
    codes = None
    for k in ks:
        own = spark.range(4**k).select(F.lit(k).alias("k"), F.col("id").alias("code"))
        codes = own if codes is None else codes.unionByName(own)
    out = codes.join(freq, ["k", "code"], "left").na.fill(0, ["df"])
    return out.withColumn("idf", F.log(F.lit(documents + 1.0) / (F.col("df") + 1)) + 1)


def _weights(table: DataFrame) -> dict[int, np.ndarray]:
    """idf arrays by k: 4^k numbers each, whatever the corpus."""
    k, code, value = (c.to_numpy() for c in table.select("k", "code", "idf").toArrow().columns)
    out = {int(x): np.ones(4 ** int(x)) for x in np.unique(k)}
    for x, values in out.items():
        values[code[k == x]] = value[k == x]
    return out


def tfidf(df: DataFrame, id_: str, seq: str, table: DataFrame) -> DataFrame:
    """(id, k, codes array<int>, weights array<double>): of each row and each k in `table` (see idf) the counts times idf, scaled to length 1; a row without k-mers
    has empty arrays. The table is broadcast: 4^k numbers."""
    weights = _weights(table)
    shared = df.sparkSession.sparkContext.broadcast(weights)
    source = df.select(F.col(id_).alias("id"), F.col(seq).alias("seq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                texts = part.column(1).to_pylist()
                for k, idfs in shared.value.items():
                    keys, n = np.unique(_codes(texts, k), return_counts=True)
                    row, code = keys >> (2 * k), keys & ((1 << 2 * k) - 1)
                    w = n * idfs[code]
                    w = w / np.sqrt(np.bincount(row, w * w, len(part)))[row]
                    at = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(part))))).astype(np.int32)
                    lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in (code.astype(np.int32), w)]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(part), k, np.int32)), *lists], names=["id", "k", "codes", "weights"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, k int, codes array<int>, weights array<double>")


def save_idf(table: DataFrame, path: str, fragment: int, documents: int) -> None:
    """Writes a table of idf() with its k's, fragment length and number of documents."""
    ks = sorted(r.k for r in table.select("k").distinct().collect())
    table.write.mode("overwrite").parquet(f"{path}/idf")
    table.sparkSession.createDataFrame([(json.dumps(ks), fragment, documents)], "ks string, fragment long, documents long").write.mode("overwrite").parquet(f"{path}/about")


def load_idf(spark: SparkSession, path: str, k: int, fragment: int | None = None) -> DataFrame:
    """The idf of one k. An error if the model lacks the k, has not 4^k weights, or is of another fragment length."""
    about = spark.read.parquet(f"{path}/about").first()
    if k not in json.loads(about.ks):
        raise ValueError(f"the model has k = {about.ks}, not {k}")
    if fragment is not None and fragment != about.fragment:
        raise ValueError(f"the model is of fragments of {about.fragment}, not {fragment}")
    table = spark.read.parquet(f"{path}/idf").where(F.col("k") == k)
    if table.count() != 4**k:
        raise ValueError(f"the model has not {4**k} weights for k = {k}")
    return table


# Stop and start codons.
STOPS, STARTS = ("TAA", "TAG", "TGA"), ("ATG", "GTG", "TTG")
_NUMBER = {c: i for i, c in enumerate("ACGT")}


def _codon(c: str) -> int:
    return 16 * _NUMBER[c[0]] + 4 * _NUMBER[c[1]] + _NUMBER[c[2]]


def _entropy(counts: np.ndarray) -> float:
    p = counts[counts > 0] / max(counts.sum(), 1)
    return float(-(p * np.log2(p)).sum())


def signals(seq: str) -> np.ndarray:
    """60 numbers of one sequence. In order: log length, GC, N, entropy of letters and of triplets, longest run; of the six reading frames the stop and start codons,
    longest and mean open stretch; over the frames least, largest and deviation of each of the four; of each frame the 90th percentile and the number of long stretches; GC of the
    three phases, their deviation and spread; and how much more letters agree three apart than one or two."""
    raw = _UPPER[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
    base = _CODE[raw]
    n, known = len(base), base < 4
    counts = np.bincount(base[known], minlength=4)
    acgt = max(int(counts.sum()), 1)
    runs = np.diff(np.flatnonzero(np.concatenate(([True], raw[1:] != raw[:-1], [True])))) if n else np.zeros(1, int)
    wide = raw.astype(np.int32)
    triplets = np.unique(wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:], return_counts=True)[1] if n > 2 else np.zeros(0, int)
    out = [math.log1p(n), (counts[1] + counts[2]) / acgt, int((raw == ord("N")).sum()) / max(n, 1), _entropy(counts) / 2, _entropy(triplets) / 6, int(runs.max()) / max(n, 1)]
    stop, start = np.zeros(64, bool), np.zeros(64, bool)
    stop[[_codon(c) for c in STOPS]] = True
    start[[_codon(c) for c in STARTS]] = True
    frames = []
    for strand in (base, np.where(base < 4, 3 - base, 4)[::-1]):
        for offset in range(3):
            m = max(0, (n - offset) // 3)
            cut = strand[offset : offset + 3 * m].reshape(m, 3).astype(int)
            codons = (cut[:, 0] * 16 + cut[:, 1] * 4 + cut[:, 2])[(cut < 4).all(1)]
            ends = np.flatnonzero(stop[codons])
            open_ = np.diff(np.concatenate(([-1], ends, [len(codons)]))) - 1
            size, length = max(len(codons), 1), max(n, 1)
            frames.append([len(ends) / size, int(start[codons].sum()) / size, 3 * open_.max() / length, 3 * open_.mean() / length, 3 * np.percentile(open_, 90) / length, (open_ >= 100).sum() / max(size / 100, 1)])
    for f in frames:
        out += f[:4]
    four = np.array(frames, np.float32)[:, :4]
    for column in four.T:
        out += [float(column.min()), float(column.max()), float(column.std())]
    for f in frames:
        out += f[4:]
    phases = []
    for offset in range(3):
        own = base[offset::3]
        phases.append(int(((own == 1) | (own == 2)).sum()) / max(int((own < 4).sum()), 1))
    agree = []
    for lag in (1, 2, 3):
        both = known[:-lag] & known[lag:] if n > lag else np.zeros(0, bool)
        agree.append(int((both & (base[:-lag] == base[lag:])).sum()) / max(int(both.sum()), 1) if n > lag else 0.0)
    out += [*phases, float(np.std(phases)), max(phases) - min(phases), agree[2] - 0.5 * (agree[0] + agree[1])]
    return np.array(out, np.float32)


def biosignals(df: DataFrame, seq: str, name: str = "signals") -> DataFrame:
    """df with the 60 signals of each sequence as array<double>; a null sequence counts as empty."""
    schema = df.select("*", F.array().cast("array<double>").alias(name)).schema
    at = df.columns.index(seq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [signals(s or "").astype(float).tolist() for s in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.list_(pa.float64()))], names=schema.names)

    return df.mapInArrow(run, schema)


def fit_heads(df: DataFrame, features: str, heads: Mapping[str, tuple[str, Column]], weight: str | None = None, steps: int = 50, l2: float = 1e-4) -> dict:
    """A multinomial logistic regression for each head (name: label column of 0, 1, ..., and which rows it learns from, those of its branch). features: array<double>."""
    rows = df.withColumn("_x", array_to_vector(features))
    out = {}
    for name, (label, branch) in heads.items():
        lr = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=steps, regParam=l2, rawPredictionCol=f"{name}_raw", probabilityCol=f"{name}_probability", predictionCol=f"{name}_prediction")
        out[name] = (lr.setWeightCol(weight) if weight else lr).fit(rows.where(branch & F.col(label).isNotNull()))
    return out


def fit_tree(df: DataFrame, features: str, label: str, trees: int = 100, depth: int = 10, seed: int = 0):
    """A random forest on the signals."""
    rows = df.withColumn("_x", array_to_vector(features)).where(F.col(label).isNotNull())
    return RandomForestClassifier(featuresCol="_x", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(rows)


"""From sequence to class: a net on the k-mer weights of a record's fragments for each of two stages, fitted, saved bound to its weights, loaded, and applied within the row."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import _codes, _weights, doc_freq, idf, load_idf, save_idf, tfidf
from .order import kept
from .score import FIRST, SECOND, cascade


@dataclass
class Stage:
    """One stage: its classes in the order of the probabilities, letters of a k-mer and of a fragment, the idf of the k-mers, the net and what a probability must exceed. Its size is that of the net, whatever the corpus."""

    classes: tuple[str, ...]
    k: int
    fragment: int
    cutoff: float
    idf: DataFrame
    documents: int
    model: MultilayerPerceptronClassificationModel

    def check(self) -> None:
        layers = list(self.model.getLayers())
        if layers[0] != 4**self.k or layers[-1] != len(self.classes):
            raise ValueError(f"the net takes {layers[0]} weights and tells {layers[-1]} classes, not {4**self.k} (k = {self.k}) and {len(self.classes)}")

    def arrays(self) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The idf by code, and the net's layers as (weights, biases)."""
        flat, layers, at, out = self.model.weights.toArray(), list(self.model.getLayers()), 0, []
        for a, b in zip(layers, layers[1:], strict=False):
            out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))  # of each input in turn the weights to all outputs
            at += (a + 1) * b
        return _weights(self.idf)[self.k], out


@F.udf(VectorUDT())
def _sparse(size, codes, weights):
    return Vectors.sparse(size, codes, weights)


def vectors(pieces: DataFrame, seq: str, table: DataFrame, k: int, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` of pieces and x, the sparse vector of their k-mer weights (see features.tfidf)."""
    rows = tfidf(pieces.select(F.struct(*keep).alias("_keep"), seq), "_keep", seq, table)
    return rows.select("id.*", _sparse(F.lit(4**k), "codes", "weights").alias("x"))


def _net(layers: Sequence[int], label: str, steps: int, seed: int) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(featuresCol="x", labelCol=label, layers=list(layers), maxIter=steps, seed=seed, blockSize=64)


def fit_stage(pieces: DataFrame, seq: str, label: str, classes: Sequence[str], k: int, fragment: int, hidden: Sequence[int] = (32,), cutoff: float = 0.65, steps: int = 100, seed: int = 42) -> Stage:
    """A stage learned from pieces: fragments of `fragment` letters at most, each with a label among `classes` (others and nulls are left out). idf and net are of the same pieces."""
    place = F.array_position(F.array(*(F.lit(c) for c in classes)), F.col(label)).cast("int") - 1
    own = kept(pieces.select(place.cast("double").alias("_y"), F.substr(F.col(seq), F.lit(1), F.lit(fragment)).alias("_s")).where(F.col("_y") >= 0))
    documents = own.count()
    table = kept(idf(doc_freq(own, "_s", k), documents, k))
    model = _net([4**k, *hidden, len(classes)], "_y", steps, seed).fit(vectors(own, "_s", table, k, ["_y"]))
    return Stage(tuple(classes), k, fragment, cutoff, table, documents, model)


def save_stage(stage: Stage, path: str) -> None:
    """Writes the net, its idf and what they are of; load_stage takes them together or not at all."""
    stage.check()
    save_idf(stage.idf, path, stage.fragment, stage.documents)
    stage.model.write().overwrite().save(f"{path}/net")
    about = json.dumps({"classes": stage.classes, "k": stage.k, "fragment": stage.fragment, "cutoff": stage.cutoff, "documents": stage.documents})
    stage.idf.sparkSession.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/stage")


def load_stage(spark: SparkSession, path: str, k: int | None = None, fragment: int | None = None) -> Stage:
    """A stage that was saved. An error if its idf is of another k or fragment length than the net, if the net does not fit either, or if k or fragment is given and is not the stage's."""
    about = json.loads(spark.read.text(f"{path}/stage").first().value)
    for name, want in (("k", k), ("fragment", fragment)):
        if want is not None and want != about[name]:
            raise ValueError(f"the stage has {name} = {about[name]}, not {want}")
    table = load_idf(spark, path, about["k"], about["fragment"])
    stage = Stage(tuple(about["classes"]), about["k"], about["fragment"], about["cutoff"], table, about["documents"], MultilayerPerceptronClassificationModel.load(f"{path}/net"))
    stage.check()
    return stage


def _probabilities(texts: list[str], k: int, fragment: int, idfs: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the mean probabilities of its fragments, and how many these are: pieces of `fragment` letters, the tail dropped; a shorter text is one."""
    out, counts = np.zeros((len(texts), len(layers[-1][1]))), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        n = max(1, len(text) // fragment)
        for begin in range(0, n, 256):
            some = [text[j * fragment : (j + 1) * fragment] for j in range(begin, min(n, begin + 256))]
            keys, times = np.unique(_codes(some, k), return_counts=True)
            row, code = keys >> (2 * k), keys & ((1 << 2 * k) - 1)
            w = times * idfs[code]
            w = w / np.sqrt(np.bincount(row, w * w, len(some)))[row]
            edge = np.searchsorted(row, np.arange(len(some) + 1))
            first, bias = layers[0]
            x = np.stack([w[a:b] @ first[code[a:b]] for a, b in zip(edge, edge[1:], strict=False)]) + bias
            for weights, bias in layers[1:]:
                x = (1 / (1 + np.exp(-x))) @ weights + bias
            x = np.exp(x - x.max(1, keepdims=True))
            out[i] += (x / x.sum(1, keepdims=True)).sum(0)
        counts[i] = n
        out[i] /= n
    return out, counts


def classify(df: DataFrame, id_: str, seq: str, first: Stage, second: Stage, min_len: int = 0) -> DataFrame:
    """(id, bp, fragments, first, second, first_probabilities, second_probabilities) of each record of at least min_len letters, in one pass: fragments, weights, both nets and their means are worked out
    within the row, so nothing is shuffled. Only records that the first stage calls organelle go through the second; its columns are null for others (see score.cascade). A null sequence is left out.

    Both stages are broadcast: a net and 4^k numbers each."""
    if first.classes != FIRST or second.classes != SECOND:
        raise ValueError(f"the stages tell {first.classes} and {second.classes}, not {FIRST} and {SECOND}")
    shared = df.sparkSession.sparkContext.broadcast([(s.k, s.fragment, *s.arrays()) for s in (first, second)])
    organelle, cutoff = FIRST.index("organelle"), first.cutoff
    source = df.where(F.length(seq) >= max(min_len, 0)).select(F.col(id_).alias("id"), F.col(seq).alias("seq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                texts = part.column("seq").to_pylist()
                p, n = _probabilities(texts, *one)
                again = [i for i in range(len(texts)) if p[i].argmax() == organelle and p[i].max() > cutoff]
                q = dict(zip(again, _probabilities([texts[i] for i in again], *two)[0].tolist(), strict=True)) if again else {}
                columns = [pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(p.tolist(), pa.list_(pa.float64())), pa.array([q.get(i) for i in range(len(texts))], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=["id", "bp", "fragments", "p", "q"])

    kind = source.schema["id"].dataType.simpleString()
    rows = source.mapInArrow(run, f"id {kind}, bp long, fragments long, p array<double>, q array<double>")
    decided: Column = cascade(F.col("p"), F.col("q"), first.cutoff, second.cutoff)
    return rows.withColumn("c", decided).select("id", "bp", "fragments", "c.first", "c.second", F.col("p").alias("first_probabilities"), F.col("q").alias("second_probabilities"))


def grid_search(train: DataFrame, test: DataFrame, label: str, classes: int, grid: Sequence[Mapping], collapsed_at: float = 0.95, at_once: int = 4, seed: int = 42) -> DataFrame:
    """A row for each distinct architecture of the grid (hidden: sizes of the hidden layers, steps): accuracy, precision, recall and f1 of each class (arrays), mean_f1, pred_share (of the class predicted most), and
    whether it collapsed, pred_share being above collapsed_at. train and test: label (0, 1, ...) and x, vectors; both are written once, and up to at_once nets are fitted at a time on them."""
    train, test = kept(train.select(label, "x")), kept(test.select(label, "x"))
    inputs = train.select("x").first().x.size
    settings = sorted({(tuple(g.get("hidden", ())), int(g.get("steps", 100))) for g in grid})

    def one(setting: tuple[tuple[int, ...], int]) -> tuple:
        hidden, steps = setting
        model = _net([inputs, *hidden, classes], label, steps, seed).fit(train)
        table = np.zeros((classes, classes), np.int64)
        for r in model.transform(test).groupBy(F.col(label).cast("int").alias("t"), F.col("prediction").cast("int").alias("p")).count().collect():
            table[r.t, r.p] = r["count"]
        right, told, true = np.diag(table).astype(float), table.sum(0), table.sum(1)
        precision, recall = right / np.maximum(told, 1), right / np.maximum(true, 1)
        f1 = 2 * precision * recall / np.maximum(precision + recall, 1e-300)
        rows = max(int(table.sum()), 1)
        share = float(told.max() / rows)
        return list(hidden), steps, float(right.sum() / rows), precision.tolist(), recall.tolist(), f1.tolist(), float(f1.mean()), share, share > collapsed_at

    with ThreadPoolExecutor(at_once) as pool:  # each waits for Spark's jobs; the fits share the cluster
        found = list(pool.map(one, settings))
    return train.sparkSession.createDataFrame(found, "hidden array<int>, steps int, accuracy double, precision array<double>, recall array<double>, f1 array<double>, mean_f1 double, pred_share double, collapsed boolean")

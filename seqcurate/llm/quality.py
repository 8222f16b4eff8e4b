"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, mix, pieces, utf8, words

#: Hashed weights, and the most labelled documents that a fit looks at (chosen by hash).
BUCKETS, MAX_RATED = 1 << 16, 20_000

_CLASS = np.zeros(256, np.uint64)
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(97, 123)]] = 2
_CLASS[[*range(48, 58)]] = 3
_CLASS[128:] = 4
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _CLASS[_c] = 8 + _c


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts: three buckets for each word (the word in lower case; the kinds of its first two and last three
    bytes; its last byte with the number of marks in it), and the text of each word."""
    h, start, end, doc = words(data, at, lower=True)
    kind = _CLASS[data]
    marks = np.concatenate(([0], np.cumsum(kind > 4)))
    shape = np.zeros(len(h), np.uint64)
    for place in (start, np.minimum(start + 1, end - 1), np.maximum(end - 3, start), np.maximum(end - 2, start), end - 1):
        shape = shape * np.uint64(211) + kind[place]
    tail = data[end - 1].astype(np.uint64) * np.uint64(64) + np.minimum(marks[end] - marks[start], 63).astype(np.uint64)
    mask = np.uint64(BUCKETS - 1)
    return np.stack([h & mask, mix(shape + np.uint64(1 << 40)) & mask, mix(tail + np.uint64(1 << 41)) & mask], 1).astype(np.int64), doc


class Ordinal:
    """P(grade > k) = 1 / (1 + exp(cut_k - x.w)), with the same weights for all grades and rising cuts. x: shares of the features of a
    text, scaled by `gain`, and 1 if a feature occurs at all."""

    GAIN = 30.0

    def __init__(self, grades: int):
        self.cuts = np.arange(grades - 1, dtype=float) - (grades - 2) / 2
        self.share, self.present = np.zeros(BUCKETS), np.zeros(BUCKETS)

    @staticmethod
    def _tail(score: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -40, 40)))

    def tail(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return self._tail(score, self.cuts)

    def fit(self, doc: np.ndarray, bucket: np.ndarray, n: np.ndarray, grade: np.ndarray, steps: int = 150, rate: float = 0.05, decay: float = 1e-4) -> None:
        """doc, bucket, n: counts of features in the rated documents. Adam on the mean negative log-likelihood."""
        rows = len(grade)
        total = np.bincount(doc, n, rows)
        x = (self.GAIN * n / np.maximum(total, 1)[doc]).astype(np.float32)
        seen = np.full(len(doc), 0.3, np.float32)
        free = np.concatenate(([self.cuts[0]], np.log(np.diff(self.cuts)))) if len(self.cuts) > 1 else self.cuts.copy()
        first, second = [np.zeros(2 * BUCKETS + len(free)) for _ in range(2)]
        value = np.concatenate([self.share, self.present, free])
        for step in range(1, steps + 1):
            cuts = np.concatenate(([value[2 * BUCKETS]], value[2 * BUCKETS] + np.cumsum(np.exp(value[2 * BUCKETS + 1 :]))))
            score = np.bincount(doc, x * value[bucket] + seen * value[BUCKETS + bucket], rows)
            tail = self._tail(score, cuts)
            wide = np.column_stack([np.ones(rows), tail, np.zeros(rows)])
            here, there = wide[np.arange(rows), grade], wide[np.arange(rows), grade + 1]
            p = np.maximum(here - there, 1e-9)
            slope = wide * (1 - wide)
            up, down = slope[np.arange(rows), grade], slope[np.arange(rows), grade + 1]
            by_score = -(up - down) / p / rows
            by_cut = np.zeros(len(cuts))
            np.add.at(by_cut, np.maximum(grade - 1, 0), np.where(grade > 0, up / p / rows, 0))
            np.add.at(by_cut, np.minimum(grade, len(cuts) - 1), np.where(grade < len(cuts), -down / p / rows, 0))
            of_free = np.concatenate(([by_cut.sum()], [by_cut[k:].sum() * np.exp(value[2 * BUCKETS + k]) for k in range(1, len(cuts))]))
            grad = np.concatenate([np.bincount(bucket, x * by_score[doc], BUCKETS), np.bincount(bucket, seen * by_score[doc], BUCKETS), of_free])
            grad[: 2 * BUCKETS] += decay * value[: 2 * BUCKETS]
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
            value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        self.share, self.present = value[:BUCKETS], value[BUCKETS : 2 * BUCKETS]
        self.cuts = np.concatenate(([value[2 * BUCKETS]], value[2 * BUCKETS] + np.cumsum(np.exp(value[2 * BUCKETS + 1 :]))))


def _counted(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, bucket, n) of all texts."""
    bucket, doc = features(data, at)
    keys, n = np.unique(np.repeat(doc, 3) * BUCKETS + bucket.ravel(), return_counts=True)
    return keys // BUCKETS, keys % BUCKETS, n


def fit(docs: DataFrame, grades: DataFrame, doc_id: str = "doc_id", text: str = "text", max_rated: int = MAX_RATED) -> Ordinal | None:
    """docs and grades (doc_id, grade int from 0) joined; at most about max_rated of them, by hash of the id, are looked at.

    Rows without id, text or grade are left out; of several grades of an id the lowest counts. None, if nothing is left or all have one grade."""
    rated = grades.where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    share = min(1.0, max_rated / max(rated.count(), 1))
    rated = rated.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull()).join(rated, "doc_id").select("text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", 1 << 20):
                doc, bucket, n = _counted(*utf8(part.column("text")))
                cuts = np.searchsorted(doc, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays([part.column("grade"), *(pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()) for x in (bucket.astype(np.uint16), n.astype(np.uint32)))], names=["grade", "bucket", "n"])

    got = rows.mapInArrow(run, "grade int, bucket binary, n binary").toArrow()
    got = sorted(zip(*(c.to_pylist() for c in got.columns), strict=True))  # bounded by max_rated; in this order a rerun learns the same
    grade = np.array([r[0] for r in got], np.int64)
    if len(np.unique(grade)) < 2:
        return None
    bucket, n = np.frombuffer(b"".join(r[1] for r in got), np.uint16), np.frombuffer(b"".join(r[2] for r in got), np.uint32)
    doc = np.repeat(np.arange(len(grade), dtype=np.int32), [len(r[1]) // 2 for r in got])
    del got
    model = Ordinal(int(grade.max()) + 1)
    model.fit(doc, bucket.astype(np.int32), n.astype(np.float32), grade)
    return model


def grade_documents(docs: DataFrame, model: Ordinal | None, keep: list[str], text: str = "text", above: int = 2, least: float = 0.5) -> DataFrame:
    """The columns in `keep`, with expected_grade double, tail_probability double (of a grade of at least `above`), kept boolean. A column in `keep`
    with one of these names gives way to the new one.

    kept: the tail probability reaches `least`. A null text counts as empty, which has no features and so the score 0; without a model grade and
    probability are null and everything is kept."""
    keep = [c for c in keep if c not in ("expected_grade", "tail_probability", "kept")]
    docs = docs.select(*keep, F.col(text).alias("__text"))
    if model is None:
        return docs.select(*keep, F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail_probability"), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in pieces(batch, "__text", 1 << 20):
                doc, bucket, n = _counted(*utf8(part.column("__text")))
                total = np.bincount(doc, n, len(part))
                score = np.bincount(doc, Ordinal.GAIN * n / np.maximum(total, 1)[doc] * m.share[bucket] + 0.3 * m.present[bucket], len(part))
                tail = m.tail(score)
                p = tail[:, above - 1] if above <= tail.shape[1] else np.zeros(len(part))  # a grade above all learned ones
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(tail.sum(1)), pa.array(p), pa.array(p >= least)], names=schema.names)

    return docs.mapInArrow(run, schema)


def ratings(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the labels: 0 for low quality, 1 for good quality that is toxic, 2 for good quality that is not."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality").isNotNull(), 2).alias("grade"))

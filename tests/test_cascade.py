"""From sequence to class: stages fitted, saved, loaded and applied, against Spark's own application of the nets."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqcurate.operators import cascade, features
from seqcurate.operators.score import FIRST, SECOND

LEAN = {"organelle": "AAT", "bacteria": "GGC", "unknown": "ACGT", "archaea": "CCA", "eukarya": "TTG", "plastid": "AAT", "mitochondrion": "ATT"}


def text(rng, cls, n):
    return "".join(rng.choice("ACGT" + LEAN[cls] * 3) for _ in range(n))


@pytest.fixture(scope="module")
def stages(spark):
    rng = random.Random(1)
    out = []
    for classes in (FIRST, SECOND):
        rows = [(c, text(rng, c, 300)) for c in classes for _ in range(25)] + [("nonsense", "ACGT" * 60), (None, "ACGT" * 60)]
        out.append(cascade.fit_stage(spark.createDataFrame(rows, "cls string, s string"), "s", "cls", classes, 3, 300, (8,), 0.5, 60))
    return out


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, c, n), c, "x") for i, (c, n) in enumerate((c, n) for c in FIRST for n in (120, 300, 899, 1500))]
    rows += [(100, None, None, "x"), (101, "", None, "x"), (102, "NNNN" * 50, None, "x"), (0, text(rng, "archaea", 400), "archaea", "x")]
    return spark.createDataFrame(rows, "i long, s string, cls string, first string")


def test_classes_are_those_of_the_nets(spark, stages, records):
    first, second = stages
    got = cascade.classify(records, "i", "s", first, second)
    assert got.dtypes == [("id", "bigint"), ("bp", "bigint"), ("fragments", "bigint"), ("first", "string"), ("second", "string"), ("first_probabilities", "array<double>"), ("second_probabilities", "array<double>")]
    rows = got.collect()
    assert len(rows) == records.count() - 1 and {r.fragments for r in rows} == {1, 2, 5}
    # the same nets by Spark, fragment by fragment
    given = [(r.i, r.s) for r in records.where("s is not null").collect()]
    pieces = [(n, s[j * 300 : (j + 1) * 300]) for n, (_, s) in enumerate(given) for j in range(max(1, len(s) // 300))]
    for stage, name in ((first, "first_probabilities"), (second, "second_probabilities")):
        x = cascade.vectors(spark.createDataFrame(pieces, "n int, s string"), "s", stage.idf, 3, ["n"])
        of = defaultdict(list)
        for r in stage.model.transform(x).collect():
            of[r.n].append(r.probability.toArray())
        means = sorted((given[n][0], *np.round(np.mean(p, 0), 6)) for n, p in of.items())
        found = sorted((r.id, *np.round(r[name], 6)) for r in rows if r[name] is not None)
        assert (found == means) if stage is first else (set(found) <= set(means))
    right = {r.i: r.cls for r in records.collect() if r.cls and r.i}
    assert np.mean([r["first"] == right[r.id] for r in rows if r.id in right]) > 0.8
    organelles = [r for r in rows if r["first"] == "organelle"]
    assert organelles and all((r.second is not None) == (r["first"] == "organelle") == (r.second_probabilities is not None) for r in rows)
    assert {r.second for r in organelles} <= set(SECOND)
    assert cascade.classify(records, "i", "s", first, second, min_len=301).count() == sum(len(s) > 300 for _, s in given)
    assert cascade.classify(records.where("false"), "i", "s", first, second).count() == 0


def test_saved_stages(spark, stages, records, tmp_path):
    first, second = stages
    for stage, name in ((first, "one"), (second, "two")):
        cascade.save_stage(stage, str(tmp_path / name))
    loaded = [cascade.load_stage(spark, str(tmp_path / n), k=3, fragment=300) for n in ("one", "two")]
    a, b = (sorted(cascade.classify(records, "i", "s", *s).collect(), key=str) for s in (stages, loaded))
    assert a == b
    with pytest.raises(ValueError, match="k = 3"):
        cascade.load_stage(spark, str(tmp_path / "one"), k=5)
    with pytest.raises(ValueError, match="fragment"):
        cascade.load_stage(spark, str(tmp_path / "one"), fragment=5000)
    with pytest.raises(ValueError, match="tell"):
        cascade.classify(records, "i", "s", second, first)
    # an idf of another k or fragment length beside the net is not taken
    other = features.idf(features.doc_freq(records.where("s is not null"), "s", 4), 20, 4)
    features.save_idf(other, str(tmp_path / "two"), 300, 20)
    with pytest.raises(ValueError):
        cascade.load_stage(spark, str(tmp_path / "two"))
    features.save_idf(first.idf, str(tmp_path / "one"), 1000, 20)
    with pytest.raises(ValueError, match="fragments"):
        cascade.load_stage(spark, str(tmp_path / "one"))


def test_grid_of_architectures(spark):
    rng = random.Random(3)
    rows = [(float(i % 3), [rng.gauss(3.0 * (i % 3 == j), 1) for j in range(3)]) for i in range(240)]
    df = spark.createDataFrame(rows, "y double, a array<double>").select("y", cascade.F.col("a"))
    from pyspark.ml.functions import array_to_vector

    df = df.withColumn("x", array_to_vector("a")).withColumn("u", F.rand(1))
    out = cascade.grid_search(df.where("u < 0.7"), df.where("u >= 0.7"), "y", 3, [{"steps": 30}, {"hidden": [4], "steps": 30}, {"hidden": (4,), "steps": 30}, {"hidden": (6, 4), "steps": 1}])
    got = {(tuple(r.hidden), r.steps): r for r in out.collect()}
    assert set(got) == {((), 30), ((4,), 30), ((6, 4), 1)}
    assert got[(), 30].mean_f1 > 0.85 and all(len(r.f1) == len(r.precision) == len(r.recall) == 3 and r.collapsed == (r.pred_share > 0.95) for r in got.values())
    best = got[(), 30]
    assert best.mean_f1 == pytest.approx(np.mean([2 * p * q / (p + q) for p, q in zip(best.precision, best.recall, strict=True)]))

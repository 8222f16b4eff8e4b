"""The operators on small fixtures and invariants."""

import zlib

from pyspark.sql import functions as F

from seqcurate.functions import labels, scalars
from seqcurate.functions.ids import base_accession, extract_accessions, parse_header
from seqcurate.operators import metrics, quota, select


def test_class_from_meta(spark):
    cases = [("euk", "Organelle-Mito", "mitochondria"), ("euk", "Archaeplastida", "eukarya"), ("euk", "Kinetoplastida", "eukarya"), ("prok", "Archaea", "archaea"), ("prok", "", None), ("euk", "organelle-unknown", None), ("bacteria", "Viruses", "virus"), ("plastid", None, "plastids"), (None, None, None)]
    df = spark.createDataFrame(cases, "label string, sg string, want string").withColumn("got", labels.class_from_meta(F.col("label"), F.col("sg")))
    assert [r.got for r in df.collect()] == [c[2] for c in cases]


def test_ids(spark):
    df = spark.createDataFrame([(">A.1|2 sg=x label=y sg=z", "GCF_000001405.40 and gcf_000001405.40, GCA_000000001")], "h string, t string")
    r = df.select(parse_header(F.col("h")).alias("m"), extract_accessions(F.col("t")).alias("a"), base_accession(F.lit("G.1.2")).alias("f"), base_accession(F.lit("G.1.2"), "last").alias("l")).first()
    assert r.m == {"sg": "z", "label": "y", "epoch": ""}
    assert r.a == ["GCF_000001405.40", "GCA_000000001"] and (r.f, r.l) == ("G", "G.1")


def test_hash_sampling(spark):
    seqs = ["acgt" * n for n in range(1, 200)]
    df = spark.createDataFrame(list(enumerate(seqs)), "id long, s string")
    kept = {r.id for r in df.where(scalars.keep_by_content(F.col("s"), 0.4, 42)).collect()}
    assert kept == {i for i, s in enumerate(seqs) if zlib.crc32(s.upper().encode(), 42) % 1_000_000 < 400_000}
    kept = {r.id for r in df.where(scalars.keep_by_id(F.col("id"), 0.4, 7)).collect()}
    assert kept == {i for i in range(len(seqs)) if zlib.crc32(f"7:{i}".encode()) < int(0.4 * (1 << 32))}


def test_water_filling(spark):
    rows = [(k, float(w), c) for k, w, c in (("a", 5, 10), ("b", 3, 100), ("c", 2, 40), ("d", 1, 0), ("e", 0, 50))]
    df = spark.createDataFrame(rows, "k string, w double, c long")
    for total in (0, 7, 60, 150, 999):
        got = {r.k: r.quota for r in quota.allocate_capped(df, F.lit(total), "w", "c", "k").collect()}
        assert sum(got.values()) == min(total, 150) and all(got[k] <= c for k, _, c in rows) and got["e"] == 0
    assert {r.k: r.quota for r in quota.allocate_capped(df, F.lit(60), "w", "c", "k").collect()} == {"a": 10, "b": 30, "c": 20, "d": 0, "e": 0}


def test_dedup_exact(spark):
    rows = [("test", "A"), ("test", "T"), ("validation", "A"), ("validation", "C"), ("validation", "G"), ("validation", "G"), ("train", "A"), ("train", "C"), ("train", "T"), ("train", "N")]
    got = select.dedup_exact(spark.createDataFrame(rows, "split string, s string"), "s", "split", ["test", "validation", "train"]).collect()
    assert sorted((r.split, r.s) for r in got) == [("test", "A"), ("test", "T"), ("train", "N"), ("validation", "C"), ("validation", "G"), ("validation", "G")]


def test_kmers_and_length_bins(spark):
    got = {r.kmer: r.n for r in select.kmer_counts(spark.createDataFrame([(1, "acgNacg")], "id long, s string"), "id", "s", 2).collect()}
    assert got == {"AC": 2, "CG": 2}
    df = spark.createDataFrame([(1000,), (1500,)], "n long")
    assert [r.b for r in df.select(scalars.length_bin(F.col("n")).alias("b")).collect()] == ["L1000", "VAR"]


def test_entry_imports(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["stratum", "available_bp", "target_bp", "kept_bp", "kept_records", "error_pct"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_diff_index(spark):
    rows = spark.createDataFrame([("A.1", 1), ("A.1", 2), ("A.2", 3), ("B.1", 4)], "key string, i int")
    got = select.diff_index(rows, spark.createDataFrame([("A.1",), ("A.1",)], "key string"), "key", ["i"]).collect()
    assert sorted((r.i, r.status) for r in got) == [(1, "already_held"), (2, "duplicate_in_source"), (3, "other_version"), (4, "new")]
    assert select.diff_index(rows.limit(0), rows.select("key"), "key", ["i"]).count() == 0


def test_distinct_sequences(spark):
    got = select.distinct_sequences(spark.createDataFrame([(1, "A"), (1, "A"), (2, "A"), (2, "C")], "r int, s string"), ["r"], "s").collect()
    assert sorted((r.r, r.copies) for r in got) == [(1, 2), (2, 1), (2, 1)]


def test_projection_and_collapse(spark):
    stats, priors = spark.createDataFrame([("a", 30), ("b", 10)], "c string, n long"), spark.createDataFrame([("a", 0.5), ("z", 0.5)], "c string, prior double")
    got = {r.c: (r.n, r.share, r.delta_pp, r.missing) for r in metrics.project(stats, priors, "c", "n", 100).collect()}
    assert got == {"a": (30, 0.75, 25.0, 20), "z": (0, 0.0, -50.0, 50)}
    assert tuple(metrics.pred_share(spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "p string"), "p").first()) == ("a", 0.5)

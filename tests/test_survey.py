"""Operators of the survey on small fixtures: odd rows, edges and invariants that the queries over whole tables do not show."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqcurate import sources
from seqcurate.functions import ids, labels, scalars
from seqcurate.operators import curate, features, metrics, plan, quota, sampling, score, select
from seqcurate.operators.order import placed, running
from seqcurate.streaming import score_stream, scored


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(50), rng.randrange(9), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x int, v int, i int").repartition(7)
    got = {r.i: r for r in running(df, [F.desc("x"), F.col("i")], {"total": F.col("v")}, ["g"]).collect()}
    last = {r.i: r.before for r in running(df, [F.desc("x"), F.col("i")], {"before": F.col("v")}, ["g"], largest=True, before=True).collect()}
    nth = {r.i: r.n for r in placed(df, [F.desc("x"), F.col("i")], "n", ["g"]).collect()}
    for g in ("a", "b", None):
        total, most = 0, None
        for n, (_, _, v, i) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[3])), 1):
            assert last[i] == most and nth[i] == n
            total, most = total + v, v if most is None else max(most, v)
            assert got[i].total == total
    assert running(df.limit(0), [F.col("x")], {"t": F.col("v")}).count() == 0


def test_census_and_dedup_on_nulls(spark):
    df = spark.createDataFrame([(None, 5), (None, 7), ("a", 1)], "g string, bp int")
    got = {r.g: (r.records, r.bp) for r in metrics.census(df, ["g"], "bp", spark.createDataFrame([("a",), ("z",), (None,)], "g string")).collect()}
    assert got == {None: (2, 12), "a": (1, 1), "z": (0, 0)}
    rows = [("test", None, "x"), ("train", None, "x"), ("train", "A", None), ("test", "A", None), ("train", "A", "y")]
    kept = select.dedup_exact(spark.createDataFrame(rows, "split string, s string, b string"), "s", "split", ["test", "train"], ["b"]).collect()
    assert sorted((r.split, r.s or "", r.b or "") for r in kept) == [("test", "", "x"), ("test", "A", ""), ("train", "", "x"), ("train", "A", "y")]
    with pytest.raises(Exception, match="split without a priority"):
        select.dedup_exact(spark.createDataFrame([("other", "A")], "split string, s string"), "s", "split", ["test"]).collect()


def test_water_filling_of_ties(spark):
    df = spark.createDataFrame([(f"s{i}", 1.0, 10) for i in range(6)], "k string, w double, c long")
    assert {r.quota for r in quota.allocate_capped(df, F.lit(30), "w", "c", "k").collect()} == {5}
    shares = sampling.cap_target(df.withColumn("q", F.when(F.col("k") == "s0", 10.0).otherwise(1.0)), "c", "q", 2.0, "k").collect()
    assert sum(r.effective for r in shares) == pytest.approx(1.0) and max(r.effective for r in shares) == pytest.approx(1 / 3)
    with pytest.raises(Exception, match="infeasible"):
        quota.bp_plan(spark.createDataFrame([("a", 10), ("b", 1)], "stratum string, bp long"), {"a": 0.5, "b": 0.5}, {}, "none", 100).collect()
    with pytest.raises(ValueError):
        quota.balance_splits(df, ["test"], {}, {}, "k", "k")


def test_evidence_and_dates(spark):
    text = lambda t, flag="": spark.createDataFrame([(t, flag)], "t string, f string").select(scalars.evidence(F.col("t"), "mag", F.col("f")).alias("m")).first().m
    assert text("a MAG of x") == "MAG" and text("magnet") is None and text("x", " y ") == "explicit_is_mag"
    assert text("metagenome-assembled, derived from metagenome") == "derived from metagenome"
    base = dict(entity_type="assembly", source="refseq", source_native_id="", assembly_accession="GCF_1.1", ftp_path="x", version_status="latest", genome_rep="Full", seq_rel_date="2020/01/01")
    rows = [base | d for d in ({}, {"seq_rel_date": "2021/01/01"}, {"seq_rel_date": ""}, {"entity_type": "organelle", "ftp_path": ""}, {"source": "jgi", "ftp_path": "na", "source_native_id": "J"}, {"source": "jgi", "assembly_accession": ""}, {"assembly_accession": "GCF_1"}, {"ftp_path": "na"})]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in base))
    ok = [r.ok for r in df.select(scalars.passes_hard_filter(F.lit(None).cast("string"), before="2021/01/01", after="2020/01/01").alias("ok")).collect()]
    assert ok == [True, False, True, True, True, False, False, False]
    sizes = [r.c for r in spark.createDataFrame([("0", "x"), (str(20 << 20), "x"), (str((20 << 20) + 1), "x"), (str(201 << 20), "x"), (None, "viral_segment_fna")], "h string, k string").select(scalars.size_class(F.col("h"), F.col("k")).alias("c")).collect()]
    assert sizes == ["medium", "small", "medium", "large", "small"]


def test_accessions_in_text(spark):
    cases = {"see GCF_1.2, nc_000001.11 (AB12345) xGCF_9": ["GCF_1.2", "NC_000001.11", "AB12345"], "JGI:77": ["JGI:77"], "": [], None: [], "GCA_1 gca_1": ["GCA_1"]}
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", ids.extract_accessions(F.col("t")).alias("a"))
    assert {r.t: r.a for r in df.collect()} == cases


def test_contamination(spark):
    contigs = spark.createDataFrame([("c1", "m", "euk", 95), ("c2", "m", "euk", 5), ("c3", "m", "euk", 900), ("d", "n", "bac", 10)], "contig_id string, mag_id string, mag_kingdom string, length int")
    hits = spark.createDataFrame([("c1", "euk", 0.95, 0.9, 0.9, 1), ("c2", "bac", 0.95, 0.9, 0.9, 2), ("c2", "euk", 0.95, 0.9, 0.9, 3), ("c3", "bac", 0.89, 1.0, 1.0, 4)], "contig_id string, target_kingdom string, fident double, qcov double, tcov double, ordinal int")
    got = {r.mag_id: r for r in select.mag_qc(contigs, hits).collect()}
    assert (got["m"].own_bp, got["m"].foreign_bp, got["m"].unassigned_bp, got["m"].foreign_share, got["m"].dropped) == (95, 5, 900, 0.05, True)
    assert got["n"].foreign_share == 0 and not got["n"].dropped


def test_corpus_round_trip(spark, tmp_path):
    for split, name, text in (("train", "archea", ">a x\nACG\nT\n"), ("train", "bacteria", ">b\nAC\n>c\nGG\n"), ("test", "archaea", ">d\nA\n"), ("test", "bacteria", ">e\nC\n")):
        (tmp_path / split).mkdir(exist_ok=True)
        (tmp_path / split / f"{name}.fasta").write_text(text)
    got = sources.read_corpus(spark, str(tmp_path), ["train", "test"], ["archaea", "bacteria"])
    assert sorted((r.fragment_id, r.sequence, r.split, r["class"]) for r in got.collect()) == [("a", "ACGT", "train", "archaea"), ("b", "AC", "train", "bacteria"), ("c", "GG", "train", "bacteria"), ("d", "A", "test", "archaea"), ("e", "C", "test", "bacteria")]
    with pytest.raises(FileNotFoundError):
        sources.read_corpus(spark, str(tmp_path), ["train"], ["plastids"])
    pred, counts = sources.infer(spark, [str(tmp_path / "train"), str(tmp_path / "test")], lambda df: df.withColumn("gc", F.length(F.regexp_replace("sequence", "[^GC]", ""))), str(tmp_path / "scored"), 2)
    assert pred.count() == 3 and counts.where("path is null").first().records == 3
    out = str(tmp_path / "out")
    paths = sources.write_corpus(got, out, width=2)
    assert sorted(p.split("/out/")[1] for p in paths) == [f"{s}/{c}.fasta" for s in ("test", "train") for c in ("archaea", "bacteria")]
    back = sources.read_corpus(spark, out, ["train", "test"], ["archaea", "bacteria"])
    assert sorted(back.collect()) == sorted(got.select(back.columns).collect())
    one = sources.read_corpus(spark, out, ["train"], ["archaea"])
    assert {f.split("/out/")[1].rpartition("/")[0] for f in one.inputFiles()} == {"train/archaea.fasta"}  # no other file is read
    # a class that is written again replaces the old one; the others stay, and nothing of the draft does
    sources.write_corpus(got.where("fragment_id = 'b'"), out)
    assert [r.fragment_id for r in sources.read_corpus(spark, out, ["train"], ["bacteria"]).collect()] == ["b"] and sources.read_corpus(spark, out, ["test"], ["bacteria"]).count() == 1
    assert sorted(x.name for x in (tmp_path / "out").iterdir()) == ["test", "train"]
    # a file, a pattern and a folder that name the same files; one file has no record that is long enough
    paths = [str(tmp_path / "train" / "bacteria.fasta"), str(tmp_path / "t*"), str(tmp_path / "test")]
    _, counts = sources.infer(spark, paths, lambda df: df, str(tmp_path / "scored2"), 2)
    assert {(r.path or "all").rpartition("/")[2]: r.records for r in counts.where("path is null or path like '%train%'").collect()} == {"archea.fasta": 1, "bacteria.fasta": 2, "all": 3}
    assert counts.where("records = 0").count() == 2


def test_chunks_of_long_records(spark, tmp_path):
    """Records over many blocks of a file, lines of any length, blank ones, text before the first header, a record without letters; compressed or not."""
    import gzip

    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    records = {"a": letters(50_000), "b": "", "c": letters(7), "d": letters(20_000)}
    lines = ["no header yet"]
    for name, seq in records.items():
        lines.append(f">{name} of {len(seq)}")
        while seq:
            n = rng.randrange(1, 90)
            lines += [seq[:n], ""] if n == 5 else [seq[:n]]
            seq = seq[n:]
    (tmp_path / "one.fa").write_text("\n".join(lines) + "\n")
    (tmp_path / "two.fa.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1500)
    try:
        for name in ("one.fa", "two.fa.gz"):
            rows = sources.read_chunks(spark, str(tmp_path / name), 600).collect()
            assert {r.header for r in rows} == {f"{k} of {len(v)}" for k, v in records.items()} and max(len(r.sequence) for r in rows) < 700
            for k, seq in records.items():
                at = 0
                for r in sorted((r for r in rows if r.fragment_id == k), key=lambda r: (r.start, len(r.sequence))):
                    assert r.start == at
                    at += len(r.sequence)
                assert at == len(seq) and "".join(r.sequence for r in sorted((r for r in rows if r.fragment_id == k), key=lambda r: (r.start, len(r.sequence)))) == seq
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stream_of_fasta(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.fasta").write_text(">a 1\nACGT\nAC\n>b\nGG\n")
    run = lambda: score_stream(spark, str(tmp_path / "in"), "", lambda df: df.select("fragment_id", "bp"), str(tmp_path / "out"), str(tmp_path / "mark"), "fasta").awaitTermination()
    run()
    (tmp_path / "in" / "two.fasta").write_text(">c\nT\n")
    run()
    assert sorted(map(tuple, scored(spark, str(tmp_path / "out")).collect())) == [("a", 6), ("b", 2), ("c", 1)]


def test_choppers(spark):
    rng = random.Random(2)
    seq = "".join(rng.choice("ACGT") for _ in range(9000))
    df = spark.createDataFrame([(1, seq), (2, seq[:300]), (3, None), (4, "N" * 5000), (5, "ACGT" * 50)], "id long, s string")
    for got in (sampling.chop_fixed(df, "id", "s", 100, passes=2, overlap=10, phase="random"), sampling.chop_varlen(df, "id", "s", 200, 900, 2.0, True), sampling.chop_discrete(df, "id", "s", (100, 300), (1, 3), 0.2, 50)):
        rows = got.collect()
        texts = {1: seq, 2: seq[:300], 5: "ACGT" * 50}
        assert {r.id for r in rows} <= {1, 2, 5} and len({(r.id, r.fragment) for r in rows}) == len(rows)
        assert all(texts[r.id][r.start : r.start + len(r.fragment)] == r.fragment for r in rows)
    cover = sum(len(r.fragment) for r in sampling.chop_varlen(df, "id", "s", 200, 900, 2.0).where("id = 1").collect())
    assert 18_000 <= cover < 18_900


def test_signals(spark):
    rng = random.Random(3)
    seq = "".join(rng.choice("ACGTN") for _ in range(400)) + "AAAAAAA"
    got = features.signals(seq)
    assert got.shape == (60,) and np.isfinite(got).all() and features.signals("").shape == (60,)
    assert got[0] == pytest.approx(math.log1p(407)) and got[5] == pytest.approx(max(len(x) for x in "".join(c if c == p else " " + c for p, c in zip(" " + seq, seq)).split()) / 407)
    acgt = Counter(c for c in seq if c != "N")
    n = sum(acgt.values())
    assert got[1] == pytest.approx((acgt["C"] + acgt["G"]) / n) and got[3] == pytest.approx(-sum(v / n * math.log2(v / n) for v in acgt.values()) / 2, rel=1e-5)
    tri = Counter(seq[i : i + 3] for i in range(len(seq) - 2))
    assert got[4] == pytest.approx(-sum(v / 405 * math.log2(v / 405) for v in tri.values()) / 6, rel=1e-5)
    codons = [seq[i : i + 3] for i in range(0, len(seq) - 2, 3) if "N" not in seq[i : i + 3]]
    assert got[6] == pytest.approx(sum(c in features.STOPS for c in codons) / len(codons))
    three = [(a, b) for a, b in zip(seq, seq[3:]) if a != "N" and b != "N"]
    lag = lambda k: np.mean([a == b for a, b in zip(seq, seq[k:]) if a != "N" and b != "N"])
    assert got[59] == pytest.approx(np.mean([a == b for a, b in three]) - 0.5 * (lag(1) + lag(2)), abs=1e-6)


def test_kmers_over_lines_and_batches(spark):
    rows = [(1, "ACG\nACG"), (2, None), (3, "acgtnACGT"), (4, "é" * 5 + "ACG"), (5, "")]
    got = features.kmer_counts(spark.createDataFrame(rows, "id long, s string"), "id", "s", [3]).collect()
    assert {(r.id, r.code): r.n for r in got} == {(1, 6): 2, (3, 6): 2, (3, 27): 2, (4, 6): 1}


def test_idf_model_checks(spark, tmp_path):
    df = spark.createDataFrame([(1, "ACGT")], "id long, s string")
    features.save_idf(features.idf(features.doc_freq(df, "s", 2), 1, 2), str(tmp_path / "m"), 5000, 1)
    assert features.load_idf(spark, str(tmp_path / "m"), 2, 5000).count() == 16
    for bad in ((3, None), (2, 1)):
        with pytest.raises(ValueError):
            features.load_idf(spark, str(tmp_path / "m"), *bad)


def test_only_what_is_above_is_looked_at(spark):
    nodes = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 3), (5, 1), (6, 5), (7, 8), (8, 7)], "id long, parent long")
    up = lambda *ids: sorted(r.id for r in select.upward(nodes, spark.createDataFrame([(i,) for i in ids], "id long")).collect())
    assert up(4) == [1, 2, 3, 4] and up(6, 3, 3) == [1, 2, 3, 5, 6] and up(7) == [7, 8] and up(99) == []


def test_weighted_sample_is_multinomial(spark):
    """Counts and counts of pairs of epochs by chi-square; the sum is exact, reruns agree, a row with a third of the weight and rows without weight."""
    rng = random.Random(4)
    w = [rng.random() * (i % 3) for i in range(200)]
    w[7] = sum(w) / 2
    rows = [(i, x if i != 11 else None) for i, x in enumerate(w)]
    w[11] = 0.0
    df = spark.createDataFrame([*rows, (500, -1.0)], "i int, w double")
    draw = lambda epoch: {r.i: r.draws for r in sampling.weighted_sample(df, "w", ["i"], 20_000, epoch=epoch).collect()}
    one, two = draw(0), draw(1)
    assert one == draw(0) != two and sum(one.values()) == sum(two.values()) == 20_000
    live = [i for i, x in enumerate(w) if x > 0]
    assert set(one) | set(two) <= set(live)
    chi = sum((got.get(i, 0) - 20_000 * w[i] / sum(w)) ** 2 / (20_000 * w[i] / sum(w)) for got in (one, two) for i in live)
    free = 2 * (len(live) - 1)
    assert abs(chi - free) < 5 * math.sqrt(2 * free)  # systematic points would be far below
    a, b = ([(g.get(i, 0) - 20_000 * w[i] / sum(w)) / math.sqrt(20_000 * w[i] / sum(w)) for i in live] for g in (one, two))
    assert abs(sum(x * y for x, y in zip(a, b, strict=True))) < 5 * math.sqrt(len(live))  # epochs are independent
    with pytest.raises(ValueError, match="nothing"):
        sampling.weighted_sample(df.where("i = 11"), "w", ["i"], 5)


def test_donor_caps(spark):
    rows = [("l", f"a{i}", f"s{i // 3}", 100 if i == 0 else 1) for i in range(30)]
    got = sampling.donor_caps(spark.createDataFrame(rows, "leaf string, acc string, sp string, n long"), "leaf", ["acc", "sp"], [0.1, 0.2]).collect()
    by = Counter()
    for r in got:
        assert r.share <= 0.1 + 1e-8
        by[r.sp] += r.share
    assert sum(r.share for r in got) == pytest.approx(1.0) and max(by.values()) <= 0.2 + 1e-8
    with pytest.raises(Exception, match="infeasible"):
        sampling.donor_caps(spark.createDataFrame(rows[:3], "leaf string, acc string, sp string, n long"), "leaf", ["acc"], [0.2]).collect()


def test_donor_caps_not_nested_or_impossible(spark):
    make = lambda rows: spark.createDataFrame(rows, "leaf string, acc string, sp string, n long")
    # rounds do not get there: an error, no shares above the caps
    rows = [("l", f"a{i}", f"s{min(i, 1)}", n) for i, n in enumerate((168, 24, 102, 23, 13, 16))]
    with pytest.raises(Exception, match="infeasible"):
        sampling.donor_caps(make(rows), "leaf", ["acc", "sp"], [0.1686, 0.5342]).collect()
    with pytest.raises(ValueError, match="cap"):
        sampling.donor_caps(make(rows), "leaf", ["acc", "sp"], [0.5, 1.5])
    crossed = [("l", f"a{i % 4}", f"s{i % 5}", 1 + i) for i in range(20)]  # each acc in all species
    got = sampling.donor_caps(make(crossed), "leaf", ["acc", "sp"], [0.26, 0.23]).collect()
    for key, cap in (("acc", 0.26), ("sp", 0.23)):
        by = Counter()
        for r in got:
            by[r[key]] += r.share
        assert max(by.values()) <= cap + 1e-8 and sum(by.values()) == pytest.approx(1.0)


def test_donor_caps_are_the_level_of_the_tree(spark):
    """Against a search for the level: every node of the tree holds at most its cap."""
    rng = random.Random(2)
    rows = [("xy"[i % 2], f"a{i}", f"s{i // 6}", f"g{i // 24}", rng.randrange(1, 90)) for i in range(96)]
    caps = (0.05, 0.16, 0.33)
    got = {r.acc: r.share for r in sampling.donor_caps(spark.createDataFrame(rows, "leaf string, acc string, sp string, genus string, n long"), "leaf", ["acc", "sp", "genus"], caps).collect()}
    for leaf in "xy":
        own = [r for r in rows if r[0] == leaf]
        total = sum(r[4] for r in own)

        def filled(level, depth, key):
            inner = [r for r in own if r[3 - depth] == key] if depth >= 0 else own
            if depth == 2:
                return min(caps[0], level * inner[0][4] / total)
            below = sorted({r[2 - depth] for r in inner})
            amount = sum(filled(level, depth + 1, k) for k in below)
            return min((1.0, caps[2], caps[1])[depth + 1], amount)

        low, high = 0.0, 1e6
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(filled(mid, 0, g) for g in {r[3] for r in own}) < 1 else (low, mid)
        assert sum(got[r[1]] for r in own) == pytest.approx(1.0)
        for g in {r[3] for r in own}:
            assert sum(got[r[1]] for r in own if r[3] == g) == pytest.approx(filled(high, 0, g), abs=1e-7)
        for s in {r[2] for r in own}:
            assert sum(got[r[1]] for r in own if r[2] == s) <= caps[1] + 1e-9


def test_cap_target_falls_back_to_room(spark):
    df = spark.createDataFrame([("a", 50.0, 1.0), ("b", 30.0, 0.0), ("c", 20.0, 0.0)], "k string, p double, q double")
    got = {r.k: r.effective for r in sampling.cap_target(df, "p", "q", 1.5, "k").collect()}
    assert got == pytest.approx({"a": 0.75, "b": 0.15, "c": 0.10})  # a is full; the others get the rest by their room
    with pytest.raises(Exception, match="empty"):
        sampling.cap_target(df.withColumn("p", F.when(F.col("k") == "b", 0.0).otherwise(F.col("p"))), "p", "q", 1.5, "k").collect()


def test_water_filling_of_many_keys(spark):
    """A hundred thousand keys, no task with all of them; the level is that of a search."""
    rng = np.random.default_rng(3)
    n = rng.integers(1, 4000, 100_000)
    counts = spark.createDataFrame([(i, int(x)) for i, x in enumerate(n)], "k long, n long")
    out = quota.allocate_rates(counts, 20_000_000, "sqrt", "k", floor=5, cap=600)
    got = {r.k: r.quota for r in out.collect()}
    cap, low = np.minimum(n, 600), np.minimum(np.minimum(n, 600), 5)
    a, b = 0.0, 1e4
    for _ in range(200):
        mid = (a + b) / 2
        a, b = (mid, b) if np.minimum(cap, low + mid * np.sqrt(n)).sum() < 20_000_000 else (a, mid)
    assert np.allclose([got[i] for i in range(len(n))], np.minimum(cap, low + b * np.sqrt(n)), atol=1e-5)


def test_qc_by_entity_type(spark):
    base = {"entity_id": "E1", "assembly_accession": "GCA_1.1", "entity_type": "assembly", "source": "refseq", "species_taxid": "9", "genome_size": "5000", "genome_size_ungapped": "bad"}
    virus = {"sequence_accession": "NC_1.1", "taxid": "7", "download_url": "u", "virus_group": "dsDNA viruses", "virus_reported_genome_length": "500", "host": "h", "is_refseq_viral": "1"}
    rows = [
        base | {"contig_n50": ""},
        base | {"entity_id": "E2", "entity_type": "organelle", "assembly_accession": ""},
        base | {"entity_id": "E3", "entity_type": "organelle", "species_taxid": ""},
        base | virus | {"entity_id": "V1", "entity_type": "virus_sequence", "virus_genome_id": "VG1"},
        base | virus | {"entity_id": "V2", "entity_type": "virus_sequence", "taxid": "", "is_refseq_viral": "0", "host": "", "virus_group": "?"},
    ]
    names = sorted({k for r in rows for k in r})
    df = spark.createDataFrame([tuple(r.get(n, "") for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    sizes = spark.createDataFrame([("9", 10000.0, 20000.0)], "species_taxid string, lo double, hi double")
    features = spark.createDataFrame([("GCA_1.1", "", "999", "PacBio")], "accession string, contig_n50 string, scaffold_n50 string, sequencing_technology string")
    out = curate.apply_qc(df, {"size_range": sizes}, features=features, virus={"allowed": ["dsDNA"], "min_length": 100})
    got = {r.entity_id: (r.qc_status, round(r.score, 6), r.flags, r.split_group_id, r.n50_metric) for r in out.collect()}
    assert got["E1"] == ("accepted", 7.0, [], "SP_9", "scaffold_n50")  # log10(1000) + curated + long reads; an ungapped size that is no number is no size
    assert got["E2"][:4] == ("accepted", 5.0, [], "9") and got["E3"][:4] == ("accepted", 5.0, [], "E3")
    assert got["V1"][:4] == ("accepted", 11.0, [], "VG1")
    assert got["V2"][:4] == ("rejected", 5.0, ["MISSING_TAXID", "GENOME_TYPE_unknown"], "9")


def test_water_filling_where_all_is_taken(spark):
    counts = spark.createDataFrame([(1, 10), (2, 20)], "k int, n long")
    assert {r.k: r.quota for r in quota.allocate_rates(counts, 500, "equal", "k").collect()} == {1: 10.0, 2: 20.0}


def test_quota_counts_unnamed_species_each(spark):
    rows = [("g", "", "", 100.0, -1.0)] * 9 + [("g", "", "5", 900.0, -1.0), ("g", "5", "", 100.0, -1.0)]
    out = select.genus_quota(spark.createDataFrame(rows, "genus string, sp string, tx string, size double, gc double"), "genus", ("sp", "tx"), "size", "gc", max_per=9)
    assert out.first().quota == 3  # 10 species, to the power of 0.4, rounded up


def test_inventory_counts_left_out_rows_as_filtered(spark):
    rows = [("s", "g", "1", "mag_excluded", "x"), ("s", "g", "2", "hard_filtered", None), ("s", "g", "", "kept", None)]
    got = curate.inventory(spark.createDataFrame(rows, "source string, group_name string, species_taxid string, status string, mag_evidence string")).first()
    assert (got.parsed, got.hard_filtered, got.mag_excluded, got.kept, got.species) == (3, 2, 1, 1, 2)


def test_spaced_sample(spark):
    df = spark.createDataFrame([(c, i) for c, n in (("a", 100), ("b", 7), ("c", 1)) for i in range(n)], "c string, i int")
    got = sampling.spaced_sample(df, "c", ["i"], 20).collect()
    want = {}
    for c, n in (("a", 100), ("b", 7), ("c", 1)):
        take = min(n, max(1, round(n * 20 / 108)))
        want[c] = sorted({int(x) for x in np.round(np.linspace(0, n - 1, take))})
    assert {c: sorted(r.i for r in got if r.c == c) for c in "abc"} == want


def test_spaced_sample_takes_exact_halves_to_the_even_place(spark):
    """Counts at which 37 * ((count - 1) / 74) misses a half in doubles; a null class is none, and no rows give none."""
    sizes = {"a": 116, "b": 124, "c": 162, "d": 75, None: 40}
    df = spark.createDataFrame([(c, i) for c, n in sizes.items() for i in range(n)], "c string, i int")
    got = sampling.spaced_sample(df, "c", ["i"], 300, "equal").collect()
    want = {c: sorted(round(Fraction(i * (n - 1), 74)) for i in range(75)) for c, n in sizes.items() if c}
    assert {c: sorted(r.i for r in got if r.c == c) for c in {r.c for r in got}} == want
    assert sampling.spaced_sample(df.where("false"), "c", ["i"], 300, "equal").count() == 0



def test_cascade_and_decode(spark):
    first = [[0.7, 0.1, 0.1, 0.05, 0.05], [0.1, 0.4, 0.05, 0.35, 0.1], [0.1, 0.3, 0.1, 0.2, 0.3], [0.65, 0.1, 0.1, 0.1, 0.05]]
    df = spark.createDataFrame([(f, [0.1, 0.2, 0.7]) for f in first], "a array<double>, b array<double>")
    got = [tuple(r.c) for r in df.select(score.cascade(F.col("a"), F.col("b"), 0.65, 0.65).alias("c")).collect()]
    assert got == [("organelle", "mitochondrion"), ("prokarya", None), ("unknown", None), ("unknown", None)]
    d = spark.createDataFrame([([0.5, 0.3, 0.2], [1.0] * 8, [0.6, 0.4], [0.5, 0.5]), ([0.2, 0.6, 0.2], [1.0] * 8, [0.6, 0.4], [0.5, 0.5])], "r array<double>, e array<double>, p array<double>, o array<double>")
    h = score.hier_decode(F.col("r"), {"euk": F.col("e"), "prok": F.col("p"), "organelle": F.col("o")}, thresholds={"prok": 0.6}, given="probabilities")
    assert [(r.h.root, r.h.leaf) for r in d.select(h.alias("h")).collect()] == [("euk_nuclear", "fungi"), ("prok", "bacteria")]


def test_promotion_only_raises(spark):
    df = spark.createDataFrame([([0.4, 0.6, 0.0], 0.99, 1000), ([0.4, 0.6, 0.0], 0.01, 1000), ([0.05, 0.9, 0.05], 0.99, 1000), ([0.4, 0.6, 0.0], 0.99, 9000)], "p array<double>, e double, bp int")
    got = [r.x for r in df.select(score.promote(F.col("p"), F.col("e"), F.col("bp"), 0.5, 1.0, 2.0, 0.1, 1.0, 0.0).alias("x")).collect()]
    assert [g.promoted for g in got] == [True, False, False, False] and all(sum(g.probabilities) == pytest.approx(1) for g in got)
    assert got[1].probabilities == pytest.approx([0.4, 0.6, 0.0], abs=1e-9)


def test_delta_admission(spark):
    cols = "record_id string, split string, digest string, species_taxid string, split_group_id string, duplicate_cluster_id string"
    base = spark.createDataFrame([("b1", "train", "d1", "1", "", ""), ("b2", "validation", "d2", "2", "", "")], cols)
    c = "record_id string, split string, meta_split string, euk_group string, digest string, species_taxid string, split_group_id string, duplicate_cluster_id string, ordinal long, has_metadata boolean"
    rows = [("n1", "train", "", "fungi", "x1", "5", "g", "", 1, True), ("n2", "train", "", "fungi", "x1", "6", "", "", 2, True), ("n3", "validation", "", "fungi", "x3", "5", "", "", 3, True), ("n4", "train", "", "fungi", "x4", "2", "", "", 4, True), ("b1", "train", "", "fungi", "x5", "7", "", "", 5, True), ("n6", "train", "", "algae", "x6", "7", "", "", 6, True), ("n7", "validation", "", "fungi", "x7", "9", "", "", 7, True), ("n8", "train", "test", "fungi", "x8", "9", "", "", 8, True), ("n9", "train", "", "", "x9", "9", "", "", 9, True), ("n10", "train", "", "fungi", "xa", "", "", "", 10, True), ("n11", "train", "", "fungi", "xb", "1", "", "", 11, False)]
    judged, unmet = plan.admit_delta(base, spark.createDataFrame(rows, c), spark.createDataFrame([("train", "fungi"), ("validation", "fungi"), ("validation", "algae")], "split string, euk_group string"))
    got = {r.ordinal: r.reason for r in judged.collect()}
    assert got == {1: None, 2: "duplicate_sequence_to_base_or_delta", 3: "cross_split_group_overlap", 4: "cross_split_group_overlap", 5: "duplicate_record_id_to_base", 6: "not_required_for_split", 7: None, 8: "metadata_split_mismatch", 9: "unresolved_euk_group", 10: "missing_species_taxid", 11: "missing_metadata"}
    assert sorted(map(tuple, unmet.collect())) == [("validation", "algae", 1)]


def test_relabel_raises_on_other_splits(spark):
    own = spark.createDataFrame([("r", "train")], "record_id string, split string")
    with pytest.raises(Exception, match="curated metadata"):
        plan.relabel(own, spark.createDataFrame([("r", "test", "fungi")], "record_id string, split string, euk_group string")).collect()


def test_router_folds(spark):
    rng = np.random.default_rng(6)
    rows = [([float(x) for x in rng.standard_normal(3)], [float(x) for x in rng.standard_normal(3)], int(rng.integers(3)), i % 17) for i in range(200)]
    df = spark.createDataFrame(rows, "b array<double>, r array<double>, y int, g long")
    out = score.oof_router(df, "b", "r", "y", "g", 3).collect()
    assert sum(r.rows for r in out) == 200 and {r.fold for r in out} == {g * 2654435761 % 5 for g in range(17)}
    for r in out:
        held = [x for x in rows if x[3] * 2654435761 % 5 == r.fold]
        plain = [int(np.argmax(x[0])) for x in held]
        f1 = [2 * sum(p == x[2] == c for p, x in zip(plain, held)) / max(1, sum(p == c for p in plain) + sum(x[2] == c for x in held)) for c in range(3)]
        assert r.base_macro_f1 == pytest.approx(np.mean(f1))


def test_temperature(spark):
    rng = np.random.default_rng(7)
    z = rng.standard_normal((3000, 3)) * 2
    p = np.exp(z / 1.7) / np.exp(z / 1.7).sum(1)[:, None]
    y = [int(rng.choice(3, p=q)) for q in p]
    t, _ = score.fit_temperature(spark.createDataFrame([([float(v) for v in a], b) for a, b in zip(z, y)], "z array<double>, y int"), "z", "y")
    assert t == pytest.approx(1.7, rel=0.15)


def test_wanted_outputs():
    assert labels.wanted_outputs(["mit", "Plastid", "pla", ""]) == ["mitochondrion", "plastid"] and "organelle" in labels.wanted_outputs(["all"])
    with pytest.raises(ValueError):
        labels.wanted_outputs(["xyz"])


def test_segments(spark):
    df = spark.createDataFrame([("1", "v", "L:NC_001234.1/AB12345; S:KX00001", 1), ("1", "w", "NC_001234.1", 2), ("1", "x", "-", 3), ("1", "y", None, 4)], "taxid string, organism string, segments string, ordinal int")
    got = sorted((r.ordinal, r.segment_name, r.sequence_accession, r.is_refseq) for r in curate.explode_segments(df).collect())
    assert got == [(1, "L", "NC_001234.1", True), (1, "S", "KX00001", False)]

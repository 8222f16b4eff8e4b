"""The dealt methods themselves: sorted orders, factors with places, probabilities, optima, gradients, recall over shards; and columns whose names clash."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqcurate.llm import blocks, language_id, near_dedup, packing, prefix_forest, quality, warc
from seqcurate.llm.mtree import MTree, exact_top_k
from seqcurate.llm.mixing import source_targets
from seqcurate.llm.near_dedup import near_duplicates
from seqcurate.llm.substring_dedup import factors, lookups, remove_repeats

from test_llm import DOCS, WORDS, brute_near, brute_repeats, brute_targets, sentence


def test_factors_equal_their_places(spark):
    rng = random.Random(21)
    pool = [sentence(rng, n) for n in (34, 35, 60, 90, 200)]
    texts = [" ".join(rng.choice((rng.choice(pool), sentence(rng, rng.randrange(50)))) for _ in range(rng.randrange(1, 7))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("key", F.xxhash64("text")).withColumn("whole", F.col("text"))
    rows = remove_repeats(df, "text").select("key", "whole", "spans").collect()
    words = {r.key: WORDS.findall(r.whole) for r in rows}
    assert any(len(s.factors) > 1 for r in rows for s in r.spans)
    for r in rows:
        own = words[r.key]
        for s in r.spans:
            covered = set()
            for f in s.factors:
                assert f.end - f.start >= 35 and s.start <= f.start and f.end <= s.end
                assert own[f.start : f.end] == words[f.source][f.source_start : f.source_start + f.end - f.start]
                covered |= set(range(f.start, f.end))
            assert covered == set(range(s.start, s.end))


def test_greedy_parse():
    assert lookups(np.array([0, 1, 1, 1, 0, 0, 1], bool), 2).tolist() == [1, 3, 6]
    places = [(0, 7, 10), (35, 7, 45), (50, 7, 60), (60, 8, 0)]
    assert factors(places, 35) == [{"start": 0, "end": 85, "source": 7, "source_start": 10}, {"start": 60, "end": 95, "source": 8, "source_start": 0}]


def test_neighbours_go_as_deep_as_a_region_needs(spark):
    """A small region: all pairs. A large one: documents that share a longer prefix, and the next one in the order."""
    bits = min(32, near_dedup.BITS // near_dedup.forest(85)[1])
    depth = near_dedup.forest(85)[1]
    deep = lambda first, rest: (first << bits * (depth - 1)) | rest
    small = [(0, 5, deep(i, 0), i, 100, 3, i) for i in range(3)]
    large = [(1, 9, deep(i // 2, i), 100 + i, 100, 40, 100 + i) for i in range(40)]
    df = spark.createDataFrame(small + large, "tree int, label long, further long, rep long, n long, m long, component long")
    got = {tuple(sorted((r.x, r.y))) for r in near_dedup.neighbours(df, 85).collect()}
    assert {p for p in got if p[1] < 100} == {(0, 1), (0, 2), (1, 2)}
    far = {p for p in got if p[0] >= 100}
    assert {(100 + i, 101 + i) for i in range(0, 40, 2)} <= far  # they share the first minimum after the label
    assert all(b - a == 1 for a, b in far)
    one = df.withColumn("component", F.lit(1).cast("long"))
    assert near_dedup.neighbours(one, 85).count() == 0


def test_near_duplicates_near_the_threshold(spark):
    rng = random.Random(23)
    rows = []
    for i in range(120):
        w = sentence(rng, 80, 10**6).split()
        other = list(w)
        for j in range(i % 4):
            other[10 + 20 * j] = f"z{i}_{j}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_near(rows)


def test_one_set_in_very_many_pairs(spark):
    """A hub with more pairs than one lot holds."""
    rng = random.Random(24)
    base = sentence(rng, 400, 10**6).split()
    rows = [(0, " ".join(base)), (1, " ".join(base))]
    for i in range(2, 202):
        w = list(base)
        for j in range(7):
            w[rng.randrange(400)] = f"q{i}_{j}"
        rows.append((i, " ".join(w)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_near(rows)


def test_kneser_ney_by_definition():
    """Probabilities of a model against the recursion written down with dictionaries of letters."""
    texts = ["abracadabra", "a banana", "bandana cab"]
    g, ends, _ = language_id.grams(texts)
    model = language_id.KneserNey(*np.unique(g, return_counts=True))
    split = lambda x, n: tuple(int(x) >> 16 * i & 0xFFFF for i in reversed(range(n)))
    counts = {4: Counter(split(x, 4) for x in g)}
    for n in (3, 2, 1):
        counts[n] = Counter(k[1:] for k in counts[n + 1])
    discount = {}
    for n, c in counts.items():
        ones, twos = (sum(v == i for v in c.values()) for i in (1, 2))
        discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def prob(gram):
        if not gram:
            return 2.0**-16
        n = len(gram)
        same = {k: v for k, v in counts[n].items() if k[:-1] == gram[:-1]}
        lower = prob(gram[1:])
        if not same:
            return lower
        total = sum(same.values())
        return max(same.get(gram, 0) - discount[n], 0) / total + discount[n] * len(same) / total * lower

    asked = np.unique(np.concatenate([g, language_id.grams(["cabana zebra"])[0]]))
    assert model.prob(asked) == pytest.approx([prob(split(x, 4)) for x in asked])


def test_packing_against_the_optimum():
    """Costs between the least possible ones, by trying every partition, and a fifth more."""
    rng = random.Random(25)
    capacities, costs = (8, 16, 32), (12.0, 20.0, 36.0)

    def least(items):
        if not items:
            return 0.0
        first, rest = items[0], items[1:]
        best = float("inf")
        for r in range(len(rest) + 1):
            for more in itertools.combinations(range(len(rest)), r):
                size = first + sum(rest[i] for i in more)
                fits = [c for cap, c in zip(capacities, costs, strict=True) if cap >= size]
                if fits:
                    best = min(best, min(fits) + least([x for i, x in enumerate(rest) if i not in more]))
        return best

    for _ in range(40):
        sizes = sorted((rng.randrange(1, 20) for _ in range(rng.randrange(1, 8))), reverse=True)
        bins = packing.pack_block(sizes, capacities, costs)
        assert sorted(i for b in bins for i in b[2]) == list(range(len(sizes)))
        cost = sum(costs[capacities.index(b[0])] for b in bins)
        assert least(sizes) - 1e-9 <= cost <= 1.2 * least(sizes) + 1e-9


def test_packing_keeps_ids(spark):
    ids = [9007199254740993, 9007199254740995, None, 5]
    df = spark.createDataFrame([(i, sentence(random.Random(1), 10), "x") for i in ids], "doc_id long, text string, bin_id string")
    assert {r.doc_id for r in packing.pack(df).collect()} == set(ids)


def test_ordinal_gradient():
    """The first step of a fit goes down the gradient of the mean negative log-likelihood, taken numerically."""
    rng = np.random.default_rng(26)
    doc = np.repeat(np.arange(60), 4)
    bucket, n = rng.integers(0, 12, 240), np.ones(240)
    grade = rng.integers(0, 3, 60)

    def loss(share, present, cuts):
        total = np.bincount(doc, n, 60)
        score = np.bincount(doc, quality.Ordinal.GAIN * n / total[doc] * share[bucket] + 0.3 * present[bucket], 60)
        tail = np.column_stack([np.ones(60), 1 / (1 + np.exp(cuts[None, :] - score[:, None])), np.zeros(60)])
        return -np.log(tail[np.arange(60), grade] - tail[np.arange(60), grade + 1]).mean()

    before, model = quality.Ordinal(3), quality.Ordinal(3)
    model.fit(doc, bucket, n, grade, steps=1, rate=1e-3, decay=0.0)
    for b in range(12):
        step = np.zeros(quality.BUCKETS)
        step[b] = 1e-5
        for name, slope in (("share", loss(before.share + step, before.present, before.cuts) - loss(before.share - step, before.present, before.cuts)), ("present", loss(before.share, before.present + step, before.cuts) - loss(before.share, before.present - step, before.cuts))):
            if abs(slope) > 1e-9:
                assert np.sign(getattr(model, name)[b]) == -np.sign(slope)
    down = loss(model.share, model.present, model.cuts)
    assert down < loss(before.share, before.present, before.cuts)
    model.fit(doc, bucket, n, grade, steps=300)
    assert (np.diff(model.cuts) > 0).all() and loss(model.share, model.present, model.cuts) < down


def test_quality_counts_are_not_clipped(spark):
    """A text with more than 65,535 of one feature is learned as it is graded."""
    rows = [(0, "x " * 70_000 + "y " * 70_000), (1, "x y"), (2, "z z"), (3, "z w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, 0)], "doc_id long, grade int"))
    got = {r.doc_id: r.expected_grade for r in quality.grade_documents(docs, model, ["doc_id"], above=1).collect()}
    assert got[0] == pytest.approx(got[1], abs=1e-3) and got[0] > 0.5 > got[2]


def test_odd_ratings(spark):
    docs = spark.createDataFrame([(i, f"w{i % 2} a") for i in range(10)] + [(None, "x"), (5, "w1 b")], "doc_id long, text string")
    grades = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(1, None), (None, 1), (3, 0), (99, 1)], "doc_id long, grade int")
    model = quality.fit(docs, grades)
    assert quality.grade_documents(docs, model, ["doc_id"]).count() == 12
    assert quality.fit(docs, grades.where("grade = 1 and doc_id <> 3")) is None


def test_columns_that_clash(spark):
    docs = spark.createDataFrame([(i, sentence(random.Random(i), 50), "en", "c", 1.0, 2, True) for i in range(6)], "doc_id long, text string, lang string, cut string, score double, letters int, kept boolean")
    got = remove_repeats(docs)
    assert got.columns == [*docs.columns, "n_words", "n_removed", "spans", "kept_sha256"] and got.where("cut = 'c'").count() == 6
    model = language_id.fit(docs)
    found = language_id.identify(docs, model, ["doc_id", "letters", "score"])
    assert found.columns == ["doc_id", "letters", "lang_pred", "score", "cross_entropy", "rejected"] and found.where("letters = 2").count() == 6
    grades = quality.grade_documents(docs, None, ["doc_id", "kept"])
    assert grades.columns == ["doc_id", "expected_grade", "tail_probability", "kept"]
    pages = spark.createDataFrame([(1, "u", "h", "x"), (None, "u", "h", "y"), (1, None, "h", "z")], "page_id long, url string, html string, top string").withColumn("sha", F.lit(1)).withColumn("key", F.lit(2))
    back = warc.round_trip(pages).collect()
    assert len(back) == 3 and sum(r.record_type == "response" for r in back) == 2 and {r.payload_digest for r in back} == {warc.digest(b"h")}


def test_warc_shared_payloads(spark, tmp_path):
    """One payload in most rows, some in a few, and long ones; by broadcast and by join."""
    rng = random.Random(27)
    pages = [(i, f"u{i}", "same" if i % 3 else rng.choice(("two", "three", "x" * 400_000, f"own{i}"))) for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    for often in (2, 50_000):
        warc.OFTEN, before = often, warc.OFTEN
        got = {r.page_id: r for r in warc.round_trip(df, str(tmp_path / f"o{often}")).collect()}
        warc.OFTEN = before
        top = {}
        for i, _, html in pages:
            top[html] = max(top.get(html, -1), i)
        assert all((got[i].record_type, got[i].refers_to) == (("response", None) if top[h] == i else ("revisit", top[h])) and got[i].payload_bytes == len(h) for i, _, h in pages)


def test_ranges_are_read_by_as_many_tasks(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", sentence(random.Random(i), 300)) for i in range(40)], "page_id long, url string, html string").repartition(2)
    archives = warc.write_warc(df, str(tmp_path / "w"))
    back = warc.read_warc(archives, split=2000)
    ranges = sum(math.ceil(r.n_bytes / 2000) for r in archives.collect())
    assert back.rdd.getNumPartitions() == ranges > 4 and back.count() == 40


@pytest.mark.parametrize("kind", ["random", "grouped"])
def test_recall_over_full_shards(spark, kind):
    """Four shards of 8,192 vectors, looked at by the one rule: at least 0.9 of the nearest are found."""
    rng = np.random.default_rng(28)
    x = rng.standard_normal((32_768, 64))
    if kind == "grouped":
        x += 2 * rng.standard_normal((50, 64))[rng.integers(0, 50, len(x))]
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit, asked = 0, np.arange(0, len(x), 512)
    best = np.argsort(-(x[asked] @ x.T - 9 * (asked[:, None] == np.arange(len(x))[None])), 1)[:, :20]
    found = defaultdict(list)
    for shard in range(4):
        ids = np.arange(shard, len(x), 4)
        place, vec, value = prefix_forest._within(ids, x[ids], asked, x[asked], 20)
        for p, v, s in zip(place, vec, value, strict=True):
            found[p].append((-s, v))
    for j, want in enumerate(best):
        hit += len({v for _, v in sorted(found[j])[:20]} & set(want.tolist()))
    assert hit / (20 * len(asked)) >= 0.9
    assert prefix_forest.WIDTH * (20 * 8192) ** 0.5 < 0.3 * 8192


def test_m_tree_prunes_what_lies_apart():
    """In few dimensions the bounds leave most pages out; routing objects are points of the tree; answers are exact."""
    rng = np.random.default_rng(29)
    x = rng.standard_normal((4000, 3))
    x = np.floor(2000 * x / np.linalg.norm(x, axis=1)[:, None])
    tree, ids = MTree(x), np.arange(4000)
    opened, heap = 0, MTree.nearest.__globals__["heapq"]
    assert all((np.abs(tree.points - p["center"]).sum(1) == 0).any() for p in tree.pages)

    class Counting:
        heappush, heapreplace = staticmethod(heap.heappush), staticmethod(heap.heapreplace)

        @staticmethod
        def heappop(queue):
            nonlocal opened
            opened += 1
            return heap.heappop(queue)

    MTree.nearest.__globals__["heapq"] = Counting
    try:
        for q in range(0, 4000, 400):
            got = tree.nearest(x, ids, x[q], q, 5)
            want = sorted((-int(x[q] @ x[i]), i) for i in ids if i != q)[:5]
            assert got == [(-s, i) for s, i in want]
    finally:
        MTree.nearest.__globals__["heapq"] = heap
    assert opened / 10 < 0.5 * len(tree.pages)


def test_repeated_query_ids(spark):
    rows = [(50, [1.0, 2.0]), (50, [0.5, 2.0]), (1, [3.0, 1.0]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = exact_top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(50, 1, 1), (50, 2, 2)]
    assert blocks.QUERIES >= 16_384


def test_shared_folder_on_a_cluster(spark, monkeypatch):
    from seqcurate.llm import common

    class Far:
        master = "spark://x:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = type("C", (), {"get": staticmethod(lambda k, d=None: d)})(), Far()

    with pytest.raises(ValueError):
        common.shared_folder(Session())


def test_targets_of_sources_that_fill_up_alike(spark):
    for sizes in ({"a": 15000, "b": 6000}, {f"s{i}": 100 for i in range(7)}, {"a": 5, "b": 2, "c": 1, "d": 50, "e": 20}):
        got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_pipeline_run(spark, tmp_path):
    """run() on written tables, stage for stage against brute force."""
    import corpus_pipeline

    rng = random.Random(30)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, 80, 10**5) + (" " + passage if i % 10 == 0 else ""), "en", "ab"[i % 2], 1) for i in range(150)]
    rows += [(1000, rows[5][1], "en", "a", 1), (1001, None, None, None, None), (1002, "12 34", "en", "a", 1), (1003, "", "en", "b", 0), (1004, sentence(rng, 9000, 10**5), "en", "a", 1), (1005, rows[7][1].replace(" w", " W", 3), "en", "b", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    left = [r for r in rows if r[0] not in (1001, 1002, 1003)]
    first = {d for d, _, _, keep in brute_near([(r[0], r[1]) for r in left], corpus_pipeline.SIMILAR) if keep}
    left = [r for r in left if r[0] in first]
    sizes = {r[0]: n - gone for r, (n, gone, _) in zip(left, brute_repeats([r[1] for r in left]), strict=True)}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    taken = Counter()
    for r in got:
        taken[r.doc_id] += r.n_words
    assert set(taken) <= set(sizes) and all(taken[d] in (sizes[d], 2 * sizes[d]) for d in taken)
    of = {r[0]: r[3] for r in left}
    have, mixed = Counter(), Counter()
    for d, n in sizes.items():
        have[of[d]] += n
        mixed[of[d]] += taken[d]
    for s, target in brute_targets(dict(have)).items():
        assert abs(mixed[s] - target) <= 2 * max(n for d, n in sizes.items() if of[d] == s)
    pieces = {(r.doc_id, r.copy, r.piece) for r in got}
    assert len(pieces) == len(got) and all(r.bin_words <= r.capacity for r in got)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

"""The operators of seqcurate.llm against brute force, round trips and held-out accuracy, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqcurate.llm import language_id, packing, quality, token_counts, warc
from seqcurate.llm.components import components
from seqcurate.llm.mixing import fly, mix_sources, source_targets
from seqcurate.llm.mtree import exact_top_k
from seqcurate.llm.near_dedup import near_duplicates
from seqcurate.llm.prefix_forest import approximate_top_k
from seqcurate.llm.substring_dedup import remove_repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, vocabulary: int = 5000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and a column whose name an operator uses itself."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    near = base.split()
    near[3] = "changed"
    rows = [(1, base, "en", "a", 9), (2, base, "en", "a", 9), (3, " ".join(near), "en", "b", 9), (4, None, None, None, None), (5, "", "en", "a", 0), (None, base, "fr", None, 1), (6, "only three words", "fr", "b", 1), (6, "only three words", "fr", "b", 1), (7, "\t \n", "fr", "c", 1), (8, "1234 5678", None, "c", 1), (9, sentence(rng, 30000), "de", "d", 1), (10, "x" * 300000, "de", "d", 1), (11, sentence(rng, 40) + " " + " ".join(base.split()[40:90]), "en", "b", 1)]
    return spark.createDataFrame([(*r, "kept") for r in rows], DOCS + ", n string")


def brute_repeats(texts, window=35):
    words = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return out


def brute_near(rows, percent=85):
    sets = []
    for _, text in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORDS.findall(text or "")]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)], low[find(i)] == d) for i, (d, _) in enumerate(rows))


def test_remove_repeats(spark, odd):
    got = remove_repeats(odd)
    assert got.columns == [*odd.columns, "n_words", "n_removed", "spans", "kept_sha256"]
    rows = odd.select("text").collect()
    want = sorted(brute_repeats([r.text for r in rows]))
    found = got.select("text", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in found) == want
    for r in found:  # the text that is left holds the words that are left
        assert hashlib.sha256(" ".join(WORDS.findall(r.text or "")).encode()).hexdigest() == r.kept_sha256
    assert got.where("doc_id = 4").first().text is None
    assert remove_repeats(odd.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_remove_repeats_random(spark, seed):
    rng = random.Random(seed)
    pool = [sentence(rng, rng.choice((34, 35, 36, 70, 200))) for _ in range(6)]
    texts = [" ".join(rng.choice((rng.choice(pool), sentence(rng, rng.randrange(60)))) for _ in range(rng.randrange(6))) for _ in range(60)]
    texts.append(" ".join(["la"] * 200))
    got = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in got] == brute_repeats(texts)


def test_near_duplicates(spark, odd):
    got = near_duplicates(odd)
    assert got.count() == odd.count()
    rows = [(r.doc_id, r.text) for r in odd.where("doc_id is not null").collect()]
    assert sorted(map(tuple, got.where("doc_id is not null").collect())) == brute_near(rows)
    alone = got.where("doc_id is null").first()
    assert alone.component_id is None and alone.kept
    assert near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_large_region(spark):
    rng = random.Random(8)
    base = sentence(rng, 150).split()
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.choice((1, 1, 2, 3))):
            w[rng.randrange(len(w))] = f"e{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, sentence(rng, 60)) for i in range(40)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_near(rows)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5}
    assert {v for k, v in got.items() if k >= 100} == {100}


def test_token_counts(spark, odd):
    pieces = [b"a", b"b", b"c", b"d", b" a", b" ab", b"abc", b"bcd", b" abcd", b"cd"]
    automaton = token_counts.LongestMatch(pieces)

    def greedy(word):
        n = i = 0
        while i < len(word):
            i += max((len(p) for p in pieces if word.startswith(p, i)), default=1)
            n += 1
        return n

    rng = random.Random(2)
    for _ in range(3000):
        word = b" " + bytes(rng.choice(b"abcdz") for _ in range(rng.randrange(12)))
        assert automaton.count(word) == greedy(word), word
    got = token_counts.token_counts(odd)
    assert got.columns == [*odd.columns, "n_bytes", "n_words", "n_tokens"]
    r = got.where("doc_id = 4").first()
    assert (r.n_bytes, r.n_words, r.n_tokens) == (0, 0, 0)
    assert got.where("doc_id = 10").first().n_words == 1


def brute_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def test_targets(spark):
    rng = random.Random(4)
    for _ in range(3):
        sizes = {s: rng.randrange(1, 1000) for s in ("a", "b", "Z", "é", None, "src10", "src9")}
        got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mixing(spark, odd):
    rng = random.Random(6)
    rows = [(i, sentence(rng, rng.randrange(1, 60)), "en", rng.choice("aabc"), 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    first, again = (sorted(map(tuple, mix_sources(docs).collect())) for _ in range(2))
    assert first == again and len(first) == 3000
    by = Counter()
    for _, size, source, _, _, copies, taken in first:
        assert taken == size * copies <= 2 * size
        by[source] += taken
    target = {x[2]: x[4] for x in first}
    for s in target:
        assert abs(by[s] - target[s]) <= 2 * 60
    assert mix_sources(odd).count() == odd.count()
    assert mix_sources(odd.limit(0)).count() == 0


def test_flight_keeps_totals():
    rng = random.Random(3)
    p, size = [rng.random() for _ in range(500)], [float(rng.randrange(1, 90)) for _ in range(500)]
    q = fly(p, size, [rng.random() for _ in range(500)])
    assert math.isclose(sum(p), sum(q), abs_tol=1e-5)
    assert math.isclose(sum(a * b for a, b in zip(p, size, strict=True)), sum(a * b for a, b in zip(q, size, strict=True)), abs_tol=1e-3)
    assert sum(0 < x < 1 for x in q) <= 2


def test_packing(spark, odd):
    got = packing.pack(odd, capacities=(64, 128, 512))
    rows = got.collect()
    sizes = Counter((r.doc_id, len(WORDS.findall(r.text))) for r in odd.collect() if r.text and WORDS.findall(r.text))
    assert sum(r.n_words for r in rows) == sum(n * k for (_, n), k in sizes.items())
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_words
        assert at == b[0].bin_words <= b[0].capacity == min(c for c in (64, 128, 512) if c >= at)
    assert packing.pack(odd.limit(0)).count() == 0


def test_language_id(spark, odd):
    rng = random.Random(1)
    syllables = {"xx": "ka ko ra mi to".split(), "yy": "ber sch ung der ich".split()}
    rows = [(i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(20)), lang) for i, lang in enumerate(rng.choice(("xx", "yy")) for _ in range(400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    got = language_id.identify(docs, model, ["doc_id", "lang"]).withColumn("held", language_id.held_out(F.col("doc_id"))).where("held").collect()
    assert got and all(r.lang == r.lang_pred and 0 <= r.score <= 1 and not r.rejected for r in got)
    strange = language_id.identify(odd, model, ["doc_id"]).collect()
    assert len(strange) == odd.count()
    assert {r.doc_id for r in strange if r.lang_pred == "und"} == {4, 5, 7, 8}
    nothing = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(odd, nothing, ["doc_id"]).collect()} == {"und"}


def test_kneser_ney_sums_to_one():
    g, _, _ = language_id.grams(["abracadabra banana", "cabbage"])
    model = language_id.KneserNey(*np.unique(g, return_counts=True))
    context = np.uint64(ord("a")) << np.uint64(32) | np.uint64(ord("b")) << np.uint64(16) | np.uint64(ord("r"))
    every = (context << np.uint64(16)) | np.arange(1 << 16, dtype=np.uint64)
    assert model.prob(every).sum() == pytest.approx(1.0)


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])


def vectors(spark, n=700, dim=12):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.standard_normal(dim) / 4], "x") for i in range(n)]
    rows += [(n + i, rows[3][1], "x") for i in range(30)]  # ties
    rows += [(2000, None, "x"), (2001, [], "x"), (2002, [None] * dim, "x"), (2003, [float("nan")] * dim, "x"), (2004, [float("inf")] * dim, "x"), (2050, [0.0] * dim, "x"), (None, rows[1][1], "x"), (2100, [1.0] * 3, "x")]
    return rows, spark.createDataFrame(rows, VECTORS)


def test_exact_top_k(spark):
    rows, df = vectors(spark)
    clean = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for q, x in clean:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in clean if i != q and len(y) == len(x))[:5]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, exact_top_k(df, F.col("vec_id") % 50 == 0).collect())) == sorted(want)
    assert exact_top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_approximate_top_k(spark):
    rows, df = vectors(spark, 3000)
    clean = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i is not None and v and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v)}
    got = approximate_top_k(df, F.col("vec_id") % 20 == 0).collect()
    hit = n = 0
    for q in {r.query_id for r in got}:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(own) + 1)) and [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        if q in clean:
            best = sorted((-float(clean[q] @ y), i) for i, y in clean.items() if i != q)[:20]
            hit += len({i for _, i in best} & {r.vec_id for r in own})
            n += 20
            assert all(abs(r.score - clean[q] @ clean[r.vec_id]) < 1e-9 for r in own)
    assert hit / n >= 0.9


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, f"http://x/{i}", rng.choice([None, "", "same", "sa\x1f\x8bme é", "".join(rng.choices("abc\n<>", k=rng.randrange(3000)))])) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_warc(pages.repartition(3), str(tmp_path / "w"))
    assert archives.agg(F.sum("n_records")).first()[0] == 300
    for split in (97, 5000, 1 << 25):  # ranges smaller than a record as well
        back = warc.read_warc(archives, split=split).collect()
        assert sorted(int(r.record_id) for r in back) == list(range(300))
    top = {}
    for i, _, html in rows:
        top[html or ""] = max(top.get(html or "", -1), i)
    for r in back:
        html = rows[int(r.record_id)][2] or ""
        last = top[html]
        assert (r.payload_bytes, r.payload_digest, r.record_type) == (len(html.encode()), warc.digest(html.encode()), "response" if int(r.record_id) == last else "revisit")
        assert r.refers_to == (None if int(r.record_id) == last else str(last))
        assert bytes(r.payload) == (html.encode() if r.record_type == "response" else b"")
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_quality(spark, odd):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        grade = i % 3
        words = sentence(rng, 40).split()
        if grade == 0:
            words = [w.upper() + "!!" for w in words]
        if grade == 1:
            words[rng.randrange(40)] = "nasty"
        rows.append((i, " ".join(words)))
        labels.append((i, grade))
    docs, grades = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, grade int")
    model = quality.fit(docs.where("doc_id < 450"), grades)
    got = {r.doc_id: r for r in quality.grade_documents(docs, model, ["doc_id"]).collect()}
    held = [i for i in range(450, 600)]
    assert np.mean([got[i].kept == (i % 3 == 2) for i in held]) > 0.95
    assert np.mean([round(got[i].expected_grade) == i % 3 for i in held]) > 0.9
    assert quality.grade_documents(odd, model, ["doc_id", "n"]).count() == odd.count()
    assert quality.fit(docs.limit(0), grades) is None


def test_pipeline(spark, odd, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, 80) + (" " + passage if i % 10 == 0 else ""), "en", "ab"[i % 2], 1) for i in range(200)]
    rows += [(1000, rows[5][1], "en", "a", 1), (1001, None, None, None, None), (1002, "12 34", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    one = corpus_pipeline.by_language(spark, docs, "")
    assert {r.doc_id for r in one.collect()} == {*range(200), 1000}
    two = corpus_pipeline.one_of_each(spark, one, "")
    assert {r.doc_id for r in two.collect()} == set(range(200))
    three = corpus_pipeline.without_repeats(spark, two, "")
    assert three.count() == 200 and not three.where(F.col("text").contains(passage)).count()
    four = corpus_pipeline.mixed(spark, three, "")
    assert four.columns == list(corpus_pipeline.COLUMNS) and four.count() > 200
    words = four.select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert corpus_pipeline.packed(spark, four, "").agg(F.sum("n_words")).first()[0] == pytest.approx(words, abs=200)


def test_pipeline_keeps_one_of_repeated_rows(spark):
    """Rows that agree in id and text are one document, the other texts of an id documents of their own; what is left is not taken for a repeat of what went."""
    import corpus_pipeline

    rng = random.Random(12)
    a, b, c = (sentence(rng, 80) for _ in range(3))
    rows = [(1, a, "en", "a", 1), (1, a, "en", "a", 1), (1, a, "en", "b", 1), (2, b, "en", "a", 1), (2, c, "en", "a", 1), (3, c, "en", "a", 1), (None, sentence(rng, 80), "en", "a", 1)]
    two = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted((r.doc_id or 0, r.text) for r in two.collect()) == sorted([(0, rows[-1][1]), (1, a), (2, b), (3, c)])
    three = corpus_pipeline.without_repeats(spark, two, "")
    assert sorted(r.text for r in three.collect()) == sorted([a, b, c, rows[-1][1]])


def test_pipeline_near_copies_from_80(spark):
    """Four of 200 words changed leave a similarity of 176 / 216 = 0.815; five leave 171 / 221 = 0.774."""
    import corpus_pipeline

    rng = random.Random(12)
    rows = []
    for i in range(80):
        w = sentence(rng, 200, 10**6).split()
        other = list(w)
        for j in range(4 + i % 2):
            other[20 + 40 * j if j < 4 else 193] = f"new{j}"
        rows += [(i, " ".join(w), "en", "a", 1), (1000 + i, " ".join(other), "en", "a", 1)]
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, DOCS), "")
    assert {r.doc_id for r in got.collect()} == {*range(80), *range(1001, 1080, 2)}


@pytest.mark.parametrize("shard", [1 << 21, 60_000])
def test_language_models_hold_every_gram(spark, monkeypatch, shard):
    """More than 200,000 four-grams, in one shard and in several, against a model of all of them in memory."""
    monkeypatch.setattr(language_id, "SHARD", shard)
    rng = random.Random(13)
    texts = ["".join(chr(0x4E00 + rng.randrange(900)) for _ in range(500)) for _ in range(600)]
    docs = spark.createDataFrame([(None, t, "zh") for t in texts] + [(None, "only a few words", "en")], "doc_id long, text string, lang string")
    g = language_id.grams(texts)[0]
    want = language_id.KneserNey(*np.unique(g, return_counts=True))
    model = language_id.fit(docs)
    assert model.names == ["en", "zh"] and len(np.unique(g)) > 200_000
    assert np.allclose(model.models[1].discounts, want.discounts)
    assert np.allclose(model.models[1].prob(g), want.prob(g))
    got = language_id.identify(docs, model, ["text"]).where("lang_pred = 'zh'").collect()
    h = language_id.scores([want], [r.text for r in got])[0][:, 0]
    assert len(got) == 600 and np.allclose([r.cross_entropy for r in got], h)


def test_left_out_is_a_model_of_the_others():
    rng = random.Random(14)
    texts = ["", *(" ".join("".join(rng.choice(("ka", "ko", "ra", "mi")) for _ in range(3)) for _ in range(rng.randrange(1, 9))) for _ in range(12))]
    model = language_id.KneserNey(*np.unique(language_id.grams(texts)[0], return_counts=True))
    model.statistics = lambda g: language_id.statistics([model.shard], g)
    got, _ = language_id.left_out(model, texts)
    for i in range(1, len(texts)):
        others = language_id.KneserNey(*np.unique(language_id.grams(texts[:i] + texts[i + 1 :])[0], return_counts=True))
        others.discounts = model.discounts
        assert got[i] == pytest.approx(language_id.scores([others], [texts[i]])[0][0, 0])


def test_rejection_in_a_rare_language(spark):
    """A language of 40 documents in 20,040, one of them odd, has a threshold all the same."""
    rng = random.Random(15)

    def text(syllables, n=12):
        return " ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(n))

    xx, zz, other = "ka ko ra mi to".split(), "αλ βε γα δι ωσ".split(), "ши да ло пу жэ".split()
    greek = lambda: "".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω ") for _ in range(120))
    rows = [(i, text(xx), "xx") for i in range(20000)] + [(20000 + i, text(zz), "zz") for i in range(39)] + [(20041, greek(), "zz")]
    assert language_id.fit(spark.createDataFrame([], "doc_id long, text string, lang string")).names == []
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert np.isfinite(model.highest).all()
    new = [("clean", text(zz)) for _ in range(20)] + [("clean", text(xx)) for _ in range(20)] + [("strange", greek()) for _ in range(20)] + [("strange", text(other)) for _ in range(20)]
    got = language_id.identify(spark.createDataFrame(new, "kind string, text string"), model, ["kind"]).collect()
    assert {(r.kind, r.rejected) for r in got} == {("clean", False), ("strange", True)}
    assert sum(r.lang_pred == "zz" for r in got if r.kind == "strange") >= 20

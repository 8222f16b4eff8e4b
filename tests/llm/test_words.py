"""Divergence of sources, the Jaccard join and spelling variants against brute force, and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqcurate.llm import divergence, jaccard_join, spelling
from seqcurate.llm.divergence import shares, skyband, source_divergence
from seqcurate.llm.spelling import near_words, spelling_variants

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, term string, word string, f1 string"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    """Rows of (doc_id, text, lang, source), with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "n", "t", "w", "f") for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd():
    """Nulls in every column, empty and very long texts, repeated rows and ids, ties."""
    rng = random.Random(3)
    names = ["alpha", "alphas", "alpah", "bravo", "Bravo", "brävo", "charlie", "charly", "delta", "É", "x", "ÿÿÿÿÿ", "ÿÿÿÿ", "don't", "emoji😀tail", "a", "a"]
    text = lambda n: " ".join(rng.choice(names) for _ in range(n))
    rows = [(i, text(rng.randrange(1, 60)), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, ""])) for i in range(150)]
    rows += [(200, None, None, None), (201, "", "fr", "s1"), (202, "\t ", "fr", "s2"), (None, text(40), "en", "s1"), (3, text(30), "en", "s2"), (3, rows[3][1], rows[3][2], rows[3][3])]
    return [*rows, (300, "y" * 200_000 + " " + text(20_000), "en", "s1"), (301, "y" * 200_000, "en", "s1"), (302, "y" * 200_000, "en", "s1"), (303, "z1 2 3", "it", "only")]


def brute_divergence(rows, least=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for _, text, lang, source in rows]
    df, n, groups = defaultdict(Counter), defaultdict(Counter), sorted({(lang, s) for lang, s, _ in docs})
    for lang, source, words in docs:
        words = [lower(w) for w in words]
        df[lang].update(set(words))
        n[lang, source].update(words)
    out = []
    for lang, source in groups:
        kept = [t for t, c in df[lang].items() if c >= least]
        mine = [s for la, s in groups if la == lang]
        count = {s: {t: n[lang, s][t] for t in kept} for s in mine}
        whole = {t: sum(count[s][t] for s in mine) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (x + 2) // (sum(c.values()) + 2 * len(kept)) for t, x in c.items()}
        own, all_ = p(count[source]), p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(sum(f(own[t], q[t]) for t in kept), s) for s in mine if s != source for q in [p(count[s])]]
        terms = [(f(own[t], all_[t]), t) for t in kept if count[source][t] and own[t] > all_[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sources", [512, 2])
def test_divergence(spark, odd, sources, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", sources)  # blocks of sources, too
    found = source_divergence(frame(spark, odd))
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert rows_of(found) == brute_divergence(odd)


def test_divergence_few_documents(spark):
    rows = [(1, "one two", "en", "a"), (2, None, "en", "b"), (3, "three", "de", "a")]
    assert rows_of(source_divergence(frame(spark, rows))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert source_divergence(frame(spark, rows).where("false")).count() == 0


def test_shares_are_exact():
    rng = random.Random(1)
    pairs = [(a, b) for _ in range(500) for b in [rng.randrange(1, 9 * 10**15)] for a in [rng.randrange(b + 1)]] + [(0, 7), (7, 7)]
    found = shares(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert found.tolist() == [1 + 10**9 * a // b for a, b in pairs]


def test_skyband_keeps_what_few_dominate():
    rng = np.random.default_rng(2)
    for size, spread, k in ((1, 3, 2), (700, 6, 3), (1500, 40, 10), (900, 10**6, 4)):
        n, m, place = rng.integers(0, spread, size), rng.integers(0, spread, size), rng.permutation(size)
        over = [int(((n >= n[i]) & (m <= m[i]) & (place < place[i])).sum()) for i in range(size)]
        assert sorted(skyband(n, m, place, k).tolist()) == [i for i in range(size) if over[i] < k]


def brute_join(rows, percent=80):
    sets = []
    for _, text, *_ in rows:
        w = lower(text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    at = list(range(len(rows)))

    def top(i):
        while at[i] != i:
            i = at[i]
        return i

    named = [i for i, r in enumerate(rows) if r[0] is not None and sets[i]]
    for i, j in combinations(named, 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((top(i), top(j)))
            at[b] = a
    least = {}
    for i in named:
        least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    return sorted([(r[0], len(sets[i]), least[top(i)] if i in named else r[0]) for i, r in enumerate(rows)], key=str)


@pytest.fixture(scope="module")
def related():
    """Groups of near copies around the threshold, small and large, a passage in very many rows, short rows, repeated ids with different texts."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(4000)}"
    rows, passage = [], [word() for _ in range(50)]

    def near(base, changes):
        out = list(base)
        for _ in range(changes):
            out[rng.randrange(len(out))] = word()
        return out

    for size, changes in ((3, 2), (6, 3), (40, 2), (40, 5), (60, 1), (25, 4)):
        base = [word() for _ in range(120)]
        rows += [" ".join(near(base, rng.randrange(changes + 1))) for _ in range(size)]
    for share in (10, 60, 300):
        rows += [" ".join([*passage, *(word() for _ in range(share))]) for _ in range(25)]
    rows += ["same words here", "same words here", "Same words HERE", "one", "", None, "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    rows = [(i, t, "en", "s") for i, t in enumerate(rows)]
    return [*rows, (5, rows[40][1], "en", "s"), (5, rows[5][1], "en", "s"), (None, rows[7][1], "en", "s"), (7, " ".join(word() for _ in range(30_000)), "en", "s")]


@pytest.mark.parametrize(("group", "hot"), [(16, 32), (2, 32), (16, 8)])
def test_join(spark, related, group, hot, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    monkeypatch.setattr(jaccard_join, "HOT", hot)  # with 8, tokens of many groups are hot
    found = jaccard_join.jaccard_join(frame(spark, related))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert rows_of(found.select("doc_id", "n_shingles", "component_id")) == brute_join(related)


def test_join_of_odd_and_no_rows(spark, odd):
    found = jaccard_join.jaccard_join(frame(spark, odd)).select("doc_id", "n_shingles", "component_id")
    assert rows_of(found) == brute_join(odd)
    assert jaccard_join.jaccard_join(frame(spark, odd).where("false")).count() == 0


def test_prefixes_are_lengthened_and_lose_no_pair(spark):
    """Every two sets that are similar share, of the tokens in both prefixes, the smaller l at least; and some l are above 1."""
    rng = random.Random(11)
    base = [list(range(g * 1000, g * 1000 + 60)) for g in range(12)]
    sets = [set(rng.sample(b, 54)) | {rng.randrange(10**6) for _ in range(rng.randrange(6))} for b in base for _ in range(12)]
    df = Counter(t for s in sets for t in s)
    repeated = spark.createDataFrame([(i, t, df[t]) for i, s in enumerate(sets) for t in s if df[t] > 1], "f long, token long, df int")
    classes = spark.createDataFrame([(i, i, len(s), 1) for i, s in enumerate(sets)], "cls long, f1 long, n long, copies long")
    found, l = defaultdict(set), {}
    for r in jaccard_join.prefixes(repeated, classes, 80).collect():
        found[r["cls"]].add(r["token"])
        l[r["cls"]] = r["l"]
    similar = [(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert similar and max(l.values()) > 1
    assert all(len(found[a] & found[b]) >= min(l[a], l[b]) for a, b in similar)


def brute_spelling(rows, one_in=97):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = [], {}
    by = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    for w, others in by.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    for w, others in by.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(others), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def test_spelling(spark, odd):
    found = spelling_variants(frame(spark, odd))
    assert found.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert rows_of(found) == brute_spelling(odd)
    assert spelling_variants(frame(spark, odd).where("false")).count() == 0


def test_spelling_chains_and_deletions(spark):
    """Forms of forms, ties, runs of one letter, and one run in three changed."""
    rng = random.Random(5)
    words = ["aaaaa", "aaaaaa", "aaaaaaa", "abcde", "abcdf", "abcdg", "abxdg", "bbcde", "éàüöß", "éàüö", "abcdefgh", "bcdefgh", "abcdefghi", "zzzzzy", "zzzzyz"]
    rows = [(i, " ".join(rng.choice(words[: 1 + rng.randrange(len(words))]) for _ in range(60)), "en", "s") for i in range(120)]
    for one_in in (97, 3):
        assert rows_of(spelling_variants(frame(spark, rows), one_in=one_in)) == brute_spelling(rows, one_in)


def test_near_words_over_range_partitions(spark):
    """Tries whose paths cross partitions: prefixes shared by far more words than a partition holds."""
    rng = random.Random(9)
    words = sorted({"common" + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(700)} | {"c", "co", "d" * 3000, "d" * 2999})
    known, pairs = near_words(spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    names = {r["id"]: r["word"] for r in known.collect()}
    assert [names[i] for i in sorted(names)] == words
    found = sorted((names[r["a"]], names[r["b"]]) for r in pairs.collect())
    gaps = defaultdict(set)
    for w in words:
        for i in range(min(len(w), 40)):
            gaps[w[:i] + "_" + w[i + 1 :]].add(w)
            gaps[w[:i] + w[i + 1 :]].add(w)
        gaps[w].add(w)
    near = {(a, b) for g, ws in gaps.items() for a in ws for b in ws if a != b and ("_" in g or g in (a, b))}
    assert found == sorted(near)
    assert spelling.trie_nodes(spark.createDataFrame([], "word string, n long"), F.col("word")).count() == 0


def test_operators_on_empty_tables(spark):
    """No rows in, no rows out, with the columns there."""
    from seqcurate.llm.prefix_forest import approximate_top_k
    from seqcurate.llm.token_counts import token_counts

    docs = spark.createDataFrame([], DOCS)
    counts = token_counts(docs.select("doc_id", "text"))
    assert counts.count() == 0 and {"doc_id", "n_bytes", "n_words", "n_tokens"} <= set(counts.columns)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found = approximate_top_k(vectors, F.col("vec_id") % 20 == 0)
    assert found.count() == 0 and found.columns == ["query_id", "rank", "vec_id", "score"]

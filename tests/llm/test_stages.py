"""How many stages near-duplicates take: with many partitions each stage leaves files and events on disk, however few its rows."""

import random
import uuid

import numpy as np
import pyarrow as pa
import pytest

from seqcurate.llm import components as parts
from seqcurate.llm.jaccard_join import jaccard_join
from seqcurate.llm.near_dedup import near_duplicates


def reach(links):
    """The smallest node that each node reaches, by brute force."""
    low = {x: x for link in links for x in link}
    while any(low[a] != low[b] for a, b in links):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return low


@pytest.fixture
def uncoalesced(spark):
    """The shuffle partitions stay as many as they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def stages(spark, work):
    """What work() returns, and the number of stages of its jobs."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "counted")
    try:
        out = work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    return out, sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group))


@pytest.mark.parametrize("chunk", [1, 2, 5, 1 << 20])
def test_contraction_in_chunks_keeps_what_is_connected(monkeypatch, chunk):
    monkeypatch.setattr(parts, "CHUNK", chunk)
    rng = random.Random(chunk)
    for n in (1, 3, 40):
        links = sorted((max(a, b), min(a, b)) for a, b in ((rng.randrange(-9, n), rng.randrange(n, 2 * n + 9)) for _ in range(60)))
        batches = [pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)) for x in zip(*links[i : i + 3], strict=True)], names=["u", "v"]) for i in range(0, len(links), 3)]
        got = [x for b in parts._contract(iter(batches)) for x in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True)]
        assert reach(got) == reach(links)
        assert all(u > v for u, v in got)
        firsts = {u: [v for x, v in got if x == u] for u in {u for u, _ in links}}
        assert all(firsts.values())
    assert not list(parts._contract(iter([])))


def test_components_in_few_stages(uncoalesced):
    rng = random.Random(3)
    ids = rng.sample(range(10**12), 400)
    links = [(ids[i], ids[i + 1]) for i in range(150)] + [(max(ids[160:]), x) for x in ids[160:]] + [(ids[155], ids[156]), (ids[7], ids[7])]
    table = uncoalesced.createDataFrame(links, "a long, b long").repartition(8).checkpoint()
    rows, count = stages(uncoalesced, lambda: parts.components(table).collect())
    assert {r.node: r.component for r in rows} == reach(links)
    assert count <= 80  # 51, skipped ones included


def _family(spark):
    """Documents of which many are near copies of one text, changed in one place or in ten, others of one another only."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base)] * 5
    for i in range(60):
        words = list(base)
        for _ in range(1 if i % 2 else 6):
            words[rng.randrange(200)] = f"x{i % 7}"
        texts.append(" ".join(words))
    texts += [" ".join(f"v{i}_{j}" for j in range(30)) for i in range(20)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)


def _linked(texts, percent):
    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {x: x for x in range(len(texts))} | reach(links)


@pytest.mark.parametrize(("operator", "most"), [(jaccard_join, 235), (near_duplicates, 200)])
def test_near_copies_in_few_stages(uncoalesced, operator, most):
    texts, docs = _family(uncoalesced)
    rows, count = stages(uncoalesced, lambda: operator(docs, percent=80).collect())
    assert {r.doc_id: r.component_id for r in rows} == _linked(texts, 80)
    assert count <= most

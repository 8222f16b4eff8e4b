"""Spelling variants of the words of a corpus, by a dictionary of pairs of trie nodes."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, pieces
from .lexicon import per_text, strings_of, summed, tokens


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of a-z, A-Z and U+00C0 to U+00FF, whose UTF-8 is C3 and a byte from 80 to BF."""
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128)
    first = data == 0xC3
    letter |= first
    letter[1:] |= first[:-1]
    return letter


def _counted(one_in: int, least_letters: int):
    """(word, n): of what a task reads, how often each word results from a run of letters."""

    def words(part: pa.RecordBatch) -> pa.Table:
        codes, strings, doc = tokens(part.column("text"), _letters)
        row, code, times = per_text(codes, doc, len(strings))
        raw = [s.as_buffer().to_pybytes() for s in strings.cast(pa.large_binary())]
        ids = [crc32(b"%d:" % x if x is not None else b":") for x in part.column("doc_id").to_pylist()]
        h = np.fromiter((crc32(raw[c], ids[r]) for r, c in zip(row.tolist(), code.tolist(), strict=True)), np.int64, len(row))
        hit = np.flatnonzero(h % one_in == 0)
        size = pc.utf8_length(strings).to_numpy(zero_copy_only=False)
        changed, new = [], code.copy()
        for i in hit.tolist():
            word = raw[code[i]].decode()
            at = int(h[i]) % len(word)
            new[i] = len(strings) + len(changed)
            changed.append(word[:at] + word[at + 1 :])
        every = pa.concat_arrays([strings, pa.array(changed, pa.large_string())])
        size = np.concatenate([size, np.array([len(x) for x in changed], np.int64)])
        n = np.bincount(new, times, len(every)).astype(np.int64)
        wanted = np.flatnonzero((n > 0) & (size >= least_letters))
        return pa.table({"word": strings_of(every, wanted), "n": n[wanted]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = (words(part) for batch in batches for part in pieces(batch, "text"))
        yield from summed(tables, ["word"], ["n"])

    return run


def spellings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", one_in: int = 97, least_letters: int = 5, least_n: int = 3) -> DataFrame:
    """(word, n): the words of spelling_variants and how often they occur."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(_counted(one_in, least_letters), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, *): adds nodes, the numbers of the trie nodes on the key's path, from the root (0) on. A node gets the next number when a key first passes
    it, so the first key's node of depth d is number d."""
    before, path, free = "", [0], 1
    for batch in batches:
        nodes = []
        for key in batch.column("key").to_pylist():
            same, end = 0, min(len(before), len(key))
            while same < end and before[same] == key[same]:
                same += 1
            new = len(key) - same
            path = [*path[: same + 1], *range(free, free + new)]
            free += new
            before = key
            nodes.append(path)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.list_(pa.int64()))], names=[*batch.schema.names, "nodes"])


def trie_nodes(words: DataFrame, key: Column) -> DataFrame:
    """words: (word, n). Returns (part, seat, word, n, nodes): for each word the numbers of the nodes that its key, a string of the same length, passes in the trie of all keys.

    Keys are sorted by range partitions; part and seat are a word's partition and its place in it. A partition numbers the nodes of its own keys, from 0. Partitions
    share only nodes of the first key's path: as deep as it agrees with the last key of the partition before, they take that partition's numbers, and all others
    get an offset. For this the driver looks at the first and last key of each partition, two rows each."""
    ordered = words.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key").select("word", "n", "key")
    # a checkpoint holds partitions as they are, so their numbers stay
    local = cut(ordered.mapInArrow(_paths, "word string, n long, key string, nodes array<long>")).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seat"))
    ends = local.groupBy("part").agg(F.min_by(F.struct("key", "nodes"), "seat").alias("first"), F.max_by(F.struct("key", "nodes"), "seat").alias("last"), F.max(F.array_max("nodes")).alias("most"))
    moves, base, before, path = [], 0, "", [0]
    for end in sorted(ends.collect(), key=lambda r: r["part"]):
        first, last = end["first"]["key"], end["last"]["key"]
        shared = next((i for i, (a, b) in enumerate(zip(first, before, strict=False)) if a != b), min(len(first), len(before)))
        taken = path[: shared + 1]
        moves.append((end["part"], base, taken))
        path = [taken[d] if node == d and d <= shared else base + node for d, node in enumerate(end["last"]["nodes"])]
        base, before = base + end["most"], last
    if not moves:
        return local.drop("key")
    moved = words.sparkSession.createDataFrame(moves, "part int, base long, taken array<long>")
    node = F.transform("nodes", lambda x, d: F.when((x == d) & (d < F.size("taken")), F.get("taken", d)).otherwise(F.col("base") + x))
    return local.join(F.broadcast(moved), "part").select("part", "seat", "word", "n", node.alias("nodes"))


def near_words(words: DataFrame) -> DataFrame:
    """words: (word, n), each word once. Returns (id, word, n) and, as a second DataFrame, (a, b, b_n): all ordered pairs of ids of words that differ by exactly one
    inserted, deleted or replaced code point, each once. Ids are in code-point order of the words."""
    forward = trie_nodes(words, F.col("word")).withColumnRenamed("nodes", "pre")
    backward = trie_nodes(words, F.reverse("word")).select("word", F.col("nodes").alias("suf"))
    both = cut(forward.join(backward, "word").select(F.col("seat").alias("id"), "word", "n", "pre", "suf"))
    size, at = F.length("word"), F.col("at")
    rows = both.select("id", "n", "pre", "suf", "word", size.alias("size"), F.explode(F.sequence(F.lit(0), size)).alias("at"))
    # the same word results wherever a run of one letter loses one, so only its first counts
    first = (at == 0) | (F.substring("word", at + 1, F.lit(1)) != F.substring("word", at, F.lit(1)))
    skip = rows.where(at < F.col("size")).select("id", "n", F.get("pre", at).alias("p"), F.get("suf", F.col("size") - 1 - at).alias("s"), first.alias("first"))
    split = rows.select(F.col("id").alias("b"), F.col("n").alias("b_n"), F.get("pre", at).alias("p"), F.get("suf", F.col("size") - at).alias("s"))
    other = skip.select(F.col("id").alias("b"), F.col("n").alias("b_n"), "p", "s")
    replaced = skip.join(other, ["p", "s"]).where("id <> b").select(F.col("id").alias("a"), "b", "b_n")
    shorter = skip.where("first").join(split, ["p", "s"]).select(F.col("id").alias("a"), F.col("n").alias("a_n"), "b", "b_n")
    ways = F.explode(F.array(F.struct("a", "b", "b_n"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))))
    return both.select("id", "word", "n"), replaced.unionByName(shorter.select(ways.alias("w")).select("w.*"))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", one_in: int = 97, least_letters: int = 5, least_n: int = 3, times: int = 2) -> DataFrame:
    """word, form, root strings, n, n_near, form_n longs: the words of the texts, and for each the more frequent spelling that it stands for, if any.

    Runs are the maximal ones of `[A-Za-z\\u00C0-\\u00FF]+`, A-Z in lower case (a null text has none). Let h be the crc32 of UTF-8 `<doc_id>:<run>` (a null id is
    empty): if `one_in` divides h, the run loses its code point h % length. Words are the distinct results of `least_letters` code points and `least_n` occurrences (n) at least;
    rows that repeat count each. Two words are near if one inserted, deleted or replaced code point makes one the other. form is the near word of largest n
    (of equal ones the first in code-point order) if that is `times` its n at least; root follows forms to the last. n_near counts near words, form_n is the form's n.
    No near word: 0, nulls, and the word as its root. An empty table gives no rows. Other columns are not looked at. A text is held whole in its task.

    Near words come from a dictionary of pairs of trie nodes: nodes of the trie of all words and of the trie of the reversed words are numbered (see trie_nodes), and a word
    is split at every place into the prefix node before and the suffix node after it, with one code point skipped or none. Words with an equal pair, both
    skipping one, have it replaced; one skipping and one not, inserted. A pair of nodes has one word for each letter that may be skipped at most, and one more.
    Since n grows `times`-fold with each form, roots are found in a few rounds, each of which doubles the steps looked ahead."""
    words, near = near_words(cut(spellings(docs, doc_id, text, one_in, least_letters, least_n)))
    best = cut(near.groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("top")))
    known = words.join(best, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("top.less") >= times * F.col("n"), F.col("top.b")).alias("form_id"))
    known = cut(known)
    step = known.where("form_id is not null").select("id", F.col("form_id").alias("to"))
    while True:
        ahead = step.select(F.col("id").alias("to"), F.col("to").alias("further"))
        step = cut(step.join(ahead, "to", "left").select("id", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        if step.where("moved").isEmpty():
            break
        step = step.drop("moved")
    named = known.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    roots = step.join(known.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    out = known.join(named, "form_id", "left").join(roots, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

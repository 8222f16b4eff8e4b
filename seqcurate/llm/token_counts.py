"""Token counts: greedy word-piece lengths by a linear longest-match automaton."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A public byte-level vocabulary, as ranks; only its pieces are used.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words of which a worker remembers the number of pieces.
REMEMBERED = 300_000


def read_pieces(path: str) -> list[bytes]:
    """The pieces of a vocabulary file: a line for each, base64 and rank."""
    return [base64.b64decode(line.split()[0]) for line in Path(path).read_bytes().splitlines() if line.strip()]


class LongestMatch:
    """A trie of pieces with failure links.

    At each node, `popped` is how many pieces the greedy longest match has certainly finished once no
    edge goes on, and `link` the node that spells what is left. A word of n bytes takes O(n) steps
    and no piece is ever built."""

    def __init__(self, pieces: list[bytes]):
        self.edges: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                nxt = self.edges[node].get(b)
                if nxt is None:
                    nxt = self.edges[node][b] = len(self.edges)
                    self.edges.append({})
                    final.append(False)
                node = nxt
            final[node] = final[node] or node > 0
        missing = set(range(256)) - {b for b, node in self.edges[0].items() if final[node]}
        for b in missing:  # every byte is a piece, so that each word has a parse
            node = self.edges[0].get(b)
            if node is None:
                node = self.edges[0][b] = len(self.edges)
                self.edges.append({})
                final.append(True)
            final[node] = True
        self.link, self.popped = [-1] * len(self.edges), [0] * len(self.edges)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for b, child in self.edges[node].items():
                queue.append(child)
                if final[child]:
                    self.link[child], self.popped[child] = 0, 1
                    continue
                at, count = self.link[node], self.popped[node]
                while at >= 0 and b not in self.edges[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[child], self.popped[child] = self.edges[at][b], count

    def count(self, word: bytes) -> int:
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for b in word:
            while b not in edges[node]:
                total += popped[node]
                node = link[node]
            node = edges[node][b]
        while node:
            total += popped[node]
            node = link[node]
        return total


class _Lengths(dict):
    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


def token_counts(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """docs with n_bytes, n_words and n_tokens (longs) of the whole text.

    A word is tokenised with one space before it, pieces being taken greedily, longest first, from the vocabulary;
    single bytes are pieces always. A null or empty text has 0 of each. Other columns, whatever their names, stay as they are,
    but for those three names, which are replaced. The vocabulary (some 50,000 pieces, no more than its file has) is read once and broadcast."""
    docs = docs.drop("n_bytes", "n_words", "n_tokens")
    automaton = docs.sparkSession.sparkContext.broadcast(LongestMatch(read_pieces(vocabulary)))
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_words", "n_tokens"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _Lengths(automaton.value)
        for batch in batches:
            sizes = []
            for value in batch.column(place):
                raw = (value.as_py() or "").encode()
                found = raw.split()
                sizes.append((len(raw), len(found), sum(map(lengths.__getitem__, found))))
            columns = [pa.array(x, pa.int64()) for x in zip(*sizes, strict=True)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "n_bytes", "n_words", "n_tokens"])

    return docs.mapInArrow(run, schema)

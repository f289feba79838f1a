"""Token counts: greedy longest-match word-pieces by a linear automaton that counts instead of building pieces.

The vocabulary is a trie of word-initial pieces and one of continuations. Each node knows its failure link (where to go on
when the next character doesn't fit) and how many tokens are popped on the way; both are computed once, breadth first. A
word is read left to right without going back: its number of tokens is the sum of the popped counts. A word that can't be
segmented is one unknown token, as usual for word-pieces.

The default vocabulary is a byte-level rank file: tokens with a leading space start a word, the others continue it; a word that
starts with none of them starts with the space alone (an empty initial piece), so every byte sequence has its count. Words
are split at ASCII white space and read as UTF-8 bytes. Counts of distinct words are kept in a bounded cache per worker.

Defined results: NULL and empty texts have no words and no tokens; repeated rows and NULL ids are counted like any other.
"""

from __future__ import annotations

import base64
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirworks.llm.common import map_rows, utf8, words
from weirworks.llm.pieces import Shared

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_CACHED = 400_000
NONE = -1


def read_vocabulary(ranks: str = VOCABULARY) -> tuple[list[bytes], list[bytes]]:
    """Initial pieces (the space alone is the empty one) and continuations."""
    with open(ranks, "rb") as f:
        tokens = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return [t[1:] for t in tokens if t[:1] == b" "], [t for t in tokens if t[:1] != b" "]


class CountingAutomaton:
    """Node 0 starts a word, node 1 continues one. ``fail[n]`` is NONE where no segmentation goes on."""

    def __init__(self, initial: list[bytes], continuation: list[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        whole = [False, False]
        for root, tokens in ((0, initial), (1, continuation)):
            for token in tokens:
                node = root
                for c in token:
                    if (to := self.next[node].get(c)) is None:
                        self.next[node][c] = to = len(self.next)
                        self.next.append({})
                        whole.append(False)
                    node = to
                if node != root:
                    whole[node] = True
        self.fail, self.popped = [NONE] * len(self.next), [0] * len(self.next)
        if b"" in initial:
            self.fail[0], self.popped[0] = 1, 1
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for c, to in self.next[node].items():
                if whole[to]:
                    self.fail[to], self.popped[to] = 1, 1  # the text so far is one token
                else:
                    at, n = self.fail[node], self.popped[node]
                    while at != NONE and c not in self.next[at]:
                        n += self.popped[at]
                        at = self.fail[at]
                    if at != NONE:
                        self.fail[to], self.popped[to] = self.next[at][c], n
                queue.append(to)

    def count(self, word: bytes) -> int:
        """Tokens of a word; NONE where it can't be segmented."""
        node, n = 0, 0
        for c in word:
            while c not in self.next[node]:
                n += self.popped[node]
                node = self.fail[node]
                if node == NONE:
                    return NONE
            node = self.next[node][c]
        while node > 1:
            n += self.popped[node]
            node = self.fail[node]
            if node == NONE:
                return NONE
        return n


class WordCounts(dict):
    """Tokens by word, filled on first use."""

    def __init__(self, vocabulary: tuple[list[bytes], list[bytes]]):
        super().__init__()
        self.automaton = CountingAutomaton(*vocabulary)

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word)
        if len(word) <= 64:
            self[word] = n
        return n

    def of(self, found: list[bytes]) -> tuple[int, int]:
        """Tokens and unknown words of a list of words."""
        if len(self) > MAX_CACHED:
            self.clear()
        counts = list(map(self.__getitem__, found))
        unknown = counts.count(NONE)
        return sum(counts) + 2 * unknown, unknown


_COUNTS: dict[str, WordCounts] = {}


def worker_counts(shared: Shared) -> WordCounts:
    if shared.id not in _COUNTS:
        _COUNTS.clear()
        _COUNTS[shared.id] = WordCounts(shared.value)
    return _COUNTS[shared.id]


def token_counts(docs: DataFrame, ranks: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every row."""
    shared = Shared(docs, read_vocabulary(ranks))

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        counts = worker_counts(shared)
        made: dict[str, object] = {"doc_id": batch.column("doc_id"), "n_words": [], "n_tokens": [], "n_unknown": []}
        for text in utf8(batch.column("text")):
            found = words(text)
            tokens, unknown = counts.of(found)
            made["n_words"].append(len(found))
            made["n_tokens"].append(tokens)
            made["n_unknown"].append(unknown)
        return made

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")

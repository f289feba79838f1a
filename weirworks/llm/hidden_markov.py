"""Hidden Markov language model over words: distributed Baum-Welch, exact scoring by the scaled forward recursion.

1. Word counts of all training texts, combined per partition before the shuffle.
2. The most frequent words, HEAD_WORDS at most, get numbers and go to every worker with their counts. Texts are
   stored as numbers; a rarer word is stored as its class, and by name and frequency for an exact join with the counts.
3. Words are emitted through classes: each of the HEAD_WORDS most frequent words is a class of its own, the others share CLASSES
   classes by a hash. A latent state emits a class, the class emits the word by its share (count + 1; one unit per shared
   class is left for unseen words), so the probabilities of all words add up to one.
4. Baum-Welch: each partition computes expected counts of its whole texts for the current model; Spark adds them up and the
   driver normalises the model (STATES x classes, a fixed bound). Every word has one count more, dealt over the states.

Batches of texts advance one token at a time together, so the recursion is vectorised over texts.

Defined results: NULL and empty texts are one end token; a NULL id belongs to the training part; repeated rows are
scored each; without training texts every word is unseen and the model is uniform.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirworks.llm.common import hash_limit, lower_words, map_rows, pieces, utf8
from weirworks.llm.pieces import Shared
from weirworks.session import stored

HEAD_WORDS, CLASSES, STATES, ROUNDS, STAY = 200_000, 1_024, 6, 4, 0.95
END = b""  # the end token; no word is empty
FLUSH = 250_000  # distinct words that a partition holds before it passes its counts on
BATCH_TOKENS = 600_000
SMOOTH = 0.1


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], ["word", "c"])
            held.clear()
            return made

        for batch in pieces(batches):
            for text in utf8(batch.column("text")):
                held.update(lower_words(text))
                held[END] += 1
            if len(held) > FLUSH:
                yield out()
        if held:
            yield out()

    return texts.select("text").mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, limit: int = HEAD_WORDS) -> list[tuple[str, int]]:
    """``limit`` words (all, if there are fewer), the most frequent first; of equally frequent ones at the limit those with the smallest hashes.

    Histograms of about 1,000 buckets of counts, and of the hashes inside the bucket that passes the limit, say which words these
    are; only they reach the driver. A sorted limit would send it as many from every task.
    """
    sizes = {r["bucket"]: r["words"] for r in counts.groupBy("bucket").agg(F.count("word").alias("words")).collect()}
    taken, least, cut = 0, None, None
    for bucket in sorted(sizes, reverse=True):
        if taken + sizes[bucket] > limit:
            cut = bucket
            break
        taken, least = taken + sizes[bucket], bucket
    chosen = F.lit(False) if least is None else F.col("bucket") >= least
    hashed = counts.withColumn("hash", F.xxhash64("word"))
    if cut is not None and taken < limit:
        chosen = chosen | ((F.col("bucket") == cut) & (F.col("hash") <= hash_limit(hashed.filter(F.col("bucket") == cut), limit - taken)))
    return sorted(((r["word"], r["c"]) for r in hashed.filter(chosen).select("word", "c").collect()), key=lambda x: (-x[1], x[0]))


def shared_class(word: bytes) -> int:
    return crc32(word) % CLASSES


def class_column(word: str = "word"):
    """The same class as ``shared_class``."""
    return F.pmod(F.crc32(F.col(word).cast("binary")), F.lit(CLASSES)).cast("int")


class Head:
    """Numbers of the frequent words, their counts, and the shared classes' totals. A frequent word's number is its class;
    class ``size`` + k is shared class k, whose number stands for each of its words."""

    def __init__(self, joined: bytes, counts: np.ndarray, totals: np.ndarray):
        words = joined.split(b"\n") if len(counts) else []
        self.size = len(words)
        self.numbers = {w: i for i, w in enumerate(words)}
        self.counts = counts.astype(np.float64)
        self.totals = totals  # shared classes: sum of (count + 1) of their words, and 1


_HEADS: dict[str, Head] = {}


def worker_head(shared: Shared) -> Head:
    if shared.id not in _HEADS:
        _HEADS.clear()
        _HEADS[shared.id] = Head(*shared.value)
    return _HEADS[shared.id]


CODED = ("doc_id bigint, held_out boolean, numbers array<int>, n_head bigint, head_base double, head_inner double,"
         " rare array<struct<word: string, n: int>>")


def code(docs: DataFrame, shared: Shared) -> DataFrame:
    """Texts as numbers, sums of log10(count + 1) and of log10 word shares over frequent words, rare words by name."""

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        head = worker_head(shared)
        base = np.concatenate([np.log10(head.counts + 1), np.zeros(CLASSES)])
        inner = np.concatenate([np.zeros(head.size), -np.log10(head.totals)])  # the rest of a rare word's share comes with its count
        made: dict[str, object] = {c: batch.column(c) for c in ("doc_id", "held_out")} | {c: [] for c in ("numbers", "n_head", "head_base", "head_inner", "rare")}
        for text in utf8(batch.column("text")):
            found = [*lower_words(text), END]
            got = list(map(head.numbers.get, found))
            rare: Counter = Counter()
            for i, x in enumerate(got):
                if x is None:
                    word = found[i]
                    rare[word] += 1
                    got[i] = head.size + shared_class(word)
            numbers = np.array(got, np.int32)
            made["numbers"].append(numbers)
            made["n_head"].append(len(numbers) - sum(rare.values()))
            made["head_base"].append(float(base[numbers].sum()))
            made["head_inner"].append(float(inner[numbers].sum()))
            made["rare"].append([{"word": w.decode(), "n": n} for w, n in rare.items()])
        return made

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text"), make, CODED, rows=200)


class Batch:
    """Sequences side by side: row t * k is token t of every sequence that has one, longest first."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[self.order]
        sizes = lengths[self.order]
        alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left") if len(sizes) else np.zeros(0, int)  # sequences longer than t
        self.alive = alive.tolist()
        self.at = np.concatenate([[0], np.cumsum(alive)]).tolist()
        self.symbols = flat[np.concatenate([starts[:n] + t for t, n in enumerate(self.alive)])] if self.alive else flat[:0]


class Model:
    """Initial, transition and emission probabilities (states x classes)."""

    def __init__(self, first: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.first, self.move, self.emit = first, move, emit
        self.by_class = np.ascontiguousarray(emit.T)

    @staticmethod
    def start(shares: np.ndarray) -> "Model":
        """Class shares, each state's disturbed by a fixed seed, and states that tend to stay: so that they grow apart."""
        rng = np.random.default_rng(11)
        emit = shares * rng.exponential(1, (STATES, len(shares)))
        move = np.full((STATES, STATES), (1 - STAY) / STATES) + STAY * np.eye(STATES)
        return Model(np.full(STATES, 1 / STATES), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def log10(self, batch: Batch) -> np.ndarray:
        """log10 probability of each sequence, in the batch's order."""
        out = np.zeros(len(batch.order))
        state = None
        for t, n in enumerate(batch.alive):
            seen = self.by_class[batch.symbols[batch.at[t]:batch.at[t + 1]]]
            state = seen * (self.first if state is None else state[:n] @ self.move)
            scale = state.sum(1)
            state /= scale[:, None]
            out[:n] += np.log10(scale)
        return out

    def expected(self, batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of first states, moves, and classes by state."""
        at, alive = batch.at, batch.alive
        seen = self.by_class[batch.symbols]
        forward, scale = np.empty_like(seen), np.empty(len(seen))
        for t, n in enumerate(alive):
            now = slice(at[t], at[t + 1])
            state = seen[now] * (self.first if not t else forward[at[t - 1]:at[t - 1] + n] @ self.move)
            scale[now] = total = state.sum(1)
            np.divide(state, total[:, None], out=forward[now])
        backward = np.ones_like(seen)
        moves = np.zeros_like(self.move)
        for t in range(len(alive) - 1, 0, -1):
            now, n = slice(at[t], at[t + 1]), alive[t]
            ahead = seen[now] * backward[now] / scale[now, None]
            before = slice(at[t - 1], at[t - 1] + n)
            moves += forward[before].T @ ahead
            backward[before] = ahead @ self.move.T
        share = forward * backward
        emitted = np.stack([np.bincount(batch.symbols, share[:, k], len(self.by_class)) for k in range(STATES)])
        return share[:at[1]].sum(0) if alive else np.zeros(STATES), moves * self.move, emitted


def coded_batches(batches: Iterator[pa.RecordBatch], tokens: int):
    """(rows of a batch, classes one after the other, lengths), about ``tokens`` tokens at a time."""
    for whole in batches:
        column = whole.column("numbers")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = np.diff(column.offsets.to_numpy())
        cut = np.flatnonzero(np.diff(np.cumsum(sizes) // tokens)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(sizes)]):
            part = whole.slice(a, b - a)
            yield part, column.slice(a, b - a).flatten().to_numpy(zero_copy_only=False), sizes[a:b]


def baum_welch_round(coded: DataFrame, units: np.ndarray, model: Model) -> Model:
    """One round over the whole training texts: expected counts per partition, added up by Spark.

    Each word, and the unseen ones of each shared class, has one count more, dealt over the states: one state would give the base score.
    """
    sent, n_classes = Shared(coded, (model.first, model.move, model.emit)), len(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Model(*sent.value)
        first, moves, emitted = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, n_classes))
        for _, flat, lengths in coded_batches(batches, BATCH_TOKENS):
            a, b, c = now.expected(Batch(flat, lengths))
            first, moves, emitted = first + a, moves + b, emitted + c
        table = np.concatenate([emitted.T, moves, first[None]])  # classes, then states, then the first states
        rows = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *[pa.array(table[rows, k].astype(np.float32)) for k in range(STATES)]], ["place", *[f"s{k}" for k in range(STATES)]])

    states = [f"s{k}" for k in range(STATES)]
    counts = coded.filter("not held_out").select("numbers").mapInArrow(run, "place bigint, " + ", ".join(f"{s} float" for s in states))
    table = np.zeros((n_classes + STATES + 1, STATES))
    found = counts.groupBy("place").agg(*[F.sum(F.col(s).cast("double")).alias(s) for s in states]).toArrow()  # the model: at most HEAD_WORDS and a few rows
    table[found.column("place").to_numpy()] = np.column_stack([found.column(s).to_numpy() for s in states])
    emit = table[:n_classes].T + units / STATES
    move = table[n_classes:-1] + SMOOTH
    first = table[-1] + SMOOTH
    return Model(first / first.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def forward_scores(coded: DataFrame, model: Model) -> DataFrame:
    """row, doc_id, held_out, sums, and the log10 probability of the classes of each whole text."""
    sent = Shared(coded, (model.first, model.move, model.emit))
    names = ["row", "doc_id", "held_out", "n_head", "head_base", "head_inner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Model(*sent.value)
        for part, flat, lengths in coded_batches(batches, BATCH_TOKENS):
            batch = Batch(flat, lengths)
            scores = np.zeros(len(lengths))
            scores[batch.order] = now.log10(batch)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(lengths, pa.int64()), pa.array(scores)], [*names, "n_tokens", "classes"])

    return coded.select(*names, "numbers").mapInArrow(run, "row bigint, doc_id bigint, held_out boolean, n_head bigint, head_base double, head_inner double, n_tokens bigint, classes double")


def train(coded: DataFrame, shares: np.ndarray, units: np.ndarray, rounds: int = ROUNDS) -> Model:
    model = Model.start(shares)
    for _ in range(rounds):
        model = baum_welch_round(coded, units, model)
    return model


def language_model_scores(docs: DataFrame, rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    bucket = F.floor(F.log2("c") * 16).cast("int")
    counts = stored(word_counts(docs.filter(~held_out())).withColumn("bucket", bucket), "word-counts")
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("word").alias("v")).first()
    n, v = size["n"], size["v"]
    head = frequent_words(counts, head_words)
    shared, words_of = np.ones(CLASSES), np.ones(CLASSES)  # a unit of each shared class is left for unseen words
    for r in counts.groupBy(class_column().alias("k")).agg(F.sum(F.col("c") + 1).alias("m"), F.count("word").alias("v")).collect():  # CLASSES rows
        shared[r["k"]] += r["m"]
        words_of[r["k"]] += r["v"]
    for w, c in head:  # these have classes of their own
        shared[shared_class(w.encode())] -= c + 1
        words_of[shared_class(w.encode())] -= 1
    mass = np.concatenate([np.array([c + 1 for _, c in head], np.float64), shared])
    known = Shared(docs, (b"\n".join(w.encode() for w, _ in head), np.array([c for _, c in head], np.int64), shared))
    coded = stored(code(docs, known).withColumn("row", F.monotonically_increasing_id()), "coded")
    scored = forward_scores(coded, train(coded, mass / mass.sum(), np.append(np.ones(len(head)), words_of), rounds))
    rare = coded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    tail = (
        rare.join(counts.select("word", "c"), "word", "left")
        .groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
                            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("logs"))
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + logs - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        (F.col("classes") + F.col("head_inner") + logs).alias("score"))

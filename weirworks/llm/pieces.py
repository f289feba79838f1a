"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads each character once. At a position it follows the output links of its state: the pieces that
end there, longest first, relax the best score from their start. A character that no piece covers alone costs the
worst piece score less 10 and becomes byte pieces. Ties keep the earlier start.

Spaces become U+2581 with one in front of the text; where no piece holds U+2581 after another character (checked when the
vocabulary is read), no piece crosses the start of a run of them, nor a control character outside all pieces. A text is
then cut there and each distinct part is segmented once per worker (a bounded cache): the same result as over the whole text.

Defined results: NULL and empty texts have no ids. Decoding gives the text back, except that U+2581 in a text returns as
a space (``round_trip`` is false there). Vocabulary files are read through their library, once, by the driver.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirworks.llm.common import map_rows

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MAX_CACHED = 300_000  # parts per worker

#: (piece, score, kind) by id; kind is "piece", "byte" or "other".
Vocabulary = list[tuple[str, float, str]]


def read_vocabulary(model: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    kind = lambda i: "byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "piece"
    return [(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())]


class Automaton:
    """Trie with failure and output links. ``outputs[s]`` lists (length, id) of the pieces that end in state s, longest first."""

    def __init__(self, pieces: list[tuple[str, int]]):
        self.next: list[dict[str, int]] = [{}]
        own: list[tuple[int, int] | None] = [None]
        for piece, number in pieces:
            state = 0
            for c in piece:
                if (to := self.next[state].get(c)) is None:
                    self.next[state][c] = to = len(self.next)
                    self.next.append({})
                    own.append(None)
                state = to
            own[state] = (len(piece), number)
        self.fail = [0] * len(self.next)
        self.outputs: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for c, to in self.next[state].items():
                if state:
                    at = self.fail[state]
                    while at and c not in self.next[at]:
                        at = self.fail[at]
                    self.fail[to] = self.next[at].get(c, 0)
                rest = self.outputs[self.fail[to]]  # complete: the failure state is nearer to the root
                self.outputs[to] = (own[to], *rest) if own[to] else rest
                queue.append(to)

    def step(self, state: int, c: str) -> int:
        while state and c not in self.next[state]:
            state = self.fail[state]
        return self.next[state].get(c, 0)


class PieceModel:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.score = [s for _, s, _ in vocabulary]
        real = [(p, i) for i, (p, _, k) in enumerate(vocabulary) if k == "piece"]
        self.automaton = Automaton(real)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(vocabulary) if k == "byte"}
        self.unknown = min((self.score[i] for _, i in real), default=0.0) - 10
        self.raw = [bytes([int(p[3:5], 16)]) if k == "byte" else p.replace(MARK, " ").encode() if k == "piece" else b"" for p, _, k in vocabulary]
        covered = set().union(*(p for p, _ in real)) if real else set()
        cuts = re.escape("".join(c for c in "\n\t\r" if c not in covered))
        crossing = any(MARK in p.lstrip(MARK) for p, _ in real)
        alone = f"|[{cuts}]" if cuts else ""
        self.part = re.compile(".+" if crossing else f"{MARK}+[^{MARK}{cuts}]*|[^{MARK}{cuts}]+{alone}", re.S)
        self.cache: dict[str, tuple[tuple[int, ...], float]] = {}

    def best(self, text: str) -> tuple[tuple[int, ...], float]:
        """Ids and score of the best segmentation of a text with marks in place of spaces."""
        auto, score = self.automaton, self.score
        total, start, piece, state = [0.0], [0], [-1], 0
        for end, c in enumerate(text, 1):
            state = auto.step(state, c)
            top, begin, number = -np.inf, end - 1, -1
            alone = False
            for length, i in auto.outputs[state]:
                alone |= length == 1
                if (s := total[end - length] + score[i]) > top:
                    top, begin, number = s, end - length, i
            if not alone and (s := total[end - 1] + self.unknown) > top:
                top, begin, number = s, end - 1, -1
            total.append(top)
            start.append(begin)
            piece.append(number)
        ids, end = [], len(text)
        while end:
            if piece[end] >= 0:
                ids.append(piece[end])
            else:  # one uncovered character
                ids += [self.byte_ids.get(b, 0) for b in reversed(text[start[end]:end].encode())]
            end = start[end]
        return tuple(reversed(ids)), total[-1]

    def _part(self, part: str) -> tuple[tuple[int, ...], float]:
        if (known := self.cache.get(part)) is None:
            known = self.best(part)
            if len(part) <= 64:
                if len(self.cache) >= MAX_CACHED:
                    self.cache.clear()
                self.cache[part] = known
        return known

    def encode(self, text: str | None) -> tuple[list[int], float]:
        if not text:
            return [], 0.0
        done = [self._part(p) for p in self.part.findall(MARK + text.replace(" ", MARK))]
        return list(chain.from_iterable([d[0] for d in done])), sum(d[1] for d in done)

    def decode(self, ids) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.decode(errors="replace")[1:] if raw[:1] == b" " else raw.decode(errors="replace")


_MODELS: dict[int, PieceModel] = {}


def worker_model(shared) -> PieceModel:
    """The model of a broadcast vocabulary, built once per Python worker."""
    if shared.id not in _MODELS:
        _MODELS.clear()
        _MODELS[shared.id] = PieceModel(shared.value)
    return _MODELS[shared.id]


class Shared:
    """A broadcast value with a name that workers can cache by."""

    def __init__(self, df: DataFrame, value):
        import uuid

        self.id, self.held = uuid.uuid4().hex, df.sparkSession.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.held.value


def encode(docs: DataFrame, model: str = MODEL, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``ids``, the segmentation's ``score`` and ``round_trip`` (decoding gives the text back)."""
    shared = Shared(docs, read_vocabulary(model))
    chosen = docs.select(*keep, "text")

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        m = worker_model(shared)
        made: dict[str, object] = {c: batch.column(c) for c in keep} | {"ids": [], "score": [], "round_trip": []}
        for text in batch.column("text").to_pylist():
            ids, score = m.encode(text)
            made["ids"].append(np.array(ids, np.int32))
            made["score"].append(float(score))
            made["round_trip"].append(m.decode(ids) == (text or ""))
        return made

    kept = ", ".join(f"`{c}` {chosen.schema[c].dataType.simpleString()}" for c in keep)
    return map_rows(chosen, make, f"{kept}, ids array<int>, score double, round_trip boolean", rows=200)


def encode_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per row: number of pieces, of bytes among them, score, digest of the ids (32-bit little-endian), round trip."""
    shared = Shared(docs, read_vocabulary(model))

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        m = worker_model(shared)
        low, high = (min(m.byte_ids.values(), default=0), max(m.byte_ids.values(), default=-1))
        made: dict[str, object] = {"doc_id": batch.column("doc_id")} | {c: [] for c in ("n_pieces", "n_bytes", "score", "ids_sha256", "round_trip")}
        for text in batch.column("text").to_pylist():
            ids, score = m.encode(text)
            flat = np.array(ids, "<i4")
            made["n_pieces"].append(len(ids))
            made["n_bytes"].append(int(((flat >= low) & (flat <= high)).sum()))
            made["score"].append(float(score))
            made["ids_sha256"].append(hashlib.sha256(flat.tobytes()).hexdigest())
            made["round_trip"].append(m.decode(ids) == (text or ""))
        return made

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make,
                    "doc_id bigint, n_pieces bigint, n_bytes bigint, score double, ids_sha256 string, round_trip boolean", rows=200)


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text of an id column."""
    shared = Shared(encoded, read_vocabulary(model))
    schema = encoded.withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = worker_model(shared)
            texts = pa.array([m.decode(x or ()) for x in batch.column(ids).to_pylist()], pa.string())
            held = [c for c in batch.schema.names if c != out]
            named = {c: batch.column(c) for c in held} | {out: texts}
            yield pa.RecordBatch.from_arrays([named[f.name] for f in schema], [f.name for f in schema])

    return encoded.mapInArrow(run, schema)

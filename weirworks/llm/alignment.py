"""Cross-tokenizer alignment over inverted pair bitmaps.

Two tokenizers cut the same bytes; offsets where tokens of both end cut them into groups, and the tokens of a group are linked.

1. One pass over the texts aligns them. Rows are numbered inside their partition; 65,536 consecutive numbers are a chunk. A task
   gathers its links by id pair and writes posting fragments: per (pair, chunk, plane) a compressed bitmap of the rows, as a
   sorted array of 16-bit numbers below 4,096 rows and as 8,192 bytes from there on. Plane 0 says which rows hold the pair;
   plane k + 1 holds bit k of (links of the row - 1), so links that repeat in a row cost a few more bits, not rows.
2. Fragments of the same (pair, chunk, plane) are OR-merged in sorted streams. A pair of every text is cut into its chunks.
3. Population counts summed per pair give its documents (plane 0) and its links (all planes by their weights).
4. Scores return over the postings: each bitmap adds its pair's count to the rows it names, chunk by chunk.

Alignment runs per unit: a text is cut before a space or line feed that follows a visible character. Neither tokenizer
has a token over such a cut (the first starts a new word there, the second has no piece with an inner space or a line feed), so
each unit is coded and aligned alone and a bounded cache keeps short ones. The tests compare with whole texts.

Defined results: NULL and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens: zeros
and an empty digest. Repeated rows and rows without an id are documents like any other. Empty tables give empty tables.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from weirworks.llm.pieces import Shared
from weirworks.session import stored

FIRST = "/opt/tokenizers/byte_bpe_50k.json"
SECOND = "/opt/tokenizers/piece_bpe_32k.model"
UNIT = re.compile(r"[ \n][^ \n]*(?:(?<!\S)[ \n][^ \n]*)*")
CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
DENSE = 4_096  # rows from which a bitmap of CHUNK bits is smaller than an array
HELD = 1_500_000  # links of distinct (row, pair) that a task holds before it writes fragments
CACHED, CACHED_LINKS = 150_000, 2_000_000  # units and links per worker; beyond, the cache starts anew
ROW = 200  # units coded as one string
FEW = 256  # links of a group that are listed without counting its tokens first
TEXTS = 300  # texts coded at a time
MARK = "▁"

POSTING = "a int, b int, chunk bigint, plane int, docs binary"
SUMMARY = "row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"


class Units(NamedTuple):
    """Aligned units by slot: rows of n_a, n_b, n_groups, n_links; whether the tokens' bytes are the unit's; groups as text; linked id pairs
    (a * SECOND_IDS + b) of all units one after the other, how often each is linked there, and how many a unit has."""

    figures: np.ndarray
    good: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    times: np.ndarray
    sizes: np.ndarray


class Texts(NamedTuple):
    """Figures of several texts: rows of n_a, n_b, n_groups, n_links; digests; and their links by text and pair."""

    figures: np.ndarray
    groups: list[str]
    text: np.ndarray
    pair: np.ndarray
    links: np.ndarray


def byte_level_table() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and a bounded cache of aligned units."""

    def __init__(self, first: bytes, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        table = byte_level_table()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            if all(c in table for c in token):
                self.a_bytes[i] = bytes(table[c] for c in token)
        name = self.b.id_to_piece
        self.b_bytes = [bytes([int(name(i)[3:5], 16)]) if self.b.is_byte(i) else name(i).replace(MARK, " ").encode() for i in range(self.b.get_piece_size())]
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.ids_b = len(self.b_bytes)
        self.number = [str(i) for i in range(max(len(self.a_bytes), self.ids_b))]
        self.lone_mark = self.b.piece_to_id(MARK)
        self.forget()

    def forget(self) -> None:
        """Empties the cache: slots of units, and their aligned parts as they came."""
        self.slots: dict[str, int] = {}
        self.parts: list[Units] = []

    def second_ids(self, strings: list[str]) -> list[list[int]]:
        """The model writes a mark of its own before a text: it stands for the first space, and goes where a string starts with a line feed."""
        coded = self.b.encode([u[1:] if u[0] == " " else u for u in strings], num_threads=1)
        for i, u in enumerate(strings):
            if u == " ":
                coded[i] = [self.lone_mark]
            elif u[0] != " ":
                coded[i] = coded[i][1:] if coded[i][:1] == [self.lone_mark] else []
        return coded

    def code(self, units: list[str]) -> Units:
        """Aligned units, in order.

        Units that end with a visible character are coded in rows of ROW, others alone. Where the tokens of a row don't give back its
        bytes, its units are coded one by one, and those that are wrong then have no tokens.
        """
        rows: list[list[str]] = []
        open_row = False
        for u in units:
            whole = not u[-1].isspace()
            if not (whole and open_row and len(rows[-1]) < ROW):
                rows.append([])
            rows[-1].append(u)
            open_row = whole
        a, b, good = self.tokens(rows)
        if not all(good):
            rows = [part for row, fine in zip(rows, good) for part in ([row] if fine else [[u] for u in row])]
            a, b, good = self.tokens(rows)
        n_units = [len(r) for r in rows]
        fine = np.repeat(np.array(good, bool), n_units)
        lengths = np.array([len(u.encode()) for u in units], np.int64)
        return self.aligned(np.concatenate([np.array(x, np.int64) for x, ok in zip(a, good) if ok] or [np.zeros(0, np.int64)]),
                            np.concatenate([np.array(x, np.int64) for x, ok in zip(b, good) if ok] or [np.zeros(0, np.int64)]), lengths, fine)

    def tokens(self, rows: list[list[str]]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        strings = ["".join(r) for r in rows]
        a = [e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)]
        b = self.second_ids(strings)
        raw = [s.encode() for s in strings]
        good = [b"".join([self.a_bytes[i] for i in x]) == r and b"".join([self.b_bytes[i] for i in y]) == r for x, y, r in zip(a, b, raw)]
        return a, b, good

    def aligned(self, a: np.ndarray, b: np.ndarray, lengths: np.ndarray, fine: np.ndarray) -> Units:
        """Token ends as running byte counts over all good units in a row; groups where the ends of both meet."""
        figures, sizes = np.zeros((len(lengths), 4), np.int64), np.zeros(len(lengths), np.int64)
        shown = [""] * len(lengths)
        stops = np.cumsum(lengths[fine])
        if not len(stops):
            return Units(figures, fine, shown, np.zeros(0, np.int64), np.zeros(0, np.int64), sizes)
        ends_a, ends_b = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1
        first_a, first_b = np.append(0, last_a[:-1]), np.append(0, last_b[:-1])
        p, q = last_a - first_a, last_b - first_b
        last_group = np.searchsorted(ends, stops) + 1
        before = lambda x: np.diff(np.searchsorted(x, stops) + 1, prepend=0)
        linked = p * q
        figures[fine] = np.column_stack([before(ends_a), before(ends_b), np.diff(last_group, prepend=0), np.add.reduceat(linked, np.append(0, last_group[:-1]))])

        texts_a, texts_b = list(map(self.number.__getitem__, a.tolist())), list(map(self.number.__getitem__, b.tolist()))
        groups = [x + "|" + y for x, y in zip(map(texts_a.__getitem__, first_a.tolist()), map(texts_b.__getitem__, first_b.tolist()))]
        several = np.flatnonzero((p > 1) | (q > 1))
        for g, i, j, k, m in zip(*(x.tolist() for x in (several, first_a[several], last_a[several], first_b[several], last_b[several]))):
            groups[g] = ",".join(texts_a[i:j]) + "|" + ",".join(texts_b[k:m])
        start, texts = 0, []
        for stop in last_group.tolist():
            texts.append(groups[start] if stop - start == 1 else ";".join(groups[start:stop]))
            start = stop
        for i, t in zip(np.flatnonzero(fine).tolist(), texts):
            shown[i] = t

        many = np.minimum(linked, np.where(linked > FEW, 0, linked))  # large groups are counted below
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        width = np.repeat(q, many)
        pairs = a[np.repeat(first_a, many) + at // width] * self.ids_b + b[np.repeat(first_b, many) + at % width]
        group = np.repeat(np.arange(len(ends)), many)
        times = np.ones(len(pairs), np.int64)
        for g in np.flatnonzero(linked > FEW).tolist():
            left, right = Counter(a[first_a[g]:last_a[g]].tolist()), Counter(b[first_b[g]:last_b[g]].tolist())
            found = {x * self.ids_b + y: n * m for x, n in left.items() for y, m in right.items()}
            pairs, group = np.append(pairs, list(found)), np.append(group, np.full(len(found), g))
            times = np.append(times, list(found.values()))
        unit = np.searchsorted(last_group, group, side="right")
        if (linked > FEW).any():
            order = np.argsort(unit, kind="stable")
            unit, pairs, times = unit[order], pairs[order], times[order]
        sizes[fine] = np.bincount(unit, minlength=len(stops))
        return Units(figures, fine, shown, pairs, times, sizes)

    def known(self, units: Iterable[str]) -> Units:
        """The cached units, after those of ``units`` that are missing were aligned and given slots."""
        if len(self.slots) > CACHED or (self.parts and len(self.parts[0].pairs) > CACHED_LINKS):
            self.forget()
        missing = [u for u in units if u not in self.slots]
        if missing or not self.parts:
            self.slots |= zip(missing, range(len(self.slots), len(self.slots) + len(missing)))
            self.parts.append(self.code(missing))
        if len(self.parts) > 1:
            shown = self.parts[0].groups
            for part in self.parts[1:]:
                shown += part.groups
            join = lambda k: np.concatenate([x[k] for x in self.parts])
            self.parts = [Units(join(0), join(1), shown, join(3), join(4), join(5))]
        return self.parts[0]

    def texts(self, texts: list[str | None]) -> Texts:
        """Aligned texts: sums over the occurrences of units are array operations."""
        cut = [UNIT.findall(" " + t) if t else [] for t in texts]
        units = self.known(set().union(*cut))
        slot = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(cut)), np.int64)
        lengths = np.array([len(c) for c in cut])
        text = np.repeat(np.arange(len(texts)), lengths)
        if len(slot) and not (fine := units.good[slot]).all():  # a text with a wrong unit has no tokens
            whole = np.ones(len(texts), bool)
            whole[text[~fine]] = False
            slot, text = slot[whole[text]], text[whole[text]]
            lengths = np.where(whole, lengths, 0)

        figures = np.zeros((len(texts), 4), np.int64)
        if len(slot):
            full = np.flatnonzero(lengths)
            figures[full] = np.add.reduceat(units.figures[slot], (np.cumsum(lengths) - lengths)[full], axis=0)
        shown, at = list(map(units.groups.__getitem__, slot.tolist())), 0
        digests = []
        for n in lengths.tolist():
            digests.append(sha256(";".join(shown[at:at + n]).encode()).hexdigest() if n else "")
            at += n

        starts, many = np.cumsum(units.sizes) - units.sizes, units.sizes[slot]
        where = np.repeat(starts[slot] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        space = len(self.a_bytes) * self.ids_b
        key = np.repeat(text, many) * space + units.pairs[where]
        order = np.argsort(key, kind="stable")
        key, times = key[order], units.times[where][order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        links = np.add.reduceat(times, first) if len(key) else times
        return Texts(figures, digests, key[first] // space, key[first] % space, links)


_ALIGNERS: dict[str, Aligner] = {}


def worker_aligner(shared: Shared) -> Aligner:
    if shared.id not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[shared.id] = Aligner(*shared.value)
    return _ALIGNERS[shared.id]


def pack(rows: np.ndarray) -> bytes:
    """Sorted 16-bit row numbers as the smaller of an array and a bitmap."""
    if len(rows) < DENSE:
        return rows.astype("<u2").tobytes()
    bits = np.zeros(CHUNK, np.uint8)
    bits[rows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(docs: bytes) -> np.ndarray:
    if len(docs) < 2 * DENSE:
        return np.frombuffer(docs, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(docs, np.uint8), bitorder="little")).astype(np.uint16)


def size(docs: bytes) -> int:
    return len(docs) // 2 if len(docs) < 2 * DENSE else int(np.bitwise_count(np.frombuffer(docs, np.uint8)).sum())


def merge(parts: list[bytes]) -> bytes:
    """OR of bitmaps of one (pair, chunk, plane)."""
    if sum(map(len, parts)) < 2 * DENSE:  # arrays
        return np.unique(np.frombuffer(b"".join(parts), "<u2")).tobytes()
    bits = np.zeros(CHUNK, np.uint8)
    for p in parts:
        bits[unpack(p)] = 1
    return pack(np.flatnonzero(bits))


def fragments(chunk: int, ids_b: int, pair: np.ndarray, low: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    """Posting fragments of links held in the order of their rows: all bitmaps of all planes without a loop over pairs."""
    order = np.argsort(pair, kind="stable")
    pair, low, more = pair[order], low[order], links[order] - 1
    made = []
    for plane in range(1 + int(more.max(initial=0)).bit_length()):
        inside = slice(None) if plane == 0 else (more >> (plane - 1)) & 1 == 1
        p, rows = pair[inside], low[inside]
        starts = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(p))
        raw = rows.astype("<u2").tobytes()
        if (ends - starts).max(initial=0) < DENSE:
            offsets = np.append(starts, len(p)).astype(np.int32) * 2
            docs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])
        else:
            docs = pa.array([pack(rows[s:e]) for s, e in zip(starts, ends)], pa.binary())
        heads = p[starts]
        made.append(pa.RecordBatch.from_arrays([
            pa.array((heads // ids_b).astype(np.int32)), pa.array((heads % ids_b).astype(np.int32)),
            pa.array(np.full(len(starts), chunk, np.int64)), pa.array(np.full(len(starts), plane, np.int32)), docs],
            names=["a", "b", "chunk", "plane", "docs"]))
    return pa.Table.from_batches(made).combine_chunks().to_batches()[0]


class Held:
    """Links of the rows of one chunk, not yet written."""

    def __init__(self):
        self.parts, self.n = [], 0

    def add(self, low: int, found: Texts) -> None:
        self.parts.append((found.pair, (found.text + low).astype(np.uint16), found.links))
        self.n += len(found.pair)

    def out(self, chunk: int, ids_b: int) -> pa.RecordBatch:
        return fragments(chunk, ids_b, *map(np.concatenate, zip(*self.parts)))


def slices(batch: pa.RecordBatch, row: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most TEXTS rows, none of them over a chunk's end; ``row`` is the first one's number."""
    start = 0
    while start < batch.num_rows:
        part = batch.slice(start, min(TEXTS, CHUNK - (row + start) % CHUNK))
        yield part
        start += part.num_rows


def _aligned(docs: DataFrame, keep: tuple[str, ...], first: str, second: str, most: int) -> DataFrame:
    """One row per document (``row``) and one per posting fragment (``a``), the other columns NULL."""
    with open(first, "rb") as f, open(second, "rb") as g:
        shared = Shared(docs, (f.read(), g.read()))
    chosen = docs.select(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)], "text")
    kept = [StructField(f"keep_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = StructType([*StructType.fromDDL(f"{SUMMARY}, {POSTING}").fields, *kept])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(shared)
        row = TaskContext.get().partitionId() << 33
        held = Held()

        def whole(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def flush(chunk: int) -> Iterator[pa.RecordBatch]:
            nonlocal held
            if held.n:
                made = held.out(chunk, aligner.ids_b)
                held = Held()
                yield whole(dict(zip(made.schema.names, made.columns)), made.num_rows)

        for whole_batch in batches:
            for batch in slices(whole_batch, row):
                found = aligner.texts(batch.column("text").to_pylist())
                n = batch.num_rows
                made = dict(zip(("n_a", "n_b", "n_groups", "n_links"), (pa.array(c) for c in found.figures.T.copy())))
                made |= {"row": pa.array(np.arange(row, row + n)), "groups": pa.array(found.groups, pa.string())}
                yield whole(made | {f"keep_{i}": batch.column(f"keep_{i}") for i in range(len(keep))}, n)
                held.add(row % CHUNK, found)
                row += n
                if held.n >= most or row % CHUNK == 0:
                    yield from flush((row - 1) // CHUNK)
        yield from flush((row - 1) // CHUNK)

    return chosen.mapInArrow(run, schema)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """OR-merges runs of the same (a, b, chunk, plane) in sorted rows and counts them; a run may go on in the next batch."""
    held: pa.Table | None = None
    names = ["a", "b", "chunk", "plane"]

    def out(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        keys = [t.column(c).to_numpy() for c in names]
        new = np.ones(t.num_rows, bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], t.num_rows)
        docs = t.column("docs").chunk(0)
        several = np.flatnonzero(ends - starts > 1)
        united = [merge(docs.slice(s, e - s).to_pylist()) for s, e in zip(starts[several].tolist(), ends[several].tolist())]
        chosen = starts.copy()
        chosen[several] = t.num_rows + np.arange(len(several))
        done = pa.concat_arrays([docs, pa.array(united, docs.type)]).take(pa.array(chosen))
        lengths = pc.binary_length(done).to_numpy(zero_copy_only=False)
        counts = lengths.astype(np.int64) // 2
        for i in np.flatnonzero(lengths >= 2 * DENSE).tolist():
            counts[i] = size(done[i].as_py())
        return pa.RecordBatch.from_arrays([*[pa.array(k[starts], t.schema.field(c).type) for c, k in zip(names, keys)], done, pa.array(counts)], names=[*names, "docs", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        last = np.logical_and.reduce([t.column(c).to_numpy() == t.column(c)[-1].as_py() for c in names])
        cut = t.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        held = t.slice(cut)
        if cut:
            yield out(t.slice(0, cut))
    if held is not None:
        yield out(held)


@dataclass
class Alignment:
    """Stored tables of an aligned corpus.

    ``documents``: ``row``, the kept columns, n_a, n_b, n_groups, n_links, groups (SHA-256 of the groups as text).
    ``postings``: a, b, chunk, plane, docs, n. ``pairs``: a, b, n_docs, n_links, best (no b of this a is in more documents).
    """

    documents: DataFrame
    postings: DataFrame
    pairs: DataFrame


def weight(plane: str = "plane"):
    """Links that a row of a plane stands for."""
    return F.when(F.col(plane) == 0, F.lit(1)).otherwise(F.expr(f"shiftleft(1L, {plane} - 1)")).cast("bigint")


def index(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), first: str = FIRST, second: str = SECOND, held: int = HELD) -> Alignment:
    """``held`` bounds the distinct (row, pair) links in a task's memory; more of them become further fragments."""
    aligned = stored(_aligned(docs, keep, first, second, held), "alignment")
    documents = aligned.filter("row is not null").select(
        "row", *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "n_a", "n_b", "n_groups", "n_links", "groups")
    parts = aligned.filter("row is null").select("a", "b", "chunk", "plane", "docs")
    merged = parts.repartition("a", "b", "chunk").sortWithinPartitions("a", "b", "chunk", "plane").mapInArrow(_merged, f"{POSTING}, n bigint")
    postings = stored(merged, "alignment-postings")
    counts = postings.groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n")).otherwise(0)).alias("n_docs"), F.sum(F.col("n") * weight()).alias("n_links"))
    counts = stored(counts, "alignment-pairs")
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    pairs = counts.join(top, "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("top")).alias("best"))
    return Alignment(documents, postings, pairs)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each posting's score to its rows; rows come sorted by chunk, so two arrays of one chunk are all that is held."""
    at, best, total = None, None, None

    def out() -> pa.RecordBatch:
        rows = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [pa.array((at << CHUNK_BITS) + rows), pa.array(best[rows]), pa.array(total[rows])], names=["row", "n_best", "count_sum"])

    for batch in batches:
        chunks, weights = batch.column("chunk").to_numpy(), batch.column("weight").to_numpy()
        counts, firsts = batch.column("n_docs").to_numpy(), batch.column("best").to_numpy(zero_copy_only=False)
        docs = batch.column("docs").to_pylist()
        edges = np.unique(np.concatenate([[0], np.flatnonzero(chunks[1:] != chunks[:-1]) + 1, [len(chunks)]]))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if at is None or chunks[lo] != at:
                if at is not None:
                    yield out()
                at, best, total = int(chunks[lo]), np.zeros(CHUNK, np.int64), np.zeros(CHUNK, np.int64)
            rows = [unpack(d) for d in docs[lo:hi]]
            lengths = [len(r) for r in rows]
            rows = np.concatenate(rows)
            np.add.at(total, rows, np.repeat(weights[lo:hi] * counts[lo:hi], lengths))
            np.add.at(best, rows, np.repeat(weights[lo:hi] * firsts[lo:hi], lengths))
    if at is not None:
        yield out()


def scores(found: Alignment) -> DataFrame:
    """``documents`` with ``n_best`` (links that are best for their first id) and ``count_sum`` (documents of the pair, over all links)."""
    counted = found.postings.join(found.pairs.select("a", "b", "n_docs", "best"), ["a", "b"]).select("chunk", weight().alias("weight"), "docs", "n_docs", "best")
    by_row = counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_scored, "row bigint, n_best bigint, count_sum bigint")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return found.documents.join(by_row, "row", "left").select(
        *[c for c in found.documents.columns if c not in ("row", "groups")], zero("n_best"), zero("count_sum"), F.col("groups").alias("groups_sha256"))

"""Benchmark decontamination by template canonicalisation.

Each word becomes a template token: numbers ``<NUM>``, capitalised words ``<NAME>``, a unit of measure after a number
``<UNIT>``, other words their case-folded letters. Adjacent names or numbers are one token, so a name may have any number of
words. Windows of eight tokens with at least four literal ones are hashed and joined with the windows of the benchmark items.
Windows that keep the item's order in the document belong together, on whatever diagonals (the document's position less
the item's) they lie; the values of their slots give a mapping from the item's values to the document's, and a slot is
consistent where its item value maps to one value throughout. A re-parameterised question keeps the template and maps
its slots consistently; different questions of one form don't.

Case is no safe sign of a name, so a text is read in four ways, and any reading of a document meets any of an item: capitals
are names; they are, but not at a sentence start or in a run of words in capitals; none is a name; no word is a slot at
all. Windows of the last reading are compared letter by letter (case folded) and need no literal tokens, so passages in other
case and items of names and numbers are found as well.

A window of the item is covered if all its words lie in windows that are met: words put between two met parts don't
uncover the windows across them. Coverage is that of all places where a window starts, or that of the places with a window
of the first reading alone, whichever is greater. Tested are each diagonal alone, the longest ordered chain of each neighbourhood (cut where
the document has no window for as many words as the item has) and of the whole document.

Documents are filtered before the join by a Bloom filter of the benchmark's windows: its size is a parameter (2^23 bits),
whatever the size of the benchmark; a larger benchmark only lets more windows through to the join, which is exact.

An item of fewer than four words says too little inside prose: it is met only by a line, or a whole text, of just these words (case folded).

Defined results: NULL or empty texts and items have no windows; items shorter than a window are one window of their own
length (with at least half of it literal, except in the last reading); pairs of repeated rows are returned once; a NULL id is kept as NULL.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from xxhash import xxh64_intdigest

from weirworks.llm.common import map_rows, utf8, words
from weirworks.llm.pieces import Shared
from weirworks.session import stored

WINDOW, LITERALS, FEW_WORDS = 8, 4, 4
BLOOM_BITS = 1 << 23
MIN_COVERAGE, MIN_CONSISTENT = 0.5, 0.9
MAX_CACHED = 300_000

#: Units of measure that count as a slot after a number.
UNITS = set(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons"
    " ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years"
    " $ usd eur euro euros dollar dollars cent cents percent % degree degrees kb mb gb tb hz khz mhz ghz v volt volts w watt watts j joule joules n newton newtons"
    " pa mol".split())
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
CLOSING = ")]}\"'`»”’"
EDGE = ".,;:!?()[]{}\"'`«»“”‘’…"
LITERAL, NAME, NUM, UNIT = 0, 1, 2, 3
SLOT_HASH = np.array([0, *(xxh64_intdigest(x) for x in (b"<NAME>", b"<NUM>", b"<UNIT>"))], np.uint64)

HITS = "id bigint, print bigint, window bigint, pos int, stop int, size int, named boolean, slots array<struct<at: int, kind: int, value: string>>"
PAIRS = ("doc_id bigint, item_id bigint, doc_print bigint, n_windows bigint, n_consistent bigint, verbatim boolean,"
         " n_item_windows bigint, coverage double, n_slots bigint")


def classify(word: bytes) -> tuple[int, int, bool, bool]:
    """(kind, hash of the literal, ends a sentence, is in capitals) of a word; UNIT is a unit only after a number."""
    whole = word.decode(errors="replace")
    ends = whole.rstrip(CLOSING)[-1:] in tuple(".!?…:")
    text = whole.strip(EDGE)
    bare = text.casefold()
    h = xxh64_intdigest(bare.encode())
    if NUMBER.fullmatch(text):
        return NUM, h, ends, False
    if bare in UNITS:
        return UNIT, h, ends, text.isupper()
    return (NAME if text[:1].isupper() else LITERAL), h, ends, len(text) > 1 and text.isupper()


class Words(dict):
    """Kind and hash by word, filled on first use, bounded."""

    def __missing__(self, word: bytes) -> tuple[int, int, bool, bool]:
        if len(self) >= MAX_CACHED:
            self.clear()
        found = self[word] = classify(word)
        return found


class Reading:
    """The words of a batch of texts as template tokens: hash, kind and first word of each, and its text's number."""

    def __init__(self, hashes: np.ndarray, kinds: np.ndarray, texts: np.ndarray, literals: int = LITERALS):
        self.literals = literals
        same = np.concatenate([[False], (kinds[1:] == kinds[:-1]) & (texts[1:] == texts[:-1])]) if len(kinds) else np.zeros(0, bool)
        self.at = np.flatnonzero(~(same & ((kinds == NAME) | (kinds == NUM))))
        self.kinds, self.texts = kinds[self.at], texts[self.at]
        self.hashes = np.where(self.kinds == LITERAL, hashes[self.at], SLOT_HASH[self.kinds])
        self.stops = np.append(self.at[1:], len(kinds))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of ``size`` tokens and which of them lie in one text and have enough literal tokens."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        mixed = np.full(n, size, np.uint64)
        for i in range(size):
            mixed = (mixed ^ self.hashes[i:n + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        literal = np.concatenate([[0], np.cumsum(self.kinds == LITERAL)])
        enough = literal[size:] - literal[:-size] >= (self.literals if size == WINDOW else min(self.literals, (size + 1) // 2))
        return mixed, enough & (self.texts[:n] == self.texts[size - 1:])


def readings(found: list[list[bytes]], known: Words) -> list[Reading]:
    """The four readings of the texts, that with all capitals as names first."""
    pairs = [known[w] for text in found for w in text]
    if not pairs:
        return []
    texts = np.repeat(np.arange(len(found)), [len(text) for text in found])
    kinds, hashes, ends, upper = (np.array(column, kind) for column, kind in zip(zip(*pairs), (np.int8, np.uint64, bool, bool)))
    one_text = texts[:-1] == texts[1:]
    after_number = np.concatenate([[False], (kinds[:-1] == NUM) & one_text])
    kinds[(kinds == UNIT) & ~after_number] = LITERAL
    start = np.concatenate([[True], ends[:-1] | ~one_text])
    pair = upper[:-1] & upper[1:] & one_text
    shouted = np.concatenate([pair, [False]]) | np.concatenate([[False], pair])
    folded = np.where(kinds == NAME, np.int8(LITERAL), kinds)
    return [Reading(hashes, kinds, texts), Reading(hashes, np.where(start | shouted, folded, kinds), texts), Reading(hashes, folded, texts),
            Reading(hashes, np.zeros_like(kinds), texts, 0)]


def bloom_places(window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return window & np.uint64(BLOOM_BITS - 1), (window >> np.uint64(32)) & np.uint64(BLOOM_BITS - 1)


def window_rows(rows: DataFrame, sizes: list[int] | None = None, bloom: Shared | None = None) -> DataFrame:
    """One row per window of every text of ``rows`` (id, print, text) with its slots; only windows in ``bloom`` where it is given.

    Without ``sizes`` a text has windows of WINDOW tokens, or one of its own length if it is shorter. ``pos`` and ``stop``
    are words of the text, ``size`` is in tokens.
    """

    schema = to_arrow_schema(StructType.fromDDL(HITS))

    def make(batches):
        known = Words()
        bits = np.unpackbits(np.frombuffer(bloom.value, np.uint8), bitorder="little").view(bool) if bloom else None
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                out: dict[str, list] = {f.name: [] for f in schema}
                ids, prints = batch.column("id").to_pylist(), batch.column("print").to_pylist()
                found = [words(text) for text in utf8(batch.column("text"))]
                first = np.cumsum([0, *map(len, found)])
                seen = set()
                for n, reading, size in ((n, r, s) for n, r in enumerate(readings(found, known)) for s in sizes or range(1, WINDOW + 1)):
                    got, good = reading.windows(size)
                    if not sizes and len(got):
                        good &= np.minimum(np.bincount(reading.texts, minlength=len(found)), WINDOW)[reading.texts[:len(got)]] == size
                    if bits is not None and len(got):
                        a, b = bloom_places(got)
                        good &= bits[a] & bits[b]
                    for i in np.flatnonzero(good).tolist():
                        if (place := (int(reading.at[i]), int(got[i]))) in seen:  # readings agree where they see the same slots
                            continue
                        seen.add(place)
                        k = int(reading.texts[i])
                        base, text = int(first[k]), found[k]
                        pos = int(reading.at[i]) - base
                        slots = []
                        for j in range(i, i + size):
                            if kind := int(reading.kinds[j]):
                                a, b = int(reading.at[j]) - base, min(int(reading.stops[j]) - base, len(text))
                                value = " ".join(w.decode(errors="replace").strip(EDGE) for w in text[a:b])
                                slots.append({"at": a - pos, "kind": kind, "value": value})
                        row = (ids[k], prints[k], int(got[i].view(np.int64)), pos, min(int(reading.stops[i + size - 1]) - base, len(text)), size, n == 0, slots)
                        for name, value in zip(out, row):
                            out[name].append(value)
                if out["id"]:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return rows.select("id", "print", "text").mapInArrow(make, HITS)


def bloom_filter(items: DataFrame) -> bytes:
    """A bit set of BLOOM_BITS bits over the windows of the items: at most BLOOM_BITS / 64 rows reach the driver."""
    low = F.col("window").bitwiseAND(F.lit(BLOOM_BITS - 1))
    high = F.shiftrightunsigned("window", 32).bitwiseAND(F.lit(BLOOM_BITS - 1))
    places = items.select(F.explode(F.array(low, high)).alias("p"))
    cells = places.groupBy(F.shiftright("p", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).collect()
    table = np.zeros(BLOOM_BITS // 64, np.int64)
    for r in cells:
        table[r["cell"]] = r["bits"]
    return table.tobytes()


def keyed(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"), "text")


def longest_chain(hits: list[dict]) -> list[dict]:
    """The most hits in the order of both texts, with the fewest changes of the diagonal. ``hits`` is in the order of (pos, -item_pos)."""
    places = sorted({h["item_pos"] for h in hits})
    tree: list[tuple[int, int, int, int]] = [(0, 0, -1, -1)] * (len(places) + 1)  # hits, -changes, pos, index: the best below a place
    on_diagonal: dict[int, int] = {}
    length, changes, before = [0] * len(hits), [0] * len(hits), [-1] * len(hits)
    for i, h in enumerate(hits):
        rank = bisect_left(places, h["item_pos"])
        best, k = tree[0], rank
        while k:
            best, k = max(best, tree[k]), k & (k - 1)
        options = [(best[0], best[1] - (best[3] >= 0), best[2], best[3])]
        if (last := on_diagonal.get(diagonal := h["pos"] - h["item_pos"])) is not None and hits[last]["pos"] < h["pos"]:
            options.append((length[last], changes[last], hits[last]["pos"], last))
        top = max(options)
        length[i], changes[i], before[i] = top[0] + 1, top[1], top[3]
        on_diagonal[diagonal] = i
        entry, k = (length[i], changes[i], h["pos"], i), rank + 1
        while k < len(tree):
            tree[k], k = max(tree[k], entry), k + (k & -k)
    at = max(range(len(hits)), key=lambda i: (length[i], changes[i]))
    chain = []
    while at >= 0:
        chain.append(hits[at])
        at = before[at]
    return chain


def candidates(hits: list[dict], item_words: int) -> Iterable[list[dict]]:
    """Sets of hits that may be one passage: every diagonal, the longest chain of each neighbourhood and of all."""
    diagonals = defaultdict(list)
    for h in hits:
        diagonals[h["pos"] - h["item_pos"]].append(h)
    yield from diagonals.values()
    if len(diagonals) == 1:
        return
    hits = sorted(hits, key=lambda h: (h["pos"], -h["item_pos"]))
    near, reach = [], 0
    neighbourhoods = [near]
    for h in hits:
        if near and h["pos"] > reach + item_words:
            near = []
            neighbourhoods.append(near)
        near.append(h)
        reach = h["pos"]
    for part in neighbourhoods if len(neighbourhoods) > 1 else []:
        yield longest_chain(part)
    yield longest_chain(hits)


def judged(hits: list[dict], item: list[dict]) -> dict[str, object]:
    """Covered windows of the item and consistent slots of hits that belong together."""
    end = max(w["stop"] for w in item)
    words_met = np.zeros(end + 1, np.int64)
    for h in hits:
        words_met[h["item_pos"] + 1:h["item_stop"] + 1] = 1
    met = np.cumsum(words_met)
    covered = {w["pos"] for w in item if met[w["stop"]] - met[w["pos"]] == w["stop"] - w["pos"]}
    named = {w["pos"] for w in item if w["named"]}
    n, total = max(((len(covered & places), len(places)) for places in ({w["pos"] for w in item}, named) if places), key=lambda x: x[0] / x[1])
    slots = {(h["item_pos"] + s["at"], s["kind"], s["theirs"], s["mine"]) for h in hits for s in h["slots"]}
    values, times = defaultdict(set), defaultdict(int)
    for _, kind, theirs, mine in slots:
        values[kind, theirs].add(mine)
        times[kind, theirs] += 1
    consistent = sum(t for k, t in times.items() if len(values[k]) == 1)
    return {"n_windows": n, "n_consistent": consistent, "verbatim": all(a == b for _, _, a, b in slots), "n_item_windows": total, "coverage": n / total, "n_slots": len(slots)}


def spaced(text: Column) -> Column:
    """The words of a text in lower case, with single spaces."""
    return F.lower(F.array_join(F.filter(F.split(text, "[ \\t\\n\\x0b\\f\\r]+"), lambda w: w != ""), " "))


def few(key: str) -> Column:
    return (F.col(key) != "") & (F.size(F.split(key, " ")) < FEW_WORDS)


def line_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs (PAIRS) of documents with items of few words that are one of their lines, or their whole text."""
    lines = keyed(docs, "doc_id").select("id", "print", F.explode(F.concat(F.split("text", "\n"), F.array("text"))).alias("line"))
    lines = lines.select("id", "print", spaced(F.col("line")).alias("key")).filter(few("key")).distinct()
    met = lines.join(items.select(F.col("id").alias("item_id"), "key").distinct(), "key")
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return met.select(F.col("id").alias("doc_id"), "item_id", F.col("print").alias("doc_print"), one.alias("n_windows"), none.alias("n_consistent"),
                      F.lit(True).alias("verbatim"), one.alias("n_item_windows"), F.lit(1.0).alias("coverage"), none.alias("n_slots"))


def contaminated(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, min_consistent: float = MIN_CONSISTENT) -> DataFrame:
    """Pairs of a document and a benchmark item whose template it holds with consistent slots.

    Columns: doc_id, item_id, doc_print, n_windows and n_item_windows (distinct places in the item), coverage, n_slots, n_consistent, verbatim.
    """
    spread = benchmark.repartition("item_id")  # the table may be one small file
    told = stored(keyed(spread, "item_id").withColumn("key", spaced(F.col("text"))), "items")
    brief, told = told.filter(few("key")), told.filter(~F.coalesce(few("key"), F.lit(False)))
    items = stored(window_rows(told.drop("key")), "item-windows")
    own = items.select(F.col("id").alias("item_id"), F.col("print").alias("item_print"), "window", F.col("pos").alias("item_pos"), F.col("stop").alias("item_stop"), F.col("slots").alias("item_slots"))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect()) or [WINDOW]  # at most WINDOW numbers
    shared = Shared(docs, bloom_filter(own))
    hits = stored(window_rows(keyed(docs, "doc_id"), sizes, shared), "document-windows")
    slots = F.transform(F.arrays_zip(F.col("slots").alias("m"), F.col("item_slots").alias("t")), lambda s: F.struct(
        s["t"]["at"].alias("at"), s["t"]["kind"].alias("kind"), s["t"]["value"].alias("theirs"), s["m"]["value"].alias("mine")))
    group = ["doc_id", "doc_print", "item_id", "item_print"]
    met = hits.join(own, "window").select(
        F.col("id").alias("doc_id"), F.col("print").alias("doc_print"), "item_id", "item_print", F.struct("pos", "item_pos", "item_stop", slots.alias("slots")).alias("hit"))
    pairs = met.groupBy(*group).agg(F.collect_set("hit").alias("hits"))  # at most the windows of one text with one item
    windows_of = items.groupBy(F.col("id").alias("item_id"), F.col("print").alias("item_print")).agg(F.collect_set(F.struct("pos", "stop", "named")).alias("item"))
    joined = _null_safe(pairs, windows_of, ["item_id", "item_print"], "inner")
    names = [f.split()[0] for f in PAIRS.split(", ")]
    schema = to_arrow_schema(StructType.fromDDL(PAIRS))

    def judge(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 100):
                out = []
                for r in whole.slice(start, 100).to_pylist():
                    tried = [judged(c, r["item"]) for c in candidates(r["hits"], max(w["stop"] for w in r["item"]))]
                    good = [t for t in tried if t["coverage"] >= min_coverage and t["n_consistent"] >= min_consistent * t["n_slots"]]
                    if good:
                        out.append(max(good, key=lambda t: [t[m] for m in names[3:]]) | {k: r[k] for k in names[:3]})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    found = joined.select(*group, "hits", "item").mapInArrow(judge, PAIRS)
    if not brief.isEmpty():
        found = found.unionByName(line_pairs(docs, brief))
    # the same item id may stand with several texts
    best = found.groupBy("doc_id", "item_id", "doc_print").agg(F.max(F.struct(*names[3:])).alias("b"))
    return best.select("doc_id", "item_id", "doc_print", *[F.col(f"b.{m}").alias(m) for m in names[3:]])


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on: Column = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay."""
    bad = contaminated(docs, benchmark, **limits).select(F.col("doc_id").alias("__bad"), F.col("doc_print").alias("__print")).distinct()
    on = docs["doc_id"].cast("bigint").eqNullSafe(F.col("__bad")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("__print"))
    return docs.join(bad, on, "left_anti")

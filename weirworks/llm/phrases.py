"""Phrase collocations by Toivonen's sampling algorithm: exact counts of all frequent phrases of up to four words.

1. **Sample.** An eighth of the rows (by a hash of id, language and text) proposes phrases, length by length: those that the sample
   holds at least ``LOWERED`` times and whose parts it proposed before.
2. **Full pass.** Every phrase is counted whose two parts of one word less are both proposed: that is the proposal itself and
   its negative border, the phrases just outside it. All single words are counted, since an unseen word is on the border.
3. **Border failures** are phrases of the border that turn out frequent. A frequent phrase that no pass counted holds one. If
   they are few (at most ``FEW`` of their places per word of the table), a closing pass counts all phrases not counted before
   whose parts are frequent or not counted either; nothing can be missing then. If they are many, they join the proposal, and
   another full pass counts the border that grew by them, until a pass has few failures of fewer than four words or none. A failure
   of pass p has at least p words, so there are at most four passes. A frequent phrase has frequent parts, so by induction none
   is missed, and each phrase is counted in exactly one pass.

The proposal is a Bloom filter of fixed size (``BLOOM_BITS``): what it lets through wrongly is only counted without need, so
counts stay exact at any size. Phrases are counted in windows of some megabytes of text with integer keys; no row per
occurrence is made. A window's counts go into one row per bucket of phrases (by hash), Spark shuffles these rows, and
each bucket is added up by the phrases themselves.

Defined results: a NULL text is empty, a NULL language is ``und``; repeated rows count again; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from xxhash import xxh3_64_intdigest

from weirworks.llm.common import pieces, utf8
from weirworks.llm.pieces import Shared
from weirworks.session import stored

LONGEST, SUPPORT, KEPT, WITHIN = 4, 30, 2_000, 80
SAMPLE = 8  # one row of so many
LOWERED = 2  # of SUPPORT / SAMPLE = 3.75 expected at the limit: few frequent phrases are missed, and each miss is found again
BLOOM_BITS = 1 << 26
FEW = 1 / 8
WINDOW_BYTES = 4_000_000
MOST_BUCKETS, BUCKETS_PER_PARTITION = 4_096, 16
SALTS = 16

GAP = 0xFF  # between pieces; no byte of UTF-8
#: A-Z in lower case, tabs as spaces, the ends of pieces as GAP.
TO_PIECES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else GAP if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256))
#: One string per counted phrase: its words, ``END`` and the language. No word holds END, so the first one parts them.
COUNTS, END = "key string, c bigint", "\n"
#: Keys of a bucket in a window one after the other, their lengths and their counts (32-bit little-endian).
PACKED = "bucket int, keys binary, lengths binary, counts binary"


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wraps around)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def extended(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase with one more word."""
    return mixed(phrase * np.uint64(31) + word)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def start_hash(lang: bytes) -> np.uint64:
    return np.uint64(xxh3_64_intdigest(b"lang " + lang))


def places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(BLOOM_BITS - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(BLOOM_BITS - 1)).astype(np.int64)


class Filter:
    """Bits of a Bloom filter; ``None`` holds everything."""

    def __init__(self, bits: bytes | None):
        self.bits = None if bits is None else np.frombuffer(bits, np.uint64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(h), bool)
        return np.logical_and.reduce([(self.bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1 for p in places(h)])


_FILTERS: dict[str, Filter] = {}


def worker_filter(shared: Shared | None) -> Filter | None:
    if shared is None:
        return None
    if shared.id not in _FILTERS:
        if len(_FILTERS) >= 2:
            _FILTERS.pop(next(iter(_FILTERS)))
        _FILTERS[shared.id] = Filter(shared.value)
    return _FILTERS[shared.id]


@dataclass
class Level:
    """Phrases of one size in a window: where they start in the text (-1: no such phrase), their words, hashes and counts."""

    at: np.ndarray
    words: np.ndarray  # one row of word numbers per phrase
    hashes: np.ndarray
    counts: np.ndarray
    prefix: np.ndarray | None = None  # number of the phrase without its last word, one level below
    suffix: np.ndarray | None = None  # without its first word
    plain: np.ndarray | None = None  # first level only: hashes of the words alone


def numbered(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """The words of a text as numbers, and the words by number; 0 is the end of a piece."""
    spaced = np.frombuffer((bytes([GAP]) + raw.translate(TO_PIECES)).replace(bytes([GAP]), bytes([32, GAP, 32])), np.uint8)
    inside = spaced != 32
    turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    offsets = np.append(0, np.cumsum(turns[1::2] - turns[::2]))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(spaced[inside])]).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), words.dictionary.cast(pa.binary())


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct keys in order: a place of each and its count; and the number of each place's key. (``np.unique`` sorts stably for the first place.)"""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.append(True, ordered[1:] != ordered[:-1])[:len(keys)]
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(starts) - 1
    first = np.flatnonzero(starts)
    return order[first], inverse, np.diff(np.append(first, len(keys)))


def first_level(ids: np.ndarray, words: list[bytes], lang: bytes) -> Level:
    plain = word_hashes(words)
    hashes = extended(np.full(len(words), start_hash(lang)), plain)
    return Level(np.where(ids == 0, -1, ids), np.arange(len(words))[:, None], hashes, np.bincount(ids, minlength=len(words)), plain=plain)


def next_level(below: Level, words: Level, good: np.ndarray, fresh: np.ndarray | None = None) -> Level:
    """Phrases of one word more whose two parts are ``good``, and at least one of them ``fresh`` where that is given."""
    n = len(below.at) - 1
    held = np.append(good, False)[below.at]  # -1: the last, no phrase
    wanted = held[:-1] & held[1:]
    if fresh is not None:
        near = np.append(fresh, False)[below.at]
        wanted &= near[:-1] | near[1:]
    starts = np.flatnonzero(wanted) if n > 0 else np.zeros(0, np.int64)
    last = words.at[starts + below.words.shape[1]]
    key = below.at[starts].astype(np.int64) * len(words.counts) + last
    where, inverse, counts = grouped(key)
    found = key[where]
    at = np.full(max(n, 0), -1, np.int64)
    at[starts] = inverse
    prefix, word = found // len(words.counts), found % len(words.counts)
    return Level(at, np.column_stack([below.words[prefix], word]), extended(below.hashes[prefix], words.plain[word]), counts,
                 prefix=prefix, suffix=below.at[starts[where] + 1])


def joined(texts: pa.Array, words: list[np.ndarray]) -> pa.Array:
    """Phrases of the words with these numbers."""
    columns = [texts.take(pa.array(w)) for w in words]
    return columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, b" ")


Met = Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]


def bordered(raw: bytes, lang: bytes, gate: Filter, seen: Filter | None, sizes: range) -> Met:
    """(size, phrases, counts, hashes) of a window. Phrases whose parts were counted under ``seen`` and are held by it were counted by an earlier
    pass; of the longest ones, which are no parts, they are not even made."""
    ids, texts = numbered(raw)
    one = first_level(ids, texts.to_pylist(), lang)
    level, before = one, np.full(len(texts), seen is not None)  # which phrases of the level an earlier pass counted
    for size in range(1, sizes.stop):
        if size > 1:
            good = gate.holds(level.hashes)
            good_before = before & seen.holds(level.hashes) if seen else before  # a filter may hold a phrase that no pass has met
            fresh = good & ~good_before if seen and size == sizes.stop - 1 else None
            level = next_level(level, one, good, fresh)
            before = good_before[level.prefix] & good_before[level.suffix]
        if not len(level.counts):
            return
        if size in sizes:
            new = ~before
            if size == 1:
                new[0] = False
            if new.any():
                yield size, joined(texts, [level.words[new, i] for i in range(size)]), level.counts[new], level.hashes[new]


def counted_window(raw: bytes, lang: bytes, gate: Filter, seen: Filter | None, sizes: range) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """``bordered`` without the hashes."""
    for size, found, counts, _ in bordered(raw, lang, gate, seen, sizes):
        yield size, found, counts


def closed(raw: bytes, lang: bytes, known: Filter, seen: Filter, sizes: range) -> Met:
    """(size, phrases, counts, hashes) of a window: all phrases not counted under ``seen`` whose parts may be frequent. Those that were
    counted may be so if they are among the frequent ones, ``known``; the others if their own parts may be. Only the new ones are numbered."""
    ids, texts = numbered(raw)
    one = first_level(ids, texts.to_pylist(), lang)
    may = known.holds(one.hashes)
    may[0] = False  # no phrase goes over the end of a piece
    may, held, hashes = may[ids], seen.holds(one.hashes)[ids], one.hashes[ids]  # of the phrase that starts at a place
    for size in range(2, sizes.stop):
        at = np.flatnonzero(may[:-1] & may[1:])
        h = extended(hashes[at], one.plain[ids[at + size - 1]])
        old = held[at] & held[at + 1]
        new = at[~old]
        if size in sizes and len(new):
            phrase = ids[new]
            for k in range(1, size):
                where, phrase, counts = grouped(phrase * len(texts) + ids[new + k])
            yield size, joined(texts, [ids[new[where] + k] for k in range(size)]), counts, h[~old][where]
        old[old] = known.holds(h[old])
        may, held = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        may[new] = may[at[old]] = True
        held[at[old]] = seen.holds(h[old])
        hashes[at] = h


def packed(keys: pa.Array, counts: np.ndarray, bucket: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """One row per bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, keys, counts = bucket[order], keys.take(pa.array(order)), counts[order].astype(np.int32).tobytes()
    offsets = np.frombuffer(keys.buffers()[1], np.int64)[:len(keys) + 1]
    lengths, data = np.diff(offsets).astype(np.int32).tobytes(), keys.buffers()[2].to_pybytes()
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(starts[1:], len(bucket))
    cut = list(zip(starts.tolist(), ends.tolist()))
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[starts].astype(np.int32)), pa.array([data[offsets[i]:offsets[j]] for i, j in cut], pa.binary()),
        pa.array([lengths[4 * i:4 * j] for i, j in cut], pa.binary()), pa.array([counts[4 * i:4 * j] for i, j in cut], pa.binary())], schema=schema)


def added_up(rows: pa.Table, least: int) -> pa.Table:
    """(key, c) of a bucket: the sums of at least ``least``, and those of all words of a language."""
    data, lengths, counts = (b"".join(rows.column(c).to_pylist()) for c in ("keys", "lengths", "counts"))
    offsets = np.append(0, np.cumsum(np.frombuffer(lengths, np.int32), dtype=np.int64))
    keys = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    sums = pa.table({"key": keys, "c": np.frombuffer(counts, np.int32).astype(np.int64)}).group_by("key", use_threads=False).aggregate([("c", "sum")])
    sums = sums.filter(pc.or_(pc.greater_equal(sums["c_sum"], least), pc.starts_with(sums["key"], END)))
    return pa.table({"key": sums["key"].cast(pa.large_string()).cast(pa.string()), "c": sums["c_sum"]})


def buckets_of(partitions: int) -> int:
    """A power of two, so many that a bucket stays within some megabytes, and so few that a window's rows are not tiny."""
    return min(MOST_BUCKETS, 1 << (BUCKETS_PER_PARTITION * partitions - 1).bit_length())


def counted(docs: DataFrame, gate: Shared | None, seen: Shared | None, sizes: range, least: int, closing: bool = False) -> DataFrame:
    """(lang, size, phrase, c): exact counts, if at least ``least``, of the phrases of these sizes whose parts ``gate`` holds and ``seen`` doesn't,
    or of those due in the closing pass, where ``gate`` has the frequent ones. Row size 0: all words of the language. The buckets go to as many tasks
    as there are tasks of documents, so a task's share doesn't grow with the table."""
    partitions = max(1, docs.rdd.getNumPartitions())
    arrow, shift = to_arrow_schema(StructType.fromDDL(PACKED)), np.uint64(65 - buckets_of(partitions).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = worker_filter(gate) or Filter(None), worker_filter(seen)
        held: dict[bytes, list[bytes]] = {}
        size_held = 0

        def out() -> Iterator[pa.RecordBatch]:
            while held:  # one language at a time, so that little is held
                lang, texts = held.popitem()
                made, total = [], 0
                for size, found, counts, hashes in (closed if closing else bordered)(b"\n".join(texts), lang, *filters, sizes):
                    total += int(counts.sum()) if size == 1 else 0
                    made.append((pc.binary_join_element_wise(found, lang, END.encode()).cast(pa.large_binary()), counts, hashes >> shift))
                if total:
                    made.append((pa.array([END.encode() + lang], pa.large_binary()), np.array([total]), np.array([start_hash(lang)]) >> shift))
                if made:
                    keys, counts, bucket = map(list, zip(*made))
                    del made, found
                    yield packed(pa.concat_arrays(keys), np.concatenate(counts), np.concatenate(bucket).astype(np.uint16), arrow)

        for batch in pieces(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
                held.setdefault(lang.encode(), []).append(text)
                size_held += len(text)
                if size_held >= WINDOW_BYTES:
                    yield from out()
                    size_held = 0
        yield from out()

    sums = docs.mapInArrow(run, PACKED).repartition(partitions, "bucket").groupBy("bucket").applyInArrow(lambda rows: added_up(rows, least), COUNTS)
    phrase, end = F.substring_index("key", END, 1), F.locate(END, F.col("key"))
    size = F.when(end == 1, 0).otherwise(F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1)
    return sums.select(F.substr("key", end + 1).alias("lang"), size.alias("size"), phrase.alias("phrase"), "c")


def hashed(lang: list[str], phrase: list[str]) -> np.ndarray:
    """The hashes that ``counted_window`` gives these phrases."""
    out, known = np.empty(len(phrase), np.uint64), {}
    split = [p.encode().split(b" ") for p in phrase]
    sizes = np.array([len(s) for s in split], np.int64)
    starts = np.array([known.get(x) or known.setdefault(x, start_hash(x.encode())) for x in lang], np.uint64)
    for n in np.unique(sizes).tolist():
        mine = np.flatnonzero(sizes == n)
        h = starts[mine]
        for k in range(n):
            h = extended(h, word_hashes([split[i][k] for i in mine.tolist()]))
        out[mine] = h
    return out


def filter_of(phrases: DataFrame, before: bytes | None) -> bytes:
    """A Bloom filter of phrases on top of ``before``. Bits are OR-ed by Spark in 64-bit words: at most BLOOM_BITS / 64 rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = hashed(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            p = np.concatenate(places(h))
            mask = (np.uint64(1) << (p & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p >> 6), pa.array(mask)], names=["slot", "mask"])

    found = phrases.select("lang", "phrase").mapInArrow(run, "slot bigint, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(BLOOM_BITS // 64, np.uint64) if before is None else np.frombuffer(before, np.uint64).copy()
    bits[found.column("slot").to_numpy()] |= found.column("mask").to_numpy().view(np.uint64)
    return bits.tobytes()


def outside(phrases: DataFrame, gate: Shared) -> DataFrame:
    """The phrases that a filter doesn't hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~worker_filter(gate).holds(hashed(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()))))

    return phrases.mapInArrow(run, phrases.schema)


def proposal(sample: DataFrame, lowered: int, longest: int) -> bytes:
    """Filter of the phrases that the sample proposes, length by length; the longest ones are never parts."""
    bits = None
    for size in range(1, longest):
        gate = Shared(sample, bits) if bits is not None else None
        found = stored(counted(sample, gate, None, range(size, size + 1), lowered), "phrase-proposal")  # one Python worker per task at a time
        bits = filter_of(found.filter(F.col("size") == size), bits)
    return bits


def places_of(phrases: DataFrame) -> int:
    return int(phrases.agg(F.sum(F.col("c").cast("decimal(38,0)"))).first()[0])


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, one_in: int = SAMPLE, lowered: int = LOWERED) -> tuple[DataFrame, int]:
    """(lang, size, phrase, c) of all phrases found at least ``support`` times (size 0: all words of a language), and the number of full passes."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    told = [c for c in ("doc_id", "lang", "text") if c in docs.columns]
    chosen = docs.filter(F.pmod(F.xxhash64(*told), F.lit(one_in)) == 0)
    sample = stored(chosen.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"), "phrase-sample")
    bits = proposal(sample, lowered, longest)
    gate, seen, done = Shared(docs, bits), None, []
    while True:
        sizes = range(1 if seen is None else 2, longest + 1)
        found = stored(counted(texts, gate, seen, sizes, support), "phrase-counts")
        done.append(found)
        failures = stored(outside(found.filter(F.col("size").between(1, longest - 1)), gate), "phrase-failures")
        if failures.isEmpty():
            return reduce(DataFrame.unionByName, done), len(done)
        if places_of(failures) <= FEW * places_of(done[0].filter("size = 0")):
            known = filter_of(reduce(DataFrame.unionByName, done).filter(F.col("size").between(1, longest - 1)), None)
            done.append(stored(counted(texts, Shared(docs, known), gate, range(2, longest + 1), support, closing=True), "phrase-counts"))
            return reduce(DataFrame.unionByName, done), len(done)
        bits = filter_of(failures, bits)
        gate, seen = Shared(docs, bits), gate


def part(phrase: str, first: Column | int, n: Column | int) -> Column:
    """``n`` words of a phrase from word ``first`` (from 1) on."""
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def salted_parts(known: DataFrame, name: str) -> DataFrame:
    """Counts of parts once per salt: a part of very many phrases is joined in SALTS places. Spark takes an explode for as large as the compressed
    file below it, a hundredth of these rows' size, so it may not choose a broadcast."""
    parts = known.select("lang", F.col("phrase").alias(name), F.col("c").alias(f"c_{name}"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return parts.hint("merge")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, kept: int = KEPT, within: int = WITHIN,
                 one_in: int = SAMPLE, lowered: int = LOWERED) -> DataFrame:
    """The best phrases per language: ``lang``, ``rank``, ``phrase``, counts ``a`` (phrase), ``l`` and ``r`` (its parts at the weakest cut), ``n``, ``score``.

    A phrase goes if a longer one holds it and is found at least ``within`` percent as often.
    """
    found, _ = frequent_phrases(docs, support, longest, one_in, lowered)
    known = stored(found, "phrases")
    totals = known.filter("size = 0").select("lang", F.col("c").alias("n"))
    known = known.filter("size > 0")
    candidates = known.filter("size > 1").select("lang", "size", "phrase", F.col("c").alias("a"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))

    inner = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))")
    holders = candidates.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("held"))
    holders = holders.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    whole = F.coalesce(F.col("held").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * within, F.lit(True))
    rest = candidates.join(holders.hint("merge"), ["lang", "phrase"], "left").filter(whole).drop("held")  # exploded like salted_parts

    cuts = rest.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", part("phrase", F.lit(1), F.col("k")).alias("l"), part("phrase", F.col("k") + 1, F.col("size") - F.col("k")).alias("r"))
    both = cuts.join(salted_parts(known, "l"), ["lang", "l", "salt"]).join(salted_parts(known, "r"), ["lang", "r", "salt"])
    score = F.expr("cast(a * 2000000BD as decimal(38, 0)) div cast(cast(c_l as decimal(20, 0)) + c_r as decimal(38, 0))")
    weakest = both.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", F.col("c_l").alias("l"), F.col("c_r").alias("r"))).alias("cut"), F.first("a").alias("a"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = weakest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= kept)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


SQL = """
with t as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) as piece from t),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), x -> x <> '') as ws from p),
g as (
  select lang, s, unnest(list_transform(range(1, len(ws) - s + 2), i -> array_to_string(ws[i:i + s - 1], ' '))) as phrase
  from w, (values (1), (2), (3), (4)) v(s) where len(ws) >= s),
f as (select lang, s, phrase, count(*)::hugeint as c from g group by all),
n as (select lang, sum(c)::bigint as n from f where s = 1 group by 1),
k as (select *, string_split(phrase, ' ') as ws from f where c >= 30),
inside as (
  select lang, array_to_string(ws[i:i + m - 1], ' ') as phrase, max(c) as held
  from (select *, unnest(range(1, s - m + 2)) as i from (select *, unnest(range(2, s)) as m from k where s > 2)) group by 1, 2),
c as (select k.* from k left join inside i on i.lang = k.lang and i.phrase = k.phrase where k.s > 1 and (held is null or 100 * held < 80 * k.c)),
u as (select *, unnest(range(1, s)) as cut from c),
b as (
  select u.lang, u.phrase, u.c as a, u.cut, x.c as l, y.c as r, (2000000::hugeint * u.c) // (x.c + y.c) as score
  from u join f x on x.lang = u.lang and x.phrase = array_to_string(u.ws[1:u.cut], ' ')
         join f y on y.lang = u.lang and y.phrase = array_to_string(u.ws[u.cut + 1:], ' ')),
d as (select * from b qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
e as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from d)
select e.lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score from e join n on n.lang = e.lang where rank <= 2000
"""

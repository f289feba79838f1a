"""MinHash near-duplicates: universal minima, banding, verification, components by alternating stars.

1. Texts with equal shingle sets (a 128-bit digest of the set) are one class; the smallest doc_id stands for it.
2. 128 minima of multiply-shift hashes per class, 32 bands of 4: a pair of similarity 0.8 meets in no band
   with probability (1 - 0.8^4)^32 = 5e-8.
3. A bucket is never paired up. Its centre is the member that meets the most others over all bands (in a group
   of copies edited from one text: that text), and each member is paired with the centre: linear in the bucket.
4. Pairs pass the signatures (at least 80 of 128 equal minima; a pair at 0.8 fails with probability < 1e-6) and
   then the full sets: 100 * intersection >= 80 * union.
5. Components by alternating large-star and small-star. Buckets that still hold several components are finished
   exactly: members outside the bucket's largest component against the bucket's other components, filtered inside
   the join by 256 bits of the signatures (a pair at 0.8 fails with probability < 1e-6) and by an exact bound: the sets
   are folded to 2048 parity bits each, which differ in no more bits than the sets in elements. So copies of one text that
   were edited apart don't become pairs. What is left is confirmed as in 4. A last run of the stars gives the components.

Defined results: a text without words has an empty set and is linked with nothing; rows with a NULL id are
linked with nothing and kept; rows that repeat an id are one document. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from weirworks.llm.common import lower_words, map_rows, pieces, utf8
from weirworks.session import stored

SHINGLE, PERMUTATIONS, ROWS = 5, 128, 4
BANDS = PERMUTATIONS // ROWS
SURE = 80  # of 128 equal minima: five standard deviations below the mean at 0.8
FOLD = 2048
BITS_APART = 58  # of 256 sketch bits: 5.5 standard deviations above the mean at 0.8
PERCENT = 80
MAX_CACHED = 2_000_000  # shingles of centres kept by a worker

SKETCH = "doc_id bigint, n_shingles bigint, digest binary, signature binary, bits array<bigint>, fold array<bigint>"


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, an empty one none."""
    h = np.array([xxh64_intdigest(w) for w in lower_words(text)], np.uint64)
    if not len(h):
        return h
    n = min(size, len(h))
    mixed = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        mixed = (mixed ^ h[i:len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the multiply-shift family, from a fixed seed."""
    rng = np.random.default_rng(20240229)
    draw = rng.integers(0, 1 << 63, (2, PERMUTATIONS), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash over the set, 32 bits each."""
    out = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):  # bounded memory for very long texts
        part = shingles[start:start + 4096]
        for i in range(0, PERMUTATIONS, 16):
            at = slice(i, i + 16)
            np.minimum(out[at], (part * a[at, None] + b[at, None]).min(1), out=out[at])
    return (out >> np.uint64(32)).astype(np.uint32)


def parity_fold(shingles: np.ndarray) -> np.ndarray:
    """FOLD bits: whether an odd number of shingles falls on each. The folds of two sets differ in at most as many bits as the sets in elements."""
    odd = np.bincount((shingles & np.uint64(FOLD - 1)).astype(np.int64), minlength=FOLD) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, set size, digest of the set and signature of every row."""
    a, b = multipliers()

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        made: dict[str, object] = {"doc_id": batch.column("doc_id"), "n_shingles": [], "digest": [], "signature": [], "bits": [], "fold": []}
        for text in utf8(batch.column("text")):
            s = shingle_hashes(text, size)
            made["n_shingles"].append(len(s))
            made["digest"].append(xxh3_128_digest(s.tobytes()))
            m = minima(s, a, b)
            made["signature"].append(m.tobytes())
            made["bits"].append(np.packbits([m & 1, m >> 1 & 1]).view(np.int64))
            made["fold"].append(parity_fold(s))
        return made

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, SKETCH)


def band_keys(classes: DataFrame) -> DataFrame:
    """(key, doc) for each band of each class: the key is a hash of the band's number and minima."""
    wide = 4 * ROWS
    parts = [F.xxhash64(F.lit(i), F.substring("signature", i * wide + 1, wide)) for i in range(BANDS)]
    return classes.select("doc", F.explode(F.array(*parts)).alias("key"))


def numbers(column: str, name: str, n: int) -> list[Column]:
    """Elements of an array as plain columns: a join condition over these stays in small compiled code."""
    return [F.coalesce(F.col(column)[i], F.lit(0)).alias(f"{name}{i}") for i in range(n)]


def far_apart() -> Column:
    """Differing bits of the two short sketches: 2 bits of each minimum."""
    return sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(4)), F.lit(0))


def may_pass(percent: int) -> Column:
    """A bound that no passing pair breaks: the sets differ in (100 - percent) / (100 + percent) of their summed sizes at most."""
    apart = sum((F.bit_count(F.col(f"fa{i}").bitwiseXOR(F.col(f"fb{i}"))) for i in range(FOLD // 64)), F.lit(0))
    return apart * (100 + percent) <= (F.col("size_a") + F.col("size_b")) * (100 - percent)


def sure_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (doc, other) with signatures ``sa``, ``sb`` of which at least SURE minima are equal."""

    def keep(batches):
        for batch in pieces(batches, 5000):
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, PERMUTATIONS) for c in ("sa", "sb"))
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("other")], ["doc", "other"]).filter(pa.array((a == b).sum(1) >= SURE))

    return pairs.select("doc", "other", "sa", "sb").mapInArrow(keep, "doc bigint, other bigint")


def with_signatures(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    return pairs.join(signed.withColumnRenamed("signature", "sa"), "doc").join(signed.select(F.col("doc").alias("other"), F.col("signature").alias("sb")), "other")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets pass, computed from the texts. Texts of documents without a pair are not moved twice."""
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("id"), "text")
    needed = pairs.select(F.explode(F.array("doc", "other")).alias("id")).distinct()
    texts = stored(texts.join(needed, "id", "left_semi"), "pair-texts")

    def keep(batches):
        cache: OrderedDict[bytes, np.ndarray] = OrderedDict()  # centres recur in a partition
        held = 0
        for batch in pieces(batches, 200):
            good = []
            for mine, other in zip(utf8(batch.column("text")), utf8(batch.column("other_text"))):
                digest = xxh3_128_digest(other)
                if (b := cache.get(digest)) is None:
                    cache[digest] = b = shingle_hashes(other, size)
                    held += len(b)
                    while held > MAX_CACHED:
                        held -= len(cache.popitem(last=False)[1])
                a = shingle_hashes(mine, size)
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("other")], ["doc", "other"]).filter(pa.array(good, pa.bool_()))

    both = (
        pairs.join(texts.withColumnRenamed("id", "doc"), "doc")
        .join(texts.select(F.col("id").alias("other"), F.col("text").alias("other_text")), "other")
    )
    return both.select("doc", "other", "text", "other_text").mapInArrow(keep, "doc bigint, other bigint")


def largest_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows, itself included."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def smallest_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them. Edges run from large (u) to small (v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def is_star(edges: DataFrame) -> bool:
    """Each node has one root at most and no root has one itself."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(edges.select("v", F.lit(0), F.lit(1)))
    bad = ends.groupBy("n").agg(F.sum("child").alias("c"), F.max("root").alias("r")).filter("c > 1 or (c > 0 and r > 0)")
    return bad.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(doc, root) of every linked node that isn't its component's smallest. ``links``: (doc, other)."""
    edges = stored(links.filter("doc <> other").select(F.greatest("doc", "other").alias("u"), F.least("doc", "other").alias("v")).distinct(), "edges")
    while not is_star(edges):
        edges = stored(smallest_star(largest_star(edges)), "edges")
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("root"))


def rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "doc", "left").withColumn("root", F.coalesce("root", "doc"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row. ``percent`` from 80 up (the bands are set for it)."""
    if percent < 80:
        raise ValueError("bands and signatures are set for a similarity of at least 80 percent")
    sketch = stored(sketches(docs, size), "sketches")
    linked = sketch.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(linked.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.first("signature").alias("signature"), F.first("bits").alias("bits"), F.first("fold").alias("fold"), F.first("n_shingles").alias("size")), "classes")
    keys = band_keys(classes)
    shared = keys.groupBy("key").agg(F.count("doc").alias("n")).filter("n > 1")
    members = stored(keys.join(shared, "key"), "members")
    score = members.groupBy("doc").agg(F.sum("n").alias("score"))
    members = stored(members.join(score, "doc").select("key", "doc", "score"), "scored")
    centres = members.groupBy("key").agg(F.max(F.struct("score", -F.col("doc"))).alias("c")).select("key", (-F.col("c.col2")).alias("other"))
    signed = classes.select("doc", "signature")
    tried = stored(members.join(centres, "key").filter("doc <> other").select("doc", "other").distinct(), "tried")
    links = stored(confirmed(stored(sure_pairs(with_signatures(tried, signed)), "pairs"), docs, size, percent), "links")
    roots = components(links)

    # What the centres have not settled: buckets with several components.
    known = rooted(members.select("key", "doc"), roots)
    per_root = known.groupBy("key", "root").agg(F.count("doc").alias("n"))
    main = per_root.groupBy("key").agg(F.max(F.struct("n", "root")).alias("m"), F.count("root").alias("roots")).filter("roots > 1").select("key", F.col("m.root").alias("main"))
    mixed = stored(known.join(main, "key").join(classes.select("doc", "bits", "fold", "size"), "doc"), "mixed")
    outside = mixed.filter("root <> main").select("key", "doc", "root", *numbers("bits", "a", 4), *numbers("fold", "fa", FOLD // 64), F.col("size").alias("size_a"))
    others = mixed.select("key", F.col("doc").alias("other"), F.col("root").alias("other_root"), "main", *numbers("bits", "b", 4), *numbers("fold", "fb", FOLD // 64), F.col("size").alias("size_b"))
    rest = (
        outside.join(others, (outside["key"] == others["key"]) & (F.col("root") != F.col("other_root"))
                     & ((F.col("other_root") == F.col("main")) | (F.col("doc") < F.col("other"))) & (far_apart() <= BITS_APART) & may_pass(percent))
        .select(F.greatest("doc", "other").alias("doc"), F.least("doc", "other").alias("other")).distinct()
        .join(tried.select(F.greatest("doc", "other").alias("doc"), F.least("doc", "other").alias("other")), ["doc", "other"], "left_anti")
    )
    rest = stored(sure_pairs(with_signatures(rest, signed)), "rest")
    if not rest.isEmpty():
        more = stored(confirmed(rest, docs, size, percent), "more-links")
        roots = components(links.union(more))
    root = rooted(classes.select("digest", "doc"), roots).select("digest", "root")
    placed = linked.select("doc_id", "n_shingles", "digest").join(root, "digest").select("doc_id", "n_shingles", F.col("root").alias("component_id"))
    alone = sketch.filter("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document of each component; all columns stay. Of rows that repeat an id and a text, the least one stays."""
    gone = near_duplicates(docs, **settings).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    rows = docs.join(gone, docs["doc_id"].cast("bigint") == F.col("__gone"), "left_anti")
    told = F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))
    keyed = docs.filter("doc_id is not null").select(told.alias("__told"))
    repeated = stored(keyed.groupBy("__told").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__told"), "repeated-rows")
    if repeated.isEmpty():
        return rows
    rows = rows.withColumn("__told", told)
    once = rows.join(repeated, "__told", "left_semi").groupBy("__told", "text").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return rows.join(repeated, "__told", "left_anti").select(*docs.columns).unionByName(once.select("__row.*"))

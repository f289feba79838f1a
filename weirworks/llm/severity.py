"""Toxicity severity by cumulative-link ordinal regression.

Features of a text are its distinct lower-case words and their prefixes of four to six letters (inflected and invented forms share
them), hashed to SPACE numbers, with the number of times they occur. The model is P(grade > k) = sigmoid(w . x - t_k) with one
weight vector for all ordered thresholds t_1 < t_2 < ...; x is log(1 + times). It returns each text's expected grade.

Training: at most MAX_LABELLED labelled documents (a documented bound; those with the smallest hashes of their ids). Spark
counts the documents of each class that have a feature; the MAX_FEATURES with the largest likelihood ratios are kept, and the fit runs over
the sample reduced to them. Every document is scored over its whole text.

Grades: a label that is 0 or 1 has no degrees, so grade 0 is "not toxic", and labelled toxic texts get 1, 2, 3 by the
terciles of their evidence: occurrences of words with toxic features. Graded labels are taken as they are (``grade`` column).

Defined results: NULL and empty texts have no features and get the model's base rate; labels with a NULL id or grade are left out;
a document with several labels counts once with the largest; without labels of two grades every severity is 0; repeated
rows and NULL ids are scored each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirworks.llm.common import hash_limit, lower_words, map_rows, pieces, utf8
from weirworks.llm.pieces import Shared
from weirworks.session import stored

SPACE, MAX_LABELLED, MAX_FEATURES, GRADES = 1 << 20, 20_000, 2_048, 3
MIN_DOCUMENTS, MIN_Z = 3, 4.5
STEPS, RATE, RIDGE = 400, 0.05, 1e-3
MAX_CACHED = 200_000
EDGE = b".,;:!?()[]\"'"


class Features(dict):
    """Feature numbers of a word: itself and its prefixes of 4 to 6 letters."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= MAX_CACHED:
            self.clear()
        text = word.strip(EDGE).decode(errors="replace")
        names = {f"w{text}", *(f"p{text[:n]}" for n in (4, 5, 6) if len(text) >= n)} if text else set()
        found = self[word] = tuple(sorted(crc32(x.encode()) % SPACE for x in names))
        return found


def feature_times(text: bytes, known: Features) -> Counter:
    times: Counter = Counter()
    for word, n in Counter(lower_words(text)).items():
        for f in known[word]:
            times[f] += n
    return times


class Ordinal:
    """Weights over the kept features and ordered thresholds."""

    def __init__(self, features: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.place = {f: i for i, f in enumerate(features)}
        self.weights, self.thresholds = weights, thresholds

    def above(self, times: Counter) -> np.ndarray:
        """P(grade > k) for k = 0, 1, ..."""
        raw = sum((self.weights[i] * np.log1p(times[f]) for f in times.keys() & self.place.keys() for i in (self.place[f],)), 0.0)
        return sigmoid(raw - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[int, list[int], list[float]]], n_features: int, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the penalised log-likelihood; ``rows``: grade, feature places, values.

    Thresholds are t_1 and positive steps exp(s), so they stay ordered.
    """
    grade = np.array([g for g, _, _ in rows])
    sizes = np.array([len(p) for _, p, _ in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    place = np.concatenate([np.array(p, np.int64) for _, p, _ in rows]) if len(rows) else np.zeros(0, np.int64)
    value = np.concatenate([np.array(v) for _, _, v in rows]) if len(rows) else np.zeros(0)
    share = np.array([max((grade > k).mean(), 1e-4) for k in range(n_grades)])
    start = -np.log(share / (1 - np.minimum(share, 1 - 1e-4)))
    steps = np.log(np.maximum(np.diff(start), 1e-2))
    x = np.concatenate([np.zeros(n_features), start[:1], steps])
    first, second = np.zeros_like(x), np.zeros_like(x)
    at = np.arange(len(rows))
    for step in range(1, STEPS + 1):
        w, t = x[:n_features], np.cumsum(np.concatenate([x[n_features:n_features + 1], np.exp(x[n_features + 1:])]))
        raw = np.bincount(row, w[place] * value, len(rows))
        p = np.hstack([np.ones((len(rows), 1)), sigmoid(raw[:, None] - t), np.zeros((len(rows), 1))])  # P(grade >= k)
        here = np.maximum(p[at, grade] - p[at, grade + 1], 1e-9)
        slope = p * (1 - p)
        low, high = slope[at, grade] / here, slope[at, grade + 1] / here
        by_raw = low - high
        by_t = np.zeros(n_grades)
        for k in range(n_grades):  # threshold k stands between grades k and k + 1
            by_t[k] = high[grade == k].sum() - low[grade == k + 1].sum()
        tail = np.cumsum(by_t[::-1])[::-1]
        grad = np.concatenate([np.bincount(place, by_raw[row] * value, n_features) / len(rows) - RIDGE * w, tail[:1] / len(rows), tail[1:] * np.exp(x[n_features + 1:]) / len(rows)])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        x = x + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return x[:n_features], np.cumsum(np.concatenate([x[n_features:n_features + 1], np.exp(x[n_features + 1:])]))


def sample(labels: DataFrame, grade: str, limit: int) -> DataFrame:
    """(id, label) of at most ``limit`` labelled documents: those with the smallest hashes."""
    one = labels.filter(f"doc_id is not null and {grade} is not null").groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(F.max(grade).cast("int").alias("label"))
    hashed = one.withColumn("hash", F.xxhash64("id"))
    most = hash_limit(hashed, limit)
    return (hashed if most is None else hashed.filter(F.col("hash") <= most)).select("id", "label")


def counted(texts: DataFrame) -> DataFrame:
    """Documents with each feature, by class (toxic or not): summed up per partition first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = Features(), np.zeros((2, SPACE), np.int64)
        for batch in pieces(batches):
            for label, text in zip(batch.column("label").to_pylist(), utf8(batch.column("text"))):
                found[int(label > 0), list(feature_times(text, known))] += 1
        held = np.flatnonzero(found.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(found[0, held]), pa.array(found[1, held])], ["feature", "clean", "toxic"])

    return texts.select("label", "text").mapInArrow(run, "feature bigint, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def reduced(texts: DataFrame, features: list[int], telling: set[int]) -> DataFrame:
    """label, places and values of the kept features, and the evidence: occurrences of words with a telling feature."""
    shared = Shared(texts, (features, telling))

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        kept, strong = shared.value
        place, known = {f: i for i, f in enumerate(kept)}, Features()
        made: dict[str, object] = {"label": batch.column("label"), "places": [], "values": [], "evidence": []}
        for text in utf8(batch.column("text")):
            times = feature_times(text, known)
            held = sorted(place[f] for f in times.keys() & place.keys())
            made["places"].append(held)
            made["values"].append([float(np.log1p(times[kept[i]])) for i in held])
            made["evidence"].append(sum(n for word, n in Counter(lower_words(text)).items() if not strong.isdisjoint(known[word])))
        return made

    return map_rows(texts.select("label", "text"), make, "label int, places array<int>, values array<double>, evidence bigint")


def train(docs: DataFrame, labels: DataFrame, grade: str = "toxic", limit: int = MAX_LABELLED) -> Ordinal | None:
    """The model, or None where the sample has fewer than two grades."""
    chosen = sample(labels, grade, limit)  # at most ``limit`` ids: small enough to send to every worker
    held = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(F.broadcast(chosen), "id")
    texts = stored(held.groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text"), "labelled")  # repeated ids count once
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    total = [sum(n for g, n in sizes.items() if (g > 0) == t) for t in (False, True)]
    if not all(total):
        return None
    n, share = F.col("clean") + F.col("toxic"), total[1] / sum(total)
    part = lambda x, expected: F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)
    z = F.sqrt(F.greatest(F.lit(0.0), 2 * (part(F.col("toxic"), n * share) + part(F.col("clean"), n * (1 - share)))))  # likelihood ratio
    z = F.when(F.col("toxic") > n * share, z).otherwise(-z)
    best = counted(texts).filter(F.col("clean") + F.col("toxic") >= MIN_DOCUMENTS).select("feature", z.alias("z")).filter(F.abs("z") >= MIN_Z)
    kept = best.orderBy(F.desc(F.abs("z")), "feature").limit(MAX_FEATURES).collect()  # bounded
    features = [r["feature"] for r in kept]
    rows = reduced(texts, features, {r["feature"] for r in kept if r["z"] > 0}).collect()  # at most ``limit`` short rows
    if max(sizes) > 1:  # graded labels
        n_grades = max(sizes)
        graded = [(r["label"], r["places"], r["values"]) for r in rows]
    else:
        n_grades = GRADES
        seen = np.array([r["evidence"] for r in rows if r["label"]])
        cuts = np.quantile(seen, [i / GRADES for i in range(1, GRADES)])
        graded = [(1 + int((r["evidence"] > cuts).sum()) if r["label"] else 0, r["places"], r["values"]) for r in rows]
    weights, thresholds = fit(graded, len(features), n_grades)
    return Ordinal(features, weights, thresholds)


def severities(docs: DataFrame, model: Ordinal | None) -> DataFrame:
    """doc_id, expected_severity, grade (the likeliest), p_toxic, toxic of every row."""
    shared = Shared(docs, model)

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        now, known = shared.value, Features()
        made: dict[str, object] = {"doc_id": batch.column("doc_id"), "expected_severity": [], "grade": [], "p_toxic": []}
        for text in utf8(batch.column("text")):
            p = now.above(feature_times(text, known)) if now else np.zeros(1)
            made["expected_severity"].append(float(p.sum()))
            made["grade"].append(int(np.argmax(np.concatenate([[1], p]) - np.concatenate([p, [0]]))))
            made["p_toxic"].append(float(p[0]))
        return made

    scored = map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, "doc_id bigint, expected_severity double, grade int, p_toxic double")
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)

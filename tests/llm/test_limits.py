"""Limits of the text operators: no rise with the size, short items, repeated rows, long texts."""

from __future__ import annotations

import gc
import random
import time
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest

from conftest import sentence
from weirworks.llm import chat, common, hidden_markov, line_frequency, minhash, secret_scan, severity, templates


@pytest.mark.parametrize("size", [60, 5_000])
def test_frequent_lines_go_alike_on_small_and_large_hosts(spark, size):
    """Lines of 50 documents go and lines of 20 stay, whatever the host holds besides."""
    rng = random.Random(size)
    rows = [(i, sentence(rng, 12) + ("\nthis footer stands here" if i < 50 else "\nthat footer stands here" if i < 70 else ""), "h") for i in range(size + 20)]
    docs = spark.createDataFrame([*rows, rows[3], rows[3]], "doc_id bigint, text string, source string")
    got = {(r.doc_id, tuple(r.removed)) for r in line_frequency.line_frequency(docs).collect()}
    assert got == {(i, (1,) if 0 < i < 50 else ()) for i in range(size + 20)}


def test_items_of_few_words_need_a_line_of_their_own(spark):
    docs = spark.createDataFrame([(1, "well yes it is"), (2, "Yes"), (3, "one two\n  YES \nthree"), (4, None), (5, "yes sir or no"), (6, "")], "doc_id bigint, text string")
    items = spark.createDataFrame([(10, "yes"), (11, None), (12, "one  two"), (13, "")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in templates.contaminated(docs, items).collect()}
    assert found == {(2, 10), (3, 10), (3, 12)}
    assert sorted(r.doc_id for r in templates.decontaminate(docs, items).collect()) == [1, 4, 5, 6]


def test_label_sample_is_bounded_without_a_sort(spark):
    ids = spark.range(5_000).selectExpr("id", "xxhash64(id) as hash")
    for limit in (0, 1, 2, 100, 4_999, 5_000, 9_000):
        most = common.hash_limit(ids, limit)
        n = 5_000 if most is None else ids.filter(f"hash <= {most}").count()
        assert n == min(limit, 5_000)
    labels = spark.createDataFrame([(i % 40, i % 2) for i in range(400)], "doc_id bigint, toxic int")
    assert severity.sample(labels, "toxic", 10).count() == 10


def test_repeated_ids_are_fitted_once(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, 20) + (" vile awful nasty" * 3 if i % 2 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    once = spark.createDataFrame(rows, "doc_id bigint, text string")
    often = spark.createDataFrame([*rows, *[rows[1]] * 200], "doc_id bigint, text string")
    a, b = (severity.train(d, labels) for d in (once, often))
    assert (a is None) == (b is None) and (a is None or (a.place == b.place and abs(a.weights - b.weights).max() < 1e-6))


def test_one_row_of_repeated_documents_stays(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, "", "z"), (3, "", "z"), (None, "n", "q"), (None, "n", "q"), (4, None, "w"), (4, None, "v")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted((tuple(r) for r in minhash.drop_near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, "a b c d e f", "x"), (3, "", "z"), (None, "n", "q"), (None, "n", "q"), (4, None, "v")], key=str)
    plain = spark.createDataFrame(rows[2:4], docs.schema)
    assert minhash.drop_near_duplicates(plain).count() == 2


def best_of(n, run):
    times = []
    gc.collect()
    for _ in range(n):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return min(times)


def test_secret_scan_grows_with_the_text():
    """Twice the text takes no more than 2.5 times the time."""
    with open(secret_scan.VOCABULARY, "rb") as f:
        test = secret_scan.token_test(f.read(), secret_scan.MAX_RATIO)
    rng = random.Random(1)
    lines = ["%064x  file-%d.txt" % (rng.getrandbits(256), i) for i in range(32_000)]

    def scan(n):
        text = "\n".join(lines[:n])
        taken = secret_scan.patterns(text)
        return list(test.spans(text, taken))

    gc.disable()
    try:
        assert best_of(7, lambda: scan(32_000)) <= 2.5 * best_of(7, lambda: scan(16_000))
    finally:
        gc.enable()


def test_tokens_never_overlap_base_spans():
    with open(secret_scan.VOCABULARY, "rb") as f:
        test = secret_scan.token_test(f.read(), secret_scan.MAX_RATIO)
    text = "k=" + "q8Zk3vX9Lm2Rt7Wp5Ys1" + " " + "q8Zk3vX9Lm2Rt7Wp5Ys1Bd"
    assert [s[1:] for s in test.spans(text, [])] and not list(test.spans(text, [("hex", 0, 3), ("hex", 5, 6), ("hex", 30, 31), ("assign", 2, 4)]))


def test_long_texts_are_streamed_in_one_pass(spark):
    rows = [(1, 0, "user", "é😀x" * 500_000), (1, 1, "assistant", "ab\n" * 85 + "c" * 256 * 3), (2, 0, "assistant", ""), (2, None, "user", None)]

    def run(n):
        cut = [(c, t, r, x[:n] if x else x) for c, t, r, x in rows]
        return chat.summaries(chat.format_conversations(spark.createDataFrame(cut, "conv_id bigint, turn bigint, role string, text string"))).collect()

    got = {r.conv_id: r for r in run(1_500_000)}
    assert got[1].n_turns == 2 and got[1].loss_chars == 255 + 768 and got[2].n_turns == 2 and got[2].loss_chars == 0
    assert best_of(1, lambda: run(1_400_000)) <= 2.5 * max(best_of(2, lambda: run(700_000)), 1.0)


def test_head_of_frequent_words_never_empties(spark):
    counts = spark.createDataFrame([(f"w{i}", 1, 0) for i in range(300)] + [("top", 5, 37)], "word string, c long, bucket int")
    for limit in (1, 200, 301, 500):
        head = hidden_markov.frequent_words(counts, limit)
        assert len(head) == min(limit, 301) and head[0] == ("top", 5) and len({w for w, _ in head}) == len(head)


def plain_baum_welch(training, shares, rounds):
    """Expected counts token by token over whole texts."""
    m = hidden_markov.Model.start(shares)
    first, move, emit = m.first, m.move, m.emit
    for _ in range(rounds):
        a, b, c = np.zeros_like(first), np.zeros_like(move), np.zeros_like(emit)
        for text in training:
            forward = [first * emit[:, text[0]]]
            for x in text[1:]:
                forward.append((forward[-1] @ move) * emit[:, x])
            backward = [np.ones(len(first))]
            for x in reversed(text[1:]):
                backward.insert(0, move @ (emit[:, x] * backward[0]))
            total = forward[-1].sum()
            for t, x in enumerate(text):
                share = forward[t] * backward[t] / total
                c[:, x] += share
                a += share if t == 0 else 0
                if t:
                    b += np.outer(forward[t - 1], emit[:, x] * backward[t]) * move / total
        first, move, emit = a + hidden_markov.SMOOTH, b + hidden_markov.SMOOTH, c + 1 / len(first)
        first, move, emit = first / first.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)
    return first, move, emit


def test_scores_equal_a_plain_model_over_words(spark):
    """The query's score on a small corpus: Baum-Welch and the forward recursion by loops, every word its own emission, unseen words by their shared unit."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["aa", "bb", "cc dd", "dd", "ee ff gg"], k=rng.randint(0, 12))) + (" new" if i % 5 == 0 else "")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = lambda i: crc32(str(i).encode()) % 7 == 2
    texts = {i: [*t.split(), ""] for i, t in rows}
    counts = Counter(w for i, ws in texts.items() if not held(i) for w in ws)
    order = {w: k for k, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}
    mass = np.concatenate([[c + 1 for _, c in sorted(counts.items(), key=lambda x: (-x[1], x[0]))], np.ones(hidden_markov.CLASSES)])
    number = lambda w: order[w] if w in order else len(order) + crc32(w.encode()) % hidden_markov.CLASSES
    first, move, emit = plain_baum_welch([[number(w) for w in ws] for i, ws in texts.items() if not held(i)], mass / mass.sum(), 2)
    assert np.allclose(emit.sum(1), 1)
    for r in hidden_markov.language_model_scores(docs, rounds=2).collect():
        state, score = first, 0.0
        for k, w in enumerate(texts[r.doc_id]):
            state = (state if k == 0 else state @ move) * emit[:, number(w)]
            score += log10(state.sum())
            state = state / state.sum()
        assert abs(score - r.score) < 1e-6 * max(1, abs(score)), (r.doc_id, score, r.score)

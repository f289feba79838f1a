"""License scans: fuzzy search of short notices by exact seeds and bounded-error verification.

Texts are lower-cased (A-Z) and reduced to their words, joined by single spaces. A notice of L characters may differ in
k = L // 10 edits (none below 12 characters). It is split into k + 1 seeds; by the pigeonhole principle every occurrence with at most k
edits holds one of them unchanged. An Aho-Corasick automaton finds the seeds of all notices in one pass; each hit gives a
window of L + 2k characters in which the regex library's bounded-error matching looks for the notice between word ends. Of matches that
overlap, the one with the fewest edits stays (then the longer, then the earlier, then the first notice); matches without edits are then
confirmed as places of a base phrase where the notice is one.

A window's verdict depends on its characters alone, so a bounded cache answers for passages that repeat.

Spans are code points of the original text, end exclusive. Defined results: a NULL text is empty: no words, no places, empty labels, score 0;
repeated rows and NULL ids are scanned like any other row; empty tables give empty tables.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from weirworks.llm.common import map_rows

#: Base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Further notices and their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("gnu general public license", "gpl"),
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "boost"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("bsd 2 clause license", "bsd-2"),
    ("bsd 3 clause license", "bsd-3"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution", "cc-by"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("creative commons zero", "cc0"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("all rights reserved", "reserved"),
)
SHORTEST, PER_EDIT = 12, 10
MAX_CACHED = 100_000

#: Bytes of ASCII that are no part of a word become spaces, capitals small letters; all bytes above are parts of words.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def allowed(notice: str) -> int:
    return len(notice) // PER_EDIT if len(notice) >= SHORTEST else 0


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` parts of nearly equal length with their offsets."""
    n = edits + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Match:
    """Of notice number ``notice`` at [start, end) of the padded words."""

    start: int
    end: int
    notice: int
    edits: int


class Scanner:
    def __init__(self, base: Sequence[tuple[str, str]], more: Sequence[tuple[str, str]]):
        import ahocorasick
        import regex

        self.phrases, self.labels = zip(*base, *more)
        self.n_base = len(base)
        self.edits = [allowed(p) for p in self.phrases]
        hits: dict[str, list[tuple[int, int]]] = {}
        for i, p in enumerate(self.phrases):
            for offset, seed in seeds(p, self.edits[i]):
                hits.setdefault(seed, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for seed, places in hits.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()
        self.patterns = [regex.compile(f"(?<= )(?:{regex.escape(p)}){{e<={k}}}(?= )", regex.BESTMATCH) for p, k in zip(self.phrases, self.edits)]
        self.cache: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def verified(self, padded: str, notice: int, start: int) -> Match | None:
        """The best match in the window of an occurrence whose seed says ``start``; one more character each side shows the word ends."""
        k = self.edits[notice]
        lo = max(0, start - k - 1)
        window = padded[lo:start + len(self.phrases[notice]) + k + 1]
        key = notice, window
        if key not in self.cache:
            if len(self.cache) >= MAX_CACHED:
                self.cache.clear()
            m = self.patterns[notice].search(window)
            self.cache[key] = (*m.span(), sum(m.fuzzy_counts)) if m else None
        found = self.cache[key]
        return found and Match(lo + found[0], lo + found[1], notice, found[2])

    def candidates(self, padded: str) -> set[tuple[int, int]]:
        """(notice, start that a seed implies)."""
        found = set()
        for last, (length, places) in self.seeds.iter(padded):
            for notice, offset in places:
                found.add((notice, last + 1 - length - offset))
        return found

    def matches(self, padded: str) -> tuple[list[Match], list[Match]]:
        """All verified matches, and the places of base phrases among the candidates."""
        found, exact = set(), []
        for notice, start in self.candidates(padded):
            if (m := self.verified(padded, notice, start)) is not None:
                found.add(m)
                p = self.phrases[notice]  # a window's best match may lie elsewhere in it: the seed's own place counts
                if notice < self.n_base and start > 0 and padded.startswith(f" {p} ", start - 1):
                    exact.append(Match(start, start + len(p), notice, 0))
        return list(found), sorted(exact, key=lambda m: (m.start, m.notice))


def best(found: list[Match]) -> list[Match]:
    """Matches that don't overlap: the fewest edits first, then the longest, the earliest, the first notice."""
    starts: list[int] = []
    ends: list[int] = []
    taken: list[Match] = []
    for m in sorted(found, key=lambda m: (m.edits, m.start - m.end, m.start, m.notice)):
        i = bisect_right(starts, m.start)
        if (i and ends[i - 1] > m.start) or (i < len(starts) and starts[i] < m.end):
            continue
        starts.insert(i, m.start)
        ends.insert(i, m.end)
        taken.insert(i, m)
    return taken


@lru_cache(maxsize=2)
def scanner(base: tuple, more: tuple) -> Scanner:
    return Scanner(base, more)


def spelled(text: str) -> tuple[list[bytes], str]:
    """The words, and the words joined and padded by single spaces."""
    found = text.encode().translate(TO_WORDS).split(b" ") if text else []
    found = [w for w in found if w]
    return found, f" {b' '.join(found).decode()} "


def report(s: Scanner, text: str) -> dict[str, object]:
    found, padded = spelled(text)
    verified, exact = s.matches(padded)
    kept = best(verified)
    base = sorted({s.labels[m.notice] for m in exact})
    spans = []
    if kept:
        places = [m.span() for m in WORD.finditer(text)]
        first, at = 0, 0  # words before the padded position
        for m in kept:
            first += padded.count(" ", at, m.start)
            at = m.start
            last = first + padded.count(" ", m.start, m.end)
            spans.append(f"{s.labels[m.notice]}:{places[first - 1][0]}:{places[last - 1][1]}:{m.edits}")
    scores = [1 - m.edits / len(s.phrases[m.notice]) for m in kept] + [1.0 for _ in exact[:1]]
    number = lambda m: padded.count(" ", 0, m.start) - 1
    return {
        "n_words": len(found), "n_base": len(exact), "first_word": number(exact[0]) if exact else None, "last_word": number(exact[-1]) if exact else None,
        "base_labels": ",".join(base), "labels": ",".join(sorted({*base, *(s.labels[m.notice] for m in kept)})), "score": max(scores, default=0.0),
        "spans": ",".join(spans)}


def scan(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE, more: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """Per document: word count, places and labels of base phrases, all labels, the best score, and spans as label:start:end:edits."""
    base, more = tuple(map(tuple, base)), tuple(map(tuple, more))

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        s = scanner(base, more)
        found = [report(s, t or "") for t in batch.column("text").to_pylist()]
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
        return {"doc_id": batch.column("doc_id")} | {c: [r[c] for r in found] for c in names}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), make, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
                    " base_labels string, labels string, score double, spans string")

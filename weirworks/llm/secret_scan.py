"""Secret scans: three fixed patterns, and a token-efficiency test for the rest.

The test takes runs of ``[A-Za-z0-9+/_=-]`` of 20 or more characters outside the matches of the
patterns. Prose and identifiers need few tokens of a byte-pair vocabulary, random strings many:
a run with less than ``max_ratio`` characters per token is reported as ``token``. Known digests
(hexadecimal runs of usual digest lengths), UUIDs and identifiers are left out first. An identifier has only words and short numbers as
parts; a word needs few tokens itself, or clearly few in lower case after a space, so no string is a word by its shape alone.

Spans are code points, end exclusive, over whole texts. Defined results: a NULL text is empty and
has no spans; repeated rows and NULL ids are scanned like any other row.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirworks.llm.common import map_rows

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that goes with this vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_RATIO, MIN_LENGTH = 2.0, 20
CLEARLY = 1.5  # times the ratio, for a word that is only one in another case

#: Patterns and shortest lengths by kind, in the order of the kinds.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # runs are maximal: the same as matches of [A-Z0-9]+ with 18 or more characters
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "token")

RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}")
UUID = re.compile(r"(?i:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
HEX_RUN = re.compile(r"(?i:[0-9a-f]+)")
PART = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,4}")
CUT = re.compile(r"[+/_=-]+")

Span = tuple[str, int, int]


def known(run: str, is_word: Callable[[str], bool]) -> bool:
    """Digests of usual lengths, UUIDs, and identifiers whose parts are words or short numbers."""
    bare = run.strip("=-_/+")
    if UUID.fullmatch(bare) or (len(bare) in DIGEST_LENGTHS and HEX_RUN.fullmatch(bare)):
        return True
    parts = [p for p in CUT.split(bare) if p]
    # camelCase counts as words where the pieces are long enough: random strings change case at almost every letter
    return all(len(words := PART.findall(p)) and sum(map(len, words)) == len(p) and len(p) >= 4 * len(words) - 3 and all(w.isdigit() or is_word(w) for w in words) for p in parts)


def patterns(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind. A match of ``assign`` with a short value is dropped after it took its text."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered(spans))


class TokenTest:
    """Characters per token under a byte-pair vocabulary given as its rank file's bytes."""

    def __init__(self, ranks: bytes, max_ratio: float):
        import tiktoken

        self.max_ratio = max_ratio
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("scan", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})

    def is_word(self, part: str) -> bool:
        tokens = self.encoding.encode_ordinary
        return len(part) >= self.max_ratio * len(tokens(part)) or len(part) >= CLEARLY * self.max_ratio * len(tokens(" " + part.lower()))

    def spans(self, text: str, taken: list[Span]) -> Iterator[Span]:
        starts, ends = [], []  # of the spans taken, by start; ends: the greatest so far
        for s, e in sorted((s, e) for _, s, e in taken):
            starts.append(s)
            ends.append(max(e, ends[-1]) if ends else e)
        for m in RUN.finditer(text):
            a, b = m.span()
            before = bisect_left(starts, b)
            if (before and ends[before - 1] > a) or known(run := m.group(), self.is_word):
                continue
            if len(run) < self.max_ratio * len(self.encoding.encode_ordinary(run)):
                yield "token", a, b


@lru_cache(maxsize=2)
def token_test(ranks: bytes, max_ratio: float) -> TokenTest:
    return TokenTest(ranks, max_ratio)


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO) -> DataFrame:
    """doc_id with ``found``: all spans as (kind, start, end), in order. The vocabulary (a fixed file) is read once by the driver."""
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def make(batch: pa.RecordBatch) -> dict[str, object]:
        test, found = token_test(ranks.value, max_ratio), []
        for text in batch.column("text").to_pylist():
            base = patterns(text or "")
            found.append([dict(zip(("kind", "start", "end"), s)) for s in ordered(base + list(test.spans(text or "", base)))])
        return {"doc_id": batch.column("doc_id"), "found": found}

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make,
                    "doc_id bigint, found array<struct<kind: string, start: bigint, end: bigint>>")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans and the text of all spans."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["kind"] != "token")
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    counts = [of(k).alias(f"n_{k}") for k in KINDS]
    return scanned.select("doc_id", *counts, F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("found")).alias("spans"))


def redact(docs: DataFrame, vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO, mask: str = "<SECRET>") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask`` (touching or overlapping spans by one); ``n_chars`` follows, other columns stay."""
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            test, texts = token_test(ranks.value, max_ratio), []
            at = batch.schema.get_field_index("text")
            chars = batch.schema.get_field_index("n_chars")
            counts = batch.column(chars).to_pylist() if chars >= 0 else None
            for i, text in enumerate(batch.column(at).to_pylist()):
                spans = ordered((base := patterns(text)) + list(test.spans(text, base))) if text else []
                if spans:
                    out, upto = [], 0
                    for _, a, b in spans:
                        if a > upto or not out:
                            out += [text[upto:a], mask]
                        upto = max(upto, b)
                    text = "".join([*out, text[upto:]])
                    if counts:
                        counts[i] = len(text)
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if counts:
                columns[chars] = pa.array(counts, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)

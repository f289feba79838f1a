"""Quality rules: cross-document line frequency.

One pass over the texts makes a narrow profile (base counts, one hash per line). Lines are
counted per host over distinct documents (ids). A line found in more than ``min_documents``
documents is above the limit, however large the host is; it is removed from every document but the
first (smallest doc_id) of the host that holds it, so no text leaves the corpus altogether. A
document left with less than ``min_left`` of its words is depleted.

Defined results: NULL and empty texts have no words and fail the base rule; a NULL host is a host
of its own; rows without an id are documents by their text and never the first holder; repeated rows are one document and judged each.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from weirworks.llm.common import SPACE, map_rows, utf8, words
from weirworks.session import stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_DOCUMENTS, MIN_LEFT, SALTS = 20, 0.3, 16

PROFILE = ("doc_id bigint, host string, print bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
           " n_repeat_words bigint, lines array<struct<pos: int, line: bigint, words: int>>")


def repeated_words(found: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more in the text, the first occurrence included."""
    windows = list(zip(*[found[i:] for i in range(WINDOW)]))
    if len(set(windows)) == len(windows):
        return 0
    times, covered, upto = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + WINDOW - max(i, upto)
            upto = i + WINDOW
    return covered


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _profile(batch: pa.RecordBatch) -> dict[str, object]:
    made: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines")}
    for text in utf8(batch.column("text")):
        found = words(text)
        made["n_words"].append(len(found))
        made["word_chars"].append(len(text.translate(None, SPACE).decode()))
        made["n_symbols"].append(len(text) - len(text.translate(None, SYMBOLS)))
        made["n_repeat_words"].append(repeated_words(found))
        full, lines = [], []
        for pos, line in enumerate(text.split(b"\n")):
            if held := line.lower().split():
                full.append(line)
                lines.append({"pos": pos, "line": signed(xxh64_intdigest(b" ".join(held))), "words": len(held)})
        made["n_dup_lines"].append(len(full) - len(set(full)))
        made["lines"].append(lines)
    return made | {c: batch.column(c) for c in ("doc_id", "host", "print")}


def keyed(docs: DataFrame) -> DataFrame:
    """The identity of a row for this operator: id, host and a hash of the text."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"), "text")


def line_frequency(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per document row: base counts, ``base_failed``, ``removed`` (positions of removed lines), ``kept``."""
    profile = stored(map_rows(keyed(docs), _profile, PROFILE).withColumn("row", F.monotonically_increasing_id()), "line-profile")
    lines = profile.select("row", "doc_id", "host", "print", F.explode("lines").alias("l")).select(
        "row", "doc_id", "host", "print", "l.line", "l.pos", "l.words")
    nameless = F.when(F.col("doc_id").isNull(), F.col("print")).alias("nameless")
    frequent = (
        lines.groupBy("host", "line", "doc_id", nameless).agg(F.lit(1).alias("one"))
        .groupBy("host", "line").agg(F.count("one").alias("n"), F.min("doc_id").alias("first"))
        .filter(F.col("n") > min_documents)
        .select("host", "line", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    # A line may be in a third of all documents: the few frequent lines are repeated per salt, the rows are spread over salts.
    removed = (
        lines.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        .join(frequent, ["host", "line", "salt"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("row").agg(F.sum("words").alias("lost"), F.sort_array(F.collect_list("pos")).alias("removed"))  # at most the lines of one text
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    lost = F.coalesce(F.col("lost"), F.lit(0)).cast("bigint")
    return (
        profile.drop("lines").join(removed, "row", "left")
        .withColumns({"base_failed": failed, "n_removed_words": lost, "removed": F.coalesce("removed", F.array().cast("array<int>"))})
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= F.lit(min_left) * F.col("n_words")))
        .drop("row", "lost")
    )


def clean_lines(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` without rejected rows, their removed lines taken out of ``text`` (``n_chars`` follows); other columns stay."""
    kept = line_frequency(docs, **limits).filter("kept").groupBy("doc_id", "host", "print").agg(F.first("removed").alias("removed"))
    kept = kept.select(F.struct("doc_id", "host", "print").alias("__key"), F.col("removed").alias("__removed"))
    key = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))
    rows = docs.withColumn("__key", key)
    left = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("__removed", i)), "\n")
    text = F.when(F.size("__removed") > 0, left).otherwise(F.col("text"))
    joined = rows.join(kept, "__key").withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.size("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)


SQL = r"""
with d as (select *, row_number() over () as r, coalesce(source, '') as host from documents),
w as (select r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from d),
pos as (select r, unnest(range(1, len(ws) - 3)) as i, ws from w where len(ws) >= 5),
win as (select r, i, array_to_string(ws[i:i + 4], ' ') as g from pos),
rep as (select r, i from (select r, i, count(*) over (partition by r, g) as c from win) where c > 1),
cov as (select r, count(distinct j) as n from (select r, unnest(range(i, i + 5)) as j from rep) group by r),
raw as (select r, host, doc_id, text, unnest(string_split(text, chr(10))) as line from d),
lw as (select r, host, doc_id, text, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from raw),
lines as (select r, host, doc_id, text, line, array_to_string(ws, ' ') as norm, len(ws) as n from lw where len(ws) > 0),
dup as (select r, count(*) - count(distinct line) as n from lines group by r),
freq as (select host, norm, min(doc_id) as first from lines group by host, norm having count(distinct doc_id) + count(distinct text) filter (doc_id is null) > 20),
lost as (select r, sum(n) as n from lines l join freq f on l.host = f.host and l.norm = f.norm and l.doc_id is distinct from f.first group by r),
b as (select d.doc_id, len(ws)::bigint as n_words, length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
             length(coalesce(text, ''))::bigint - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))::bigint as n_symbols,
             coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(cov.n, 0)::bigint as n_repeat_words, coalesce(lost.n, 0)::bigint as n_removed_words
      from d join w using (r) left join cov using (r) left join dup using (r) left join lost using (r))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words - n_removed_words >= 0.3 * n_words as kept
from b
"""

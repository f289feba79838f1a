"""WARC archives, chat formatting and the pipeline."""

from __future__ import annotations

import base64
import hashlib

import duckdb
import pytest
from check_queries import compare

import corpus_pipeline
from weirworks.llm import chat, warc
from weirworks.llm.queries import QUERIES
from weirworks.session import scratch_dir

PAGES = [(1, "http://a.b.com/x", "hi"), (2, "http://a.b.com/x", "hi"), (2, "http://a.b.com/x", "hi"), (None, None, None), (5, "ü ://[x", ""), (6, "http://[::1", "hi"),
         (7, "http://c.com:80/ü?q=1 2#f\r\nX: y", ""), (None, "z", "only"), (8, "https://b.com/", "größe\r\n\r\nWARC/1.1"), (-9, "https://b.com/", "größe\r\n\r\nWARC/1.1"), (10, "q", "x" * 300_000)]
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def brute(rows):
    largest: dict[bytes, int] = {}
    for p, _, h in rows:
        if p is not None:
            h = (h or "").encode()
            largest[h] = max(largest.get(h, p), p)
    out = []
    for p, _, h in rows:
        h = (h or "").encode()
        again = h in largest and p != largest[h]
        out.append((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if again else "response", largest[h] if again else None))
    return sorted(out, key=repr)


def taken(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_archives(spark, sf, monkeypatch):
    assert taken(QUERIES["op7_warc_capture_index"](spark, sf)) == brute(duckdb.sql(f"select page_id, url, html from '{sf}/pages.parquet'").fetchall())
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    pages = spark.createDataFrame([(*r, "x", "y") for r in PAGES * 2], "page_id bigint, url string, html string, key string, digest string")
    assert taken(warc.archive_round_trip(pages)) == brute(PAGES * 2)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_lookup_finds_only_what_is_there(spark):
    folder = scratch_dir(spark, "warc-test")
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org/p{i}", f"text {i % 5}") for i in range(300)], "page_id bigint, url string, html string")
    index = warc.build_index(warc.write_archives(pages, f"{folder}/a"), f"{folder}/i", 5)
    asked = spark.createDataFrame([(7, "http://h1.org/p7"), (7, "http://h1.org/p8"), (10**6, "zzz"), (None, None), (-1, "")], "page_id bigint, url string")
    assert [(r.page_id, r.url) for r in warc.lookup(asked, index).collect()] == [(7, "http://h1.org/p7")]


def test_reversed_hosts_sort_together():
    assert warc.reversed_host("https://Blog.Example.com:8080/a/b?c=d#e") == "com,example,blog:8080)/a/b?c=d"
    assert warc.capture_key("http://a.com/", -5) < warc.capture_key("http://a.com/", 3) and warc.capture_key("", None) < warc.capture_key("", -(1 << 63))


CONVERSATIONS = [
    (1, 0, "system", None), (1, 1, "user", "a\\b <|im_end|> [INST] \\<s>\n"), (1, 2, "assistant", "é" * 600 + "</s><<SYS>>"), (1, 2, "assistant", "tie"), (1, 2, "assistant", "tie"),
    (2, None, "user", ""), (2, 5, None, "no role"), (None, 0, "assistant", "no id"), (3, 0, "us\ner<|im_start|>", "odd role\\"), (4, 1, "assistant", ""), (5, 0, "user", "only the user"),
]


def test_chat_on_odd_rows(spark):
    rows = spark.createDataFrame([(*r, "x", 1) for r in CONVERSATIONS], "conv_id bigint, turn bigint, role string, text string, message string, seq int")
    con = duckdb.connect()
    con.register("conversations", rows.toArrow())
    extra = spark.createDataFrame([(-7, 0, "user", chat.EXTRA), (-7, 1, "assistant", chat.EXTRA)], "conv_id bigint, turn bigint, role string, text string")
    got = chat.summaries(chat.format_conversations(rows.select("conv_id", "turn", "role", "text").union(extra))).filter("conv_id is null or conv_id <> 3")
    # a line break in a role takes one more character, which the SQL does not count: conversation 3 is tested below
    verdict = compare(got, con, f"select * from ({chat.SQL}) where conv_id is distinct from 3")
    assert verdict.startswith("OK"), verdict
    assert chat.summaries(chat.format_conversations(rows.limit(0))).count() == 0


@pytest.mark.parametrize("text", [t for *_, t in CONVERSATIONS if t is not None] + ["\\", "\\\\<s>", "<\\s>", "<<s>SYS>>", "[[INST]]", "<|im_start|><|im_end|>\n"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and not chat.ANY_CONTROL.search(chat.escape(text))
    for role in ("user", "assistant", "odd\nrole\\", ""):
        segment, a, b = chat.render(role, text)
        assert chat.parse(segment) == (role, text)
        assert a is None or chat.unescape(segment[a:b]) == text


def test_fold_of_edits_and_regenerations(spark):
    log = [
        (1, 1, 0, "open", "user", None), (1, 1, 1, "delta", None, "helo"), (1, 2, 5, "open", "assistant", None), (1, 2, 6, "delta", None, "wrong "), (1, 2, 7, "delta", None, "answer"),
        (1, 2, 8, "regenerate", None, None), (1, 2, 9, "delta", None, "right "), (1, 2, 10, "delta", None, "answer"), (1, 1, 11, "edit", None, "hello"), (1, 1, 12, "delta", None, "!"), (1, 2, 13, "close", None, None),
    ]
    got = chat.fold(spark.createDataFrame(log[::-1], chat.EVENTS)).orderBy("message").collect()
    assert [chat.parse(r.segment) for r in got] == [("user", "hello!"), ("assistant", "right answer")]
    assert got[1].segment[got[1].mask_start:got[1].mask_end] == "right answer" and got[0].mask_start is None


def test_pipeline(spark, sf, edge_docs):
    docs, base = spark.read.parquet(f"{sf}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf)
        if name != "pieces":
            assert docs.columns == before.columns
        docs = docs.cache()
        base = base or before
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
    assert 0 < docs.count() < base.count() and docs.filter("not round_trip").count() == 0
    odd = edge_docs
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, sf).cache()
    assert odd.count() >= 3
    empty = edge_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0

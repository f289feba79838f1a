"""WARC archives and a two-level capture index.

Archives: one gzip member per record, files of at most FILE_BYTES per task, written below the shared folder. A payload that
occurs again is stored once, with the largest page_id; the other records revisit it. File names hold a random number per
task attempt, and only the manifest of successful attempts names files, so a lost or repeated attempt leaves no record twice.

Index: captures sorted by (URL with reversed host, page_id) and cut into ranges. Each range is a file of gzip blocks of
BLOCK_LINES lines and a sparse directory file with the first key of each block. A lookup picks the range from the list of
first keys (one per index file, at most INDEX_FILES), binary-searches the range's directory, reads and searches one block, and
reads the record's bytes from its archive.

Defined results: a NULL html is an empty payload, a NULL url an empty one, a NULL page_id sorts first, is never referred to unless
no record of the payload has an id, and is returned as NULL; repeated rows are records of their own, all with the same type.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from weirworks.llm.common import pieces
from weirworks.llm.pieces import Shared
from weirworks.session import scratch_dir, stored

FILE_BYTES, BLOCK_LINES, INDEX_FILES, LEVEL = 64 << 20, 500, 2_000, 3
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "key string, file string, at bigint, size bigint"
READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def reversed_host(url: str) -> str:
    """``com,example,blog)/path?query``: captures of a host and its subdomains sort together. A URL that can't be split stays as it is."""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url
    return f"{host}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def capture_key(url: str, page_id: int | None) -> str:
    """Sorts by reversed-host URL, then page_id; bytes and characters sort alike in UTF-8."""
    number = " " * 20 if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{quote(reversed_host(url), safe=SAFE)} {number}"


SAFE = "".join(chr(c) for c in range(33, 127))  # everything else, white space included, is percent-encoded


def name_of(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    digits = (name or "")[len("<urn:page:"):-1]
    return int(digits) if digits else None


def record(page_id: int | None, url: str, digest: str, length: int, payload: bytes | None, refers_to: int | None) -> bytes:
    """A WARC record; without a payload it is a revisit."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {name_of(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {quote(url, safe=SAFE)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {length}"]
    if payload is None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {name_of(refers_to)}"]
    body = payload or b""
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join([*head, "", ""]).encode() + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


def gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def gunzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


class Files:
    """Files of the shared folder by URI, a few of them open."""

    def __init__(self, limit: int = 32):
        self.limit, self.open = limit, OrderedDict()

    def read(self, uri: str, at: int, size: int) -> bytes:
        if uri not in self.open:
            system, path = pafs.FileSystem.from_uri(uri)
            self.open[uri] = system.open_input_file(path)
            if len(self.open) > self.limit:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(uri)
        return self.open[uri].read_at(size, at)

    def read_all(self, uri: str) -> bytes:
        system, path = pafs.FileSystem.from_uri(uri)
        with system.open_input_file(path) as f:
            return f.read()


def new_file(folder: str, kind: str):
    """(URI, stream) of a new file; its name is unique to this attempt."""
    uri = f"{folder}/{uuid.uuid4().hex}.{kind}"
    system, path = pafs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, digest, length, html of responses only, and for revisits the page they refer to."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    # Only the digests meet; a payload that a third of the pages share is summed up before the shuffle.
    largest = rows.groupBy("digest").agg(F.max("page_id").alias("largest"))
    narrow = rows.select("page_id", "digest").distinct().join(largest, "digest").filter(~F.col("page_id").eqNullSafe(F.col("largest")))
    narrow = narrow.select(F.col("page_id").alias("id"), F.col("digest").alias("again"), "largest")
    both = rows.join(narrow, rows["page_id"].eqNullSafe(narrow["id"]) & (rows["digest"] == narrow["again"]), "left")
    again = F.col("again").isNotNull()
    return both.select("page_id", "url", "digest", F.octet_length("html").cast("bigint").alias("length"),
                       F.when(~again, F.col("html")).alias("html"), F.when(again, F.col("largest")).alias("refers_to"), again.alias("again"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns their manifest: key, file, offset and size of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = stream = None
        at = 0
        for batch in pieces(batches, 200):
            out: dict[str, list] = {c: [] for c in ("key", "file", "at", "size")}
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "length", "html", "refers_to", "again"))
            for page_id, url, digest, length, html, refers_to, again in zip(*columns):
                if stream is None or at >= FILE_BYTES:
                    if stream:
                        stream.close()
                    (uri, stream), at = new_file(folder, "warc.gz"), 0
                label = base64.b32encode(bytes.fromhex(digest)).decode()
                packed = gzip(record(page_id, url, label, length, None if again else (html or "").encode(), refers_to))
                stream.write(packed)
                for c, v in zip(out, (capture_key(url, page_id), uri, at, len(packed))):
                    out[c].append(v)
                at += len(packed)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if c in ("key", "file") else pa.int64()) for c, v in out.items()], list(out))
        if stream:
            stream.close()

    return stored(decided(pages).mapInArrow(run, MANIFEST), "warc-manifest")


class Index:
    """First keys of the index files, sorted, with the files; one entry per index file."""

    def __init__(self, ranges: list[tuple[str, str, str]]):
        self.ranges = sorted(ranges)


def build_index(manifest: DataFrame, folder: str, files: int | None = None) -> Index:
    """Sorts the captures into ranges and writes blocks and directories."""
    files = min(INDEX_FILES, files or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = stream = None
        at, first, directory, lines = 0, "", [], []

        def block() -> None:
            nonlocal at
            packed = gzip("\n".join(lines).encode())
            directory.append(json.dumps([lines[0].split("\t", 1)[0], at, len(packed)]))
            stream.write(packed)
            at += len(packed)
            lines.clear()

        for batch in pieces(batches, 5000):
            for key, file, offset, size in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "at", "size"))):
                if stream is None:
                    (uri, stream), first = new_file(folder, "cdx.gz"), key
                # a block may end anywhere: a lookup goes on to the next block while the key lasts
                lines.append(f"{key}\t{file}\t{offset}\t{size}")
                if len(lines) == BLOCK_LINES:
                    block()
        if stream:
            if lines:
                block()
            stream.close()
            where, out = new_file(folder, "directory")
            out.write("\n".join(directory).encode())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, uri, where)], ["first", "blocks", "directory"])

    ranged = manifest.repartitionByRange(files, "key").sortWithinPartitions("key")
    ranges = stored(ranged.mapInArrow(run, "first string, blocks string, directory string"), "capture-index")
    return Index([tuple(r) for r in ranges.collect()])  # at most INDEX_FILES rows


class Searcher:
    """Finds captures in one index file: binary search in the directory, one block at a time."""

    def __init__(self, files: Files, blocks: str, directory: str):
        self.files, self.blocks = files, blocks
        self.entries = [json.loads(x) for x in files.read_all(directory).decode().split("\n")]
        self.firsts = [e[0] for e in self.entries]
        self.held, self.keys, self.lines = -1, [], []

    def load(self, n: int) -> None:
        if self.held != n:
            _, at, size = self.entries[n]
            self.lines = [x.split("\t") for x in gunzip(self.files.read(self.blocks, at, size)).decode().split("\n")]
            self.keys, self.held = [x[0] for x in self.lines], n

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, size) of every capture with this key. Blocks before the last one that starts below the key can't hold it."""
        n = bisect_right(self.firsts, key) - 1
        while n > 0 and self.firsts[n] == key:  # the key may have begun in the block before
            n -= 1
        while 0 <= n < len(self.entries) and self.firsts[n] <= key:
            self.load(n)
            for x in self.lines[bisect_right(self.keys, key) - self.keys.count(key):bisect_right(self.keys, key)]:
                yield x[1], int(x[2]), int(x[3])
            n += 1


def lookup(captures: DataFrame, index: Index) -> DataFrame:
    """The records of all captures of (url, page_id) pairs, read through the index (READ); pairs without a capture give no row."""
    known = Shared(captures, index.ranges)
    names = [f.split()[0] for f in READ.split(", ")]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [r[0] for r in known.value]
        for batch in pieces(batches, 5000):
            keys = [capture_key(u or "", p) for u, p in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist())]
            ranges = [max(0, bisect_right(firsts, k) - 1) for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int64()), pa.array(keys, pa.string())], ["range", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, searcher, held = Files(), None, None
        for batch in pieces(batches, 500):
            out: list[tuple] = []
            for number, key in zip(batch.column("range").to_pylist(), batch.column("key").to_pylist()):
                if number != held:
                    searcher, held = Searcher(files, *known.value[number][1:]), number
                for where in searcher.find(key):
                    headers, payload = parse(gunzip(files.read(*where)))
                    out.append(seen(headers, payload))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if x in ("url", "payload_digest", "record_type") else pa.int64()) for x, c in zip(names, zip(*out))], names)

    wanted = captures.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"))
    routed = wanted.mapInArrow(route, "range bigint, key string").distinct()
    # Ranges hold about equal numbers of captures; keys of a range are looked up in order.
    return routed.repartition("range").sortWithinPartitions("range", "key").mapInArrow(run, READ)


def seen(headers: dict[str, str], payload: bytes) -> tuple:
    """What a record says of its payload; a response is measured, and must agree with its headers."""
    digest, length = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
    if headers["WARC-Type"] == "response":
        measured = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        if measured != (digest, length):
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} differs from its headers")
    return page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], length, digest, headers["WARC-Type"], page_of(headers.get("WARC-Refers-To"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes archives and index for all pages, then reads every capture back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    manifest = write_archives(pages, f"{folder}/archives")
    index = build_index(manifest, f"{folder}/index")
    return lookup(pages, index)

"""WARC archives with a two-level capture index.

Records are gzip members in files sorted by reversed-host URL key. The index of a file is its sorted
keys in compressed blocks; a sparse directory has the first key of each block. A lookup searches
the directory, reads and searches one block, and reads one byte range of the archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.blobs import BlobWriter, Ranges, read_blob, write_blob
from fleetquarry.llm.common import slices, stored
from fleetquarry.session import shared_dir

BLOCK_LINES = 1000
BATCH_BYTES = 8 << 20
#: Compression of records: fast, as archives are written once and pages are short.
LEVEL = 3
#: Stands for a missing page_id in keys.
NO_ID = -(1 << 63)

Key = tuple[str, int]


def url_key(url: str | None) -> str:
    """com,example,host:port)/path?query in lower case; '' for null, a text that is no URL as it is."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip().lower())
    except ValueError:
        return url
    host, _, port = parts.netloc.rpartition("@")[2].partition(":")
    if not host:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/") + query


def _order(key: Key) -> tuple[bytes, int]:
    """As Spark sorts it: texts by their UTF-8 bytes."""
    return key[0].encode(), key[1]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, size: int, sha: str, payload: bytes, revisits: int | None) -> bytes:
    """One WARC record of a payload of ``size`` bytes and digest ``sha``. A revisit has the HTTP header, with the
    full length, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if revisits is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        # header values are one line each
        f"WARC-Target-URI: {json.dumps(url or '', ensure_ascii=False)[1:-1]}",
        f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisits is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{revisits}>",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload bytes, payload digest, record type and the page it refers to. The digest of a
    response is made from the payload and must be the one in the header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    page = lambda name: int(v) if (v := fields.get(name, "<urn:page:>")[10:-1]) else None
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != told):
        raise ValueError("a record's payload is not what its header says")
    return page("WARC-Record-ID"), size, told, fields["WARC-Type"], page("WARC-Refers-To")


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` under ``root``; returns (part, surt, page_id), each part's first key.

    Of equal payloads the largest page_id is a response, the others revisit it. Null html is empty;
    rows without page_id revisit if any page of their payload has one, else they are responses.
    A range partition is a part: archive, index and directory files, named by its number.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1(F.col("html").cast("binary")))
    last = rows.groupBy("sha").agg(F.max("page_id").alias("last"))
    # copies of one payload meet in the join by digest; they are dealt anew by the skew rule
    kind = "page_id long, url string, sha string, surt string, size long, digest string, member binary"
    known = rows.mapInArrow(_members, kind).join(last, "sha").withColumn(
        "revisits", F.when(F.col("last").isNull() | F.coalesce(F.col("page_id") == F.col("last"), F.lit(False)), F.lit(None)).otherwise(F.col("last"))
    )
    known = known.withColumn("key_id", F.coalesce("page_id", F.lit(NO_ID))).drop("sha", "last")
    ordered = known.repartitionByRange("surt", "key_id").sortWithinPartitions("surt", "key_id", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"{root}/part-{part:06d}"
        archive, at = BlobWriter(f"{name}.warc.gz"), 0
        blocks, directory, lines, index_at, first = [], [], [], 0, None

        def close_block() -> None:
            nonlocal index_at
            block = gzip.compress("\n".join(json.dumps(line, ensure_ascii=False) for line in lines).encode(), mtime=0)
            directory.append((lines[0][0], lines[0][1], index_at, len(block)))
            blocks.append(block)
            index_at += len(block)
            lines.clear()

        for batch in slices(batches, "member", BATCH_BYTES):
            for row in batch.to_pylist():
                first = first or (row["surt"], row["key_id"])
                member = row["member"]
                if row["revisits"] is not None:
                    raw = record(row["page_id"], row["url"], row["size"], row["digest"], b"", row["revisits"])
                    member = gzip.compress(raw, LEVEL, mtime=0)
                archive.write(member)
                lines.append((row["surt"], row["key_id"], at, len(member)))
                at += len(member)
                if len(lines) >= BLOCK_LINES:
                    close_block()
        if first is None:
            archive.abort()
            return
        if lines:
            close_block()
        archive.close()
        write_blob(f"{name}.index.gz", blocks)
        write_blob(f"{name}.directory", [json.dumps(directory).encode()])
        out = [pa.array([part], pa.int32()), pa.array([first[0]]), pa.array([first[1]], pa.int64())]
        yield pa.RecordBatch.from_arrays(out, ["part", "surt", "key_id"])

    return ordered.mapInArrow(run, "part int, surt string, key_id long")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as compressed response records, which is how they go through the exchanges."""
    for batch in slices(batches, "html", BATCH_BYTES):
        urls = batch.column("url").to_pylist()
        sizes, digests, members = [], [], []
        for page_id, url, html in zip(batch.column("page_id").to_pylist(), urls, batch.column("html").to_pylist()):
            payload = html.encode()
            sizes.append(len(payload))
            digests.append(digest(payload))
            raw = record(page_id, url, len(payload), digests[-1], payload, None)
            members.append(gzip.compress(raw, LEVEL, mtime=0))
        surts = pa.array([url_key(u) for u in urls], pa.string())
        made = [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(members, pa.binary())]
        columns = [*(batch.column(n) for n in ("page_id", "url", "sha")), surts, *made]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "sha", "surt", "size", "digest", "member"])


def _keyed(pages: DataFrame) -> DataFrame:
    """With surt and key_id, the sort key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "surt"])

    kind = ", ".join(f"{n} {t}" for n, t in pages.dtypes) + ", surt string"
    return pages.mapInArrow(run, kind).withColumn("key_id", F.coalesce("page_id", F.lit(NO_ID)))


class Reader:
    """Looks up keys in the files of one part, best in sorted order."""

    def __init__(self, root: str, part: int):
        name = f"{root}/part-{part:06d}"
        self._directory = json.loads(read_blob(f"{name}.directory"))
        self._firsts = [_order((d[0], d[1])) for d in self._directory]
        self._index, self._archive = Ranges(f"{name}.index.gz"), Ranges(f"{name}.warc.gz")
        self._at, self._lines, self._keys = -1, [], []

    def _load(self, block: int) -> None:
        if block != self._at:
            _, _, start, size = self._directory[block]
            self._lines = [json.loads(x) for x in gzip.decompress(self._index.read(start, size)).decode().split("\n")]
            self._keys = [_order((x[0], x[1])) for x in self._lines]
            self._at = block

    def __call__(self, key: Key, nth: int) -> bytes:
        """The nth record (from 0) with this key."""
        wanted = _order(key)
        # the last block that starts before the key; equal keys may go on over several blocks
        block = max(0, bisect_right(self._firsts, (wanted[0], wanted[1] - 1)) - 1)
        while block < len(self._directory):
            self._load(block)
            lo, hi = bisect_right(self._keys, (wanted[0], wanted[1] - 1)), bisect_right(self._keys, wanted)
            if nth < hi - lo:
                _, _, start, size = self._lines[lo + nth]
                return zlib.decompress(self._archive.read(start, size), 31)
            nth, block = nth - (hi - lo), block + 1
        raise KeyError(key)

    def close(self) -> None:
        self._index.close()
        self._archive.close()


def look_up(pages: DataFrame, root: str, parts: list[tuple[int, str, int]]) -> DataFrame:
    """The captures of ``pages(page_id, url)`` in the archives under ``root``, one for each row.

    ``parts`` are the first keys, as many as tasks wrote. Each lookup goes to its part, so a task opens
    one part at a time and needs only that part's directory.
    """
    parts = sorted(parts, key=lambda p: _order((p[1], p[2])))
    firsts = [_order((p[1], p[2])) for p in parts]
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("surt").to_pylist(), batch.column("key_id").to_pylist())
            own = [parts[max(0, bisect_right(firsts, _order(k)) - 1)][0] for k in keys]
            columns = [pa.array(own, pa.int32()), batch.column("surt"), batch.column("key_id")]
            yield pa.RecordBatch.from_arrays(columns, ["part", "surt", "key_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at, last, nth = None, None, None, 0
        for batch in batches:
            out = []
            for part, surt, key_id in zip(*(c.to_pylist() for c in batch.columns)):
                if part != at:
                    if reader:
                        reader.close()
                    reader, at = Reader(root, part), part
                nth = nth + 1 if (surt, key_id) == last else 0
                last = (surt, key_id)
                out.append(parse(reader(last, nth)))
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if reader:
            reader.close()

    keys = _keyed(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))).select("surt", "key_id")
    routed = keys.mapInArrow(route, "part int, surt string, key_id long")
    spread = routed.repartition(len(parts), "part").sortWithinPartitions("part", "surt", "key_id")
    return spread.mapInArrow(run, kind)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Archives ``pages`` in the shared folder and reads every capture back by its URL key.

    (page_id, payload_bytes, payload_digest, record_type, refers_to); an empty table gives no rows, and
    rows that repeat give as many records.
    """
    root = shared_dir(pages.sparkSession, "warc")
    firsts = stored(write_archives(pages, root), "warc-parts")
    parts = [(r["part"], r["surt"], r["key_id"]) for r in firsts.collect()]  # one for each part
    if not parts:
        return pages.sparkSession.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        )
    return look_up(pages, root, parts)

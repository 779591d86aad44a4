"""WARC archives with a two-level capture index.

``write`` stores a record per page in gzip members of archive files in the
shared folder. Pages with equal payloads of ``MIN_BYTES`` or more keep one
response, that of the smallest page_id; the others are revisit records without
payload that refer to it. ``build_index`` sorts the captures by reversed-host
URL key into compressed blocks, one index file per key range, each ending in a
sparse directory of its blocks (first key, offset, length). ``lookup`` sends
keys to their file, binary-searches the directory, reads the block's range and
then the record's range.

Files get a name of their own for every task attempt and count only if the
finished job lists them, so a repeated task leaves no trace in the result.

Defined results: null html is an empty payload; a null url is the empty key;
rows that repeat a page_id with the same payload are all responses if it is
the smallest; a null page_id never is what others refer to, its row revisits
an equal payload if there is one; payloads of any length are stored whole, one
record each; no pages give no records; columns other than the three are not
read, whatever their names.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ._shared import bounded_batches, byte_slices, materialize, split_uri

MIN_BYTES = 0
#: Captures of an index block; bytes of one coalesced read of an archive.
BLOCK, READ_BYTES = 512, 4 << 20
#: Archive bytes that one reading task is dealt, and what makes a task worthwhile.
DEAL, LEAST = 64 << 20, 1 << 20
TRAILER = struct.Struct("<QQ8s")
MAGIC = b"CAPINDX1"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
CAPTURE = "key string, page_id long, file string, offset long, length long"
FILES = "path string, first_key string, last_key string, captures long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def url_key(url: str) -> str:
    """Reversed host, then port, path and query: com,example,www)/path?q."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").split("."), parts.port
    except ValueError:
        return ")" + url
    return ",".join(reversed(host)) + (f":{port}" if port else "") + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def line(value: str) -> str:
    """A header value: line breaks and the like are percent-encoded."""
    return "".join(c if c >= " " and c not in "%\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def unline(value: str) -> str:
    out, raw = value.encode(), bytearray()
    i = 0
    while i < len(out):
        if out[i] == 0x25:
            raw.append(int(out[i + 1:i + 3], 16))
            i += 3
        else:
            raw.append(out[i])
            i += 1
    return raw.decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    block = (HTTP % len(payload)) + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {line(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=5, mtime=0)


def parse(raw: bytes) -> dict:
    """Fields of an unpacked record; the payload's size is its HTTP length."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    url = fields.get("WARC-Target-URI")
    return {"page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None, "url": None if url is None else unline(url),
            "payload_bytes": int(http.rpartition(b"Content-Length: ")[2]), "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": fields["WARC-Type"], "refers_to": int(fields["X-Refers-To-Page"]) if revisit else None, "payload": None if revisit else payload}


def create(folder: str, name: str):
    system, path = split_uri(f"{folder}/{name}")
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_file(uri: str):
    system, path = split_uri(uri)
    return system.open_input_file(path)


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archives; returns a capture (key, page_id, file, offset,
    length) per record."""
    bounded_batches(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", html.alias("payload"), F.sha1(html).alias("sha"))
    # the few digests that occur again, one row each; a hot one's pages are split by the join
    again = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1 AND first IS NOT NULL").select("sha", "first")
    again = materialize(again, "warc-equal")
    rows = rows.join(again, "sha", "left").select("page_id", "url", "payload", "sha", "first")

    def run(batches):
        name, out, at = f"pages-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for part in byte_slices(batch, "payload"):
                out = out or create(folder, name)
                found = []
                for page, url, payload, sha, first in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "first"))):
                    revisit = first is not None and page != first
                    raw = record(page, url, payload, base64.b32encode(bytes.fromhex(sha)).decode(), first, revisit)
                    out.write(raw)
                    found.append((url_key(url or ""), page, f"{folder}/{name}", at, len(raw)))
                    at += len(raw)
                yield pa.RecordBatch.from_arrays([pa.array(c) if i != 1 else pa.array(c, pa.int64()) for i, c in enumerate(zip(*found))],
                                                 names=["key", "page_id", "file", "offset", "length"])
        if out:
            out.close()

    return materialize(rows.mapInArrow(run, CAPTURE), "warc-captures")


def ending(directory: list, at: int) -> bytes:
    """The block directory and the trailer that finds it."""
    raw = zlib.compress(json.dumps(directory).encode())
    return raw + TRAILER.pack(at, len(raw), MAGIC)


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Index files of sorted captures; returns one row per file (the upper
    level of the index): path, first_key, last_key, captures."""
    rows = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")

    def run(batches):
        name, out, at, directory, first, last, n = f"index-{uuid.uuid4().hex}.cdx", None, 0, [], None, None, 0
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                lines = batch.slice(i, BLOCK).to_pylist()
                out = out or create(folder, name)
                raw = zlib.compress("\n".join(json.dumps(list(x.values())) for x in lines).encode(), 5)
                out.write(raw)
                directory.append([lines[0]["key"], at, len(raw)])
                at, first, last, n = at + len(raw), lines[0]["key"] if first is None else first, lines[-1]["key"], n + len(lines)
        if out:
            out.write(ending(directory, at))
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "first_key": first, "last_key": last, "captures": n}],
                                             schema=pa.schema([("path", pa.string()), ("first_key", pa.string()), ("last_key", pa.string()), ("captures", pa.int64())]))

    return materialize(rows.mapInArrow(run, FILES), "warc-index")


class IndexFile:
    """One index file: its sparse directory, and blocks on demand."""

    def __init__(self, uri: str):
        self.file = open_file(uri)
        size = self.file.size()
        at, length, magic = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"not an index file: {uri}")
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, at)))
        self.keys = [x[0] for x in self.directory]
        self.held = (None, [])

    def block(self, i: int) -> list:
        if self.held[0] != i:
            _, at, length = self.directory[i]
            self.held = (i, [json.loads(x) for x in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")])
        return self.held[1]

    def find(self, key: str) -> list:
        """Captures (key, page_id, file, offset, length) of a key."""
        i, found = max(0, bisect.bisect_left(self.keys, key) - 1), []
        while i < len(self.keys) and self.keys[i] <= key:
            lines = self.block(i)
            at = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while at < len(lines) and lines[at][0] == key:
                found.append(lines[at])
                at += 1
            i += 1
        return found


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures of distinct ``keys`` (key): each key goes to the files whose
    range may hold it, in one sorted run per file."""
    spark = index.sparkSession
    wanted = keys.select("key").distinct()
    # the upper level, a row per index file, is an ordered list of first keys
    files = [tuple(r) for r in index.select("first_key", "last_key", "path").orderBy("first_key", "last_key").toLocalIterator()]
    shared = spark.sparkContext.broadcast(files)

    def route(batches):
        firsts = [f[0] for f in shared.value]
        for batch in batches:
            found = []
            for key in batch.column("key").to_pylist():
                i = bisect.bisect_right(firsts, key) - 1
                while i >= 0 and shared.value[i][1] >= key:
                    found.append((key, shared.value[i][2]))
                    i -= 1
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["key", "path"])

    def search(batches):
        held = (None, None)
        for batch in batches:
            out = []
            for key, path in zip(batch.column("key").to_pylist(), batch.column("path").to_pylist()):
                if held[0] != path:
                    held = (path, IndexFile(path))
                out += held[1].find(key)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i != 1 else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out))], names=["key", "page_id", "file", "offset", "length"])

    routed = wanted.mapInArrow(route, "key string, path string")
    return routed.repartitionByRange("path", "key").sortWithinPartitions("path", "key").mapInArrow(search, CAPTURE)


def read(captures: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of captures, by range reads that join neighbours in a file.

    Size and digest of a response are those of the payload as read; a revisit
    has those of its header. Captures are dealt by the bytes they stand for:
    a file's stretches of ``DEAL`` bytes (less when there is little) each go to
    one task. Written first, the captures are found once.
    """
    spark = captures.sparkSession
    rows = materialize(captures.select("file", "offset", "length"), "warc-found")
    total = rows.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // LEAST))
    tasks = max(1, few, -(-total // DEAL))
    rows = rows.withColumn("stretch", F.floor(F.col("offset") / max(1, total // tasks)))
    rows = rows.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset").drop("stretch")

    def run(batches):
        held = (None, None)
        for batch in batches:
            todo = list(zip(batch.column("file").to_pylist(), batch.column("offset").to_pylist(), batch.column("length").to_pylist()))
            while todo:
                name, start, length = todo[0]
                n, end = 1, start + length
                while n < len(todo) and todo[n][0] == name and todo[n][1] <= end and max(end, todo[n][1] + todo[n][2]) - start <= READ_BYTES:
                    end, n = max(end, todo[n][1] + todo[n][2]), n + 1
                if held[0] != name:
                    held = (name, open_file(name))
                data = held[1].read_at(end - start, start)
                found = [as_read(parse(zlib.decompress(data[at - start:at - start + size], 31))) for _, at, size in todo[:n]]
                yield pa.RecordBatch.from_pylist([x if payloads else x | {"payload": None} for x in found], schema=ARROW)
                todo = todo[n:]

    return rows.mapInArrow(run, RECORD)


def as_read(fields: dict) -> dict:
    """A response's size and digest from its payload."""
    payload = fields["payload"]
    return fields if payload is None else fields | {"payload_bytes": len(payload), "payload_digest": digest_of(payload)}


ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64()), ("payload", pa.binary())])


def archive(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write all pages, index them, look every page's URL up and read its
    records back: page_id, payload_bytes, payload_digest, record_type,
    refers_to. The digest of a response is that of the payload as read."""
    folder = scratch_path(pages.sparkSession, "warc")
    captures = write(pages, folder, min_bytes)
    index = build_index(captures, folder)
    found = read(lookup(index, captures), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

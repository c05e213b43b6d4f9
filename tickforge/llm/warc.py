"""WARC archives with a two-level capture index.

``write_archives`` puts every page into WARC 1.1 files (one gzip member a record). Pages are
range-partitioned by their reversed-host URL key, so each file holds a contiguous stretch of
keys; along with it the task writes the file's index: sorted lines in compressed blocks of
``BLOCK_LINES`` and a sparse directory of the blocks (first key, offset, length). The returned
manifest names, for each part, its first key and files. ``lookup`` finds captures by binary
search in the manifest, then in one part's directory, then in one block, and range-reads the
record. A payload that equals another page's is stored once (``response``); the other captures
are ``revisit`` records that name it.

Files go below ``root`` in the shared store through ``pyarrow.fs``, each under a name of its task
attempt; only the attempt whose manifest row is committed is ever read.

Defined cases: NULL html counts as empty, NULL url as the empty key; of equal payloads (of at
least ``least_bytes``) the row with the largest page_id is the response (rows that share that id
are all responses); rows with a NULL page_id are responses and name no one; repeated rows are
written each; an empty table makes no files.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections import OrderedDict
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import table, written
from tickforge.session import scratch_dir

BLOCK_LINES = 512
#: WARC-Date of records whose page carries no time.
DATE = "2000-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """``com,example,www)/path?query``: host reversed and lower case, sorted by site."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:  # not a URL: the text itself, as a path without host
        return f"){(url or '').strip()}"
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _uri(root: str) -> str:
    return root.replace("file:/", "file:///", 1) if root.startswith("file:/") and not root.startswith("file://") else root


def record(page_id: int | None, url: str, payload: bytes, response: bool, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record (uncompressed)."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if response else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join(url.split())}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(body)}",
    ]
    if not response:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names), HTTP headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    body = rest[: int(headers["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"headers": headers, "http": http, "payload": payload, "payload_bytes": length}


def _number(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").rstrip(">")
    return int(text) if text else None


def write_archives(pages: DataFrame, root: str, *, least_bytes: int = 0, partitions: int | None = None) -> DataFrame:
    """Archives and index below ``root``; returns the manifest (one row a file)."""
    spark = pages.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.udf(url_key, "string")  # a short string function; the payload never passes it
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    # Payloads met more than once: the digest and the page that holds the response.
    shared = (
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where((F.col("n") > 1) & F.col("keeper").isNotNull()).select("digest", "keeper")
    )
    shared = written(shared, "warc-shared")  # its size decides between broadcast and sort-merge join
    rows = rows.join(shared, "digest", "left").select("page_id", "url", "payload", "keeper")
    rows = rows.withColumn("key", key("url")).repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")
    target = _uri(root)

    def write(batches):
        store, base = _filesystem(target)
        name = out = index = None
        at = size = 0
        lines: list[str] = []
        directory: list[tuple[str, int, int]] = []
        first = None

        def block():
            nonlocal size
            packed = gzip.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6, mtime=0)
            index.write(packed)
            directory.append((json.loads(lines[0])[:2], size, len(packed)))
            size += len(packed)
            lines.clear()

        for batch in batches:
            for page_id, url, body, keeper, k in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    name = f"{base}/{uuid.uuid4().hex}"
                    store.create_dir(base, recursive=True)
                    out, index, first = store.open_output_stream(f"{name}.warc.gz", compression=None), store.open_output_stream(f"{name}.cdx.gz", compression=None), [k, page_id]
                response = page_id is None or keeper is None or keeper == page_id
                packed = gzip.compress(record(page_id, url, body, response, keeper), 2, mtime=0)
                out.write(packed)
                lines.append(json.dumps([k, page_id, at, len(packed)]))
                at += len(packed)
                if len(lines) == BLOCK_LINES:
                    block()
        if out is not None:
            if lines:
                block()
            out.close(), index.close()
            with store.open_output_stream(f"{name}.idx") as f:
                f.write("\n".join(json.dumps(x) for x in directory).encode())
            yield pa.RecordBatch.from_pylist([{"first_key": first[0], "first_id": first[1], "name": name.rsplit("/", 1)[1], "bytes": at}], schema=pa.schema([("first_key", pa.string()), ("first_id", pa.int64()), ("name", pa.string()), ("bytes", pa.int64())]))

    made = rows.select("page_id", "url", "payload", "keeper", "key").mapInArrow(write, "first_key string, first_id long, name string, bytes long")
    return written(made, "warc-manifest")


def _order(key: str, page_id: int | None) -> tuple:
    # Spark sorts strings by their UTF-8 bytes and NULL first.
    return key.encode("utf-8", "surrogatepass"), page_id is not None, page_id or 0


class Reader:
    """Binary search in manifest, directory and block, then a range read; keeps one block and a
    few open files, whatever the size of the archive."""

    def __init__(self, root: str, manifest: list[tuple[str, int | None, str]], open_files: int = 16):
        self.store, self.base = _filesystem(_uri(root))
        self.parts = sorted((_order(k, i), name) for k, i, name in manifest)
        self.directories: OrderedDict[str, list] = OrderedDict()
        self.files: OrderedDict[str, object] = OrderedDict()
        self.open_files = open_files
        self.block_at, self.block = None, []

    def _recent(self, cache: OrderedDict, name: str, make):
        if name not in cache:
            cache[name] = make()
            if len(cache) > self.open_files:
                cache.popitem(last=False)
        cache.move_to_end(name)
        return cache[name]

    def _directory(self, part: str) -> list:
        def load():
            with self.store.open_input_stream(f"{self.base}/{part}.idx") as f:
                rows = [json.loads(x) for x in f.read().decode().split("\n")]
            return [(_order(*first), a, b) for first, a, b in rows]

        return self._recent(self.directories, part, load)

    def _read(self, name: str, at: int, size: int) -> bytes:
        return self._recent(self.files, name, lambda: self.store.open_input_file(f"{self.base}/{name}")).read_at(size, at)

    def captures(self, key: str, page_id: int | None):
        """(offset, length, file) of each capture with this key and id."""
        want = _order(key, page_id)
        # Equal keys may begin in the part or block before the first one that starts with them.
        p = max(0, bisect.bisect_left(self.parts, (want,)) - 1)
        while p < len(self.parts) and self.parts[p][0] <= want:
            part = self.parts[p][1]
            directory = self._directory(part)
            b = max(0, bisect.bisect_left(directory, (want,)) - 1)
            while b < len(directory) and directory[b][0] <= want:
                if self.block_at != (part, b):
                    lines = gzip.decompress(self._read(f"{part}.cdx.gz", *directory[b][1:])).decode("utf-8", "surrogatepass").split("\n")
                    self.block_at, self.block = (part, b), [(_order(k, i), at, n) for k, i, at, n in map(json.loads, lines)]
                i = bisect.bisect_left(self.block, (want,))
                while i < len(self.block) and self.block[i][0] == want:
                    yield self.block[i][1], self.block[i][2], f"{part}.warc.gz"
                    i += 1
                b += 1
            p += 1

    def records(self, key: str, page_id: int | None):
        for at, size, name in self.captures(key, page_id):
            yield parse_record(zlib.decompress(self._read(name, at, size), wbits=31))


def lookup(wanted: DataFrame, root: str, manifest: DataFrame, *, partitions: int | None = None) -> DataFrame:
    """The records of the captures in ``wanted`` (url, page_id), payload included."""
    spark = wanted.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One row an archive file (a file is a shuffle partition): the top level of the index.
    parts = spark.sparkContext.broadcast([(r["first_key"], r["first_id"], r["name"]) for r in manifest.select("first_key", "first_id", "name").collect()])
    key = F.udf(url_key, "string")
    asked = wanted.select(F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.col("page_id").cast("long").alias("page_id"))
    asked = asked.select(key("url").alias("key"), "page_id").groupBy("key", "page_id").agg(F.lit(1).alias("one")).select("key", "page_id")
    asked = asked.repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")
    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"

    def read(batches):
        reader = Reader(root, parts.value)
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        rows, held = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for k, page_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for r in reader.records(k, page_id):
                    h = r["headers"]
                    rows.append((_number(h["warc-record-id"]), h["warc-target-uri"], h["warc-type"], _number(h.get("warc-refers-to")), h["warc-payload-digest"].removeprefix("sha1:"), r["payload_bytes"], r["payload"]))
                    held += len(r["payload"])
                    if held > 8_000_000 or len(rows) >= 2_000:
                        yield out()
                        rows, held = [], 0
        if rows:
            yield out()

    return asked.mapInArrow(read, schema)


def archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, looked up again and described from its record."""
    pages = table(spark, sf_dir, "pages")
    root = scratch_dir(spark, "warc")
    manifest = write_archives(pages, root)
    return lookup(pages, root, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


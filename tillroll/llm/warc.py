"""WARC archives with a two-level capture index.

Records are written by the tasks that read the pages, one gzip member each, so
that any record can be read by its offset.  Of equal payloads of at least
``LEAST_REVISIT`` bytes only the smallest ``page_id``'s is stored; the others are
revisit records with the payload's headers.

The index sorts all captures by key: the host's labels reversed, then the rest
of the url (``com,example,www)/path?query``).  Each range of keys becomes an
index file of zstandard blocks of ``BLOCK_CAPTURES`` lines, closed by a sparse
directory with the first key, place and size of each block.  The upper level
is a table with the first and last key of each index file.  A lookup finds the
file and then the block by binary search, and reads only that block and the
record.  Tasks draw new file names for each attempt, and only files named in
the written tables count, so lost executors leave no wrong files behind.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import file_system, shared_dir, written

LEAST_REVISIT = 100
BLOCK_CAPTURES = 500
#: A new archive is begun beyond this size; ranges up to READ_BYTES are read at once.
ARCHIVE_BYTES, READ_BYTES = 1 << 30, 4 << 20
#: Bytes of archives that a task should read back, and the most tasks it may take.
TASK_BYTES, MOST_TASKS = 8 << 20, 20_000
DATE = "1970-01-01T00:00:00Z"
TAIL = "<2q8s"
MAGIC = b"TILLCDX1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CAPTURE = "key string, page_id long, file string, offset long, length long"


def capture_key(url: Column) -> Column:
    """Reversed host labels, ``)`` and the rest; the text itself without ``://``; null is empty."""
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    tail = F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1)
    surt = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)
    return F.coalesce(F.when(F.instr(url, "://") > 0, surt).otherwise(url), F.lit(""))


def marked(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, first``: ``first`` is the response that a revisit refers to.

    Rows without ``page_id``, and repeated rows of the response, are responses.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    large = rows.where(F.octet_length("html") >= LEAST_REVISIT).where("page_id is not null")
    groups = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    groups = written(groups.where("first <> last").select(F.col("digest").alias("shared"), "first"), "shared")
    rows = rows.join(groups, F.col("digest") == F.col("shared"), "left")
    return rows.withColumn("first", F.when(F.col("page_id") > F.col("first"), F.col("first"))).drop("shared")


def _safe(url: str) -> str:
    """The url without characters that would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC record as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    kind = "response" if first is None else "revisit"
    block = http + payload if first is None else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    gz = zlib.compressobj(4, zlib.DEFLATED, 31)
    return gz.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + gz.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC headers, HTTP headers and payload of a record; the lengths are checked."""
    raw = zlib.decompress(member, 31)
    top, rest = raw.split(b"\r\n\r\n", 1)
    lines = top.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    size = int(head["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record length does not match")
    http, payload = rest[:size].split(b"\r\n\r\n", 1)
    return head, http, payload


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes a record for every row of ``pages`` (``page_id``, ``url``, ``html``); returns the captures.

    A null html is an empty payload, a null url has no target header.
    """
    folder = shared_dir(pages.sparkSession, "warc")
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    rows = marked(pages).withColumn("key", capture_key(F.col("url")))

    def work(batches):
        out_store, out_path = file_system(folder)
        stream, at, name = None, 0, ""
        for batch in batches:
            got = {k: [] for k in ("key", "page_id", "file", "offset", "length")}
            for page_id, url, html, digest, first, key in zip(
                    *(batch.column(i) for i in range(6)), strict=True):
                if stream is None or at >= ARCHIVE_BYTES:
                    if stream is not None:
                        stream.close()
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    stream, at = out_store.open_output_stream(f"{out_path}/{name}", compression=None), 0
                member = record(page_id.as_py(), url.as_py(), html.as_py().encode(), digest.as_py(), first.as_py())
                stream.write(member)
                for k, v in zip(got, (key.as_py(), page_id.as_py(), f"{folder}/{name}", at, len(member)), strict=True):
                    got[k].append(v)
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["key"], pa.string()), pa.array(got["page_id"], pa.int64()), pa.array(got["file"], pa.string()),
                 pa.array(got["offset"], pa.int64()), pa.array(got["length"], pa.int64())], names=list(got))
        if stream is not None:
            stream.close()

    columns = rows.select("page_id", "url", "html", "digest", "first", "key")
    return written(columns.mapInArrow(work, _CAPTURE), "captures")


def write_index(captures: DataFrame) -> DataFrame:
    """Sorts captures into index files; returns the upper level: ``part, file, first_key, last_key, n``."""
    folder = shared_dir(captures.sparkSession, "cdx")
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    order = ["key", "page_id", "file", "offset"]
    rows = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def work(batches):
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.cdx"
        pack = zstandard.ZstdCompressor(level=3)
        directory, lines, first, last, at, n, size = [], [], None, None, len(MAGIC), 0, 0
        out_store, out_path = file_system(folder)
        stream = None

        def flush():
            nonlocal at, lines
            data = pack.compress("\n".join(lines).encode())
            stream.write(data)
            directory.append([json.loads(lines[0])[0], at, len(data)])
            at += len(data)
            lines = []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    stream = out_store.open_output_stream(f"{out_path}/{name}", compression=None)
                    stream.write(MAGIC)
                    first = row[0]
                last, n, size = row[0], n + 1, size + row[4]
                lines.append(json.dumps(row))
                if len(lines) == BLOCK_CAPTURES:
                    flush()
        if stream is None:
            return
        if lines:
            flush()
        data = pack.compress(json.dumps(directory).encode())
        stream.write(data)
        stream.write(struct.pack(TAIL, at, len(data), MAGIC))
        stream.close()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int64()), "file": [f"{folder}/{name}"], "first_key": [first],
            "last_key": [last], "n": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    schema = "part long, file string, first_key string, last_key string, n long, bytes long"
    return written(rows.mapInArrow(work, schema), "cdx-files")


class IndexFile:
    """Binary search in the block directory of one index file, and range reads of its blocks."""

    def __init__(self, uri: str):
        store, path = file_system(uri)
        self.file = store.open_input_file(path)
        size, tail = self.file.size(), struct.calcsize(TAIL)
        at, length, magic = struct.unpack(TAIL, self.file.read_at(tail, size - tail))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not an index file")
        self.directory = json.loads(zstandard.ZstdDecompressor().decompress(self.file.read_at(length, at)))
        self.firsts = [row[0].encode() for row in self.directory]

    def block(self, i: int) -> list[list]:
        _, at, length = self.directory[i]
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(length, at))
        return [json.loads(line) for line in data.decode().split("\n")]

    def scan(self, low: str | None = None, high: str | None = None) -> Iterator[list]:
        """Captures with ``low <= key <= high`` in order; a bound of None is open.

        Keys compare by their UTF-8 bytes, as in the sort.
        """
        low_b, high_b = (None if k is None else k.encode() for k in (low, high))
        begin = 0 if low_b is None else max(0, bisect_left(self.firsts, low_b) - 1)
        end = len(self.firsts) if high_b is None else bisect_right(self.firsts, high_b)
        for i in range(begin, end):
            for row in self.block(i):
                key = row[0].encode()
                if (low_b is None or key >= low_b) and (high_b is None or key <= high_b):
                    yield row


def scan_index(files: DataFrame, low: str | None = None, high: str | None = None) -> DataFrame:
    """The captures with keys from ``low`` to ``high``: files by the upper level, then blocks by search."""
    picked = files
    if low is not None:
        picked = picked.where(F.col("last_key") >= low)
    if high is not None:
        picked = picked.where(F.col("first_key") <= high)
    picked = picked.select("file").repartition(max(1, files.count()))

    def work(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                found = IndexFile(uri).scan(low, high)
                while rows := [r for _, r in zip(range(10_000), found)]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                            pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                        names=["key", "page_id", "file", "offset", "length"])

    return picked.mapInArrow(work, _CAPTURE)


def lookup(files: DataFrame, urls: DataFrame) -> DataFrame:
    """Captures of each ``url``: the index file by its key range, then the block by binary search.

    Urls meet the upper level, a row per index file, in a range join; each task
    answers the urls of one file from its sorted directory.
    """
    keys = urls.select("url").distinct().withColumn("want", capture_key(F.col("url")))
    keys = keys.join(files.select("file", "first_key", "last_key"),
                     (F.col("want") >= F.col("first_key")) & (F.col("want") <= F.col("last_key")))
    rows = keys.select("file", "want", "url").repartition("file").sortWithinPartitions("file", "want")

    def work(batches):
        index, of = None, None
        for batch in batches:
            out = []
            for uri, want, url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if uri != of:
                    index, of = IndexFile(uri), uri
                out += [(url, *row) for row in index.scan(want, want)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["url", "key", "page_id", "file", "offset", "length"])

    return rows.mapInArrow(work, "url string, " + _CAPTURE)


def reading_tasks(files: DataFrame) -> int:
    """Tasks that read back all that the index lists: by the bytes of the archives, as the captures
    themselves are too small to tell."""
    total = files.agg(F.sum("bytes")).first()[0] or 0
    return max(1, min(MOST_TASKS, -(-total // TASK_BYTES)))


def read_records(captures: DataFrame, tasks: int | None = None) -> DataFrame:
    """Reads captures from the archives: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``.

    Captures are dealt by stretches of their archive and read in order, touching
    ranges at once.  Sizes and digests of responses are those of the payload read,
    and have to agree with the headers; a revisit's come from its headers, and its
    payload is null.
    """
    rows = captures.select("file", "offset", "length")
    near = F.xxhash64("file", F.floor(F.col("offset") / TASK_BYTES))
    rows = rows.repartition(near) if tasks is None else rows.repartition(tasks, near)
    rows = rows.sortWithinPartitions("file", "offset")

    def ranges(batches):
        """Archive and touching captures of up to READ_BYTES."""
        held, of, end = [], None, 0
        for batch in batches:
            for uri, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (uri != of or at != end or end - held[0][0] >= READ_BYTES):
                    yield of, held
                    held = []
                held.append((at, n))
                of, end = uri, at + n
        if held:
            yield of, held

    def work(batches):
        file, opened = None, None
        for uri, held in ranges(batches):
            if uri != opened:
                store, path = file_system(uri)
                file, opened = store.open_input_file(path), uri
            begin = held[0][0]
            data = file.read_at(held[-1][0] + held[-1][1] - begin, begin)
            out = []
            for at, n in held:
                head, http, payload = parse(data[at - begin:at - begin + n])
                size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                kind = head["WARC-Type"]
                if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"damaged payload in {uri} at {at}")
                ids = [re.fullmatch(r"<urn:page:(-?\d*)>", head[k])[1] if k in head else ""
                       for k in ("WARC-Record-ID", "WARC-Refers-To")]
                out.append((int(ids[0]) if ids[0] else None, head.get("WARC-Target-URI"), size, digest, kind,
                            int(ids[1]) if ids[1] else None, payload if kind == "response" else None))
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return rows.mapInArrow(work, "page_id long, url string, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long, payload binary")


def archived(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives with their index and reads every record back through it.

    Per row: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.
    """
    files = write_index(write_archives(pages))
    return read_records(scan_index(files), reading_tasks(files)).drop("payload", "url")

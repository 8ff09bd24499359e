"""Cutting JSON files into events without parsing their types.

A file holds an array of events, or objects one after another.  Files are cut
by byte ranges: a range may begin anywhere, inside a text or deep in an event,
so a first pass notes for every range of a long file how it changes the two
things that matter, under both possible beginnings: whether a text is open
(parity of its unescaped quotes) and how deep the brackets are.  Running sums
of these give the true state at each range's begin.  The second pass emits the
events whose separator lies in its range and reads on past the range's end for
the last one, so each event comes once, whole, from one task.  Memory is one
range plus one event.

What an event holds is not looked at: unknown fields and values of other types
arrive as they are.  Bytes that belong to no whole event (a file that breaks
off, text outside the array) come as records with a ``fault``, so every
non-blank part of a file is in some record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a range; longer files are cut into several.
RANGE_BYTES = 4 << 20
#: An event of more bytes comes in pieces, as faulty records.
MOST_EVENT_BYTES = 64 << 20
#: Bytes that a reading task should see.
TASK_BYTES = 64 << 20

BLANK = b" \t\r\n"
RECORDS = "record string, fault string, source_file string, position long"

_QUOTE, _ESCAPE, _COMMA = ord('"'), ord("\\"), ord(",")
_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[[ord("["), ord("{")]] = True
_CLOSE[[ord("]"), ord("}")]] = True


def open_file(path: str):
    """The file of a path as a listing names it: without escapes, whatever signs are in it."""
    from urllib.parse import quote

    import pyarrow.fs as pafs
    scheme, sign, rest = path.partition(":")
    if not sign or "/" in scheme:
        return pafs.LocalFileSystem().open_input_file(path)
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    host, _, inner = rest.removeprefix("//").partition("/")
    store, inner = pafs.FileSystem.from_uri(f"{scheme}://{host}/{quote(inner)}")
    return store.open_input_file(inner)


class Scanner:
    """Structural bytes of a stretch of JSON, outside texts, piece after piece."""

    def __init__(self, in_text: bool = False, depth: int = 0, escapes: int = 0):
        self.in_text, self.depth, self.escapes = in_text, depth, escapes

    def quotes(self, data: np.ndarray) -> np.ndarray:
        """Positions of quotes that no odd run of backslashes stands before."""
        at = np.flatnonzero(data == _QUOTE)
        slashes = data == _ESCAPE
        run = 0
        if slashes.any() or self.escapes:
            last = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(data))))  # last byte that is none
            before = at - 1 - np.where(at > 0, last[np.maximum(at - 1, 0)], -1)
            before += np.where(before == at, self.escapes, 0)
            at = at[before % 2 == 0]
            run = len(data) - 1 - int(last[-1]) if len(data) else 0
            run += self.escapes if run == len(data) else 0
        self.escapes = run
        return at

    def scan(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(positions, depth behind each)`` of brackets and commas outside texts; the state moves on."""
        quotes = self.quotes(data)
        at = np.flatnonzero(_OPEN[data] | _CLOSE[data] | (data == _COMMA))
        at = at[(np.searchsorted(quotes, at) + self.in_text) % 2 == 0]
        kind = data[at]
        depth = self.depth + np.cumsum(_OPEN[kind].astype(np.int64) - _CLOSE[kind].astype(np.int64))
        self.in_text = bool((len(quotes) + self.in_text) % 2)
        if len(depth):
            self.depth = int(depth[-1])
        return at, depth


def _escapes_before(f, start: int) -> int:
    """Backslashes right before a position."""
    found, step = 0, 256
    while start:
        lo = max(0, start - step)
        f.seek(lo)
        data = f.read(start - lo)
        kept = len(data.rstrip(b"\\"))
        found += len(data) - kept
        if kept:
            break
        start = lo
    return found


def _is_array(f) -> bool:
    """Whether the file's first byte that says something opens an array."""
    f.seek(0)
    head = f.read(4096)
    head = head[3:] if head.startswith(b"\xef\xbb\xbf") else head
    while head and not head.lstrip(BLANK):
        head = f.read(4096)
    return head.lstrip(BLANK)[:1] == b"["


def range_state(f, start: int, end: int) -> tuple[int, int, int]:
    """``(odd number of quotes, depth gained if no text is open at the begin, if one is)``."""
    escapes = _escapes_before(f, start)
    f.seek(start)
    data = np.frombuffer(f.read(end - start), np.uint8)
    closed, opened = Scanner(False, 0, escapes), Scanner(True, 0, escapes)
    closed.scan(data)
    opened.scan(data)
    return int(closed.in_text), closed.depth, opened.depth


def _cuts(array: bool, data: np.ndarray, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that part events, and their kind: array begins (0), comma (1), ends (2), object ends (3)."""
    kind = data[at]
    if not array:
        cut = (kind == ord("}")) & (depth == 0)
        return at[cut], np.full(int(cut.sum()), 3)
    begins, ends = (kind == ord("[")) & (depth == 1), (kind == ord("]")) & (depth == 0)
    comma = (kind == _COMMA) & (depth == 1)
    cut = begins | ends | comma
    return at[cut], np.where(begins, 0, np.where(comma, 1, 2))[cut]


def range_events(f, length: int, start: int, end: int, in_text: bool, depth: int,
                 most: int = MOST_EVENT_BYTES) -> Iterator[tuple[bytes, str | None, int]]:
    """``(bytes, fault, position)`` of the records that begin in ``[start, end)`` of a file."""
    array = _is_array(f)
    scanner = Scanner(in_text, depth, _escapes_before(f, start))
    f.seek(start)
    block = f.read(end - start)
    at = start
    held, held_at, before = (b"", 0, 2) if start == 0 else (None, 0, None)  # what stands before the first cut belongs to range 0

    def record(raw, position, last, this):
        text = raw.removeprefix(b"\xef\xbb\xbf") if position == 0 else raw
        body = text.strip(BLANK)
        if not body:
            return None
        inside = this == 3 or (last in (0, 1) and this in (1, 2))
        return body, None if inside else "unterminated" if this is None else "outside_array", position

    while True:
        data = np.frombuffer(block, np.uint8)
        cuts, kinds = _cuts(array, data, *scanner.scan(data))
        done = 0
        for cut, kind in zip(cuts.tolist(), kinds.tolist(), strict=True):
            stop = cut + 1 if kind == 3 else cut
            if held is not None:
                found = record(held + block[done:stop], held_at, before, kind)
                if found:
                    yield found
            if at + cut >= end:  # the next range's
                return
            held, held_at, before, done = b"", at + cut + 1, kind, cut + 1
        if held is not None:
            held += block[done:]
            if len(held) > most:
                yield held, "too_long", held_at
                held, held_at = b"", held_at + len(held)
                most = 0  # its other pieces too
        at += len(block)
        if held is None or at >= length:
            break
        block = f.read(min(1 << 20, length - at))
        if not block:
            break
    if held is not None:
        found = record(held, held_at, before, None)
        if found:
            yield found


def _ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    parts = F.ceil(F.col("length") / range_bytes)
    rows = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)).alias("i"))
    return rows.select("path", "length", "i", (F.col("i") * range_bytes).alias("start"),
                       F.least((F.col("i") + 1) * range_bytes, F.col("length")).alias("end"))


def cut_events(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records ``record, fault, source_file, position`` of the files ``(path, length)``.

    ``position`` is the record's first byte in its file.
    """
    total, longest = files.agg(F.sum("length"), F.max("length")).first()
    tasks = max(1, -(-(total or 0) // TASK_BYTES), min(files.sparkSession.sparkContext.defaultParallelism, -(-(total or 0) // (1 << 20))))
    ranges = _ranges(files, range_bytes)

    def states(batches):
        for batch in batches:
            got = []
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
                with open_file(path) as f:
                    got.append(range_state(f, start, end))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([g[k] for g in got], pa.int64()) for k in range(3))],
                names=[*batch.schema.names, "odd", "gain_closed", "gain_open"])

    schema = "path string, length long, i long, start long, end long"
    if longest and longest > range_bytes:
        long_ones = ranges.where(F.col("length") > range_bytes).repartition(tasks, "path", "i")
        known = long_ones.mapInArrow(states, f"{schema}, odd long, gain_closed long, gain_open long")
        before = Window.partitionBy("path").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
        known = known.withColumn("in_text", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
        gain = F.when(F.col("in_text"), F.col("gain_open")).otherwise(F.col("gain_closed"))
        known = known.withColumn("gain", gain).withColumn("depth", F.coalesce(F.sum("gain").over(before), F.lit(0)))
        known = known.drop("odd", "gain_closed", "gain_open", "gain")
        ranges = ranges.where(F.col("length") <= range_bytes).withColumns({"in_text": F.lit(False), "depth": F.lit(0).cast("long")})
        ranges = ranges.unionByName(known)
    else:
        ranges = ranges.withColumns({"in_text": F.lit(False), "depth": F.lit(0).cast("long")})

    def events(batches):
        for batch in batches:
            for path, length, start, end, in_text, depth in zip(
                    *(batch.column(c).to_pylist() for c in ("path", "length", "start", "end", "in_text", "depth")), strict=True):
                out, size = [], 0
                with open_file(path) as f:
                    for raw, fault, position in range_events(f, length, start, end, in_text, depth):
                        try:
                            text = raw.decode()
                        except UnicodeDecodeError:
                            text, fault = raw.decode(errors="backslashreplace"), "bad_encoding"
                        out.append((text, fault, path, position))
                        size += len(raw)
                        if size > RANGE_BYTES:
                            yield _records(out)
                            out, size = [], 0
                if out:
                    yield _records(out)

    return ranges.repartition(tasks, "path", "i").mapInArrow(events, RECORDS)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                      names=[c.split()[0] for c in RECORDS.split(", ")])

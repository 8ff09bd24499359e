"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units turn into typed
placeholders, all other words into lower case without punctuation.  Windows of
``WINDOW`` template tokens of the benchmark and of all documents meet in a hash
join, so that a question counts even if its numbers or names were replaced.
Windows with fewer than ``LITERAL`` real words say too little as templates; an
item shorter than a window is one window of its own length.  A capitalised word
that opens a sentence may be a name or not and is read both ways.  Each window that
is not all numbers is also compared literally, all its words in lower case, so
that exact copies count whatever stands before them and however few real words
they have.  A text of numbers only equals the same whole text.

Matches of one document and item at one offset form an alignment.  There, each
value of the item's slots has to stand for one value throughout ("3" for "7"
everywhere, "Anna" for "Tom" everywhere); positions that break this are not
counted.  A document is contaminated by an item if the alignments together
cover at least ``COVER`` of the item's windows, or of those that say enough as
templates, or ``RUN`` windows.

Before the join, documents' windows pass a bitmap of 2**24 places that the
benchmark's windows set, 2 MB whatever the benchmark's size; it only spares
the shuffle and never decides.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import text as tx
from tillroll.llm.common import written

WINDOW, LITERAL = 8, 4
COVER, RUN = 0.5, 6
PLACE_BITS = 24

#: Units of measure, money and time (fixed values), matched after a number.
UNITS = (
    "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "foot", "feet", "yd", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "gram", "grams", "ton", "tons", "tonne", "tonnes", "oz", "lb", "lbs", "pound", "pounds",
    "ml", "cl", "l", "litre", "litres", "liter", "liters", "gallon", "gallons",
    "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hr", "hour", "hours",
    "day", "days", "week", "weeks", "month", "months", "year", "years",
    "percent", "degree", "degrees", "celsius", "fahrenheit", "kelvin", "mph", "kmh", "kph",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur", "gbp",
    "w", "kw", "mw", "kwh", "v", "volt", "volts", "a", "amp", "amps", "j", "joule", "joules", "n", "newton", "newtons",
    "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb",
)
NUMBER, NAME, UNIT = (np.uint64(v) for v in (0x51ED27001, 0x51ED27002, 0x51ED27003))

_ROWS = "id long, pos long, h long, slots array<long>, good boolean, n_windows long, n_good long"
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;\n\r"]] = True


def _unit_hashes() -> np.ndarray:
    joined = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    return np.sort(tx.hash_spans(joined, *tx.spans(joined != 32)))


def tokens(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template token, slot value (0 for a real word) and start of each word of a block of bytes."""
    token, slot, starts, _, _ = _read(raw)
    return token, slot, starts


def _read(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """As :func:`tokens`, and each word's value and whether it is a real word that may be a name.

    A word is a run of letters, digits and bytes of other scripts; a point or
    comma between digits belongs to the number.  A name is a capitalised word
    (not one all in capitals) that does not open a sentence; one that does may be a name.
    """
    low = tx.LOWER[raw].copy()
    # capitals of Latin-1 in UTF-8: C3 80..9E
    latin = np.flatnonzero(raw == 0xC3)
    latin = latin[latin + 1 < len(raw)]
    latin = latin[(raw[latin + 1] >= 0x80) & (raw[latin + 1] <= 0x9E) & (raw[latin + 1] != 0x97)]
    low[latin + 1] += 0x20
    inside = _WORD[raw]
    digit = _DIGIT[raw]
    marks = np.flatnonzero((raw == 0x2E) | (raw == 0x2C))
    marks = marks[(marks > 0) & (marks + 1 < len(raw))]
    marks = marks[digit[marks - 1] & digit[marks + 1]]
    inside[marks] = True
    starts, ends = tx.spans(inside)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, starts, none, np.zeros(0, dtype=bool)
    value = tx.hash_spans(low, starts, ends)
    number = digit[starts]
    unit = np.zeros(len(starts), dtype=bool)
    unit[1:] = number[:-1]
    known = _unit_hashes()
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    unit &= (known[at] == value) & ~number
    capital = _UPPER[raw[starts]]
    is_latin = np.zeros(len(raw), dtype=bool)
    is_latin[latin] = True
    capital |= is_latin[starts]
    second = np.minimum(starts + np.where(is_latin[starts], 2, 1), len(raw) - 1)
    capital &= (second < ends) & ~_UPPER[raw[second]] & ~is_latin[second]
    # a sentence opens at the start and where the gap before the word has a stop
    stops = np.concatenate([[0], np.cumsum(_STOP[raw])])
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = stops[starts[1:]] > stops[ends[:-1]]
    name = capital & ~opens & ~number
    token = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    slot = np.where(number | unit | name, value, np.uint64(0))
    return token, slot, starts, value, capital & opens & (slot == 0)


def _windows(token: np.ndarray, slot: np.ndarray, value: np.ndarray, either: np.ndarray, width: int):
    """The keys of the windows of ``width`` tokens: ``(pos, hash, names, good)`` and which windows count and say enough.

    ``names`` is 0 for the literal key, else has a bit for each word that may be a
    name and is read as one, above the lowest bit, which marks templates.
    """
    n = len(token) - width + 1
    scale = [np.uint64(pow(0x9FB21C651E98DF25, i, 1 << 64)) for i in range(width + 1)]
    start = np.uint64(width) * scale[width]
    literal, h = np.full(n, start, dtype=np.uint64), np.full(n, start, dtype=np.uint64)
    mixed_value, mixed = tx.mix(value), tx.mix(token)
    for i in range(width):
        literal += scale[width - 1 - i] * mixed_value[i:i + n]
        h += scale[width - 1 - i] * mixed[i:i + n]
    real = np.concatenate([[0], np.cumsum(slot == 0)])
    real = real[width:] - real[:n]
    # numbers are so wherever they stand, names are not
    words = np.concatenate([[0], np.cumsum(token != NUMBER)])
    counts = words[width:] > words[:n]
    enough = min(LITERAL, width)
    good = real >= enough
    pos = np.flatnonzero(good)
    left, key, names = real[pos], h[pos], np.ones(len(pos), np.int64)
    # every choice of readings, as long as enough real words are left
    if either.any():
        mix_name = tx.mix(np.array([NAME], np.uint64))[0]
        for i in range(width):
            more = np.flatnonzero(either[pos + i] & (left > enough))
            if len(more):
                at = pos[more]
                key = np.concatenate([key, key[more] + scale[width - 1 - i] * (mix_name - mixed[at + i])])
                names = np.concatenate([names, names[more] | (2 << i)])
                left = np.concatenate([left, left[more] - 1])
                pos = np.concatenate([pos, at])
    # a template without slots is its own literal key
    plain = np.flatnonzero(counts & (real < width))
    pos = np.concatenate([pos, plain])
    key = np.concatenate([key, literal[plain]])
    names = np.concatenate([names, np.zeros(len(plain), np.int64)])
    return pos, tx.mix(key), names, counts, good


def _whole(value: np.ndarray) -> int:
    """A key of a whole text."""
    return int.from_bytes(blake2b(value.tobytes(), digest_size=8).digest(), "little")


def _texts(column: pa.Array):
    """Tokens and slots of each text, block after block."""
    for i, token, slot, _, _ in _parts(column):
        yield i, token, slot


def _parts(column: pa.Array):
    """Tokens, slots, values and possible names of each text; a longer text in pieces that are joined."""
    data, offsets = tx.string_bytes(column)
    for lo, hi in tx.blocks(offsets):
        part = data[offsets[lo]:offsets[hi]]
        if hi - lo == 1 and len(part) > tx.BLOCK:
            found = [_read(p) for p in tx.pieces(part)]
            token, slot, _, value, either = (np.concatenate(c) for c in zip(*found, strict=True))
            yield lo, token, slot, value, either
            continue
        own = offsets[lo:hi + 1] - offsets[lo]
        # a newline between texts keeps words and sentences apart
        gaps = np.insert(part, own[1:-1], 10)
        token, slot, starts, value, either = _read(gaps)
        first = np.searchsorted(starts, own + np.arange(len(own)))
        for i in range(hi - lo):
            at = slice(first[i], first[i + 1])
            yield lo + i, token[at], slot[at], value[at], either[at]


def _slots(slot: np.ndarray, value: np.ndarray, names: int) -> list[int]:
    """Values of a window's slots, with the words read as names; none for the literal key."""
    if not names:
        return []
    read = (names >> np.arange(1, len(slot) + 1)) & 1 == 1
    return value[(slot != 0) | read].view(np.int64).tolist()


def _rows(batches, widths, bitmap=None):
    """Windows' keys as rows; ``widths`` gives those wanted for a text of so many tokens."""
    def marked(h):
        at = h >> np.uint64(64 - PLACE_BITS)
        return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    for batch in batches:
        ids = batch.column(0).to_pylist()
        out = [[], [], [], [], [], [], []]
        for i, token, slot, value, either in _parts(batch.column(1)):
            if len(token) and (token == NUMBER).all():
                h = np.array([_whole(value)], np.uint64)
                if bitmap is None or marked(h)[0]:
                    for column, x in zip(out, (ids[i], 0, int(h.view(np.int64)[0]), [], False, 1, 0), strict=True):
                        column.append(x)
                continue
            for width in widths(len(token)):
                pos, h, names, counts, good = _windows(token, slot, value, either, width)
                hit = np.arange(len(pos)) if bitmap is None else np.flatnonzero(marked(h))
                if not len(hit):
                    continue
                pos, h, names = pos[hit], h[hit], names[hit].tolist()
                out[0] += [ids[i]] * len(hit)
                out[1] += pos.tolist()
                out[2] += h.view(np.int64).tolist()
                out[3] += [_slots(slot[p:p + width], value[p:p + width], m) for p, m in zip(pos.tolist(), names, strict=True)]
                out[4] += good[pos].tolist()
                out[5] += [int(counts.sum())] * len(hit)
                out[6] += [int(good.sum())] * len(hit)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out, types, strict=True)],
            names=["id", "pos", "h", "slots", "good", "n_windows", "n_good"])


def _bitmap(items: DataFrame) -> np.ndarray:
    """One bit for each value of the windows' upper ``PLACE_BITS`` bits."""
    place = F.shiftrightunsigned("h", 64 - PLACE_BITS) + 1  # the functions count places from 1
    rows = items.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()  # 2**24 bits at most
    size = 1 << 12
    out = np.zeros(1 << (PLACE_BITS - 3), dtype=np.uint8)
    for r in rows:
        out[(r["part"] - 1) * size:r["part"] * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs ``doc_id, item_id, n_windows, matched, cover`` of documents and items they contain.

    ``matched`` counts the item's windows that consistent alignments cover, ``cover``
    is their share of all windows but those of numbers only, or of those that say enough as
    templates, whichever is larger.  A null or empty text matches nothing; rows without an id take no part; rows that share an id count as one text;
    repeated rows change nothing.  Other columns are left aside.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long"), "text")
    items = items.mapInArrow(lambda b: _rows(b, lambda n: [min(n, WINDOW)] if n else []), _ROWS)
    items = written(items, "items")
    shared = spark.sparkContext.broadcast(_bitmap(items))
    # the widths of shorter windows, fewer than WINDOW
    short = benchmark.select("text").mapInArrow(_short_widths, "width int").distinct().collect()
    widths = sorted({r["width"] for r in short} | {WINDOW})

    def work(batches):
        return _rows(batches, lambda n: [w for w in widths if w <= n], shared.value)

    found = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(work, _ROWS)
    found = found.select(F.col("id").alias("doc_id"), F.col("pos").alias("at"), "h", F.col("slots").alias("values"))
    items = items.select(F.col("id").alias("item_id"), "pos", "h", "slots", "good", "n_windows", "n_good")
    hits = written(found.join(items, "h"), "hits")
    hits = hits.withColumn("shift", F.col("at") - F.col("pos"))
    # the slot values of one alignment: each of the item's may stand for one of the document's only
    line = ["doc_id", "item_id", "shift"]
    pairs = hits.select(*line, F.explode(F.arrays_zip("slots", "values")).alias("z"))
    pairs = pairs.groupBy(*line, F.col("z.slots").alias("slot")).agg(
        F.min("z.values").alias("lo"), F.max("z.values").alias("hi"))
    broken = pairs.where("lo <> hi").groupBy(*line).agg(F.collect_set("slot").alias("broken"))
    hits = hits.join(broken, line, "left")
    hits = hits.where(F.col("broken").isNull() | ~F.arrays_overlap("slots", "broken"))
    per = hits.groupBy("doc_id", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("n_good").alias("n_good"),
        F.countDistinct("pos").alias("matched"), F.countDistinct(F.when(F.col("good"), F.col("pos"))).alias("enough"))
    cover = F.greatest(F.col("matched") / F.col("n_windows"),
                       F.when(F.col("n_good") > 0, F.col("enough") / F.col("n_good")))
    per = per.select("doc_id", "item_id", "n_windows", "matched", cover.alias("cover"))
    return per.where((F.col("cover") >= COVER) | (F.col("matched") >= RUN))


def _short_widths(batches):
    for batch in batches:
        found = {len(t) for _, t, _ in _texts(batch.column(0))}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(w for w in found if 0 < w < WINDOW), pa.int32())], names=["width"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents; rows without ``doc_id`` stay."""
    gone = written(contaminated(docs, benchmark).select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")

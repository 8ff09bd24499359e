"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of ordinary text and
one on windows of toxic text, and each window of a document is compressed
after either.  The bytes that the toxic dictionary saves over the ordinary one
are the window's gain.  A window is one word in a fixed frame: a frame that
both dictionaries hold costs the same few bytes, so that differences of two or
three bytes stand out, which they do not in windows of many random words.

Only documents carry labels, and most words of a toxic document are ordinary.
So the toxic dictionary is trained on words that, or whose beginnings, far more
toxic than ordinary documents of the sample have, beyond chance; a second round takes those of
them that it really shortens, and puts common ordinary words that it shortens by
mistake into the ordinary samples again.  The window threshold is the gain that one
in ten thousand windows of ordinary documents exceeds.  A document's score is
a logistic function of its largest gain, its number of windows above the
threshold and, if there are any, its length, calibrated on documents that the
dictionaries have not seen; then the dictionaries are trained again on all.

Fitting uses a bounded sample: ``PER_CLASS`` documents of each label, chosen by
a hash of their id, of at most ``SAMPLE_CHARS`` characters each.  Scoring reads
every whole text.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillroll.llm import text as tx

PER_CLASS, SAMPLE_CHARS = 3000, 10_000
ORDINARY_BYTES, TOXIC_BYTES = 64 << 10, 4 << 10
LEVEL, LEAST_GAIN = 19, 2
#: So many toxic documents have to share a word or a beginning.
SUPPORT = 3
#: Ordinary words that this share of documents has are common.
COMMON = 0.01
REPEATED = 0.3
#: Hashing takes some 50 bytes of memory for each byte of a block, and a table as long as the longest block stays.
WINDOW_BYTES, BATCH_BYTES = 64, tx.BLOCK
#: Lengths in bytes at which words of toxic documents are compared: whole, and their beginnings.
STEMS = (WINDOW_BYTES, 8, 6, 5, 4)
KEPT_WINDOWS = 1_000_000
THRESHOLD = 0.3
FRAME = b"a window of text: "

#: Bytes of words: letters, digits and all of other scripts.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def windows(column: pa.Array):
    """``(first text, last text, lower-cased bytes, window starts, ends, text of each)`` by blocks."""
    data, offsets = tx.string_bytes(column)
    for lo, hi in tx.blocks(offsets, BATCH_BYTES):
        part = tx.LOWER[data[offsets[lo]:offsets[hi]]]
        own = offsets[lo:hi + 1] - offsets[lo]
        inside = _IN_WORD[part]
        starts, ends = tx.spans(inside)
        cross = own[1:-1][(own[1:-1] > 0) & (own[1:-1] < len(part))]
        cross = np.unique(cross[inside[cross] & inside[cross - 1]])
        starts, ends = np.sort(np.r_[starts, cross]), np.sort(np.r_[ends, cross])
        if len(starts) and (ends - starts).max() > WINDOW_BYTES:  # very long words are cut
            n = -(-(ends - starts) // WINDOW_BYTES)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            starts, ends = np.repeat(starts, n) + k * WINDOW_BYTES, np.repeat(ends, n)
            ends = np.minimum(ends, starts + WINDOW_BYTES)
        yield lo, hi, part, starts, ends, np.searchsorted(own, starts, side="right") - 1


def _trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary; too few samples are repeated, as the trainer wants some mass."""
    framed = [FRAME + s + b" " for s in samples]
    framed *= 1 + 20 * size // max(1, sum(map(len, framed)))
    for part in (size, size // 4, 1024):
        try:
            return zstandard.train_dictionary(part, framed, level=LEVEL).as_bytes()
        except (zstandard.ZstdError, ValueError, MemoryError):
            continue
    return b"".join(framed)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Searches for the cheapest parse, with matches from three bytes on."""
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=17, hash_log=17, search_log=3, min_match=3, target_length=32,
        strategy=zstandard.STRATEGY_BTULTRA, write_content_size=0, write_checksum=0, write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(content or b"\0" * 8), compression_params=parameters)


class Gains:
    """Bytes that the toxic dictionary saves on a window; those met are kept by hash."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.one, self.two = _compressor(ordinary).compress, _compressor(toxic).compress
        self.kept: dict[int, int] = {}

    def of(self, word: bytes) -> int:
        unit = FRAME + word + b" "
        return len(self.one(unit)) - len(self.two(unit))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        hashes, at, back = np.unique(tx.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        raw, kept = data.tobytes(), self.kept
        if len(kept) > KEPT_WINDOWS:
            kept.clear()
        gains = np.empty(len(hashes))
        for i, (h, a, z) in enumerate(zip(hashes.tolist(), starts[at].tolist(), ends[at].tolist(), strict=True)):
            g = kept.get(h)
            if g is None:
                g = kept[h] = self.of(raw[a:z])
            gains[i] = g
        return gains[back]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    window_threshold: float
    weights: np.ndarray

    def features(self, column: pa.Array, gains: Gains | None = None) -> np.ndarray:
        """Per text: largest gain, log of the windows above the threshold, and log of all if there are such.

        Without one, length says nothing: short clean texts and empty ones score alike.
        """
        gains = gains or Gains(self.ordinary, self.toxic)
        out = np.zeros((len(column), 3))
        for lo, hi, data, starts, ends, of in windows(column):
            g = gains(data, starts, ends)
            best = np.zeros(hi - lo)
            np.maximum.at(best, of, g)
            out[lo:hi, 0] = best
            hits = np.bincount(of, g >= self.window_threshold, hi - lo)
            out[lo:hi, 1] = np.log1p(hits)
            out[lo:hi, 2] = np.log1p(np.bincount(of, minlength=hi - lo)) * (hits > 0)
        return out

    def score(self, column: pa.Array, gains: Gains | None = None) -> np.ndarray:
        z = np.clip(self.features(column, gains) @ self.weights[1:] + self.weights[0], -30, 30)
        return 1 / (1 + np.exp(-z))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - 0.05 * w)
    return w


def _words(texts: list[str]) -> list[set[bytes]]:
    """The distinct windows of each text, without texts that mostly repeat earlier ones.

    A text of which more than ``REPEATED`` of the three-word runs came before is
    a copy; copies would pass their rare words off as common.
    """
    found, seen = [], set()
    for text in texts:
        words, runs = set(), []
        for _, _, data, starts, ends, _ in windows(pa.array([text], pa.string())):
            raw = data.tobytes()
            words.update(raw[a:z] for a, z in zip(starts.tolist(), ends.tolist(), strict=True))
            h = tx.hash_spans(data, starts, ends)
            runs.append(tx.mix(tx.mix(h[:-2] + h[1:-1] * np.uint64(3)) + h[2:] * np.uint64(5)) if len(h) > 2 else h)
        runs = set(np.concatenate(runs).tolist()) if runs else set()
        if len(runs & seen) <= REPEATED * len(runs):
            found.append(words)
            seen |= runs
    return found


def _marks(n: int, m: int, toxic: int, ordinary: int, tried: int) -> bool:
    """Whether n of the toxic and m of the ordinary documents are too uneven for chance.

    Chernoff's bound on the count, against as many tries; and the share among
    the toxic has to be nine times that among the ordinary.
    """
    if n * ordinary < 9 * m * toxic:
        return False
    share, usual = n / (n + m), toxic / (toxic + ordinary)
    gap = share * np.log(share / usual) + (0 if share == 1 else (1 - share) * np.log((1 - share) / (1 - usual)))
    return (n + m) * gap >= np.log(10 * tried)


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary of two lists of texts."""
    bad, good = _words(toxic), _words(ordinary)
    known = Counter(w for words in good for w in words)
    plain = [w for words in good for w in sorted(words)]
    base = _trained(plain, ORDINARY_BYTES)
    picked = set()
    for size in STEMS:  # whole words, then beginnings that toxic words share
        whole = size == WINDOW_BYTES
        on, off = (Counter(stem for words in texts for stem in {w[:size] for w in words if whole or len(w) > size})
                   for texts in (bad, good))
        stems = {stem for stem, n in on.items() if n >= SUPPORT and _marks(n, off[stem], len(bad), len(good), len(on))}
        picked |= {w for words in bad for w in words if w[:size] in stems}
    picked = picked or {w for words in bad for w in words if w not in known} or {w for words in bad for w in words}
    marked = _trained([w for words in bad for w in sorted(words & picked)], TOXIC_BYTES)
    gains = Gains(base, marked)
    often = max(SUPPORT, COMMON * len(good))
    hard = sorted(w for w, n in known.items() if n >= often and gains.of(w) >= LEAST_GAIN)
    again = {w for w in picked if gains.of(w) >= LEAST_GAIN} or picked
    base = _trained(plain + hard * 20, ORDINARY_BYTES)
    return base, _trained([w for words in bad for w in sorted(words & again)], TOXIC_BYTES)


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """Train on two thirds of each list, calibrate on the rest, then train the dictionaries on all.

    With one label missing, the score is constant: 0 without toxic documents.
    """
    if not toxic or not ordinary:
        return Model(b"", b"", 1.0, np.array([30.0 if toxic else -30.0, 0, 0, 0]))
    cut_t, cut_o = -(-2 * len(toxic) // 3), -(-2 * len(ordinary) // 3)
    rest_t, rest_o = toxic[cut_t:] or toxic, ordinary[cut_o:] or ordinary
    base, marked = dictionaries(toxic[:cut_t], ordinary[:cut_o])
    gains = Gains(base, marked)
    clean = [gains(*w[2:5]) for w in windows(pa.array(rest_o, pa.string()))]
    clean = np.concatenate([*clean, np.zeros(1)])
    model = Model(base, marked, float(max(LEAST_GAIN, np.quantile(clean, 0.9999))), np.zeros(4))
    x = model.features(pa.array(rest_t + rest_o, pa.string()), gains)
    y = np.array([1.0] * len(rest_t) + [0.0] * len(rest_o))
    model.weights = _logistic(x, y)
    model.ordinary, model.toxic = dictionaries(toxic, ordinary)
    return model


def held_out() -> Column:
    """Rows whose label takes no part: crc32 of the id as text modulo 4 is 2; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit_tables(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out.

    An id labelled more than once is toxic if any of its labels says so; null
    labels and ids count as none.
    """
    marks = labels.where("toxic is not null and doc_id is not null").where(~held_out())
    marks = marks.groupBy(F.col("doc_id").alias("marked_id")).agg((F.max("toxic") > 0).alias("marked"))
    order = F.xxhash64("marked_id")
    picked = [marks.where(F.col("marked") == on).orderBy(order, "marked_id").limit(PER_CLASS) for on in (True, False)]
    picked = F.broadcast(picked[0].union(picked[1]))  # at most 2 * PER_CLASS ids
    rows = docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS)
    rows = rows.join(picked, F.col("doc_id") == F.col("marked_id"))
    rows = rows.groupBy("doc_id", "marked").agg(F.min("text").alias("text"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return fit([r["text"] for r in rows if r["marked"]], [r["text"] for r in rows if not r["marked"]])


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole ``text`` in the column ``name``; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size
    at = docs.columns.index("text")

    def work(batches):
        model = shared.value
        gains = Gains(model.ordinary, model.toxic)
        for batch in batches:
            score = pa.array(model.score(batch.column(at).cast(pa.string()), gains))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, name])

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``.

    Rows are judged one by one: repeated rows repeat, a null text is judged as
    an empty one, a null id is kept.  Other columns are left aside.
    """
    model = fit_tables(docs, labels)
    scored = with_scores(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those scored as toxic, all columns as they are."""
    name = "score"
    while name in docs.columns:
        name += "_"
    return with_scores(docs, fit_tables(docs, labels), name).where(F.col(name) < THRESHOLD).drop(name)

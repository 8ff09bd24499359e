"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct k-word shingles (A-Z lower-cased, words
without blanks).  Two permutations of a universe of 2**20 places make every
signature coordinate: the first spreads the shingles, the second, shifted
circularly by one more place for each coordinate, ranks them.  As the shift
makes the coordinates of a shingle neighbours in the second permutation, a
whole signature row is one contiguous read.

Six coordinates form a band.  With 42 bands a pair at similarity 0.8 shares
none with a probability of 3e-6, and one at 0.1 shares some with 4e-5.

Work is on distinct sets only; equal sets form a class whose members are
linked by definition.  In every bucket of a band, all are compared with its
smallest document first, on full sets.  Buckets that then still hold several
components are closed: each document outside the largest component streams by
the bucket's members, held in blocks of bounded bytes, with 8 bits of every
coordinate as a filter (a link passes with all but a probability of 1e-6) before
the exact comparison.  Pairs inside a component are never compared, those that
a block has tied together neither, and only links leave a block.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import text as tx
from tillroll.llm.common import connected_components, with_links, written

PLACES = 1 << 20
ROWS, BANDS = 6, 42
COORDINATES = ROWS * BANDS
#: Share of equal coordinates below which a pair is not compared: five deviations under 0.8.
LEAST_AGREEMENT = 0.68
NEED = LEAST_AGREEMENT + (1 - LEAST_AGREEMENT) / 256
SALTS = 64
#: A block holds so many bytes of texts and sketches (a longer text alone), and at most so many documents stream by it.
BLOCK_BYTES, STREAMED = 4 << 20, 8192

_SIGNED = "doc_id long, n_shingles long, digest binary, keys array<long>, sketch binary"
_perms: list[np.ndarray] = []


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    if not _perms:
        rng = np.random.default_rng(20240229)
        spread = rng.permutation(PLACES).astype(np.int64)
        rank = rng.permutation(PLACES).astype(np.uint32)
        ring = np.concatenate([rank, rank[:COORDINATES - 1]])
        _perms[:] = [spread, np.lib.stride_tricks.sliding_window_view(ring, COORDINATES)]
    return _perms[0], _perms[1]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of all words as one, if fewer."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        h = tx.mix(h * np.uint64(0x9FB21C651E98DF25) + words[i:n - width + 1 + i])
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    spread, rows = _permutations()
    at = spread[(shingles >> np.uint64(44)).astype(np.int64)]
    out = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(at), 1024):
        np.minimum(out, rows[at[lo:lo + 1024]].min(axis=0), out=out)
    return out


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for i in range(ROWS):
        h = tx.mix(h * np.uint64(0x9FB21C651E98DF25) + parts[:, :, i])
    return h.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    data, offsets = tx.string_bytes(column)
    for _, words, own in tx.word_hashes(data, offsets):
        for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True):
            yield shingle_set(words[a:b], k)


def signed(docs: DataFrame, k: int) -> DataFrame:
    """Per row: set size, digest of the set, band keys and 8 bits of each coordinate."""
    def work(batches):
        for batch in batches:
            sizes, digests, sigs = [], [], []
            for s in _sets(batch.column(1), k):
                sizes.append(len(s))
                digests.append(_digest(s) if len(s) else None)
                sigs.append(signature(s))
            if not sizes:
                continue
            sig = np.stack(sigs)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(_band_keys(sig).ravel()), BANDS)
            low = (sig & np.uint32(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 keys.cast(pa.list_(pa.int64())), pa.array([r.tobytes() for r in low], pa.binary())],
                names=["doc_id", "n_shingles", "digest", "keys", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, _SIGNED)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose full sets reach the similarity.

    Rows are dealt by the first node and a salt of the second; its text comes
    first in each group, the others stream by.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    heads = salted.select("a", "salt").distinct().join(texts, F.col("a") == F.col("node"))
    heads = heads.select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    rest = salted.join(texts, F.col("b") == F.col("node")).select("a", "salt", "b", "text")
    rows = heads.union(rest).withColumn("g", F.xxhash64("a", "salt"))
    rows = rows.repartition("g").sortWithinPartitions("g", "a", "salt", F.col("b").asc_nulls_first())

    def work(batches):
        heads, of = [], None  # a node has several sets if rows share its id
        for batch in batches:
            a, salt, b = (batch.column(i).to_pylist() for i in range(3))
            links = []
            for i, s in enumerate(_sets(batch.column(3), k)):
                if of != (a[i], salt[i]):
                    heads, of = [], (a[i], salt[i])
                if b[i] is None:
                    heads.append(s)
                elif len(s) and any(_linked(h, s, percent) for h in heads if len(h)):
                    links.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[j] for x in links], pa.int64()) for j in range(2)], names=["a", "b"])

    return rows.select("a", "salt", "b", "text").mapInArrow(work, "a long, b long")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


class _Block:
    """Part of a bucket's members, held; the others stream by and meet them."""

    def __init__(self, k: int, percent: int):
        self.k, self.percent = k, percent
        self.parts: list[pa.RecordBatch] = []
        self.same: dict[int, int] = {}  # components that links of this block tie together
        self.held: dict[int, np.ndarray] = {}

    def add(self, rows: pa.RecordBatch) -> None:
        self.parts.append(rows)

    def _build(self) -> None:
        rows, self.parts = pa.Table.from_batches(self.parts).combine_chunks(), []
        self.node, self.part, self.outside, self.bits, self.keys = _columns(rows)
        self.part = self.part.copy()
        self.text = rows["text"].chunk(0)

    def _full(self, i: int) -> np.ndarray:
        if i not in self.held:
            self.held[i] = next(_sets(self.text.slice(i, 1), self.k))
        return self.held[i]

    def meet(self, rows: pa.RecordBatch) -> list[tuple[int, int]]:
        """Links between ``rows`` and held members of other components; likely ones are tried first."""
        if self.parts:
            self._build()
        node, part, _, bits, keys = _columns(rows)
        bucket, text = rows.column("bucket").to_numpy(), rows.column("text")
        links = []
        for m in range(rows.num_rows):
            own = int(part[m])
            while own in self.same:
                own = self.same[own]
            like = (self.bits == bits[m]).mean(axis=1)
            # two that are both outside the largest component meet as the smaller one streams by
            hit = np.flatnonzero((like >= NEED) & (self.part != own) & (self.node != node[m])
                                 & (~self.outside | (self.node > node[m])))
            if not len(hit):
                continue
            first = (self.keys[hit] == keys[m]).argmax(axis=1)
            hit = hit[keys[m][first] == bucket[m]]
            full = None
            for i in hit[np.lexsort((self.node[hit], -like[hit]))].tolist():
                if self.part[i] == own:
                    continue
                if full is None:
                    full = next(_sets(text.slice(m, 1), self.k))
                if _linked(self._full(i), full, self.percent):
                    links.append((int(min(self.node[i], node[m])), int(max(self.node[i], node[m]))))
                    other = int(self.part[i])
                    self.same[other] = own
                    self.part[self.part == other] = own
        return links


def _columns(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    node, part, outside = (rows.column(c).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch)
                           else rows.column(c).to_numpy() for c in ("node", "component", "outside"))
    bits = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, COORDINATES)
    keys = rows.column("keys")
    keys = (keys if isinstance(keys, pa.Array) else keys.chunk(0)).flatten().to_numpy().reshape(-1, BANDS)
    return node, part, outside, bits, keys


def _across(buckets: DataFrame, sets: DataFrame, texts: DataFrame, labels: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between different components that share a bucket.

    Of a bucket, what is outside its largest component streams by the members,
    held in blocks of bounded bytes with their sketches, keys and texts.  A pair whose
    sketches agree enough is compared on full sets in the first band that it shares,
    so it is compared once and only links leave the block; what a block has linked
    it does not compare again.  Sketches and texts are joined once per node.
    """
    stored = sets.select("node", "sketch", "keys").join(texts, "node")
    stored = written(stored.withColumn("bytes", F.lit(COORDINATES + 8 * BANDS) + F.octet_length("text")), "stored")
    nodes = stored.groupBy("node").agg(F.sum("bytes").alias("bytes")).join(labels, "node", "left")
    nodes = nodes.select("node", "bytes", F.coalesce("component", "node").alias("component"))
    rows = written(buckets.join(written(nodes, "nodes"), "node", "left"), "open")
    per = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    most = F.max(F.struct("n", "component"))
    major = per.groupBy("bucket").agg(
        most["component"].alias("major"), (F.sum("n") - most["n"]).alias("minors"), F.sum("n").alias("all"),
        F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    # two members have met already; one component needs nothing
    major = major.where("minors > 0 and all > 2").withColumn("streams", F.ceil(F.col("minors") / STREAMED).cast("int"))
    rows = rows.join(written(major, "major"), "bucket").select(
        "node", "component", F.struct("bucket", (F.col("component") != F.col("major")).alias("outside"), "blocks", "streams").alias("at"))
    rows = rows.groupBy("node", "component").agg(F.collect_set("at").alias("at"))  # at most the node's bands
    rows = rows.join(stored.drop("bytes"), "node").withColumn("at", F.explode("at"))

    def own(n):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def each(n, row):
        return F.transform(F.sequence(F.lit(0), F.col(n) - 1), row)

    # block (i, j): the i-th stream of those outside by the j-th part of all
    held = each("at.streams", lambda i: F.struct(i.alias("i"), own("at.blocks").alias("j"), F.lit(False).alias("streams")))
    stream = each("at.blocks", lambda j: F.struct(own("at.streams").alias("i"), j.alias("j"), F.lit(True).alias("streams")))
    rows = rows.withColumn("in", F.explode(F.when(F.col("at.outside"), F.concat(held, stream)).otherwise(held)))
    blocks = rows.select("node", "component", "at.bucket", "at.outside", "sketch", "keys", "text", "in.streams",
                         F.xxhash64("at.bucket", "in.i", "in.j").alias("g"))
    blocks = blocks.repartition("g").sortWithinPartitions("g", "streams")

    def work(batches):
        last, block = None, None
        for batch in batches:
            g = batch.column("g").to_numpy()
            streams = batch.column("streams").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (streams[1:] != streams[:-1])) + 1
            links = []
            for lo, hi in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                if block is None or g[lo] != last:
                    last, block = g[lo], _Block(k, percent)
                if streams[lo]:
                    links += block.meet(batch.slice(lo, hi - lo))
                else:
                    block.add(batch.slice(lo, hi - lo))
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[j] for x in links], pa.int64()) for j in range(2)], names=["a", "b"])

    return blocks.mapInArrow(work, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id, n_shingles, component_id, kept``.

    Links join documents with ``100 * intersection >= percent * union``; the
    component is the smallest ``doc_id`` that links reach.  A null or blank text
    has an empty set and links with nothing.  Rows that share a ``doc_id`` are
    one document that has the sets of all.  A row without ``doc_id`` takes no
    part: no component, not kept.  Repeated rows give repeated results; other
    columns are left aside.
    """
    table = written(signed(docs, k), "signed")
    real = table.where("digest is not null and doc_id is not null")
    classes = written(real.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    sets = real.join(classes.withColumnRenamed("digest", "d"),
                     (F.col("doc_id") == F.col("node")) & (F.col("digest") == F.col("d")), "left_semi")
    sets = sets.select(F.col("doc_id").alias("node"), "digest", "keys", "sketch")
    sets = written(sets.dropDuplicates(["node", "digest"]), "sets")

    bands = sets.select("node", F.explode("keys").alias("bucket"))
    shared = written(bands.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n"))
                     .where("n > 1").select("bucket", "head"), "buckets")
    buckets = written(bands.join(shared, "bucket").select("bucket", "head", "node"), "members")
    pairs = written(buckets.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b"))
                    .distinct(), "pairs")

    # the texts of all documents that share a bucket, read once
    met = buckets.select("node").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(met, "node", "left_semi")
    texts = texts.withColumn("h", F.xxhash64("text")).dropDuplicates(["node", "h"]).drop("h")
    texts = written(texts, "texts")
    links = written(_verified(pairs, texts, k, percent), "links")

    # rows of one doc_id with several sets tie their classes together
    ids = real.join(classes, "digest").select("doc_id", "node")
    several = ids.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    several = ids.join(several, "doc_id").select(F.col("lo").alias("a"), F.col("node").alias("b"))
    links = links.union(written(several, "ties"))
    components = written(connected_components(links), "components")
    more = written(_across(buckets.select("bucket", "node"), sets, texts, components, k, percent), "links")
    if not more.isEmpty():
        components = written(with_links(components, more), "components")

    rows = table.join(classes, "digest", "left")
    rows = rows.join(components.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that a smaller one of their component stands for.

    Rows without ``doc_id`` stay.
    """
    gone = near_duplicates(docs, k, percent).where("not kept and doc_id is not null").select("doc_id").distinct()
    gone = written(gone, "gone").withColumnRenamed("doc_id", "gone_id")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")

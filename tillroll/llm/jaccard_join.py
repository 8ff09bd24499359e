"""Jaccard join of word shingles by size-banded tiles and hashed bitmaps.

A document's set holds the hashes of its distinct k-word shingles, sorted; equal
sets form a class that is worked on once.  Sets of similar size share a band
(each band a quarter wider than the last), and a set near a band's upper end
visits the next band too, as partners can be larger by the threshold's share.

Two linked sets in a band differ in at most K shingles, K known from the band's
largest size.  The range of hashes is therefore cut into K + 1 parts: linked
sets agree on at least one part entirely.  A tile is a band, a part and the
part's content; sets meet only inside tiles, so that no linked pair is missed
and sets that merely share passages seldom meet.  A part that is empty tells
little: a set with empty parts is cut a second time by another hash, and tiles
of empty parts are those empty in both cuts.

In a tile, hashed bitmaps (two to four bits per shingle) come first: bits of one set
that the other lacks are shingles that it lacks, which bounds the overlap from
above.  Only pairs whose bound reaches the threshold have their sorted arrays
intersected.  A tile's sets first meet its smallest document, then a second
one of what is not tied yet; tiles that still hold several components are
closed in blocks of bounded bytes, each pair in the first tile that it shares,
and only links leave a block.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import text as tx
from tillroll.llm.common import connected_components, runs, with_links, written

#: Bytes of texts that one side of a block holds (a longer text alone).
BLOCK_BYTES = 8 << 20
#: A head's partners are dealt over so many groups.
SALTS = 64
LEAST_BITS = 64
#: Rounds in which an open tile's nodes meet one more of them, before blocks close it.
STARS = 2

_SIGNED = "doc_id long, n_shingles long, digest binary, keys array<long>, bits binary, bytes long"
_EDGES = [1]


def band(n: int) -> int:
    """Number of the size band that holds sets of ``n``."""
    while _EDGES[-1] <= n:
        _EDGES.append(max(_EDGES[-1] + 1, _EDGES[-1] * 5 // 4))
    return bisect_right(_EDGES, n) - 1


def most_apart(number: int, percent: int) -> int:
    """The most shingles in which linked sets of a band differ: of sizes a and b, (100-p)(a+b)/(100+p)."""
    band(_EDGES[-1] if len(_EDGES) <= number + 1 else 1)
    return 2 * (100 - percent) * (_EDGES[number + 1] - 1) // (100 + percent)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of all words as one, if fewer."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width + 77), dtype=np.uint64)
    for i in range(width):
        h = tx.mix(h * np.uint64(0xD6E8FEB86659FD93) + words[i:n - width + 1 + i])
    return np.unique(h)


def _sets(column: pa.Array, k: int):
    data, offsets = tx.string_bytes(column)
    for _, words, own in tx.word_hashes(data, offsets):
        for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True):
            yield shingle_set(words[a:b], k)


def _cut(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and content hashes of equal parts of the range of (sorted) hashes."""
    borders = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)
    at = np.concatenate([[0], np.searchsorted(hashes, borders), [len(hashes)]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.mix(hashes), dtype=np.uint64)])
    return np.diff(at), sums[at[1:]] - sums[at[:-1]]


def tile_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the tiles of a sorted set: those of its band, and of the next one if partners can lie there."""
    n = len(hashes)
    own = band(n)
    out = []
    for number in {own, band(100 * n // percent)}:
        parts = most_apart(number, percent) + 1
        salt = np.uint64((number * 2 + 1) * 0x632BE59BD9B4E019 % (1 << 64))
        sizes, content = _cut(hashes, parts)
        place = np.arange(parts, dtype=np.uint64)
        full = sizes > 0
        out.append(tx.mix(tx.mix(content[full] + place[full]) ^ salt))
        empty = np.flatnonzero(~full)
        if len(empty):
            # cut once more, by another hash
            sizes, content = _cut(np.sort(tx.mix(hashes ^ salt)), parts)
            again = sizes > 0
            out.append(tx.mix(tx.mix(content[again] + place[again]) ^ ~salt))
            both = np.flatnonzero(~again)
            pairs = (empty[:, None] * parts + both[None, :]).ravel().astype(np.uint64)
            out.append(tx.mix(pairs ^ (salt >> np.uint64(1))))
    return np.unique(np.concatenate(out)).view(np.int64)


def bitmap(hashes: np.ndarray) -> bytes:
    """Two to four bits per shingle: a power of two, so that a longer bitmap folds to a shorter one."""
    bits = LEAST_BITS
    while bits < 2 * len(hashes):
        bits *= 2
    flags = np.zeros(bits, dtype=bool)
    flags[(hashes >> np.uint64(7)) & np.uint64(bits - 1)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[:len(bits) // 2] | bits[len(bits) // 2:]
    return bits


def least_overlap(a, b, percent: int):
    """The smallest overlap at which sets of sizes ``a`` and ``b`` link."""
    return -(-percent * (a + b) // (100 + percent))


def most_overlap(a: np.ndarray, size_a: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """From bitmaps of equal length: no overlap of ``a`` with a row of ``others`` is larger."""
    only_a = np.bitwise_count(a & ~others).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(others & ~a).sum(axis=1, dtype=np.int64)
    return np.minimum(size_a - only_a, sizes - only_b)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def signed(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row: set size, digest of the set, its tiles' keys, bitmap and bytes of text."""
    def work(batches):
        for batch in batches:
            out = []
            for s in _sets(batch.column(1), k):
                if len(s):
                    out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                tile_keys(s, percent).tolist(), bitmap(s)))
                else:
                    out.append((0, None, None, None))
            if out:
                types = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array([r[i] for r in out], t) for i, t in enumerate(types)), batch.column(2)],
                    names=["doc_id", "n_shingles", "digest", "keys", "bits", "bytes"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "text", size).mapInArrow(work, _SIGNED)


def _tiles(sets: DataFrame) -> DataFrame:
    """``key, head, node`` of all tiles that hold several nodes; the head is the smallest node."""
    rows = sets.select(F.explode("keys").alias("key"), "node")
    rows = rows.repartition("key").sortWithinPartitions("key", "node")

    def work(batches):
        last = None  # (key, head, whether the head has been put out)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if last is not None:
                key, node = np.append(last[0], key), np.append(last[1], node)
            new = np.append(True, key[1:] != key[:-1])
            head = node[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
            several = head != node
            # a head belongs in as soon as another node of its tile is seen
            begins = np.flatnonzero(new)
            with_more = np.add.reduceat(several.astype(np.int64), begins) > 0
            keep = several.copy()
            keep[begins[with_more]] = True
            if last is not None and last[2]:
                keep[0] = False
            shown = bool(with_more[-1]) or (len(begins) == 1 and last is not None and last[2])
            last = (key[begins[-1]], node[begins[-1]], shown)
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(head[keep]), pa.array(node[keep])],
                                             names=["key", "head", "node"])

    return rows.mapInArrow(work, "key long, head long, node long")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose bitmaps allow the overlap that they need."""
    cols = {side: sets.select(F.col("node").alias(f"n{side}"), F.col("n_shingles").alias(f"size{side}"),
                              F.col("bits").alias(f"bits{side}")) for side in "ab"}
    rows = pairs.join(cols["a"], F.col("a") == F.col("na")).join(cols["b"], F.col("b") == F.col("nb"))

    def work(batches):
        for batch in batches:
            size_a, size_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint8) for c in (4, 5))
                n = min(len(x), len(y))
                most = most_overlap(_folded(x, n), int(size_a[i]), _folded(y, n)[None, :], size_b[i:i + 1])
                keep[i] = most[0] >= least_overlap(int(size_a[i]), int(size_b[i]), percent)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return rows.select("a", "b", "sizea", "sizeb", "bitsa", "bitsb").mapInArrow(work, "a long, b long")


def _linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets link.

    Rows are dealt by the first node and a salt of the second; its text comes first
    in each group, the others stream by.
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
                elif len(s) and any(len(h) and overlap(h, s) >= least_overlap(len(h), len(s), percent) for h in heads):
                    links.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[j] for x in links], pa.int64()) for j in range(2)], names=["a", "b"])

    return rows.select("a", "salt", "b", "text").mapInArrow(work, "a long, b long")


def _open_tiles(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, node, component`` of tiles whose rows ``(key, node)`` lie in several components.

    Of tiles that hold the same nodes one stays: members of a group share many.
    """
    rows = rows.select("key", "node").join(labels, "node", "left")
    rows = written(rows.select("key", "node", F.coalesce("component", "node").alias("component")), "open")
    mixed = rows.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    kept = mixed.where("lo <> hi").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    return written(rows.join(written(kept.select("key"), "mixed"), "key"), "open")


def _next_heads(rows: DataFrame) -> DataFrame:
    """``key, one, of``: of each open tile, a node outside its largest component, and its component."""
    per = rows.groupBy("key", "component").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node"), "node"))["node"].alias("one"))
    most = per.groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("major"))
    heads = per.join(most, "key").where("component <> major")
    heads = heads.groupBy("key").agg(F.max(F.struct("n", "one", "component")).alias("h"))
    return heads.select("key", F.col("h.one").alias("one"), F.col("h.component").alias("of"))


def _across(rows: DataFrame, sets: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between different components of an open tile, in blocks of bounded bytes.

    Of a tile, what is outside its largest component meets all.  A pair is compared
    in the first tile that it shares.
    """
    shared = rows.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # at most the node's keys
    rows = rows.join(sets.select("node", "bytes", "n_shingles"), "node")
    per = rows.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    major = per.groupBy("key").agg(F.max(F.struct("n", "component", "bytes")).alias("m"), F.sum("bytes").alias("total"))

    def chunks(size):
        return F.greatest(F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")

    major = major.select("key", F.col("m.component").alias("major"), chunks(F.col("total") - F.col("m.bytes")).alias("minors"),
                         chunks(F.col("total")).alias("all"))
    rows = rows.join(written(major, "major"), "key")

    def own(n):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    minors = rows.where("component <> major").withColumn("i", own("minors")).withColumn("j", each("all"))
    others = rows.withColumn("j", own("all")).withColumn("i", each("minors"))
    cols = ["key", "node", "component", "n_shingles", F.xxhash64("key", "i", "j").alias("g")]
    blocks = minors.select(*cols, F.lit(True).alias("minor")).union(others.select(*cols, F.lit(False).alias("minor")))
    blocks = blocks.join(sets.select("node", "bits"), "node").join(shared, "node").join(texts, "node")
    blocks = blocks.repartition("g").sortWithinPartitions("g")

    def work(batches):
        for group in runs(batches, "g"):
            node, part, size = (group[c].to_numpy() for c in ("node", "component", "n_shingles"))
            minor, tile = group["minor"].to_numpy(), group["key"].to_numpy()
            maps = [np.frombuffer(b, np.uint8) for b in group["bits"].to_pylist()]
            width = min(map(len, maps))
            bits = np.stack([_folded(m, width) for m in maps])
            text, keys = group["text"], group["keys"]
            held: dict[int, np.ndarray] = {}

            def full(i):
                if i not in held:
                    held[i] = next(_sets(text.slice(i, 1).combine_chunks(), k))
                return held[i]

            rest = np.flatnonzero(~minor)
            links = []
            for m in np.flatnonzero(minor).tolist():
                most = most_overlap(bits[m], int(size[m]), bits[rest], size[rest])
                can = (most >= least_overlap(size[m], size[rest], percent)) & (part[rest] != part[m]) & (node[rest] != node[m])
                own_keys = np.array(keys[m].as_py())
                for i in rest[can].tolist():
                    if np.intersect1d(own_keys, keys[i].as_py(), assume_unique=True)[0] != tile[i]:
                        continue
                    a, b = full(i), full(m)
                    if overlap(a, b) >= least_overlap(len(a), len(b), percent):
                        links.append((int(min(node[i], node[m])), int(max(node[i], node[m]))))
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[j] for x in links], pa.int64()) for j in range(2)], names=["a", "b"])

    columns = ["node", "component", "n_shingles", "minor", "key", "bits", "keys", "text", "g"]
    return blocks.select(*columns).mapInArrow(work, "a long, b long").distinct()


def components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id, n_shingles, component_id``.

    Links join documents with ``100 * intersection >= percent * union``; the
    component is the smallest ``doc_id`` that links reach.  A null or blank text
    has an empty set and links with nothing.  Rows that share a ``doc_id`` are
    one document that has the sets of all.  A row without ``doc_id`` takes no
    part and has no component.  Repeated rows give repeated results; other
    columns are left aside.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    table = written(signed(docs, k, percent), "signed")
    real = table.where("digest is not null and doc_id is not null")
    classes = written(real.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    sets = real.join(classes.withColumnRenamed("digest", "d"),
                     (F.col("doc_id") == F.col("node")) & (F.col("digest") == F.col("d")), "left_semi")
    sets = written(sets.select(F.col("doc_id").alias("node"), "n_shingles", "digest", "keys", "bits", "bytes")
                   .dropDuplicates(["node", "digest"]), "sets")

    tiles = written(_tiles(sets), "tiles")
    pairs = tiles.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    pairs = written(_possible(pairs, sets, percent).distinct(), "pairs")

    # the texts of all documents that share a tile, read once
    met = tiles.select("node").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(met, "node", "left_semi")
    texts = texts.withColumn("h", F.xxhash64("text")).dropDuplicates(["node", "h"]).drop("h")
    texts = written(texts, "texts")

    # rows of one doc_id with several sets tie their classes together
    ids = real.join(classes, "digest").select("doc_id", "node")
    several = ids.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    several = ids.join(several, "doc_id").select(F.col("lo").alias("a"), F.col("node").alias("b"))
    links = written(_linked(pairs, texts, k, percent).union(several), "links")
    found = written(connected_components(links), "components")
    rows = tiles.where("head <> node")
    for turn in range(STARS + 1):
        rows = _open_tiles(rows, found)
        if rows.isEmpty():
            break
        if turn < STARS:
            heads = written(_next_heads(rows), "heads")
            met = rows.join(heads, "key").where("component <> of")
            pairs = met.select(F.least("one", "node").alias("a"), F.greatest("one", "node").alias("b")).distinct()
            more = _linked(written(_possible(pairs, sets, percent).distinct(), "pairs"), texts, k, percent)
            # the head has met all that it has to
            rows = rows.join(heads.select("key", F.col("one").alias("node")), ["key", "node"], "left_anti")
        else:
            more = _across(rows, sets, texts, k, percent)
        more = written(more, "links")
        if not more.isEmpty():
            found = written(with_links(found, more), "components")

    rows = table.join(classes, "digest", "left")
    rows = rows.join(found.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"))

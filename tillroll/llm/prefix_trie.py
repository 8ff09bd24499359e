"""The trie of conversation prefixes, from sorted sequences and their common prefixes.

Each conversation is a sequence of turns, each turn a 128-bit digest of its role
and text.  All sequences are range-sorted and cut into blocks of bounded size;
texts never move.  Of neighbours in the order the length of the longest common
prefix (LCP) is known, across block borders too.

In a block, a sparse table holds the minimum LCP of every run of ``2**k`` rows.
Each candidate prefix (a row and a depth at which it differs from the row
before) finds the last row that still shares it, and its parent's first row, by
binary search over that table, independently of all others; there is no stack
that is passed from row to row.  What a node reports is then a difference of
running sums over its interval, or a range minimum.

Only nodes that touch a block's border and go on in the next block are put
together by a shuffle: at most the depth of two rows per block.  The ids of
conversations that end at such a node travel as one text per block, and the
hash runs over these texts in order, so a node where a third of all
conversations end needs no list of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import runs, written

#: Bytes of a turn's digest.
WIDTH = 16
#: Turns (or conversations) that a block holds; a longer conversation is a block.
BLOCK_TURNS = 250_000
#: A conversation's base is the one whose id is the next lower multiple of this.
FAMILY = 5
#: The shared turns are fewer than this.
MOST_SHARED = 9
SALTS = 16
EMPTY = hashlib.sha256(b"").hexdigest()

_PIECES = ("block long, open boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, "
           "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends binary")


def sequences(table: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns ``(turn, role, digest, bytes)`` in order.

    Turns come by number, null first; equal numbers by role, then by digest.
    Null role or text counts as empty.  Rows without ``conv_id`` take no part;
    other columns are left aside.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = table.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"),
                 F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(table: DataFrame) -> DataFrame:
    """``conv_id, seq, bytes``: each conversation's own turns after its first h behind its base's first h.

    ``h`` is the unsigned crc32 of the decimal id modulo 9, the base the conversation
    ``conv_id - conv_id % 5``; a base that is absent gives no turns.
    """
    own = written(sequences(table), "turns")
    base = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED - 1).alias("first"))
    rows = own.withColumn("of", F.col("conv_id") - F.col("conv_id") % FAMILY)
    rows = rows.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int"))
    rows = rows.join(base, F.col("of") == F.col("base"), "left")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("first", none), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    rows = rows.select("conv_id", turns.alias("turns"))
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    return rows.select("conv_id", seq.alias("seq"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"))


def _blocks(rows: DataFrame, turns: int, limit: int) -> DataFrame:
    """Rows in the order of (seq, conv_id) with the number of their block; blocks ascend with the order."""
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-turns // limit))

    def number(batches):
        at, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                size = _lengths(batch.column(1))
                ends = done + np.cumsum(np.maximum(size, 1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array((at << 32) + (ends - 1) // limit)], names=[*batch.schema.names, "block"])
                done = int(ends[-1])

    rows = rows.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    return rows.mapInArrow(number, "conv_id long, seq binary, bytes array<long>, block long")


def _lengths(column: pa.Array) -> np.ndarray:
    """Turns of each sequence."""
    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // WIDTH


def _borders(sorted_rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Per block: the LCP of its first row with the row before, and of its last row with the row behind (-1: none)."""
    ends = written(sorted_rows.groupBy("block").agg(F.min("seq").alias("first"), F.max("seq").alias("last")), "borders")
    numbers = sorted(r[0] for r in ends.select("block").collect())  # a number per block
    if len(numbers) < 2:
        return {b: (-1, -1) for b in numbers}
    follows = ends.sparkSession.createDataFrame(list(zip(numbers[:-1], numbers[1:], strict=True)), "block long, behind long")
    pairs = ends.select("block", "last").join(follows, "block").join(
        ends.select(F.col("block").alias("behind"), "first"), "behind").select("block", "behind", "last", "first")

    def work(batches):
        for batch in batches:
            common = [_common(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64())],
                                             names=["block", "behind", "common"])

    found = pairs.mapInArrow(work, "block long, behind long, common long").collect()  # three numbers per block
    before, after = {r["behind"]: r["common"] for r in found}, {r["block"]: r["common"] for r in found}
    return {b: (before.get(b, -1), after.get(b, -1)) for b in numbers}


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share at the beginning."""
    n = min(len(a), len(b))
    x = np.frombuffer(a[:n], np.uint8).reshape(-1, WIDTH)
    y = np.frombuffer(b[:n], np.uint8).reshape(-1, WIDTH)
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n // WIDTH


class RangeMinimum:
    """Sparse table: the minimum of every run of ``2**k`` values."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= self.n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of each closed range, from two overlapping runs."""
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        level = np.log2(hi - lo + 1).astype(np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            table = self.levels[k]
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
        return out

    def last(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row whose values, from behind ``at`` on, all reach ``depth``: binary search by halving runs."""
        r = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            can = np.flatnonzero(r + (1 << k) < self.n)
            can = can[self.levels[k][r[can] + 1] >= depth[can]]
            r[can] += 1 << k
        return r

    def first(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row from which on, up to ``at``, all values behind it reach ``depth``."""
        lo = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            can = np.flatnonzero(lo - (1 << k) >= 0)
            can = can[self.levels[k][lo[can] - (1 << k) + 1] >= depth[can]]
            lo[can] -= 1 << k
        return lo


def _neighbours(turns: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """LCP of each row but the first with the row before."""
    most = np.minimum(size[1:], size[:-1])
    begin = np.cumsum(most) - most
    step = np.arange(int(most.sum())) - np.repeat(begin, most)
    differ = (turns[np.repeat(at[1:-1], most) + step] != turns[np.repeat(at[:-2], most) + step]).any(axis=1)
    out = most.copy()
    some = np.flatnonzero(most)
    if len(some):
        least = np.minimum.reduceat(np.where(differ, step, np.iinfo(np.int64).max), begin[some])
        out[some] = np.minimum(least, most[some])
    return out


def block_nodes(block: int, ids: np.ndarray, seqs: list[bytes], sizes: np.ndarray, before: int, after: int) -> pa.RecordBatch:
    """The nodes of a block's sorted sequences; those that go on beyond its borders as open pieces.

    ``sizes`` has the text bytes of all turns one after another, ``before`` and
    ``after`` the LCP with the neighbouring blocks.  All figures of a piece add up
    over blocks.
    """
    n = len(ids)
    size = np.array([len(s) // WIDTH for s in seqs], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    turns = np.frombuffer(b"".join(seqs), dtype=np.uint64).reshape(-1, WIDTH // 8)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])  # bytes of all turns before
    lcp = np.concatenate([[before], _neighbours(turns, size, at)]).astype(np.int64)
    table, least_id = RangeMinimum(lcp), RangeMinimum(ids)

    # candidate prefixes: a row and each depth at which it differs from the row before
    low = lcp + 1
    low[0] = 0
    count = size - low + 1
    begin = np.cumsum(count) - count
    row = np.repeat(np.arange(n), count)
    depth = np.arange(len(row)) - np.repeat(begin, count) + np.repeat(low, count)
    last = table.last(row, depth)
    parent = np.full(len(row), -1)
    deep = np.flatnonzero(depth > 0)
    up = table.first(row[deep], depth[deep] - 1)
    parent[deep] = begin[up] + depth[deep] - 1 - low[up]

    goes_back = (row == 0) & (depth <= before)
    opened = goes_back | ((last == n - 1) & (depth <= after))
    children = np.bincount(parent[deep][~goes_back[deep]], minlength=len(row))
    ends_here = np.concatenate([[0], np.cumsum(np.append(lcp[1:], after) < size)])  # a childless node's last row
    leaves = ends_here[last + 1] - ends_here[row]
    shared = total[at[:-1] + np.maximum(lcp, 0)] - total[at[:-1]]
    before_last = total[at[row] + np.maximum(depth - 1, 0)] - total[at[row]]
    first_share = shared[0] if before >= 0 else 0
    shared[0] = 0
    sums = np.cumsum(shared)
    saved = sums[last] - sums[row] - (last - row) * before_last + np.where(goes_back, first_share - before_last, 0)
    smallest = least_id.least(row, last)

    same = np.concatenate([[False], (lcp[1:] == size[1:]) & (size[1:] == size[:-1])])
    heads = np.append(np.flatnonzero(~same), n)
    run_end = dict(zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True))
    hashes, texts = [EMPTY] * len(row), [None] * len(row)
    for i in np.flatnonzero(depth == size[row]).tolist():
        a = int(row[i])
        text = ",".join(map(str, ids[a:run_end[a]].tolist())).encode()
        if opened[i]:
            texts[i] = text
        else:
            hashes[i] = hashlib.sha256(text).hexdigest()
    keys, parent_keys = [None] * len(row), [None] * len(row)
    up_open = (parent >= 0) & opened[np.maximum(parent, 0)]
    known: dict[int, bytes] = {}

    def key(i):  # of candidate i, which is open
        if i not in known:
            known[i] = hashlib.blake2b(seqs[row[i]][:WIDTH * int(depth[i])], digest_size=16).digest()
        return known[i]

    for i in np.flatnonzero(opened).tolist():
        keys[i] = key(i)
    for i in np.flatnonzero(up_open).tolist():
        parent_keys[i] = key(int(parent[i]))
    parent_id = pa.array(smallest[np.maximum(parent, 0)], mask=(parent < 0) | up_open)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(row), block)), pa.array(opened), pa.array(keys, pa.binary()), pa.array(parent_keys, pa.binary()),
         pa.array(smallest), pa.array(depth), parent_id, pa.array(last - row + 1), pa.array(children.astype(np.int64)),
         pa.array(leaves), pa.array(saved), pa.array(hashes), pa.array(texts, pa.binary())],
        names=[c.split()[0] for c in _PIECES.split(", ")])


def _end_hashes(pieces: DataFrame) -> DataFrame:
    """``key, sha``: the hash over the ids that end at an open node, block after block."""
    def work(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text)
                else:
                    state.update(b"," + text)
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()),
                                              pa.array([d[1] for d in done], pa.string())], names=["at", "sha"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["at", "sha"])

    rows = pieces.where("ends is not null").select("key", "block", "ends")
    return rows.repartition("key").sortWithinPartitions("key", "block").mapInArrow(work, "at binary, sha string")


def trie(table: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (see :func:`rebuilt`).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    An empty table has no nodes; conversations without turns end at the root.
    Repeated rows are turns of their own.  A row holds all turn digests of its
    conversation, 24 bytes per turn.
    """
    rows = written(rebuilt(table), "rebuilt")
    turns, = rows.agg(F.coalesce(F.sum(F.greatest(F.size("bytes"), F.lit(1))), F.lit(0))).first()
    ranked = written(_blocks(rows.select("conv_id", "seq", "bytes"), int(turns), block_turns), "ranked")
    borders = _borders(ranked)

    def work(batches):
        for group in runs(batches, "block"):
            block = group["block"][0].as_py()
            before, after = borders[block]
            sizes = group["bytes"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield block_nodes(block, group["conv_id"].to_numpy(), group["seq"].to_pylist(), sizes, before, after)

    dealt = ranked.select("conv_id", "seq", "bytes", "block").repartition(max(1, len(borders)), "block")
    pieces = written(dealt.sortWithinPartitions("block", "seq", "conv_id").mapInArrow(work, _PIECES), "pieces")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    opened = pieces.where("open")
    sums = opened.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"),
        *[F.sum(c).cast("long").alias(c) for c in out[3:7]])
    sums = sums.join(_end_hashes(opened), F.col("key") == F.col("at"), "left")
    sums = written(sums.withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY))).drop("at", "sha"), "open")
    parents = sums.select(F.col("key").alias("up"), F.col("conv_id").alias("up_id"))
    joined = sums.join(parents, F.col("parent_key") == F.col("up"), "left").withColumn("parent_conv_id", F.col("up_id"))

    closed = pieces.where("not open")
    inner = closed.where("parent_key is null")
    # the root's children, or those of a very common beginning, are dealt over several tasks
    salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    outer = closed.where("parent_key is not null").withColumn("turn", F.pmod("conv_id", F.lit(SALTS)).cast("int"))
    outer = outer.join(salted, (F.col("parent_key") == F.col("up")) & (F.col("turn") == F.col("salt")))
    outer = outer.withColumn("parent_conv_id", F.col("up_id"))
    return inner.select(*out).union(outer.select(*out)).union(joined.select(*out))

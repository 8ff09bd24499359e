"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

Vectors are whole numbers, ``floor(256 x)`` of each component.  All rows are
sorted by label and by their place on a Hilbert curve through the dimensions of
widest spread, and written as Parquet blocks of bounded size, so a block holds
neighbours.  A zone map keeps each block's least and greatest value per
dimension, its labels and its rows.

Interval arithmetic over a zone map bounds the score of every row of a block
from both sides.  A group of anchors (neighbours on the curve too) reads the
blocks in the order of their upper bounds: for the positives only blocks that
hold the label and whose upper bound reaches the least score known to be among
the best; for the negatives only blocks whose interval meets a window that is
still open.  Blocks and zone maps are read from the shared folder in the tasks;
one block and one group of anchors are in memory.  Bounds carry a margin for
rounding and scores are exact integers, so nothing is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import file_system, matrix, shared_dir, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 80, 100
LABELS = 10
#: Dimensions of the curve, and bits of each.
CURVE_DIMS, CURVE_BITS = 15, 4
BLOCK_BYTES = 4 << 20
GROUP = 128
#: Sums of whole numbers below are exact in doubles, and below the second in 64-bit integers.
WHOLE, INTEGER = float(1 << 53), float(1 << 62)
MARGIN = 1e-9

_FOUND = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, "
          "blocks_read long, blocks_known long")


def whole(table: DataFrame) -> DataFrame:
    """``vec_id, label, v``: whole numbers as doubles, one row for each id.

    Rows with a null id, label or vector, or a null or non-finite component, take
    no part.  Of several rows of one id the one with the smallest vector (then
    label) counts.  Where the id is divisible by 7 the label first becomes
    ``(label + 1) % 10``.  Other columns are left aside.
    """
    def scaled(c):
        y = SCALE * c.cast("double")
        return F.when(F.abs(y) >= WHOLE, y).otherwise(F.floor(y).cast("double"))

    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < float("inf")))
    label = F.col("label").cast("long")
    rows = table.where("vec_id is not null and label is not null and embedding is not null").where(fine).select(
        F.col("vec_id").cast("long"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.transform("embedding", scaled).alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("r")).select("vec_id", "r.label", "r.v")


def _spread(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(dimensions of widest spread, their least, their greatest value)``: from ``width`` sums."""
    def work(batches):
        n, least, most = 0, np.full(width, np.inf), np.full(width, -np.inf)
        total, square = np.zeros(width), np.zeros(width)
        for batch in batches:
            m = matrix(batch.column(0), width)
            if len(m):
                n += len(m)
                least, most = np.minimum(least, m.min(axis=0)), np.maximum(most, m.max(axis=0))
                total, square = total + m.sum(axis=0), square + (m * m).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(total), pa.array(square), pa.array(least),
                 pa.array(most)], names=["dim", "n", "total", "square", "least", "most"])

    sums = rows.select("v").mapInArrow(work, "dim long, n long, total double, square double, least double, most double")
    sums = sums.groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "square")],
                                   F.min("least").alias("least"), F.max("most").alias("most")).orderBy("dim").collect()
    got = np.array([[r["total"] / r["n"], r["square"] / r["n"], r["least"], r["most"]] for r in sums])
    dims = np.argsort(-(got[:, 1] - got[:, 0] ** 2), kind="stable")[:CURVE_DIMS]
    return dims, got[dims, 2], got[dims, 3]


def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole coordinates below ``2**bits``.

    The transposed form: undo the curve's rotations from the highest bit down,
    Gray-encode, and interleave the bits.
    """
    x = cells.astype(np.uint64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint64(q - 1)
        for i in range(dims):
            high = (x[:, i] & np.uint64(q)) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p).astype(np.uint64)
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), dtype=np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, -1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= turn[:, None]
    out = np.zeros(len(x), dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << np.uint64(1)) | ((x[:, i] >> np.uint64(b)) & np.uint64(1))
    return out.astype(np.int64)


def _placed(rows: DataFrame, width: int) -> DataFrame:
    dims, least, most = _spread(rows, width)
    steps = (1 << CURVE_BITS) - 1

    def work(batches):
        for batch in batches:
            m = matrix(batch.column(2), width)[:, dims]
            cells = np.clip((m - least) / np.maximum(most - least, 1) * steps, 0, steps).round()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_place(cells, CURVE_BITS))],
                                             names=[*batch.schema.names, "place"])

    return rows.select("vec_id", "label", "v").mapInArrow(work, "vec_id long, label long, v array<double>, place long")


def _zones(blocks: DataFrame, width: int) -> DataFrame:
    """Per block file: rows, least and greatest label and value of each dimension."""
    def work(batches):
        for batch in batches:
            files = np.asarray(batch.column(2).to_pylist(), dtype=object)
            for file in dict.fromkeys(files.tolist()):
                at = np.flatnonzero(files == file)
                m = matrix(batch.column(1).take(pa.array(at)), width)
                labels = batch.column(0).take(pa.array(at)).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * width), pa.array(np.arange(width)), pa.array(np.full(width, len(at))),
                     pa.array(np.full(width, labels.min())), pa.array(np.full(width, labels.max())),
                     pa.array(m.min(axis=0)), pa.array(m.max(axis=0))],
                    names=["file", "dim", "n", "label_low", "label_high", "low", "high"])

    parts = blocks.select("label", "v", F.col("_metadata.file_path").alias("file")).mapInArrow(
        work, "file string, dim long, n long, label_low long, label_high long, low double, high double")
    dims = parts.groupBy("file", "dim").agg(F.sum("n").alias("n"), F.min("label_low").alias("label_low"),
                                            F.max("label_high").alias("label_high"), F.min("low").alias("low"),
                                            F.max("high").alias("high"))
    return dims.groupBy("file").agg(
        F.max("n").alias("n"), F.min("label_low").alias("label_low"), F.max("label_high").alias("label_high"),
        F.sort_array(F.collect_list(F.struct("dim", "low", "high"))).alias("z")).select(
        "file", "n", "label_low", "label_high", F.col("z.low").alias("low"), F.col("z.high").alias("high"))


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Below and above every score of each anchor (rows of ``q``) with rows of each block."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    slack = MARGIN * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) + MARGIN
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def exact_scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``v`` with each row of ``q``: 64-bit integers, or Python's where larger."""
    if not len(v) or not len(q):
        return np.zeros((len(v), len(q)), dtype=np.int64)
    most = float((np.abs(q) @ np.abs(v).max(axis=0)).max())
    if most < WHOLE:
        return (v @ q.T).astype(np.int64)
    if max(most, np.abs(v).max(), np.abs(q).max()) < INTEGER:
        return v.astype(np.int64) @ q.astype(np.int64).T
    rows, cols = ([[int(x) for x in r] for r in m.tolist()] for m in (v, q))
    out = np.empty((len(v), len(q)), dtype=object)
    for i, a in enumerate(rows):
        for j, b in enumerate(cols):
            out[i, j] = sum(x * y for x, y in zip(a, b, strict=True))
    return out


def _first(held: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The first ``n`` of ``(-score, id)`` pairs held and new, higher scores first, ties to smaller ids."""
    if len(ids) > 4 * n and scores.dtype != object:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = scores >= least
        scores, ids = scores[some], ids[some]
    return sorted([*held, *((-int(s), int(i)) for s, i in zip(scores.tolist(), ids.tolist(), strict=True))])[:n]


class Blocks:
    """The zone maps of all blocks as one group of anchors sees them, and the blocks' rows on demand."""

    def __init__(self, zones: str, width: int, q: np.ndarray):
        self.width, self.read_files = width, set()
        store, path = file_system(zones)
        files, n, labels, below, above = [], [], [], [], []
        for batch in pads.dataset(path, filesystem=store, format="parquet").to_batches():
            if batch.num_rows:
                names = {c: batch.column(c) for c in batch.schema.names}
                files += names["file"].to_pylist()
                n.append(names["n"].to_numpy())
                labels.append(np.stack([names["label_low"].to_numpy(), names["label_high"].to_numpy()]))
                lo, hi = bounds(q, matrix(names["low"], width), matrix(names["high"], width))
                below.append(lo)
                above.append(hi)
        order = np.argsort(files)
        self.files = [files[i] for i in order]
        self.n = np.concatenate(n)[order]
        self.low, self.high = np.concatenate(labels, axis=1)[:, order]
        self.below, self.above = np.concatenate(below, axis=1)[:, order], np.concatenate(above, axis=1)[:, order]

    def rows(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        store, path = file_system(self.files[at])
        with store.open_input_file(path) as f:
            table = pq.read_table(f, columns=["vec_id", "label", "v"])
        self.read_files.add(at)
        return (table["vec_id"].to_numpy(), table["label"].to_numpy(),
                matrix(pa.concat_arrays(table["v"].chunks) if table["v"].num_chunks != 1 else table["v"].chunk(0), self.width))


def positives(blocks: Blocks, ids: np.ndarray, labels: np.ndarray, q: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per anchor the first positives as ``(-score, id)``."""
    best: list[list[tuple[int, int]]] = [[] for _ in ids]
    holds = (blocks.low[None, :] <= labels[:, None]) & (labels[:, None] <= blocks.high[None, :])
    # a block of the label alone with enough rows puts that many scores over its lower bound
    sure = holds & ((blocks.low == blocks.high) & (blocks.n > POSITIVES))[None, :]
    least = np.where(sure, blocks.below, -np.inf).max(axis=1)
    above = np.where(holds, blocks.above, -np.inf)
    for b in np.argsort(-above.max(axis=0), kind="stable").tolist():
        live = np.flatnonzero(holds[:, b] & (above[:, b] >= least))
        if not len(live):
            continue
        n, own, v = blocks.rows(b)
        scores = exact_scores(v, q[live])
        for j, i in enumerate(live.tolist()):
            some = np.flatnonzero((own == labels[i]) & (n != ids[i]))
            best[i] = _first(best[i], scores[some, j], n[some], POSITIVES)
            if len(best[i]) == POSITIVES:
                least[i] = max(least[i], -best[i][-1][0])
    return best


def negatives(blocks: Blocks, labels: np.ndarray, q: np.ndarray, best: list) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Per anchor and positive score the first negatives of its window as ``(-score, id)``."""
    found = {(i, -s): [] for i, held in enumerate(best) for s, _ in held if s <= 0}
    windows: dict[int, list[int]] = {}
    for i, score in found:
        windows.setdefault(i, []).append(score)
    if not windows:
        return found
    alone = (blocks.low == blocks.high)[None, :] & (blocks.low[None, :] == labels[:, None])

    def open_from(i, score):
        """The least score that still counts."""
        held = found[i, score]
        return max(-(-LOW * score // HIGH), -held[-1][0] if len(held) == NEGATIVES else -(-LOW * score // HIGH))

    top = np.full(len(labels), -np.inf)
    top[list(windows)] = 0
    for b in np.argsort(-(blocks.above + top[:, None]).max(axis=0), kind="stable").tolist():
        live = [i for i, scores in windows.items() if not alone[i, b]
                and any(blocks.above[i, b] >= open_from(i, s) and blocks.below[i, b] <= s for s in scores)]
        if not live:
            continue
        n, own, v = blocks.rows(b)
        all_scores = exact_scores(v, q[live])
        for j, i in enumerate(live):
            other = own != labels[i]
            for score in windows[i]:
                some = np.flatnonzero(other & (all_scores[:, j] <= score) & (all_scores[:, j] >= open_from(i, score)))
                if len(some):
                    found[i, score] = _first(found[i, score], all_scores[some, j], n[some], NEGATIVES)
    return found


def mine(table: DataFrame, every: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives of the anchors (ids divisible by ``every``) among all rows.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` and, of the anchor's group, ``blocks_read`` and ``blocks_known``.
    Positives are the first rows of the anchor's label, negatives the first rows
    of other labels with 80 to 100 percent of the positive's score; higher scores
    come first, ties go to smaller ids.  An anchor without positives, or a positive
    with an empty window (negative scores have one), gives no rows; nor does an empty
    table.  Shorter vectors count as filled up with zeros.  See :func:`whole` for what takes no
    part.  A reported score that no BIGINT holds fails.
    """
    spark = table.sparkSession
    rows = written(whole(table), "whole")
    count, anchors, width = rows.agg(
        F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1)), F.max(F.size("v"))).first()
    if not anchors or not width:
        # vectors without components all score 0
        width = 1
    cores = spark.sparkContext.defaultParallelism
    held = max(64, block_bytes // (8 * width))
    order = ["label", "place", "vec_id"]
    placed = written(_placed(rows, width), "placed") if count else rows.withColumn("place", F.lit(0).cast("long"))
    path = shared_dir(spark, "blocks")
    (placed.repartitionByRange(max(2 * cores, -(-count // held)), *order).sortWithinPartitions(*order)
     .write.option("maxRecordsPerFile", held).parquet(path))
    blocks = spark.read.schema(placed.schema).parquet(path)
    zones = shared_dir(spark, "zones")
    _zones(blocks, width).write.parquet(zones)
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def work(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, GROUP):
                part = batch.slice(lo, GROUP)
                ids, labels, q = part.column(0).to_numpy(), part.column(1).to_numpy(), matrix(part.column(2), width)
                known = Blocks(zones, width, q)
                best = positives(known, ids, labels, q)
                found = negatives(known, labels, q, best)
                out = [(int(ids[i]), p, rank, n, -s, -t, len(known.read_files), len(known.files))
                       for i, held in enumerate(best) for s, p in held
                       for rank, (t, n) in enumerate(found.get((i, -s), []), 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], pa.int32() if c == "rank" else pa.int64()) for k, c in enumerate(names)], names=names)

    chosen = placed.where(F.col("vec_id") % every == 0)
    chosen = chosen.repartitionByRange(max(1, min(4 * cores, -(-anchors // 16)), -(-anchors // (8 * GROUP))), *order)
    return chosen.sortWithinPartitions(*order).select("vec_id", "label", "v").mapInArrow(work, _FOUND)

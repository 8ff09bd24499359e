"""Exact top-k inner products over norm-sorted vectors.

Vectors are whole numbers, ``floor(1024 x)`` of each component.  All are sorted
by descending length and cut into blocks.  A rotation by the singular vectors
of the whole table (from its Gram matrix, summed over all rows) gathers most of
each product in the first coordinates.

A query's threshold starts with its k-th best score among the ``HEAD`` longest
vectors.  It is sent only to blocks whose longest vector could reach that by
Cauchy-Schwarz.  Within a block, chunk after chunk: a query is done when its
length times the chunk's longest is under the threshold; else the partial
product of the first ``LEADING`` rotated coordinates plus the product of the
two residual lengths bounds every score, and only vectors whose bound reaches
the threshold are scored exactly.  Bounds carry a margin for rounding, scores
are exact integers, so nothing is lost: where the product of two lengths could
pass what doubles hold exactly, 64-bit integers are used, and beyond those
Python's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written

SCALE, TOP = 1024, 10
HEAD, LEADING, CHUNK, QUERIES = 1024, 16, 2048, 256
#: Bytes of the vectors of one block, as doubles; a worker holds a few times as much.
BLOCK_BYTES = 128_000_000
#: Doubles from here on are whole, and sums of products below are exact in doubles.
WHOLE = float(1 << 53)
#: Sums of products below are exact in 64-bit integers.
INTEGER = float(1 << 62)
#: Stands for all scores from here on.
BIGGEST = (1 << 63) - 1
#: Longer vectors count as this long for the rotation, so that a few huge ones do not drown all others.
LONG = float(1 << 21)
MARGIN = 1e-9
#: Share of a squared length that rounding may take from a residual, and so added to it.
LOST = 1e-12


def whole(table: DataFrame) -> DataFrame:
    """``vec_id, v, norm2``: one vector of whole numbers (as doubles) for each id.

    Null vectors, and those with null or non-finite components, take no part, nor
    do rows without id.  Of several vectors of one id the smallest counts;
    repeated rows count once.
    """
    def scaled(c):
        y = SCALE * c.cast("double")
        return F.when(F.abs(y) >= WHOLE, y).otherwise(F.floor(y).cast("double"))

    x = F.transform("embedding", scaled)
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < float("inf")))
    rows = table.where("vec_id is not null and embedding is not null").where(fine)
    rows = rows.select(F.col("vec_id").cast("long"), x.alias("v"))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthogonal matrix whose columns are the right singular vectors, strongest first."""
    def work(batches):
        gram = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width)
            m /= np.maximum(1, np.sqrt((m * m).sum(axis=1)) / LONG)[:, None]
            gram += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(gram.ravel())], names=["at", "x"])

    sums = vectors.select("v").mapInArrow(work, "at long, x double").groupBy("at").agg(F.sum("x").alias("x"))
    gram = np.zeros(width * width)
    for r in sums.collect():  # width * width rows
        gram[r["at"]] = r["x"]
    gram = gram.reshape(width, width)
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1]


def _scores(v: np.ndarray, norm: np.ndarray, q: np.ndarray, q_norm: float) -> np.ndarray:
    """Exact products with ``q``: 64-bit integers, or Python's if some may be larger."""
    most = norm * q_norm * (1 + MARGIN)
    if most.max(initial=0) < WHOLE:
        return (v @ q).astype(np.int64)
    if most.max() < INTEGER:
        return _exact(v, q, most)
    out = np.empty(len(v), dtype=object)
    huge = most >= INTEGER
    out[~huge] = _exact(v[~huge], q, most[~huge])
    whole_q = [int(x) for x in q.tolist()]
    out[huge] = [sum(int(a) * b for a, b in zip(row, whole_q, strict=True)) for row in v[huge].tolist()]
    return out


def _exact(v: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Products of at most ``most``, which is under ``INTEGER``."""
    out = np.zeros(len(v), dtype=np.int64)
    some = most < WHOLE
    out[some] = (v[some] @ q).astype(np.int64)
    if not some.all():
        out[~some] = v[~some].astype(np.int64) @ q.astype(np.int64)
    return out


def _best(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions of the TOP highest scores, ties to smaller ids."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:TOP], dtype=np.int64)
    if len(scores) > 4 * TOP:
        least = np.partition(scores, len(scores) - TOP)[len(scores) - TOP]
        keep = np.flatnonzero(scores >= least)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:TOP]]
    return np.lexsort((ids, -scores))[:TOP]


class Block:
    """Vectors in descending length, their rotated leading parts and residual lengths."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, turn: np.ndarray):
        order = np.lexsort((ids, -(v * v).sum(axis=1)))
        self.ids, self.v = ids[order], v[order]
        self.lead, self.rest, self.norm = self.parts(self.v, turn)
        self.turn = turn

    @staticmethod
    def parts(v: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lead = v @ turn[:, :LEADING]
        norm2 = (v * v).sum(axis=1)
        rest = np.sqrt(np.maximum(norm2 - (lead * lead).sum(axis=1), 0) + LOST * norm2)
        return lead, rest, np.sqrt(norm2)

    def search(self, ids: np.ndarray, q: np.ndarray, least: np.ndarray):
        """``(query position, ids, scores)`` of the best of each query that can reach ``least``."""
        lead, rest, norm = self.parts(q, self.turn)
        least = least.copy()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(q))]
        for lo in range(0, len(self.ids), CHUNK):
            part = slice(lo, lo + CHUNK)
            live = np.flatnonzero(norm * self.norm[lo] * (1 + MARGIN) >= least)
            if not len(live):
                break
            bound = lead[live] @ self.lead[part].T + np.outer(rest[live], self.rest[part])
            slack = MARGIN * np.outer(norm[live], self.norm[part])
            hits = bound + slack >= least[live][:, None]
            for row, i in enumerate(live.tolist()):
                at = np.flatnonzero(hits[row]) + lo
                at = at[self.ids[at] != ids[i]]
                if not len(at):
                    continue
                n = np.concatenate([found[i][0], self.ids[at]])
                s = np.concatenate([found[i][1], _scores(self.v[at], self.norm[at], q[i], norm[i])])
                top = _best(s, n)
                found[i] = n[top], s[top]
                if len(top) == TOP:
                    least[i] = max(least[i], float(s[top[-1]]))
        return found


def search(table: DataFrame, every: int = 100) -> DataFrame:
    """Per query (ids divisible by ``every``): its TOP highest scores over all other vectors.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller ``vec_id``, and
    a query has fewer rows if there are fewer other vectors.  Shorter vectors
    count as filled up with zeros.  See :func:`whole` for what takes no part.
    A score that no BIGINT holds fails, as it does in SQL.
    """
    spark = table.sparkSession
    vectors = written(whole(table), "vectors")
    count, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    schema = "query_id long, vec_id long, score long"
    if not count or not width:
        width = 1
    blocks = max(2 * spark.sparkContext.defaultParallelism, -(-count * 8 * width // BLOCK_BYTES))
    turn = rotation(vectors, width)
    order = [F.col("norm2").desc(), F.col("vec_id")]
    head = vectors.orderBy(*order).limit(HEAD).select("vec_id", "v").toArrow()  # HEAD vectors
    ranked = vectors.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id())
    ranked = written(ranked, "ranked")
    longest = ranked.groupBy("block").agg(F.max("norm2").alias("top")).orderBy("block").collect()  # a row per block
    tops = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(t).cast("double").alias("top"))
                     for b, t in longest or [(0, 0)]])
    shared = spark.sparkContext.broadcast((
        turn, head.column("vec_id").to_numpy().astype(np.int64), _matrix(head.column("v").combine_chunks(), width)))

    def begin(batches):
        turn, ids, v = shared.value
        longest = Block(ids, v, turn)
        for batch in batches:
            q_ids = batch.column(0).to_numpy()
            least = np.full(len(q_ids), -np.inf)
            for lo in range(0, len(q_ids), QUERIES):
                part = slice(lo, lo + QUERIES)
                q = _matrix(batch.column(1).slice(lo, QUERIES), width)
                for i, (_, s) in enumerate(longest.search(q_ids[part], q, least[part])):
                    if len(s) == TOP:
                        least[lo + i] = float(s[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=[*batch.schema.names, "least"])

    queries = vectors.where(F.col("vec_id") % every == 0).select("vec_id", "v", "norm2")
    queries = written(queries.mapInArrow(begin, "vec_id long, v array<double>, norm2 double, least double"), "queries")
    reach = (1 + MARGIN) * F.sqrt(F.col("norm2").cast("double"))
    queries = queries.withColumn("block", F.explode(F.filter(
        tops, lambda b: reach * F.sqrt(b["top"].cast("double")) >= F.col("least"))))
    rows = queries.select(F.col("block.block").alias("block"), F.lit(True).alias("query"), "vec_id", "v", "least").union(
        ranked.select("block", F.lit(False), "vec_id", "v", F.lit(None).cast("double")))
    rows = rows.repartition(blocks, "block").sortWithinPartitions("block", "query")

    def work(batches):
        turn = shared.value[0]
        held, block, of = [], None, None
        for batch in batches:
            number = batch.column(0).to_numpy()
            query = batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((number[1:] != number[:-1]) | (query[1:] != query[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(number)], strict=True):
                if lo == hi:
                    continue
                if number[lo] != of:
                    held, block, of = [], None, number[lo]
                ids = batch.column(2).slice(lo, hi - lo).to_numpy()
                v = _matrix(batch.column(3).slice(lo, hi - lo), width)
                if not query[lo]:
                    held.append((ids, v))
                    continue
                if block is None and held:
                    block = Block(*(np.concatenate(c) for c in zip(*held, strict=True)), turn)
                    held = []
                least = batch.column(4).slice(lo, hi - lo).to_numpy()
                out = [[], [], []]
                for a in range(0, hi - lo, QUERIES):
                    part = slice(a, a + QUERIES)
                    for i, (n, s) in enumerate(block.search(ids[part], v[part], least[part])):
                        out[0].append(np.full(len(n), ids[a + i]))
                        out[1].append(n)
                        out[2].append(np.array([min(max(x, -BIGGEST), BIGGEST) for x in s.tolist()], np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out],
                                                 names=["query_id", "vec_id", "score"])

    found = rows.mapInArrow(work, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= TOP)
    score = F.when(F.abs("score") < BIGGEST, F.col("score")).otherwise(
        F.raise_error(F.lit("a score is too large for a BIGINT")).cast("long"))
    return found.select("query_id", "rank", "vec_id", score.alias("score"))

"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model counts n-grams of UTF-8 bytes (``ORDER`` bytes, so that a gram fits a
64-bit integer) over all trusted texts: documents labelled as of good quality.
Tasks count what they read, Spark adds the counts up by gram; lower orders
count the distinct bytes that come before a gram.  Each order has its own three
discounts, from its counts of counts.

Scoring joins counts, shard by shard, never text: every run of ``RUN`` rows of
an input file ("split" below) asks for the grams it holds, once each; the
distinct grams meet the count tables of all orders in hash joins, from the
lowest order up, and the logarithms go back to the splits that asked.  A
split's answers lie in a file of their own in the shared folder (written under
its key, the same bytes by any attempt), which the tasks that read rows of that
split again load.  So the texts are not shuffled, and a task holds the grams of
one split at most.  A gram without an answer is an error, never another gram's.

A document is kept if its perplexity lies between two quantiles of the trusted
documents of its language (of all trusted ones, if the language has none):
noise lies above, endless repetition below.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import text as tx
from tillroll.llm.common import file_system, runs, shared_dir, written

ORDER = 5
LOW, HIGH = 0.005, 0.995
HELD_GRAMS = 4_000_000
#: Rows of a file that ask together.
RUN = 16_384
BLOCK = 4 << 20


def _split() -> Column:
    """A key of the run of rows, within its file, that a row belongs to.

    It depends on the file alone.  Where tasks cut a file changes with the number of executors, so a scan may
    meet a run in two tasks; both then hold the same key.
    """
    return F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / RUN))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER`` bytes that end at each byte of the texts, as integers, and each text's first.

    Before a text come zeros.
    """
    lead = ORDER - 1
    sizes = np.diff(offsets)
    spaced = np.insert(data[offsets[0]:offsets[-1]], np.repeat(offsets[:-1] - offsets[0], lead), 0)
    code = np.zeros(max(0, len(spaced) - lead), dtype=np.int64)
    for i in range(ORDER):
        code = (code << 8) | spaced[i:i + len(code)]
    first = np.concatenate([[0], np.cumsum(sizes)])
    # code i ends at byte i + lead; the lead zeros of each later text end no gram of theirs
    keep = np.ones(len(code), dtype=bool)
    for i in range(lead):
        at = first[1:-1] + lead * np.arange(1, len(sizes)) + i - lead
        keep[at] = False
    return code[keep], first


def _write_files(rows: DataFrame, folder: str, columns: list[str]) -> None:
    """One file for each ``split``: the columns as Arrow, in the order of the first."""
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    rows = rows.select("split", *columns).repartition("split").sortWithinPartitions("split", columns[0])

    def work(batches):
        out_store, out_path = file_system(folder)
        done = 0
        for group in runs(batches, "split"):
            name = f"{out_path}/{group['split'][0].as_py()}"
            draft = f"{name}.{uuid.uuid4().hex}"
            with out_store.open_output_stream(draft) as sink:
                with pa.ipc.new_file(sink, group.select(columns).schema) as file:
                    file.write_table(group.select(columns))
            try:
                out_store.move(draft, name)
            except OSError:  # another attempt's file is there, with the same rows; some stores refuse to replace it
                if out_store.get_file_info(name).type.name == "NotFound":
                    raise
            done += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([done], pa.int64())})

    rows.mapInArrow(work, "n long").agg(F.sum("n")).collect()


def _read_file(folder: str, split: int) -> pa.Table | None:
    store, path = file_system(folder)
    if store.get_file_info(f"{path}/{split}").type.name == "NotFound":
        return None
    with store.open_input_file(f"{path}/{split}") as source:
        return pa.ipc.open_file(source).read_all()


def _parts(batches, *at: int):
    """Rows of one split each, of limited text size: ``(split, batch, bytes, offsets)``; text is column 2."""
    for batch in batches:
        splits = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(splits)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            part = batch.slice(lo, hi - lo)
            data, offsets = tx.string_bytes(part.column(2))
            for a, z in tx.blocks(offsets, BLOCK):
                yield int(splits[lo]), part.slice(a, z - a), data, offsets[a:z + 1]


def _counted(docs: DataFrame, folder: str) -> DataFrame:
    """``g, c``: the grams of the trusted documents, whose ids lie in the split's file."""
    def work(batches):
        held, size = [], 0
        trusted, of = None, None

        def flush():
            code = np.concatenate([h[0] for h in held])
            order = np.argsort(code, kind="stable")
            code, n = code[order], np.concatenate([h[1] for h in held])[order]
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            return code[starts], np.add.reduceat(n, starts)

        for split, part, data, offsets in _parts(batches):
            if split != of:
                table = _read_file(folder, split)
                trusted, of = (table["doc_id"].to_numpy() if table is not None else np.zeros(0, np.int64)), split
            ids = part.column(1)
            good = np.isin(pa.compute.fill_null(ids, 0).to_numpy(), trusted) & ~ids.is_null().to_numpy(False)
            code, first = grams(data, offsets)
            code = code[np.repeat(good, np.diff(first))]
            if not len(code):
                continue
            held.append(np.unique(code, return_counts=True))
            size += len(held[-1][0])
            if size > HELD_GRAMS:
                held = [flush()]
                size = len(held[0][0])
                if size > HELD_GRAMS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names=["g", "c"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in flush()], names=["g", "c"])

    return docs.mapInArrow(work, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _asked(docs: DataFrame) -> DataFrame:
    """``split, g``: the grams of each split; a gram may come more than once."""
    def work(batches):
        held, of = np.zeros(0, np.int64), None

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(held), of)), pa.array(held)], names=["split", "g"])

        for split, _, data, offsets in _parts(batches):
            if of is not None and (split != of or len(held) > HELD_GRAMS):
                yield out()
                held = held[:0]
            of = split
            held = np.union1d(held, grams(data, offsets)[0])
        if of is not None and len(held):
            yield out()

    return docs.mapInArrow(work, "split long, g long")


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more, between 0 and the count."""
    n = dict(counts.where("c <= 4").groupBy("c").count().collect())  # four rows
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def _answers(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``g, lp``: natural logarithms of the interpolated probability of each wanted gram."""
    def tail(n):
        return F.col("g").bitwiseAND(F.lit((1 << 8 * n) - 1))

    # the counts of each order, the highest first
    tables = [written(counts, "counts")]
    for n in range(ORDER - 1, 0, -1):
        tables.append(written(tables[-1].groupBy(tail(n).alias("g")).agg(F.count("*").alias("c")), "counts"))
    wanted = written(wanted.select("g").distinct(), "wanted")
    below = None
    for n in range(1, ORDER + 1):
        table = tables[ORDER - n]
        d = _discounts(table)
        of = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        stats = table.groupBy(F.shiftright("g", 8).alias("h")).agg(
            F.sum("c").alias("sum"), F.sum(of).alias("held"))
        need = wanted.select(tail(n).alias("g")).distinct() if n < ORDER else wanted
        need = need.withColumn("h", F.shiftright("g", 8)).join(stats, "h", "left")
        need = need.join(table, "g", "left")
        if below is None:
            need = need.withColumn("lower", F.lit(1 / 256))
        else:
            need = need.withColumn("low", need["g"].bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)))
            need = need.join(below.select(F.col("g").alias("low"), F.col("p").alias("lower")), "low")
        p = F.when(F.col("sum").isNull(), F.col("lower")).otherwise(
            (F.when(F.col("c").isNull(), 0.0).otherwise(F.col("c") - of) + F.col("held") * F.col("lower")) / F.col("sum"))
        below = written(need.select("g", p.alias("p")), "order")
    return below.select("g", F.log("p").alias("lp"))


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``lang``, ``text``): ``doc_id, lang, n_bytes, perplexity, trusted``.

    ``docs`` has to be read from Parquet files, whose rows are known by file and number.  Perplexity is per byte; an empty or null
    text has none (null).  Without a trusted text, every byte is as likely as any.
    An id labelled more than once is trusted if all of its labels say so.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "perplexity")
    rows = docs.select(_split().alias("split"), F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    good = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("marked"))
    good = good.agg(F.min("quality").alias("quality")).where("quality >= 1").select("marked")
    ids = rows.select("split", "doc_id").join(good, F.col("doc_id") == F.col("marked")).select("split", "doc_id").distinct()
    _write_files(ids, f"{folder}/trusted", ["doc_id"])
    texts = rows.select("split", "doc_id", "text")
    counts = _counted(texts, f"{folder}/trusted")
    asked = written(_asked(texts).distinct(), "asked")
    answers = _answers(counts, asked)
    _write_files(asked.join(answers, "g").select("split", "g", F.col("lp").cast("float").alias("lp")),
                 f"{folder}/answers", ["g", "lp"])

    def score(batches):
        g = lp = trusted = of = None
        for split, part, data, offsets in _parts(batches):
            if split != of:
                table, marks = _read_file(f"{folder}/answers", split), _read_file(f"{folder}/trusted", split)
                g, lp = (table["g"].to_numpy(), table["lp"].to_numpy()) if table is not None else (None, None)
                trusted, of = (marks["doc_id"].to_numpy() if marks is not None else np.zeros(0, np.int64)), split
            code, first = grams(data, offsets)
            sizes = np.diff(first)
            total = np.zeros(len(sizes))
            some = np.flatnonzero(sizes)
            if len(some):
                at = np.minimum(np.searchsorted(g, code), len(g) - 1) if g is not None and len(g) else None
                if at is None or not np.array_equal(g[at], code):
                    raise ValueError(f"split {split} changed between two scans: grams without answers")
                total[some] = np.add.reduceat(lp[at].astype(np.float64), first[:-1][some])
            value = np.exp(-total / np.maximum(sizes, 1))
            ids = part.column(1)
            good = np.isin(pa.compute.fill_null(ids, 0).to_numpy(), trusted) & ~ids.is_null().to_numpy(False)
            yield pa.RecordBatch.from_arrays(
                [ids, part.column(3), pa.array(sizes, pa.int64()), pa.array(value, mask=sizes == 0), pa.array(good)],
                names=["doc_id", "lang", "n_bytes", "perplexity", "trusted"])

    return rows.mapInArrow(score, "doc_id long, lang string, n_bytes long, perplexity double, trusted boolean")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: ``doc_id, lang, n_bytes, perplexity, low, high, keep``.

    A text without perplexity is not kept; without any trusted document all
    others are.  Null languages are one language; repeated rows repeat.
    """
    rows = written(perplexities(docs, labels), "perplexity")
    good = rows.where("trusted and perplexity is not null")
    bounds = F.percentile_approx("perplexity", [LOW, HIGH], 10_000)
    own = good.groupBy(F.coalesce("lang", F.lit("")).alias("of")).agg(bounds.alias("own"))
    every = good.agg(bounds.alias("every"))  # one row
    rows = rows.withColumn("l", F.coalesce("lang", F.lit("")))
    rows = rows.join(written(own, "bounds"), F.col("l") == F.col("of"), "left").crossJoin(F.broadcast(every))
    bound = F.coalesce("own", "every")
    rows = rows.withColumn("low", bound[0]).withColumn("high", bound[1])
    keep = F.col("perplexity").isNotNull() & F.coalesce(
        F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return rows.select("doc_id", "lang", "n_bytes", "perplexity", "low", "high", keep.alias("keep"))

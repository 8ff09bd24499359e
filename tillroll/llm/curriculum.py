"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1.  Its integral says
how much of the mix the source has given by any time; the integral over all
time, its weight, sets its target: the words of all documents are shared by
weight, no target goes beyond ``MOST`` times its source's size, and what is
over is shared again among the others by weight.

A source's documents lie, in an order drawn from a hash, on a line of words
that repeats.  The mix takes the line up to the target: whole passes, and at
the last pass a document on the border gives its first words only.  Each taken
piece starts at some word of the line; the time at which the source's
cumulative demand reaches that word is its training position, in closed form
as schedules are linear: ``w(t) = w * (1 + slope * (2 t - 1))``.

Words before a document are counted in two steps, per bucket of a source and
within the bucket (three hexadecimal digits of the hash), so that a source with
a third of all rows is spread over 4096 groups; all else is small sums.  Everything is exact integer
arithmetic up to the target, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
WEIGHTS = (1, 2, 3)
#: Slopes of the schedules, in turn like the weights: rising, flat and falling sources.
SLOPES = (0.5, 0.0, -0.5)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """Per source: ``key`` (null last by ``missing``), size, weight, slope and target in words.

    A source is held at ``MOST`` times its size if the level, words per unit of
    weight, that fills all others rises above what it has.  Sorted by what they
    have per unit, such sources come first, so one running sum finds the level.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(place) - 1

    def in_turn(values):
        return F.element_at(F.array(*map(F.lit, values)), (turn % len(values) + 1).cast("int"))

    sums = sums.select("source", "source_size", in_turn(WEIGHTS).cast("double").alias("weight"),
                       in_turn(SLOPES).alias("slope"))
    most = MOST * F.col("source_size")
    fill = Window.orderBy(most / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    sums = (sums.withColumn("total", F.sum("source_size").over(everything))
            .withColumn("held_before", F.coalesce(F.sum(most).over(before), F.lit(0)))
            .withColumn("weight_left", F.sum("weight").over(rest)))
    sums = sums.withColumn("level", (F.col("total") - F.col("held_before")) / F.col("weight_left"))
    sums = sums.withColumn("held", F.col("weight") * F.col("level") > most)
    # the level that counts is that of the first source that is not held
    sums = sums.withColumn("level", F.max(F.when(~F.col("held"), F.col("level"))).over(everything))
    target = F.when(F.col("held"), most.cast("double")).otherwise(
        F.least(F.col("weight") * F.col("level"), most.cast("double")))
    return sums.select("source", "source_size", "weight", "slope", F.coalesce(target, F.lit(0.0)).alias("target"))


def planned(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``, ``source``): the words before it and its source's plan.

    Rows of one id, or without one, follow in the order of a hash of their text.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words(F.col("text")).alias("size"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("order"),
                       F.coalesce(F.md5("text"), F.lit("")).alias("tie"))
    rows = rows.withColumn("bucket", F.substring("order", 1, 3))
    rows = written(rows, "sized")
    plan = written(targets(rows), "targets")
    keys = [F.col("source"), F.col("bucket")]
    per = rows.groupBy(*keys).agg(F.sum("size").alias("bucket_size"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = written(per.select(*keys, F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)).alias("ahead")), "ahead")
    inner = (Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "tie", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    p, q = per.alias("p"), plan.alias("q")
    rows = rows.alias("r").join(p, F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.bucket") == F.col("p.bucket")))
    rows = rows.select("r.*", (F.col("ahead") + F.col("inside")).alias("start"))
    rows = rows.alias("r").join(q, F.col("r.source").eqNullSafe(F.col("q.source")))
    return rows.select("r.doc_id", "r.source", "r.size", "r.start", "r.tie", "q.source_size", "q.target", "q.slope")


def _taken(passes: Column | int) -> Column:
    """Words that the given pass (from 0) takes of a document."""
    line = F.floor(F.col("target")) - (F.col("start") + passes * F.col("source_size"))
    return F.greatest(F.lit(0), F.least(F.col("size"), line)).cast("long")


def _position(begin: Column) -> Column:
    """The time at which the source's demand reaches word ``begin`` of its target.

    The share of the target given by time t is ``(1 - s) t + s t^2``.
    """
    share = F.least(begin / F.col("target"), F.lit(1.0))
    s = F.col("slope")
    root = F.sqrt(F.greatest((1 - s) * (1 - s) + 4 * s * share, F.lit(0.0)))
    return F.when(s == 0, share).otherwise(2 * share / ((1 - s) + root))


def _pieces(plan: DataFrame) -> DataFrame:
    """Each piece that the mix takes, one row per document and pass, with its words and training position."""
    passes = plan.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    pieces = passes.withColumn("words", _taken(F.col("pass"))).where("words > 0")
    begin = F.col("start") + F.col("pass") * F.col("source_size")
    return pieces.select("doc_id", "source", "tie", "start", "size", "words", _position(begin).alias("position"))


def _in_order(rows: DataFrame, position: str, doc_id: str) -> DataFrame:
    """Range-sorted into training order; rows without a position come last."""
    order = [F.col(position).asc_nulls_last(), F.col(doc_id).asc_nulls_first()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame) -> DataFrame:
    """Per row, in training order: ``doc_id, size, source_size, target, taken, position``.

    The pieces of the mix are range-sorted by position and written; a row's
    ``taken``, the words the mix takes of it with repeats, and ``position``, the
    time of its first piece (null if nothing is taken), are read off them.  A null
    text has size 0; a null source is a source, the last; repeated rows are rows of
    their own.  An empty table gives no rows; if all sizes are 0, nothing is taken.
    """
    plan = written(planned(docs), "planned")
    ordered = written(_in_order(_pieces(plan), "position", "doc_id"), "ordered")
    # rows with words start at words of their own on their source's line
    per = ordered.groupBy("source", "start").agg(F.sum("words").alias("taken"), F.min("position").alias("position"))
    p, d = plan.alias("p"), per.alias("d")
    same = F.col("p.source").eqNullSafe(F.col("d.source")) & (F.col("p.start") == F.col("d.start")) & (F.col("p.size") > 0)
    rows = p.join(d, same, "left").select(
        "p.doc_id", "p.size", "p.source_size", "p.target", F.coalesce("d.taken", F.lit(0)).cast("long").alias("taken"), "d.position")
    return _in_order(rows, "position", "doc_id")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix in training order: each taken piece a row with all columns of ``docs``.

    Rows are range-sorted by position, then ``doc_id``.  A piece that is cut at the
    target holds its first words; ``n_chars``, if there, then counts them.  Rows
    that share a ``doc_id`` and a text are taken as often as planned for each.
    """
    pieces = _pieces(planned(docs)).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("tie").alias("_tie"),
        F.col("position").alias("_position"), F.col("words").alias("_words"), F.col("size").alias("_size"))
    pieces = written(pieces, "pieces")
    # the table's columns stay within one, so that none clashes with those beside it
    one = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    one = one.select("row", F.col("row.doc_id").cast("long").alias("_id"), F.col("row.source").cast("string").alias("_source"),
                     F.coalesce(F.md5("row.text"), F.lit("")).alias("_tie"))
    # rows that agree in id, source and text are interchangeable: one stands for them
    same = ["_id", "_source", "_tie"]
    twice = written(one.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "twice")
    match = [one[c].eqNullSafe(twice[c]) for c in same]
    single = one.join(twice, match, "left_anti")
    repeated = one.join(twice, match, "left_semi").dropDuplicates(same)
    one = single.unionByName(repeated).alias("o")
    pieces = pieces.alias("p")
    joined = one.join(pieces, F.col("o._id").eqNullSafe(F.col("p._id")) & F.col("o._source").eqNullSafe(F.col("p._source"))
                      & (F.col("o._tie") == F.col("p._tie")))
    joined = joined.select("row", "p._id", "_position", "_words", "_size")
    whole = F.col("_words") == F.col("_size")
    each = F.regexp_extract_all("row.text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    text = F.when(whole, F.col("row.text")).otherwise(
        F.array_join(F.slice(each, F.lit(1), F.col("_words").cast("int")), ""))
    out = joined.withColumn("_text", text)
    made = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(whole, F.col("row.n_chars")).otherwise(
            F.length("_text").cast(docs.schema["n_chars"].dataType))
    return _in_order(out, "_position", "_id").select(*(made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))

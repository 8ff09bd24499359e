"""Distinct counts kept as bitmaps: equal COUNT(DISTINCT) over any period, replay, late and repeated lines."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tillroll.operators.distinct_state import DistinctState

SCHEMA = "d date, pay string, who string, cart long, more int"


def _lines(seed, n=400, months=(1, 2, 3)):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # a third of all lines is one customer's; ids and days may be missing
        who = "hot" if rng.random() < 0.34 else rng.choice([None, *(f"c{j}" for j in range(60))])
        day = None if rng.random() < 0.03 else dt.date(2024, rng.choice(months), rng.randint(1, 28))
        out.append((day, rng.choice(["cash", "card", None]), who, rng.randrange(90), i))
    return out


def _state(tmp_path, **more):
    return DistinctState(str(tmp_path / "state"), ("who", "cart"), "d", "pay string", **more)


def _plain(df, by=()):
    return df.groupBy(*by).agg(F.count_distinct("who").alias("unique_who"), F.count_distinct("cart").alias("unique_cart"))


def test_counts_equal_count_distinct_over_any_period(spark, tmp_path):
    state = _state(tmp_path, shards=3)
    loads = [_lines(i, months=m) for i, m in enumerate([(1, 2), (2, 3), (1, 4)])]   # the last one is late for January
    for i, load in enumerate(loads):
        state.append(spark.createDataFrame(load, SCHEMA), i)
    every = spark.createDataFrame([r for load in loads for r in load], SCHEMA)
    month = F.trunc("d", "MM").alias("m")
    for by in ((), (F.col("d"),), (F.col("d"), F.col("pay")), (month,), (F.col("pay"),)):
        assert rows(state.counts(spark, by)) == rows(_plain(every, by))
    part = every.where(F.col("d").between("2024-01-20", "2024-03-05"))
    assert rows(state.counts(spark, (F.col("pay"),), "2024-01-20", dt.date(2024, 3, 5))) == rows(_plain(part, (F.col("pay"),)))


def test_replay_repeated_lines_and_more_shards_change_nothing(spark, tmp_path):
    load = _lines(9)
    df = spark.createDataFrame(load, SCHEMA)
    _state(tmp_path).append(df, 0)
    want = rows(_plain(df, ("d", "pay")))
    _state(tmp_path).append(df.limit(0), 0)                    # a replay: number 0 is there
    _state(tmp_path, shards=40).append(df.sample(0.5, 3), 1)   # lines that were there
    by = (F.col("d"), F.col("pay"))
    assert rows(_state(tmp_path).counts(spark, by)) == want
    ids = spark.read.parquet(f"{tmp_path}/state/ids/who")
    assert ids.count() == ids.select("id").distinct().count() == ids.select("shard", "number").distinct().count()


def test_a_batch_that_ended_after_its_ids_goes_on(spark, tmp_path):
    state, df = _state(tmp_path), spark.createDataFrame(_lines(4), SCHEMA)
    from tillroll.streaming import commit
    commit.commit({state._ids_at("who"): state._new_ids(df, "who")}, 0)
    state.append(df, 0)
    assert rows(state.counts(spark)) == rows(_plain(df))


def test_many_ids_fill_several_blocks(spark, tmp_path):
    state = DistinctState(str(tmp_path / "s"), ("id",), "d", shards=1)
    df = spark.range(70_001).withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")))
    state.append(df, 0)
    assert state.counts(spark).first()[0] == 70_001
    assert rows(state.counts(spark, (F.trunc("d", "MM").alias("m"),))) == rows(
        df.groupBy(F.trunc("d", "MM").alias("m")).agg(F.count_distinct("id").alias("unique_id")))
    assert spark.read.parquet(str(tmp_path / "s" / "bits" / "id")).select("shard", "block").distinct().count() == 3


def test_empty_state_null_ids_and_lost_numbers(spark, tmp_path):
    state = _state(tmp_path)
    assert [tuple(r) for r in state.counts(spark).collect()] == [(0, 0)]
    assert state.counts(spark, (F.col("d"),)).collect() == []
    nulls = spark.createDataFrame([(dt.date(2024, 1, 1), "cash", None, None, 1)], SCHEMA)
    state.append(nulls, 0)
    state.append(nulls.limit(0), 1)
    assert [tuple(r) for r in state.counts(spark, (F.col("d"),)).collect()] == [(dt.date(2024, 1, 1), 0, 0)]
    # ids of a batch that is not the one whose ids were committed are no silent loss
    with pytest.raises(Exception, match="without a number"):
        other = spark.createDataFrame([(dt.date(2024, 1, 2), "cash", "x", 1, 1)], SCHEMA)
        state._new_bits(other, "who").collect()


def test_plan_has_no_expand_and_reads_only_the_months(spark, tmp_path):
    state = _state(tmp_path)
    state.append(spark.createDataFrame(_lines(2), SCHEMA), 0)
    plan = state.counts(spark, (F.col("d"),), "2024-02-01", "2024-02-28")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert "PartitionFilters: [isnotnull(month" in plan


def test_lines_are_read_once_per_id_column(spark, tmp_path):
    state = _state(tmp_path)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    loads = [_lines(i, n=200) for i in range(2)]
    for i, load in enumerate(loads):
        state.append(spark.createDataFrame(load, SCHEMA).mapInArrow(seen, SCHEMA), i)
    assert read.value == 2 * 400                                                       # two id columns
    every = spark.createDataFrame(loads[0] + loads[1], SCHEMA)
    assert rows(state.counts(spark, (F.col("pay"),))) == rows(_plain(every, ("pay",)))

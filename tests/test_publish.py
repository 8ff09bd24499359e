"""Gold publishing: partial refresh of touched days == full rebuild."""
from pyspark.sql import functions as F

from helpers import SF001, rows
from tillroll.plans import gold, publish, testmodel as tm

COLS = ["store_id", "store_name", "store_city", "store_region", "category", "report_date",
        "total_revenue", "total_number_of_unit", "total_transaction", "unique_customers"]


def test_refresh_touched_days_equals_rebuild(spark, scratch):
    pos = tm.pos_silver(spark, SF001)
    dates = sorted(r[0] for r in pos.select("transaction_date").distinct().collect()
                   if r[0] is not None)
    cut = dates[len(dates) // 2]
    early = pos.filter(F.col("transaction_date") < cut)
    late = pos.filter((F.col("transaction_date") >= cut) | F.col("transaction_date").isNull())
    path = f"{scratch}/fact_decisions"
    publish.publish(gold.fact_decisions(early), path, ("report_date",))
    # a batch arrives: all late rows plus a re-delivery touching one early day
    batch = late.unionByName(early.filter(F.col("transaction_date") == dates[0]))
    publish.refresh_fact_days(spark, pos, batch, gold.fact_decisions, path)
    got = spark.read.parquet(path).select(*COLS)
    want = gold.fact_decisions(pos).select(*COLS)
    assert got.count() == want.count()
    assert rows(got.drop("total_revenue")) == rows(want.drop("total_revenue"))
    g = {tuple(r[:6]): r[6] for r in got.collect()}
    w = {tuple(r[:6]): r[6] for r in want.collect()}
    assert g.keys() == w.keys()
    assert all(abs((g[k] or 0) - (w[k] or 0)) < 1e-6 for k in g)


def test_views_are_queryable(spark):
    pos = tm.pos_silver(spark, SF001)
    publish.register_views(spark, {"silver_csv_transaction": pos,
                                   "fact_kpi_summary": gold.kpi_summary(pos)})
    n = spark.sql("SELECT total_transactions FROM fact_kpi_summary").collect()[0][0]
    assert n == pos.select("transaction_id").distinct().count()


def test_publish_replaces_all_partitions(spark, scratch):
    path = f"{scratch}/t"
    a = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, d string")
    publish.publish(a, path, ("d",))
    publish.publish(a.filter("d = '2024-01-02'"), path, ("d",))
    assert [str(r.d) for r in spark.read.parquet(path).collect()] == ["2024-01-02"]

"""Cross-dataset invariants of the gold layer."""
from pyspark.sql import functions as F

from helpers import SF001
from tillroll.operators import changes
from tillroll.plans import gold, testmodel as tm


def _one(df, c):
    return df.agg(F.sum(c)).collect()[0][0]


def test_fact_totals_equal_kpi(spark):
    pos = tm.pos_silver(spark, SF001)
    fact = gold.fact_decisions(pos)
    kpi = gold.kpi_summary(pos).collect()[0]
    assert abs(_one(fact, "total_revenue") - kpi.total_revenue) < 1e-6
    assert _one(fact, "total_number_of_unit") == kpi.total_units


def test_category_by_region_sums_equal_fact(spark):
    fact = gold.fact_decisions(tm.pos_silver(spark, SF001))
    cat = gold.category_by_region(fact)
    assert abs(_one(cat, "total_revenue") - _one(fact, "total_revenue")) < 1e-6
    assert _one(cat, "total_unique_stores") == fact.count()


def test_as_of_last_commit_equals_current(spark):
    log = tm.order_change_log(spark, SF001)
    st = changes.state_as_of(log, "order_id", changes.last_commit(log), tie_cols=("source_file",))
    latest = tm.erp_silver(spark, SF001).filter(F.col("order_status") != "CANCELLED")
    assert st.count() == latest.count()
    assert st.select("order_id").exceptAll(latest.select("order_id")).count() == 0


def test_store_revenue_window_has_at_most_31_dates(spark):
    fact = gold.fact_decisions(tm.pos_silver(spark, SF001))
    out = gold.store_revenue(fact).collect()
    assert out
    for r in out:
        assert (r.to_date - r.from_date).days <= 30


def test_store_revenue_cutoff_from_lines_equals_from_fact(spark):
    pos = tm.pos_silver(spark, SF001)
    fact = gold.fact_decisions(pos)
    a = gold.store_revenue(fact).drop("rolling_revenue")
    b = gold.store_revenue(fact, latest=gold.latest_sale_date(pos)).drop("rolling_revenue")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

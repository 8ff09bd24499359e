"""Gold facts and dashboard views over the silver datasets.

Output names and values follow the published datasets, including the
misleading ones (kept for parity, documented per function):
``store_revenue`` sums daily distinct counts, ``total_unique_stores`` is a row
count, ``total_event_count`` counts readings, ``total_cost`` in the margin is
built from the *average* unit cost, and ``avg_alerts`` is a daily count.

Plan notes (checked with ``explain``):
* every aggregate runs partial (map-side) then final, so a hot group key sends
  one row per task to the shuffle;
* exact ``COUNT(DISTINCT)`` expands per distinct column and first shuffles on
  (group key, distinct value), which spreads a hot group over many tasks;
* joins are between aggregated sides; AQE turns them into broadcast joins
  only when the runtime size of a side is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.expr import EXACT_SUM_TYPE, exact_sum
from tillroll.functions.expr import round_half_away as r2

R = F.col


# ------------------------------------------------------------------ G1
def fact_decisions(pos: DataFrame) -> DataFrame:
    """G1 store × category × day fact."""
    return (pos.groupBy("store_id", "store_name", "store_city", "store_region", "category",
                        F.to_date("transaction_date").alias("report_date"))
               .agg(exact_sum("total_orderline").alias("total_revenue"),
                    F.sum("quantity").alias("total_number_of_unit"),
                    F.count_distinct("transaction_id").alias("total_transaction"),
                    F.count_distinct("customer_id").alias("unique_customers"),
                    F.avg("total_orderline").alias("avg_cart"),
                    F.current_timestamp().alias("load_timestamp")))


# ------------------------------------------------------------------ G2
def kpi_summary(pos: DataFrame) -> DataFrame:
    """G2 one-row KPI summary (a global aggregate: one row even when empty)."""
    return pos.agg(F.count_distinct("transaction_id").alias("total_transactions"),
                   F.count_distinct("customer_id").alias("total_unique_customers"),
                   exact_sum("total_orderline").alias("total_revenue"),
                   F.avg("discount_pct").alias("avg_discount"),
                   F.sum("quantity").alias("total_units"))


# ------------------------------------------------------------------ G3
def store_revenue(fact: DataFrame, days: int = 30, latest: Column | None = None) -> DataFrame:
    """G3 rolling window per store: fact rows dated on or after (latest date −
    ``days``), i.e. up to ``days + 1`` dates.  The latest date is an
    uncorrelated scalar subquery, run once; over a stored fact it reads the
    fact, while a caller computing the fact on the fly can pass the same
    date from the silver lines (``latest_sale_date``) and skip a second
    aggregation.  Sums of daily distinct counts over-count repeat customers;
    kept as published."""
    if latest is None:
        latest = fact.select(F.max("report_date")).scalar()
    return (fact.filter(R("report_date") >= F.date_sub(latest, days))
                .groupBy("store_id", "store_name", "store_city", "store_region")
                .agg(exact_sum("total_revenue").alias("rolling_revenue"),
                     F.sum("total_number_of_unit").alias("rolling_units"),
                     F.sum("total_transaction").alias("rolling_transactions"),
                     F.sum("unique_customers").alias("rolling_customers"),
                     F.min("report_date").alias("from_date"),
                     F.max("report_date").alias("to_date")))


def latest_sale_date(pos: DataFrame) -> Column:
    """``max(report_date)`` of ``fact_decisions(pos)`` without building the
    fact: every dated line yields a fact row of its date."""
    return pos.select(F.max(F.to_date("transaction_date"))).scalar()


# ------------------------------------------------------------------ G4
def category_by_region(fact: DataFrame) -> DataFrame:
    """G4 re-aggregation of the fact (its sums are additive).
    ``total_unique_stores`` is ``COUNT(store_id)``: fact rows, as published."""
    return (fact.groupBy("category", "store_region")
                .agg(exact_sum("total_revenue").alias("total_revenue"),
                     F.sum("total_number_of_unit").alias("total_units"),
                     F.count("store_id").alias("total_unique_stores")))


# ------------------------------------------------------------------ G5/G6
def daily_revenue(pos: DataFrame) -> DataFrame:
    """G5 per-day revenue, newest first (NULL date sorts as highest)."""
    return (pos.groupBy(F.to_date("transaction_date").alias("transaction_date"))
               .agg(exact_sum("total_orderline").alias("daily_revenue"),
                    F.count("transaction_id").alias("number_of_transactions"),
                    F.count_distinct("transaction_id").alias("unique_transactions"),
                    F.count_distinct("customer_id").alias("unique_customers"),
                    F.avg("total_orderline").alias("avg_cart_size"))
               .orderBy(R("transaction_date").desc_nulls_first()))


def daily_revenue_from(pos: DataFrame, uniques: DataFrame) -> DataFrame:
    """G5 with the distinct counts out of a state (``transaction_date, unique_transaction_id,
    unique_customer_id``): the lines are aggregated once, without an Expand."""
    sums = (pos.groupBy(F.to_date("transaction_date").alias("transaction_date"))
               .agg(exact_sum("total_orderline").alias("daily_revenue"),
                    F.count("transaction_id").alias("number_of_transactions"),
                    F.avg("total_orderline").alias("avg_cart_size")))
    u = uniques.select(R("transaction_date").alias("_day"), "unique_transaction_id", "unique_customer_id")
    return (sums.join(u, R("transaction_date").eqNullSafe(R("_day")))
                .select("transaction_date", "daily_revenue", "number_of_transactions",
                        R("unique_transaction_id").alias("unique_transactions"),
                        R("unique_customer_id").alias("unique_customers"), "avg_cart_size")
                .orderBy(R("transaction_date").desc_nulls_first()))


def daily_revenue_by_payment(pos: DataFrame) -> DataFrame:
    """G6 per day × payment method, with the largest line."""
    return (pos.groupBy(F.to_date("transaction_date").alias("transaction_date"),
                        "payment_method")
               .agg(exact_sum("total_orderline").alias("daily_revenue"),
                    F.count("transaction_id").alias("number_of_transactions"),
                    F.count_distinct("transaction_id").alias("unique_transactions"),
                    F.count_distinct("customer_id").alias("unique_customers"),
                    F.avg("total_orderline").alias("avg_cart_size"),
                    F.max("total_orderline").alias("max_cart"))
               .orderBy(R("transaction_date").desc_nulls_first(),
                        R("payment_method").asc_nulls_last()))


# ------------------------------------------------------------------ G7/G8
def sensor_stats(iot: DataFrame) -> DataFrame:
    """G7 per store and unit (unit shown as ``sensor_name``)."""
    return (iot.groupBy("store_name", "sensor_unit")
               .agg(F.avg("sensor_value").alias("avg_sensor_value"),
                    F.min("sensor_value").alias("min_sensor_value"),
                    F.max("sensor_value").alias("max_sensor_value"))
               .orderBy(R("store_name").asc_nulls_last(), R("sensor_unit").asc_nulls_last())
               .select("store_name", R("sensor_unit").alias("sensor_name"),
                       "avg_sensor_value", "min_sensor_value", "max_sensor_value"))


def sensor_by_event_type(iot: DataFrame) -> DataFrame:
    """G8 per store and event type; ``total_event_count`` counts readings."""
    return (iot.groupBy("store_name", "event_type")
               .agg(F.avg("sensor_value").alias("avg_sensor_value"),
                    F.min("sensor_value").alias("min_sensor_value"),
                    F.count(F.lit(1)).alias("total_event_count"))
               .orderBy(R("store_name").asc_nulls_last(), R("event_type").asc_nulls_last()))


# ------------------------------------------------------------------ G9
def _kg_unit(unit: Column) -> Column:
    return F.lower(unit).like("%kg%")


def sales_kg_sensor(pos: DataFrame, iot: DataFrame) -> DataFrame:
    """G9 transactions joined with weight readings of the same store and day.

    Published form joins every POS line with every kg reading of its store-day
    and then aggregates (N×M rows).  Same result, linear cost: aggregate each
    side to store-day first, then join one row to one row.

    * revenue over the fan-out = Σ orderline × (kg readings that day)
    * distinct transactions are unaffected by the fan-out
    * avg reading over the fan-out = Σ value / non-NULL values (each line
      repeats the same set of readings)
    """
    t = (pos.groupBy("store_id", "store_name",
                     F.to_date("transaction_date").alias("sale_date"))
            .agg(exact_sum("total_orderline").alias("_rev"),
                 F.count_distinct("transaction_id").alias("unique_transactions")))
    s = (iot.filter(_kg_unit(R("sensor_unit")))
            .groupBy("store_id", F.to_date("event_ts").alias("sale_date"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("sensor_value").alias("_sv"),
                 F.count("sensor_value").alias("_nv")))
    j = t.join(s, ["store_id", "sale_date"])
    return (j.select("store_id", "store_name", "sale_date",
                     (R("_rev") * R("_n")).alias("total_revenue"),
                     "unique_transactions",
                     (R("_sv") / F.nullif(R("_nv"), F.lit(0))).alias("avg_self_value"))
             .orderBy(R("sale_date").desc_nulls_first(), R("store_name").asc_nulls_last()))


# ------------------------------------------------------------------ G10
def gross_margin(pos: DataFrame, erp: DataFrame) -> DataFrame:
    """G10 store × category margin.  ``erp.total_cost`` is the rounded
    *average* unit cost (as published); cost = units sold × that average."""
    p = (pos.groupBy("store_id", "store_name", "store_city", "category")
            .agg(r2(exact_sum("total_orderline")).alias("total_revenue"),
                 F.sum("quantity").alias("total_units_sold")))
    e = (erp.groupBy("store_id", "category")
            .agg(r2(F.avg("unit_cost")).alias("_avg_cost"),
                 F.count_distinct("order_id").alias("total_orders")))
    return _margin(p, e)


def _margin(p: DataFrame, e: DataFrame) -> DataFrame:
    j = p.join(e, ["store_id", "category"])
    cost = R("total_units_sold") * R("_avg_cost")
    profit = R("total_revenue") - cost
    return j.select(
        "store_id", "store_name", "store_city", "category", "total_revenue",
        r2(cost).alias("total_cost"),
        r2(profit).alias("total_gross_profit"),
        r2(profit / F.nullif(R("total_revenue"), F.lit(0)) * 100).alias("gross_profit_margin"),
        "total_units_sold", "total_orders")


def order_costs(rows: DataFrame, sign: Column | None = None) -> DataFrame:
    """What G10 needs of the orders, as sums that can be added: ``store_id, category, cost, priced,
    orders, rows``.  ``sign`` is -1 for rows that leave the table (change rows), else 1.

    A key is one current row, so counting rows with a key counts distinct keys."""
    sign = F.lit(1) if sign is None else sign
    return rows.groupBy("store_id", "category").agg(
        F.sum(R("unit_cost").try_cast(EXACT_SUM_TYPE) * sign).cast(EXACT_SUM_TYPE).alias("cost"),
        F.sum(F.when(R("unit_cost").isNotNull(), sign).otherwise(0)).cast("long").alias("priced"),
        F.sum(F.when(R("order_id").isNotNull(), sign).otherwise(0)).cast("long").alias("orders"),
        F.sum(sign).cast("long").alias("rows"))


def add_order_costs(costs: DataFrame, changes: DataFrame) -> DataFrame:
    """:func:`order_costs` after a table's change rows (``change_action``): old sums plus deltas."""
    delta = order_costs(changes, F.when(R("change_action") == "DELETE", -1).otherwise(1))
    both = costs.unionByName(delta).groupBy("store_id", "category").agg(
        F.sum("cost").cast(EXACT_SUM_TYPE).alias("cost"), *[F.sum(c).cast("long").alias(c) for c in ("priced", "orders", "rows")])
    return both.filter("rows > 0")


def gross_margin_from(fact: DataFrame, costs: DataFrame) -> DataFrame:
    """G10 from states that grow by deltas: the daily fact's additive sums and :func:`order_costs`."""
    p = (fact.groupBy("store_id", "store_name", "store_city", "category")
             .agg(r2(exact_sum("total_revenue")).alias("total_revenue"),
                  F.sum("total_number_of_unit").alias("total_units_sold")))
    e = costs.select("store_id", "category", r2(R("cost").cast("double") / F.nullif(R("priced"), F.lit(0))).alias("_avg_cost"),
                     R("orders").alias("total_orders"))
    return _margin(p, e)


# ------------------------------------------------------------------ G11/G12
def _avg_if(cond: Column) -> Column:
    return r2(F.avg(F.when(cond, R("sensor_value"))))


def _unit_is(u: str) -> Column:
    return R("sensor_unit") == u


def _type_is(t: str) -> Column:
    return R("event_type") == t


def iot_store_daily(iot: DataFrame) -> DataFrame:
    """G11 store-day sensor pivot: one pass of conditional averages (the
    conditions mix unit and event type, so ``pivot()`` does not fit)."""
    return (iot.groupBy(F.to_date("event_ts").alias("event_date"), "store_id", "store_name")
               .agg(_avg_if(_unit_is("kg")).alias("avg_weight"),
                    _avg_if(_unit_is("celsius")).alias("avg_temperature"),
                    _avg_if(_unit_is("percent") & _type_is("entrance_gate")).alias("avg_occupancy"),
                    _avg_if(_unit_is("count") & _type_is("entrance_gate")).alias("avg_footfall"),
                    _avg_if(_unit_is("percent") & _type_is("cold_storage")).alias("avg_humidity"),
                    _avg_if(_unit_is("count") & _type_is("energy_meter")).alias("avg_power"),
                    F.count_distinct(F.when(R("alert_type").isNotNull(), R("event_id")))
                     .alias("total_number_of_alerts")))


def iot_pivot(iot: DataFrame) -> DataFrame:
    """G12 weight / occupancy / humidity per store-day, date then name."""
    return (iot.groupBy("store_id", "store_name", F.to_date("event_ts").alias("event_date"))
               .agg(_avg_if(_unit_is("kg")).alias("average_value"),
                    _avg_if(_unit_is("percent") & _type_is("entrance_gate")).alias("occupancy_percentage"),
                    _avg_if(_unit_is("percent") & _type_is("cold_storage")).alias("humidity_percentage"))
               .orderBy(R("event_date").asc_nulls_last(), R("store_name").asc_nulls_last()))


# ------------------------------------------------------------------ G13
def sales_vs_iot(fact: DataFrame, iot_daily: DataFrame) -> DataFrame:
    """G13 fact (store × category × day) joined with the store-day sensor
    pivot; sensor values repeat per category.  ``avg_alerts`` is the day's
    alert count, as published."""
    i = iot_daily.select(R("store_id").alias("_sid"), R("event_date"), "avg_temperature",
                         "avg_power", "avg_footfall", "total_number_of_alerts", "avg_occupancy")
    j = fact.join(i, (R("store_id") == R("_sid")) & (R("report_date") == R("event_date")))
    return j.select(
        "report_date", "store_id", "store_name", "category", "total_transaction",
        r2(R("total_revenue")).alias("total_revenue"),
        r2(R("avg_cart")).alias("avg_basket_size"),
        r2(R("avg_temperature")).alias("avg_temperature"),
        r2(R("avg_power")).alias("avg_power"),
        r2(R("avg_footfall")).alias("avg_footfall"),
        R("total_number_of_alerts").alias("avg_alerts"),
        r2(R("avg_occupancy")).alias("avg_occupancy"))


# ------------------------------------------------------------------ G14
def _pct_change(cur: str, prev: Column) -> Column:
    return (R(cur) - prev) / F.nullif(prev, F.lit(0)) * 100


def quarter_change(pos: DataFrame) -> DataFrame:
    """G14 quarter-over-quarter: cart, units, revenue, transactions, customers
    per (year, quarter) and % change against the previous quarter.

    Lines without a date form a row of their own (NULL year and quarter), so the
    totals over all rows are those of all lines; it has no previous quarter and
    is none.  The window runs over the aggregated quarters (a few rows per year
    of data), never over sales rows."""
    d = F.to_date("transaction_date")
    q = (pos.groupBy(F.year(d).alias("year"), F.quarter(d).alias("quarter"))
            .agg(F.avg("total_orderline").alias("avg_cart"),
                 F.sum("quantity").alias("total_units"),
                 exact_sum("total_orderline").alias("total_revenue"),
                 F.count_distinct("transaction_id").alias("total_transactions"),
                 F.count_distinct("customer_id").alias("total_customers")))
    w = Window.partitionBy(R("year").isNull()).orderBy("year", "quarter")
    metrics = ["avg_cart", "total_units", "total_revenue", "total_transactions",
               "total_customers"]
    return q.select("year", "quarter", *metrics,
                    *[_pct_change(m, F.lag(m).over(w)).alias(f"{m}_change_pct")
                      for m in metrics])


# ------------------------------------------------------------------ G15
def revenue_by_city(pos: DataFrame) -> DataFrame:
    return (pos.groupBy("store_city")
               .agg(exact_sum("total_orderline").alias("total_revenue"),
                    F.count_distinct("transaction_id").alias("total_transactions"),
                    F.count_distinct("customer_id").alias("unique_customers")))


def units_by_category(pos: DataFrame) -> DataFrame:
    return pos.groupBy("category").agg(F.sum("quantity").alias("total_units"))


def payment_share(pos: DataFrame) -> DataFrame:
    """Revenue share per payment method.  The total is a window over the
    aggregated methods (a handful of rows), so the sales are scanned once."""
    m = pos.groupBy("payment_method").agg(exact_sum("total_orderline").alias("total_revenue"))
    total = (F.sum(R("total_revenue").cast(EXACT_SUM_TYPE)).over(Window.partitionBy())
             .cast("double"))
    return m.select("payment_method", "total_revenue",
                    (R("total_revenue") / F.nullif(total, F.lit(0)) * 100).alias("revenue_share_pct"))


def monthly_revenue(pos: DataFrame) -> DataFrame:
    d = F.to_date("transaction_date")
    return (pos.groupBy(F.trunc(d, "month").alias("month"))
               .agg(exact_sum("total_orderline").alias("total_revenue"),
                    F.count_distinct("transaction_id").alias("total_transactions"),
                    F.count_distinct("customer_id").alias("unique_customers")))


# ------------------------------------------------------------------ V1
def row_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """V1 has-data check: one row per dataset (rows, newest load time).

    Each count is a global aggregate (partial counts per task); the union
    is of one-row results."""
    out = None
    for name, df in datasets.items():
        lt = [c for c in ("loaded_time", "load_timestamp") if c in df.columns]
        newest = F.max(lt[0]) if lt else F.lit(None).cast("timestamp")
        one = df.agg(F.count(F.lit(1)).alias("row_count"),
                     newest.cast("timestamp").alias("max_loaded_time")
                     ).select(F.lit(name).alias("dataset"), "row_count", "max_loaded_time")
        out = one if out is None else out.unionByName(one)
    return out

"""Running the lake: landing folders → bronze → silver → gold.

``Lake(root)`` names the folders.  ``ingest`` starts the auto-ingest pipes,
``refine`` the silver tasks (both streaming; ``trigger=None`` back-fills what
is there and stops, a ``processingTime`` string keeps them running), and
``build_gold`` publishes the gold tables and registers the views over the
stored silver datasets.  Stream state lives under the session's shared
checkpoint folder.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import schemas
from tillroll.operators.distinct_state import DistinctState
from tillroll.plans import gold, publish
from tillroll.session import state_path
from tillroll.sources import landing
from tillroll.streaming import outcomes, pipes, tasks
from tillroll.streaming.commit import exists, put_file, read_json


@dataclass(frozen=True)
class Lake:
    root: str
    name: str = "lake"

    # landing stages (where files arrive, in dated sub-folders)
    @property
    def json_stage(self) -> str:
        return f"{self.root}/landing/json"

    @property
    def csv_stage(self) -> str:
        return f"{self.root}/landing/ftp/csv"

    @property
    def parquet_stage(self) -> str:
        return f"{self.root}/landing/ftp/parquet"

    def bronze(self, t: str) -> str:
        return f"{self.root}/bronze/{t}"

    def silver(self, t: str) -> str:
        return f"{self.root}/silver/{t}"

    def gold(self, t: str) -> str:
        return f"{self.root}/gold/{t}"

    def distinct(self) -> DistinctState:
        """Distinct transactions and customers of the POS lines, kept by the refreshes."""
        return DistinctState(self.gold("_distinct"), ("transaction_id", "customer_id"), "transaction_date",
                             "payment_method string")

    def checkpoint(self, spark: SparkSession, job: str) -> str:
        """Stream state of one job; each root has its own, whatever its name."""
        of = hashlib.sha256(self.root.rstrip("/").encode()).hexdigest()[:16]
        return state_path(spark, "streams", f"{self.name}-{of}", job)


def ingest(spark: SparkSession, lake: Lake, trigger: str | None = None,
           json_layout: str = "array") -> list[StreamingQuery]:
    """Pipes: CSV → ``stg_csv_transaction`` (+ quarantine), JSON →
    ``stg_json_iot``, ``*orders*.parquet`` → order log, ``*inventory*.parquet``
    → inventory."""
    for stage in (lake.csv_stage, lake.json_stage, lake.parquet_stage):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage)  # nothing may have landed yet
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    qs = pipes.pos_pipe(spark, lake.csv_stage, lake.bronze("pos"), lake.bronze("pos_quarantine"),
                        lake.checkpoint(spark, "pos_pipe"), trigger)
    qs += pipes.json_pipe(spark, lake.json_stage, lake.bronze("iot"),
                          lake.checkpoint(spark, "json_pipe"), json_layout, trigger,
                          lake.bronze("iot_quarantine"))
    qs.append(pipes.orders_pipe(spark, lake.parquet_stage, lake.bronze("orders"),
                                lake.checkpoint(spark, "orders_pipe"), trigger))
    qs.append(pipes.inventory_pipe(spark, lake.parquet_stage, lake.bronze("inventory"),
                                   lake.checkpoint(spark, "inventory_pipe"), trigger))
    return qs


def load_outcomes(spark: SparkSession, lake: Lake) -> DataFrame:
    """What became of every file in the landing folders, read off bronze and the quarantines
    (``outcomes.file_outcomes``); ``outcomes.outcome_events`` of it is the ledger."""
    stages = ((lake.json_stage, landing.FEED_DRIVE), (lake.csv_stage, landing.FEED_FTP), (lake.parquet_stage, landing.FEED_FTP))
    files = reduce(DataFrame.unionByName, [outcomes.landed_files(spark, path, feed) for path, feed in stages])

    def tables(suffix: str) -> list[DataFrame]:
        named = [lake.bronze(f"{t}{suffix}") for t in ("pos", "iot", "orders", "inventory")]
        return [spark.read.schema("source_file string, loaded_time timestamp").parquet(path) for path in named]

    return outcomes.file_outcomes(files, tables(""), tables("_quarantine"))


def refine(spark: SparkSession, lake: Lake, trigger: str | None = None) -> list[StreamingQuery]:
    """Tasks: bronze → silver POS lines, sensor readings, orders (MERGE)."""
    return [
        tasks.pos_task(spark, lake.bronze("pos"), lake.silver("pos"),
                       lake.checkpoint(spark, "pos_task"), trigger),
        tasks.iot_task(spark, lake.bronze("iot"), lake.silver("iot"),
                       lake.checkpoint(spark, "iot_task"), trigger),
        tasks.orders_task(spark, lake.bronze("orders"), lake.silver("orders"),
                          lake.checkpoint(spark, "orders_task"), trigger),
    ]


def await_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()


def silver_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {
        "silver_csv_transaction": tasks.read_silver(spark, lake.silver("pos"), schemas.POS_SILVER),
        "silver_iot_events": tasks.read_silver(spark, lake.silver("iot"), schemas.IOT_SILVER),
        "silver_erp_orders": tasks.read_current(spark, lake.silver("orders")),
    }


def build_gold(spark: SparkSession, lake: Lake, since=None) -> dict[str, DataFrame]:
    """Publish the gold tables (CTAS) and register every gold view.

    With ``since`` (a process time), ``fact_decisions`` is recomputed only for the report
    dates of lines that silver took in after it; the days it replaces equal a full
    rebuild's.  Silver commits its batches in order, so nothing older comes later.

    Tables: ``fact_decisions`` (by report date), ``fact_gross_margin``,
    ``fact_iot_store_daily``, ``fact_sales_verses_iot`` and the refreshed
    ``matelized_view_category_by_region``.  Views are live DataFrames over
    the stored tables.  Returns all of them by name."""
    s = silver_tables(spark, lake)
    pos, iot, erp = (s["silver_csv_transaction"], s["silver_iot_events"],
                     s["silver_erp_orders"])
    if since is None:
        publish.publish(gold.fact_decisions(pos), lake.gold("fact_decisions"), ("report_date",))
    else:
        publish.refresh_fact_days(spark, pos, pos.filter(F.col("process_time") > F.lit(since)),
                                  gold.fact_decisions, lake.gold("fact_decisions"))
    fact = spark.read.parquet(lake.gold("fact_decisions"))
    publish.publish(gold.gross_margin(pos, erp), lake.gold("fact_gross_margin"))
    publish.publish(gold.iot_store_daily(iot), lake.gold("fact_iot_store_daily"), ("event_date",))
    iot_daily = spark.read.parquet(lake.gold("fact_iot_store_daily"))
    publish.publish(gold.sales_vs_iot(fact, iot_daily), lake.gold("fact_sales_verses_iot"), ("report_date",))
    publish.publish(gold.category_by_region(fact),
                    lake.gold("matelized_view_category_by_region"))
    return gold_tables(spark, lake)


def gold_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The published gold tables and the views over the stored data, all registered, by name."""
    s = silver_tables(spark, lake)
    pos, iot = s["silver_csv_transaction"], s["silver_iot_events"]
    fact = spark.read.parquet(lake.gold("fact_decisions"))
    iot_daily = spark.read.parquet(lake.gold("fact_iot_store_daily"))
    out = dict(s)
    out.update({
        "fact_decisions": fact,
        "fact_gross_margin": spark.read.parquet(lake.gold("fact_gross_margin")),
        "fact_iot_store_daily": iot_daily,
        "fact_sales_verses_iot": spark.read.parquet(lake.gold("fact_sales_verses_iot")),
        "matelized_view_category_by_region":
            spark.read.parquet(lake.gold("matelized_view_category_by_region")),
        "fact_kpi_summary": gold.kpi_summary(pos),
        "store_revenue": gold.store_revenue(fact),
        "fact_daily_revenue": gold.daily_revenue(pos),
        "daily_revenue_by_payment": gold.daily_revenue_by_payment(pos),
        "sensor_stats": gold.sensor_stats(iot),
        "sensor_by_event_type": gold.sensor_by_event_type(iot),
        "sales_kg_sensor": gold.sales_kg_sensor(pos, iot),
        "iot_pivot": gold.iot_pivot(iot),
        "quarter_change": gold.quarter_change(pos),
        "revenue_by_city": gold.revenue_by_city(pos),
        "units_by_category": gold.units_by_category(pos),
        "payment_share": gold.payment_share(pos),
        "monthly_revenue": gold.monthly_revenue(pos),
    })
    if exists(spark, lake.distinct().root):
        # counts of whole months come from the days' bitmaps, not from the lines
        month = F.trunc("transaction_date", "MM").alias("sales_month")
        out["distinct_by_month"] = lake.distinct().counts(spark, (month,))
    out["row_counts"] = gold.row_counts({k: out[k] for k in (
        "silver_csv_transaction", "silver_iot_events", "silver_erp_orders",
        "fact_decisions", "fact_iot_store_daily", "fact_sales_verses_iot")})
    publish.register_views(spark, out)
    return out


def refresh_gold(spark: SparkSession, lake: Lake) -> dict[str, set]:
    """Bring the gold tables up to date from what has changed, and only that.

    The days that new silver batches touch were observed when these were written, and
    the orders table put out change rows; what the last refresh has taken in is
    kept beside gold.  Touched days flow on: POS days to ``fact_decisions``, sensor days to
    ``fact_iot_store_daily``, both to ``fact_sales_verses_iot`` (only these days' folders
    are read and replaced); order changes are added to the cost sums of the margin.  What spans
    all days is put together from the daily fact, never from silver.

    Returns the days taken in, by silver table.  A refresh that breaks off is done again whole."""
    state_file = f"{lake.gold('_refresh')}/state.json"
    state = read_json(spark, state_file)
    if state is None:
        state = {"pos": -1, "iot": -1, "orders": -1}
    taken, newest = {}, dict(state)
    for name in ("pos", "iot"):
        taken[name], newest[name] = tasks.touched_days(spark, lake.silver(name), state[name])
    newest["orders"] = max([state["orders"], *tasks.generations(spark, lake.silver("orders"))])
    changed = newest["orders"] > state["orders"]
    costs_at = "{}/upto={}".format(lake.gold("_order_costs"), "{}")
    s = silver_tables(spark, lake)
    first = state["pos"] < 0 and state["iot"] < 0 and state["orders"] < 0

    def days_of(table: DataFrame, column: str, days: set) -> DataFrame:
        return table if first else table.filter(publish.in_days(column, days))

    def lines_of(name: str, column: str, days: set) -> DataFrame:
        return s[name] if first else tasks.only_days(s[name], column, days)

    if taken["pos"] or first:
        lines = lines_of("silver_csv_transaction", "transaction_date", taken["pos"])
        publish.replace_days(gold.fact_decisions(lines), lake.gold("fact_decisions"), "report_date")
        if newest["pos"] >= 0:
            # lines that the state holds already change nothing in it
            lake.distinct().append(lines, newest["pos"])
    fact = spark.read.parquet(lake.gold("fact_decisions"))
    if taken["iot"] or first:
        publish.replace_days(gold.iot_store_daily(lines_of("silver_iot_events", "event_ts", taken["iot"])),
                             lake.gold("fact_iot_store_daily"), "event_date")
    iot_daily = spark.read.parquet(lake.gold("fact_iot_store_daily"))
    both = (taken["pos"] | taken["iot"]) - {None}  # days join days
    if both or first:
        publish.replace_days(gold.sales_vs_iot(days_of(fact, "report_date", both), days_of(iot_daily, "event_date", both)),
                             lake.gold("fact_sales_verses_iot"), "report_date")
    if changed:
        old = state["orders"]
        if old < 0:
            costs = gold.order_costs(s["silver_erp_orders"])
        else:
            fresh = tasks.read_changes(spark, lake.silver("orders") + "_changes", old)
            costs = gold.add_order_costs(spark.read.parquet(costs_at.format(old)), fresh)
        publish.publish(costs, costs_at.format(newest["orders"]))
    if taken["pos"] or changed or first:
        publish.publish(gold.category_by_region(fact), lake.gold("matelized_view_category_by_region"))
        if newest["orders"] >= 0:
            costs = spark.read.parquet(costs_at.format(newest["orders"]))
            publish.publish(gold.gross_margin_from(fact, costs), lake.gold("fact_gross_margin"))
    put_file(spark, state_file, json.dumps(newest))
    return taken


def load_time_window(df: DataFrame, since) -> DataFrame:
    """Rows loaded at or after ``since`` (reads of a stream's table between
    runs; reading does not consume).  On bronze the day condition prunes
    ``ingest_date`` folders before any file is opened."""
    ts = F.lit(since).cast("timestamp")
    if "ingest_date" in df.columns:
        df = df.filter(F.col("ingest_date") >= F.to_date(ts))
    return df.filter(F.col("loaded_time") >= ts)


def main(argv: list[str] | None = None) -> None:
    """``python -m tillroll.jobs ROOT [--trigger "1 minute"] [--json-layout lines]``

    Without ``--trigger``: back-fill everything landed so far, refine, publish
    gold, print the row counts.  With it: keep the pipes and tasks running, and bring
    gold up to date every ``--gold-every`` seconds."""
    import argparse

    from tillroll.session import build_session
    ap = argparse.ArgumentParser(prog="tillroll.jobs")
    ap.add_argument("root")
    ap.add_argument("--trigger", default=None)
    ap.add_argument("--json-layout", default="array", choices=["array", "lines"])
    ap.add_argument("--gold-every", type=int, default=300)
    args = ap.parse_args(argv)
    spark = build_session()
    lake = Lake(args.root)
    if args.trigger:
        qs = ingest(spark, lake, args.trigger, args.json_layout) + refine(spark, lake, args.trigger)
        while not spark.streams.awaitAnyTermination(args.gold_every):
            if all(exists(spark, lake.silver(t)) for t in ("pos", "iot")):
                refresh_gold(spark, lake)
                gold_tables(spark, lake)
        for q in qs:
            q.stop()
        return
    await_all(ingest(spark, lake, None, args.json_layout))
    await_all(refine(spark, lake))
    build_gold(spark, lake)["row_counts"].show(truncate=False)


if __name__ == "__main__":
    main()

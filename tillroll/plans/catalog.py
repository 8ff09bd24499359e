"""Named queries over the driver's test tables (one per operator group).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Presentation
for comparison: columns holding load/process time or the session's offset are
dropped (they differ per run), and DOUBLE columns are rounded half away from
zero to 2 places, exactly as the SQL oracle does (``oracle.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tillroll.functions.expr import round_half_away
from tillroll.operators import changes
from tillroll.plans import gold, testmodel as tm
from tillroll.session import SEMANTIC_CONF

RUN_VARYING = {"loaded_time", "process_time", "processed_timestamp", "load_timestamp",
               "timezone", "max_loaded_time"}

# Fixed parameters of the registered time-travel queries.
AS_OF_TIMESTAMP = "1998-06-30 23:59:59"
AS_OF_OFFSET_SECONDS = 30 * 24 * 3600
# Commit times that part the order change log into the loads of the registered commit queries.
COMMIT_CUTS = ("1996-01-01 00:00:00", "1999-01-01 00:00:00")
# Load times that part the order log into the batches of the registered MERGE queries.
MERGE_CUTS = ["1994-07-01 00:00:00", "1997-01-01 00:00:00"]


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in RUN_VARYING:
            continue
        c = F.col(f.name)
        cols.append(round_half_away(c).alias(f.name) if isinstance(f.dataType, DoubleType) else c)
    return df.select(*cols)


def _prepare(spark: SparkSession) -> None:
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _prepare(spark)
            return present(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---------------------------------------------------------------- silver
@register("pos_staging")
def q_pos_staging(spark, d):
    """S14 load-with-transformation: casts, date+time → timestamp, lineage."""
    return tm.pos_staging(spark, d)


@register("silver_pos_clean")
def q_silver_pos(spark, d):
    """B1 clean POS lines (P10 clamps, F1–F7, F15)."""
    return tm.pos_silver(spark, d)


@register("silver_iot_flatten")
def q_silver_iot(spark, d):
    """B2 flatten nested sensor payloads."""
    return tm.iot_silver(spark, d)


@register("silver_erp_latest")
def q_silver_erp(spark, d):
    """B3/C5 upsert of order versions: last processed version per order."""
    return tm.erp_silver(spark, d)


# ---------------------------------------------------------------- gold POS
@register("fact_decisions")
def q_fact_decisions(spark, d):
    return gold.fact_decisions(tm.pos_silver(spark, d))


@register("kpi_summary")
def q_kpi(spark, d):
    return gold.kpi_summary(tm.pos_silver(spark, d))


@register("store_revenue_30d")
def q_store_revenue(spark, d):
    pos = tm.pos_silver(spark, d)
    return gold.store_revenue(gold.fact_decisions(pos), latest=gold.latest_sale_date(pos))


@register("category_by_region")
def q_category_by_region(spark, d):
    return gold.category_by_region(gold.fact_decisions(tm.pos_silver(spark, d)))


@register("daily_revenue")
def q_daily_revenue(spark, d):
    return gold.daily_revenue(tm.pos_silver(spark, d))


@register("daily_revenue_by_payment")
def q_daily_revenue_by_payment(spark, d):
    return gold.daily_revenue_by_payment(tm.pos_silver(spark, d))


@register("quarter_change")
def q_quarter_change(spark, d):
    return gold.quarter_change(tm.pos_silver(spark, d))


@register("revenue_by_city")
def q_revenue_by_city(spark, d):
    return gold.revenue_by_city(tm.pos_silver(spark, d))


@register("units_by_category")
def q_units_by_category(spark, d):
    return gold.units_by_category(tm.pos_silver(spark, d))


@register("payment_share")
def q_payment_share(spark, d):
    return gold.payment_share(tm.pos_silver(spark, d))


@register("monthly_revenue")
def q_monthly_revenue(spark, d):
    return gold.monthly_revenue(tm.pos_silver(spark, d))


# ---------------------------------------------------------------- gold IoT
@register("sensor_stats")
def q_sensor_stats(spark, d):
    return gold.sensor_stats(tm.iot_silver(spark, d))


@register("sensor_by_event_type")
def q_sensor_by_event_type(spark, d):
    return gold.sensor_by_event_type(tm.iot_silver(spark, d))


@register("iot_store_daily")
def q_iot_store_daily(spark, d):
    return gold.iot_store_daily(tm.iot_silver(spark, d))


@register("iot_pivot")
def q_iot_pivot(spark, d):
    return gold.iot_pivot(tm.iot_silver(spark, d))


@register("sales_kg_sensor")
def q_sales_kg_sensor(spark, d):
    return gold.sales_kg_sensor(tm.pos_silver(spark, d), tm.iot_silver(spark, d))


@register("sales_vs_iot")
def q_sales_vs_iot(spark, d):
    return gold.sales_vs_iot(gold.fact_decisions(tm.pos_silver(spark, d)),
                             gold.iot_store_daily(tm.iot_silver(spark, d)))


# ---------------------------------------------------------------- gold ERP
@register("gross_margin")
def q_gross_margin(spark, d):
    return gold.gross_margin(tm.pos_silver(spark, d), tm.erp_silver(spark, d))


# ---------------------------------------------------------------- changes
def _order_state(log, bound, inclusive=True):
    return changes.state_as_of(log, "order_id", bound, inclusive=inclusive,
                               tie_cols=("source_file",))


@register("as_of_timestamp")
def q_as_of_timestamp(spark, d):
    """T2 ``AT(TIMESTAMP => …)`` over the order change log."""
    log = tm.order_change_log(spark, d)
    return _order_state(log, F.lit(AS_OF_TIMESTAMP).cast("timestamp_ntz"))


@register("as_of_offset")
def q_as_of_offset(spark, d):
    """T1 ``AT(OFFSET => -30 days)`` anchored at the log's last commit."""
    log = tm.order_change_log(spark, d)
    return changes.state_as_of_offset(log, "order_id", AS_OF_OFFSET_SECONDS,
                                      anchor=changes.last_commit(log),
                                      tie_cols=("source_file",))


@register("before_version")
def q_before_version(spark, d):
    """T3 ``BEFORE(STATEMENT => last load)``: state just before the last commit."""
    log = tm.order_change_log(spark, d)
    return _order_state(log, changes.last_commit(log), inclusive=False)


def _committed_orders(spark, d):
    """The order change log loaded in three commits; its folder."""
    import uuid

    from tillroll.operators import commits
    from tillroll.session import state_path
    root = state_path(spark, "committed", uuid.uuid4().hex)
    log = tm.order_change_log(spark, d)
    cuts = [F.lit(c).cast("timestamp_ntz") for c in COMMIT_CUTS]
    # undated versions come with the last load
    load = F.when(F.col("commit_ts") < cuts[0], 0).when(F.col("commit_ts") < cuts[1], 1).otherwise(2)
    for i in range(len(cuts) + 1):
        commits.append(root, log.where(load == i), i)
    return root


@register("before_commit")
def q_before_commit(spark, d):
    """T3 ``BEFORE(STATEMENT => last load)`` over the log kept by commits: the last load's folder is not read."""
    from tillroll.operators import commits
    root = _committed_orders(spark, d)
    return commits.state_at_commit(spark, root, "order_id", commits.last_commit(spark, root), inclusive=False,
                                   tie_cols=("source_file",))


@register("commit_index")
def q_commit_index(spark, d):
    """V1/T1 rows and times of each load, observed while it was written."""
    from tillroll.operators import commits
    return commits.index(spark, _committed_orders(spark, d))


@register("changes_diff")
def q_changes_diff(spark, d):
    """C3 standard change stream between the T2 state and the current state."""
    log = tm.order_change_log(spark, d)
    return changes.log_diff(log, "order_id", F.lit(AS_OF_TIMESTAMP).cast("timestamp_ntz"),
                            None, tie_cols=("source_file",))


@register("restore_value")
def q_restore_value(spark, d):
    """T4/P13 ``UPDATE … SET quantity_ordered = (SELECT … BEFORE(last load)
    WHERE order_id = t.order_id)`` applied to every current order."""
    log = tm.order_change_log(spark, d)
    last = changes.last_commit(log)
    return changes.log_restore(log, "order_id", None, last, ["quantity_ordered"],
                               tie_cols=("source_file",))


@register("conditional_update")
def q_conditional_update(spark, d):
    """Discounts under 10 become 99, as an update with a condition."""
    stg = tm.pos_staging(spark, d)
    return changes.update_where(stg, {"discount_pct": F.lit(99.0)}, F.col("discount_pct") < 10)


@register("distinct_values")
def q_distinct_values(spark, d):
    """P11 ``SELECT DISTINCT discount_pct`` of the staged POS lines."""
    return tm.pos_staging(spark, d).select("discount_pct").distinct()


@register("row_counts")
def q_row_counts(spark, d):
    """V1 row counts of the silver datasets and the main facts."""
    pos = tm.pos_silver(spark, d)
    iot = tm.iot_silver(spark, d)
    return gold.row_counts({
        "silver_csv_transaction": pos,
        "silver_iot_events": iot,
        "silver_erp_orders": tm.erp_silver(spark, d),
        "fact_decisions": gold.fact_decisions(pos),
        "fact_iot_store_daily": gold.iot_store_daily(iot),
    })


# ---------------------------------------------------------------- landing
@register("file_classify")
def q_file_classify(spark, d):
    """S1–S3 extension gate per feed and dated landing key."""
    classified, _, _ = tm.landing_run(spark, d)
    return classified


@register("file_skip_existing")
def q_file_skip_existing(spark, d):
    """S4 files whose landing key already exists in the store."""
    _, marked, _ = tm.landing_run(spark, d)
    return marked.select("feed", "file_ref", "file_name", "accepted", "landing_key",
                         "already_exists")


@register("landing_ledger")
def q_landing_ledger(spark, d):
    """S5 status events appended by the run."""
    _, _, ledger = tm.landing_run(spark, d)
    return ledger


@register("file_current_status")
def q_file_current_status(spark, d):
    """S6 latest status per file."""
    from tillroll.sources import landing
    _, _, ledger = tm.landing_run(spark, d)
    return landing.current_status(ledger)


@register("latest_events_topk")
def q_latest_events(spark, d):
    """L3 newest ten ledger events."""
    from tillroll.sources import landing
    _, _, ledger = tm.landing_run(spark, d)
    return landing.latest_events(ledger, 10)


# ---------------------------------------------------------------- more sources
@register("silver_iot_typed")
def q_silver_iot_typed(spark, d):
    """B2 over the typed path: payload events read as ``IOT_EVENT`` rows."""
    from tillroll import schemas
    from tillroll.plans import silver
    b = tm.iot_bronze(spark, d)
    ev = (b.lateralJoin(spark.tvf.variant_explode(F.col("raw_payload").outer()))
           .select(F.try_variant_get("value", "$", schemas.IOT_EVENT.simpleString()).alias("e"),
                   "source_file", "loaded_time")
           .select("e.*", "source_file", "loaded_time"))
    return silver.flatten_iot_typed(ev)


@register("name_normalize")
def q_name_normalize(spark, d):
    """S22 order files whose column names differ per batch (case, spaces)
    conformed back to the declared schema."""
    from tillroll import schemas
    from tillroll.sources.readers import conform
    files = tm.erp_bronze(spark, d)
    odd = files.toDF(*[(c.upper() if i % 2 else f" {c.replace('_', ' ').title()} ")
                       for i, c in enumerate(files.columns)])
    return conform(odd, schemas.ERP_ORDERS)


@register("pos_quarantine")
def q_pos_quarantine(spark, d):
    """Quarantine split of the POS lines: rows that cannot be staged, with why."""
    from tillroll.sources import readers
    raw = tm.pos_lines(spark, d).withColumn(readers.CORRUPT, F.lit(None).cast("string")) \
        .withColumn("loaded_time", F.current_timestamp())
    _, bad = readers.split_pos(raw)
    return bad.drop(readers.CORRUPT)


@register("json_flatten")
def q_json_flatten(spark, d):
    """One row per event of every payload."""
    from tillroll.operators.flatten import flatten
    rows = flatten(spark, tm.iot_bronze(spark, d), "raw_payload")
    return rows.select("source_file",
                       F.try_variant_get("value", "$.event_id", "string").alias("event_id"),
                       F.try_variant_get("value", "$.event_type", "string").alias("event_type"),
                       F.schema_of_variant("value").startswith("OBJECT").alias("is_object"))


# ---------------------------------------------------------------- loads of landed files
@register("pos_csv_load")
def q_pos_csv_load(spark, d):
    """S8/S12/S14 CSV files with a header → staged POS lines; bad lines stay out."""
    from tillroll import schemas
    from tillroll.sources import readers
    lines = tm.pos_raw(spark, d).select(
        *[F.col(c).cast("string").alias(c) for c in schemas.POS_CSV_FIELDS])
    path = tm.landed(spark, "csv", lines, "csv", header=True, escape='"')
    good, _ = readers.split_pos(readers.read_pos_csv(spark, path))
    return good.drop("source_file")


def _event_files(spark, d, text):
    """Sensor events as JSON files of one event per line; ``text`` may spoil a line."""
    from tillroll.sources import readers
    events = tm.iot_events(spark, d).select("event.*")
    path = tm.landed(spark, "json", events.select(text(F.to_json(F.struct("*"))).alias("value")), "text")
    return readers.split_json(readers.read_json_records(spark, path, "lines"))


@register("iot_json_load")
def q_iot_json_load(spark, d):
    """S7/S15 JSON files → VARIANT payloads → one row per reading."""
    from tillroll.plans import silver
    good, _ = _event_files(spark, d, lambda line: line)
    return silver.flatten_iot(spark, good).drop("source_file")


@register("json_quarantine")
def q_json_quarantine(spark, d):
    """Lines that break off go to the quarantine, all others are loaded: per event id,
    where it went.  A line breaks off if its event's text ends in 7."""
    def spoil(line):
        ends = F.get_json_object(line, "$.event_id").endswith("7")
        return F.when(ends, F.substring(line, 1, F.length(line) - 3)).otherwise(line)

    good, bad = _event_files(spark, d, spoil)
    held = bad.select(F.regexp_extract("record", '"event_id":"([0-9]+)"', 1).alias("event_id"),
                      "reason")
    return good.select(F.try_variant_get("raw_payload", "$.event_id", "string").alias("event_id"),
                       F.lit("loaded").alias("reason")).unionByName(held)


@register("orders_parquet_load")
def q_orders_parquet_load(spark, d):
    """S9/S13/S16/S17 parquet files, picked by the pattern of their path, columns by name."""
    from tillroll import schemas
    from tillroll.sources import readers
    names = [f.name for f in schemas.ERP_ORDERS.fields]
    path = tm.landed(spark, "erp", tm.build_erp_bronze(spark, d).select(*reversed(names)), "parquet")
    # the landed folder's files have Spark's names; the feed's pattern is in the folder
    return readers.read_erp_orders(spark, path, path_regex=r".*erp.*[.]parquet").select(*names)


@register("json_mixed_load")
def q_json_mixed_load(spark, d):
    """S7/S15/S20/C2 the JSON pipe over array files with unknown fields, ill-typed values, broken
    and foreign elements: what became of each event; events in = loaded + quarantined."""
    from tillroll.streaming import pipes
    src = tm.landed(spark, "json-mixed", tm.mixed_event_arrays(spark, d), "text")
    bronze, held = f"{src}-bronze", f"{src}-held"
    for q in pipes.json_pipe(spark, src, bronze, f"{src}-state", quarantine=held):
        q.awaitTermination()
    p = F.col("raw_payload")

    def field(path):
        return F.try_variant_get(p, path, "string")

    good = spark.read.parquet(bronze).select(
        field("$.event_id").alias("event_id"), F.lit("loaded").alias("outcome"), field("$.metadata.battery_pct").alias("battery"),
        field("$.readings[0].value").alias("value"), field("$.extra.note").alias("note"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("battery", "value", "note")]
    bad = spark.read.parquet(held).select(
        F.regexp_extract("record", "([0-9]+)", 1).alias("event_id"), F.col("reason").alias("outcome"), *nothing)
    return good.unionByName(bad)


@register("orders_mixed_load")
def q_orders_mixed_load(spark, d):
    """S9/S13/S16/S22 the order pipe over files of three layouts (declared; spaced upper-case names
    with DOUBLE quantities and text dates; text quantities, a column missing, one more)."""
    from tillroll import schemas
    from tillroll.streaming import pipes
    src = tm.landed_as(spark, "erp_orders", tm.mixed_order_layouts(spark, d))
    bronze, held = f"{src}-bronze", f"{src}-held"
    pipes.orders_pipe(spark, src, bronze, f"{src}-state", quarantine=held).awaitTermination()
    kept = ["order_id", "order_date", "product_sku", "quantity_ordered", "quantity_received", "unit_cost", "warehouse_id", "is_late"]
    types = {f.name: f.dataType for f in schemas.ERP_ORDERS.fields}
    good = spark.read.parquet(bronze).select(*kept, F.lit("loaded").alias("outcome"))
    bad = spark.read.parquet(held).select(
        *[F.get_json_object("record", f"$.{c}").try_cast(types[c]).alias(c) for c in kept], F.col("reason").alias("outcome"))
    return good.unionByName(bad)


def _outcomes(spark, d):
    """Sensor events landed by day, some of them spoilt, taken in by the JSON pipe: what became of each file.

    On the 13th of a month all lines break off, on other odd days those of event ids that end in 7."""
    from tillroll.sources import landing
    from tillroll.streaming import outcomes, pipes
    day = F.to_date(F.substring("event.timestamp", 1, 10))
    line = F.to_json("event")
    spoilt = (F.dayofmonth(day) == 13) | ((F.dayofmonth(day) % 2 == 1) & F.col("event.event_id").endswith("7"))
    lines = tm.iot_events(spark, d).select(
        day.alias("day"), F.when(spoilt, F.substring(line, 1, F.length(line) - 3)).otherwise(line).alias("value"))
    src = tm.landed(spark, "json-days", lines.hint("rebalance", "day"), "text", by=("day",))
    bronze, held = f"{src}-bronze", f"{src}-held"
    for q in pipes.json_pipe(spark, src, bronze, f"{src}-state", "lines", quarantine=held):
        q.awaitTermination()
    tables = [spark.read.parquet(path).select("source_file", "loaded_time") for path in (bronze, held)]
    return outcomes.file_outcomes(outcomes.landed_files(spark, src, landing.FEED_DRIVE), [tables[0]], [tables[1]])


def _landed_day(ref):
    return F.regexp_extract(ref, "/day=([^/]*)/", 1).try_cast("date").alias("landed_day")


@register("load_outcomes")
def q_load_outcomes(spark, d):
    """S6 rows loaded and quarantined of the files of each landing day, read off the tables."""
    return _outcomes(spark, d).groupBy(_landed_day("file_ref")).agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_quarantined").alias("rows_quarantined"),
        F.count_if(F.col("status") == "NO_ROWS").alias("files_without_rows"))


@register("load_status")
def q_load_status(spark, d):
    """S6 the current status of each landing day's files, from the ledger of what happened to them."""
    from tillroll.sources import landing
    from tillroll.streaming import outcomes
    now = landing.current_status(outcomes.outcome_events(_outcomes(spark, d)))
    every = [F.when(F.bool_and(F.col("status") == s), s) for s in (outcomes.LOADED, outcomes.QUARANTINED)]
    return now.groupBy(_landed_day("original_file_id")).agg(
        F.coalesce(*every, F.lit(outcomes.PARTLY_LOADED)).alias("status"))


def _merged_orders(spark, d):
    """The order log merged in three batches, as its files' days would bring them; (table, change rows)."""
    import uuid

    from tillroll.session import state_path
    from tillroll.streaming import tasks
    root = state_path(spark, "merged", uuid.uuid4().hex)
    log = tm.erp_bronze(spark, d)
    lows, highs = [None, *MERGE_CUTS], [*MERGE_CUTS, None]
    for i, (low, high) in enumerate(zip(lows, highs, strict=True)):
        batch = log
        if low:
            batch = batch.filter(F.col("loaded_time") >= F.lit(low).cast("timestamp"))
        if high:
            batch = batch.filter(F.col("loaded_time") < F.lit(high).cast("timestamp"))
        tasks.merge_batch(spark, f"{root}/orders", batch, i, f"{root}/changes", keep=1)  # only the newest state is asked for
    return tasks.read_current(spark, f"{root}/orders"), tasks.read_changes(spark, f"{root}/changes").drop("change_batch")


@register("orders_merge")
def q_orders_merge(spark, d):
    """J6/C5 the incremental MERGE: its state after three batches."""
    return _merged_orders(spark, d)[0]


@register("orders_merge_changes")
def q_orders_merge_changes(spark, d):
    """C3 the change rows that the three MERGEs themselves put out."""
    return _merged_orders(spark, d)[1]


# ---------------------------------------------------------------- distinct counts that merge
# Sale days that part the POS lines into the batches of the registered queries.
DISTINCT_CUTS = ["1994-07-01", "1997-01-01"]


def _distinct_state(spark, d):
    """The POS lines taken into a bitmap state in three batches, undated lines with the last."""
    import uuid

    from tillroll.operators.distinct_state import DistinctState
    from tillroll.session import state_path
    state = DistinctState(state_path(spark, "distinct", uuid.uuid4().hex), ("transaction_id", "customer_id"),
                          "transaction_date", "payment_method string")
    lines = tm.pos_silver(spark, d)
    day = F.col("transaction_date")
    lows, highs = [None, *DISTINCT_CUTS], [*DISTINCT_CUTS, None]
    for i, (low, high) in enumerate(zip(lows, highs, strict=True)):
        batch = lines
        if low:
            batch = batch.filter(day >= F.lit(low).cast("date") if high else day.isNull() | (day >= F.lit(low).cast("date")))
        if high:
            batch = batch.filter(day < F.lit(high).cast("date"))
        state.append(batch, i)
    return state


@register("distinct_by_month")
def q_distinct_by_month(spark, d):
    """A6 exact distinct counts per month and payment method, merged from the days' bitmaps."""
    month = F.trunc("transaction_date", "MM").alias("sales_month")
    return _distinct_state(spark, d).counts(spark, (month, F.col("payment_method")))


@register("daily_revenue_merged")
def q_daily_revenue_merged(spark, d):
    """G5 with its distinct counts out of the bitmap state."""
    uniques = _distinct_state(spark, d).counts(spark, (F.col("transaction_date"),))
    return gold.daily_revenue_from(tm.pos_silver(spark, d), uniques)

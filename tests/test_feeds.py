"""How the feeds are derived: what is moved, and the texts that stay the same."""
from pyspark.sql import functions as F

from helpers import SF001, rows
from tillroll.plans import testmodel as tm


def test_lines_are_not_moved_by_customer(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are too large to broadcast
    try:
        plan = tm.pos_raw(spark, SF001)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    at = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(o_custkey" in line]
    assert at
    for i in at:
        below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        assert not any("l_orderkey" in line for line in plan[i:below])


def test_clock_text(spark, tmp_path):
    """``%02d:%02d:%02d`` of the second of the day, keys under zero and null ones included."""
    keys = [0, 1, 1234, 12342, 86399, 10 ** 12, -1, -40, -9000, None]
    like = {t: tm.table(spark, SF001, t) for t in ("lineitem", "orders", "customer", "nation", "region", "part")}
    one = like["lineitem"].limit(1).collect()[0]
    lines = [{**one.asDict(), "l_orderkey": k, "l_linenumber": n} for k in keys for n in (1, 5)]
    order = like["orders"].limit(1).collect()[0]
    orders = [{**order.asDict(), "o_orderkey": k} for k in keys]
    spark.createDataFrame(lines, like["lineitem"].schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, like["orders"].schema).write.parquet(f"{tmp_path}/orders.parquet")
    for t in ("customer", "nation", "region", "part"):
        like[t].write.parquet(f"{tmp_path}/{t}.parquet")
    got = {(r[0], r[1]): r[2] for r in tm.pos_raw(spark, str(tmp_path)).select(
        F.col("transaction_id").cast("long"), "loyalty_points", "transaction_time").collect()}
    assert len(got) == 2 * (len(keys) - 1)  # a null key joins nothing

    def part(x, y):  # the sign of the dividend, as in SQL
        return (abs(x) % y) * (1 if x >= 0 else -1)

    for (k, n), text in got.items():
        s = part(k * 7 + n * 13, 86400)
        assert text == "%02d:%02d:%02d" % (int(s / 3600), part(int(s / 60), 60), part(s, 60))


def test_the_order_feed_is_the_same_in_parts(spark, monkeypatch):
    import uuid
    whole = tm.build_erp_bronze(spark, SF001)
    monkeypatch.setattr(tm, "FEED_LINES_JOINED", 2000)
    monkeypatch.setattr(tm, "_input_signature", lambda *a: uuid.uuid4().hex)
    parts, stored = [], tm.stored_feed
    monkeypatch.setattr(tm, "stored_feed", lambda s, d, n, build, **o: stored(s, d, n, lambda: parts.extend(build()) or parts, **o))
    assert rows(tm.erp_bronze(spark, SF001)) == rows(whole) and len(parts) > 2
    assert all(0 < p.count() < 3000 for p in parts)

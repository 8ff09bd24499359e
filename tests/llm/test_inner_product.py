import math
import random

import pytest

from tillroll.llm import inner_product
from tillroll.llm.queries import OP5


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, block string, norm2 int")


def brute(rows):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(1024 * x) for x in v]
        vectors[i] = min(vectors.get(i, w), w)
    out = []
    for q in (i for i in vectors if i % 100 == 0):
        best = sorted((-sum(a * b for a, b in zip(vectors[q], vectors[c], strict=False)), c) for c in vectors if c != q)[:10]
        out += [(q, r, c, -s) for r, (s, c) in enumerate(best, 1)]
    return sorted(out)


def got(spark, rows):
    out = inner_product.search(table(spark, rows))
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())


def single(x):
    return float(f"{x:.3f}")


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "HEAD", 40)
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.25, 0.5, 1, 2]) * round(rng.gauss(0, 1) * 64) / 64 for _ in range(24)]) for i in range(900)]
    assert got(spark, rows) == brute(rows)


def test_ties_zeros_and_odd_rows(spark):
    rows = [(i, [0.5, 0.25, 0.0]) for i in range(300)] + [(i, [0.0, 0.0, 0.0]) for i in range(300, 320)]
    rows += [(400, [-1.0, 0.5, 0.25]), (500, None), (600, [1.0, None, 0.0]), (700, [float("nan"), 0.0, 0.0]),
             (800, [float("inf"), 0.0, 0.0]), (900, [0.5]), (1000, []), (None, [1.0, 1.0, 1.0]), (7, [0.5, 0.25, 0.0])]
    assert got(spark, rows) == brute(rows)


def test_few_and_none(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0, 2.0])]) == []
    rows = [(0, [1.0, 2.0]), (1, [-1.0, 0.5]), (100, [0.25, 0.25])]
    assert got(spark, rows) == brute(rows)


def test_large_components_take_part_like_in_the_sql(spark, monkeypatch):
    duckdb = pytest.importorskip("duckdb")
    monkeypatch.setattr(inner_product, "HEAD", 40)
    rng = random.Random(5)
    rows = [(i, [round(rng.gauss(0, 1) * 64) / 64 for _ in range(24)]) for i in range(600)]
    # multiples of powers of two, so that the doubles of the SQL are exact
    rows += [(i, [float(2048 * rng.randint(-3, 3)) for _ in range(24)]) for i in range(600, 640)]
    rows += [(i, [float((1 << 16) * rng.randint(-20, 20)) if k < 2 else 0.0 for k in range(24)]) for i in range(690, 701)]
    rows += [(710, [2048.0] + [0.0] * 23), (720, [0.0] * 23 + [-float(1 << 18)]), (800, [2047.0] * 24), (730, [float("inf")] * 24)]
    out = got(spark, rows)
    assert out == brute(rows)
    assert {600, 700, 800} <= {r[0] for r in out}
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding float[])")
    con.executemany("insert into embeddings values (?, ?)", [list(r) for r in rows])
    assert sorted(con.execute(OP5).fetchall()) == out


def test_products_beyond_exact_doubles(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "HEAD", 20)
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(0 if k == 0 else -1 << 19, 1 << 19)) for k in range(12)]) for i in range(300)]
    # differ by less than doubles tell apart; one component is far longer than all others
    rows += [(400 + i, [float(1 << 21), float(1 << 20), i / 1024] + [0.0] * 9) for i in range(30)]
    rows += [(500, [float(1 << 20), 1.0, -3.0]), (501, [-1e15, 2.0, 1.0]), (502, [0.0, 0.0, 0.5])]
    assert got(spark, rows) == brute(rows)
    rows = [(0, [1.0, 2.0]), (1, [1e30, 0.0])]
    with pytest.raises(Exception, match="too large"):
        got(spark, rows)

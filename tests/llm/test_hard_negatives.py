"""Mined negatives against a plain double loop."""
import math
import random

import numpy as np
import pytest

from tillroll.llm import hard_negatives as hn

INF = float("inf")


def brute(rows, every=100):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = ([math.floor(256 * x) for x in v], math.fmod(label + 1, 10) if i % 7 == 0 else label)
        best[i] = min(best.get(i, key), key)

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for a, (v, label) in best.items():
        if a % every:
            continue
        scored = [(-score(v, w), i, other) for i, (w, other) in best.items() if i != a]
        for p, pid, _ in sorted(s for s in scored if s[2] == label)[:5]:
            window = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)
            out += [(a, pid, rank, n, -p, -t) for rank, (t, n, _) in enumerate(window[:5], 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    full = [(*r, 1, "x") for r in rows]
    table = spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, place int, file string")
    got = hn.mine(table, **kw)
    return sorted(tuple(r)[:6] for r in got.collect())


def vectors(seed, n, width, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(spread * (i % 3), 1) for _ in range(width)], i * 7 % 4) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_equals_brute_force(spark, block_bytes):
    rows = vectors(1, 700, 6)
    rows += [(1000 + i, [0.5] * 6, i % 3) for i in range(30)]                                 # ties
    rows += [(800, None, 1), (801, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (802, [INF] * 6, 1), (803, [float("nan")] * 6, 1),
             (804, [1.0] * 6, None), (None, [1.0] * 6, 1), (900, [0.1, 0.2], 2), (1100, [], 0), (100, [9.0] * 6, 3),
             (5, rows[5][1], rows[5][2])]
    want = brute(rows)
    assert len(want) > 50
    assert mined(spark, rows, block_bytes=block_bytes) == want


@pytest.mark.parametrize("power,width", [(20, 4), (22, 8)])
def test_large_components_are_exact(spark, power, width):
    # beyond what doubles hold, and with bounds beyond 64 bits
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-2**power, 2**power, width)], i % 3) for i in range(220)]
    assert mined(spark, rows) == brute(rows)


def test_scores_beyond_bigint_fail(spark):
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(100, [1e30], 0), (1, [1e30], 0), (2, [1e30], 1)])


def test_empty_and_without_anchors_or_positives(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 0), (2, [1.0], 1)]) == []


def test_tight_blocks_are_skipped(spark):
    # clusters far apart: windows read few of the blocks
    rows = [(i, [100.0 * (i % 20 == d) + (i % 11) / 11 for d in range(20)], i % 20 % 7) for i in range(4000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hn.mine(table, block_bytes=1 << 14).collect()
    assert sorted(tuple(r)[:6] for r in got) == brute(rows)
    assert max(r.blocks_read for r in got) < max(r.blocks_known for r in got)


def test_hilbert_places_are_neighbours():
    dims, bits = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = hn.hilbert_place(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(2)
    v, q = rng.normal(size=(50, 8)) * 100, rng.normal(size=(9, 8)) * 100
    low, high = hn.bounds(q, v.min(axis=0)[None], v.max(axis=0)[None])
    scores = q @ v.T
    assert (low[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= high[:, 0]).all()

"""The join against all pairs: families of variants, tiny sets, several rows of one id, empty parts."""
import random

import numpy as np
import pytest

from tillroll.llm import common
from tillroll.llm import jaccard_join as jj


def brute(rows, k, percent):
    sets = {}
    for i, text in rows:
        if i is not None:
            w = (text or "").lower().split()
            sets.setdefault(i, []).append(frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k
                                          else frozenset([tuple(w)] if w else []))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in sets:
        for y in sets:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: find(i) for i in sets}


def family_rows(seed, families, sizes, change):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        n = rng.choice(sizes)
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(rng.choice([3, 10, 25])):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, n // change))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w = w[:max(1, len(w) - rng.randrange(0, max(1, n // 12)))]
            if rng.random() < 0.3:
                base = w
            rows.append((len(rows), " ".join(w)))
    return rows


def check(spark, rows, k, percent):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, component string")
    got = jj.components(docs, k, percent).collect()
    want = brute(rows, k, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    return got, want


@pytest.mark.parametrize("k,percent,change", [(3, 90, 40), (5, 80, 25)])
def test_equals_all_pairs(spark, k, percent, change):
    rows = family_rows(5, 24, [3, 9, 12, 20, 40, 80, 150, 400], change)
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, "a"), (n + 3, "A"), (n + 4, "a b"), (n + 5, "a \t B"), (n + 6, " "),
             (0, rows[5][1]), (n + 2, "a"), (None, "a")]
    got, want = check(spark, rows, k, percent)
    assert want[n + 2] == want[n + 3] and want[n] == n and len(set(want.values())) < len(want)
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_a_tile_whose_smallest_document_links_to_few(spark):
    # variants around several centres: stars by the smallest node leave components open
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for c in range(4):
        centre = list(base)
        for i in range(4 * c):
            centre[7 * i + 1] = f"c{c}-{i}"
        for _ in range(25):
            w = list(centre)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    check(spark, [(i, t) for i, (_, t) in enumerate(rows)], 3, 90)


def test_blocks_close_what_stars_leave(spark, monkeypatch):
    rows = family_rows(11, 6, [60, 200], 30)
    monkeypatch.setattr(jj, "STARS", 0)
    monkeypatch.setattr(jj, "BLOCK_BYTES", 2000)
    check(spark, rows, 3, 90)


def test_empty_table(spark):
    assert jj.components(spark.createDataFrame([], "doc_id long, text string"), 3, 90).collect() == []


def test_linked_sets_always_share_a_tile():
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        for n in [1, 2, 5, 9, 10, 11, 19, 20, 37, 90, 91, 400, 3000]:
            for _ in range(12):
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
                gone = int(rng.integers(0, n - -(-percent * n // 100) + 1))
                b = rng.permutation(a)[gone:]
                new = 0
                while 100 * len(b) >= percent * (len(a) + new + 1) and rng.random() < 0.9:
                    new += 1
                b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, new).astype(np.uint64)]))
                both = jj.overlap(a, b)
                assert 100 * both >= percent * (len(a) + len(b) - both)
                assert set(jj.tile_keys(a, percent).tolist()) & set(jj.tile_keys(b, percent).tolist())
                x, y = (np.frombuffer(jj.bitmap(s), np.uint8) for s in (a, b))
                w = min(len(x), len(y))
                assert jj.most_overlap(jj._folded(x, w), len(a), jj._folded(y, w)[None, :], np.array([len(b)]))[0] >= both


def test_later_links_only_work_through_what_they_tie(spark, monkeypatch):
    made = []

    def counted(df, purpose, write=common.written):
        out = write(df, purpose)
        made.append((purpose, out.count()))
        return out

    found = spark.createDataFrame([(i, i % 5) for i in range(300)], "node long, component long")
    later = spark.createDataFrame([(3, 299), (8, 500), (601, 600)], "a long, b long")  # 299 lies with 4
    monkeypatch.setattr(common, "written", counted)
    got = {r["node"]: r["component"] for r in jj.with_links(found, later).collect()}
    assert got == {i: 3 if i % 5 == 4 else i % 5 for i in range(300)} | {500: 3, 600: 600, 601: 600}
    assert max(n for _, n in made) <= 6  # ends of the three links

import math
import random
from collections import Counter, defaultdict

import numpy as np

from tillroll.llm import perplexity


def brute(trusted, texts, order):
    """The textbook recursion over byte strings."""
    counts = {order: Counter()}
    for t in trusted:
        b = b"\0" * (order - 1) + t.encode()
        counts[order].update(b[i:i + order] for i in range(len(b) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    d, of = {}, {}
    for n, c in counts.items():
        k = Counter(c.values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0
        raw = [1 - 2 * y * k[2] / k[1] if k[1] else .5, 2 - 3 * y * k[3] / k[2] if k[2] else 1.0,
               3 - 4 * y * k[4] / k[3] if k[3] else 1.5]
        d[n] = [min(max(x, .05), i + .95) for i, x in enumerate(raw)]
        of[n] = defaultdict(list)
        for g, x in c.items():
            of[n][g[:-1]].append(x)

    def p(g):
        n = len(g)
        if not n:
            return 1 / 256
        had = of[n].get(g[:-1])
        if not had:
            return p(g[1:])
        c = counts[n][g]
        cut = sum(d[n][min(x, 3) - 1] for x in had)
        return ((c - d[n][min(c, 3) - 1] if c else 0) + cut * p(g[1:])) / sum(had)

    out = []
    for t in texts:
        raw = (t or "").encode()
        b = b"\0" * (order - 1) + raw
        out.append(math.exp(-sum(math.log(p(b[i:i + order])) for i in range(len(raw))) / len(raw)) if raw else None)
    return out


def table(spark, documents, rows, scratch, files=3):
    path = f"{scratch}/documents.parquet"
    documents(rows).repartition(files).write.parquet(path)
    return spark.read.parquet(path)


def test_equals_the_recursion(spark, documents, scratch):
    rng = random.Random(4)
    syllables = ["an", "er", "ti", "é", "lo", " ", " ", "ma"]
    texts = ["".join(rng.choices(syllables, k=rng.randint(3, 80))) for _ in range(60)] + [None, "", "###!!!", "€"]
    rows = list(enumerate(texts))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(50)] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = perplexity.perplexities(table(spark, documents, rows, scratch), labels).collect()
    want = dict(zip(range(len(texts)), brute([t for i, t in rows[:50] if i % 3], texts, perplexity.ORDER), strict=True))
    assert len(out) == len(texts)
    for r in out:
        if want[r["doc_id"]] is None:
            assert r["perplexity"] is None and r["n_bytes"] == 0
        else:
            assert math.isclose(r["perplexity"], want[r["doc_id"]], rel_tol=1e-5)


def test_filter_and_edge_cases(spark, documents, scratch):
    rng = random.Random(9)
    words = ["river", "stone", "bridge", "light", "table", "green", "market", "winter", "garden"]
    rows = [(i, " ".join(rng.choices(words, k=60)), "s", "en" if i % 2 else None) for i in range(200)]
    rows += [(300, "#$%&" * 60), (301, None), (302, ""), (303, "river stone " * 100_000), (None, " ".join(words)), (5, rows[5][1])]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)] + [(300, 0, 0)], "doc_id long, quality int, toxic int")
    out = perplexity.classify(table(spark, documents, rows, scratch), labels).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r["keep"] for r in out}
    assert not by[300] and not by[301] and not by[302]
    assert sum(by[i] for i in range(150, 200)) >= 45


def test_other_input_splits_in_each_scan(spark, documents, scratch, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choices(["an", "er", "ti", "lo", " ", "ma"], k=40)) for _ in range(400)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    path = f"{scratch}/documents.parquet"
    monkeypatch.setattr(perplexity, "RUN", 64)
    documents(list(enumerate(texts))).repartition(2).write.option("parquet.block.size", 4096).parquet(path)
    want = {r["doc_id"]: tuple(r) for r in perplexity.perplexities(spark.read.parquet(path), labels).collect()}
    sizes = iter([2_000, 50_000, 900, 7_000, 1_500] * 20)
    plain, old = perplexity.written, spark.conf.get("spark.sql.files.maxPartitionBytes")

    def other(*a, **k):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(next(sizes)))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        return plain(*a, **k)

    monkeypatch.setattr(perplexity, "written", other)
    try:
        rows = perplexity.perplexities(spark.read.parquet(path), labels)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1100")
        out = {r["doc_id"]: tuple(r) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert out == want and sum(r[-1] for r in out.values()) == 200


def test_without_trust_or_rows(spark, documents, scratch):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = perplexity.classify(table(spark, documents, [(1, "abc"), (2, None)], scratch), none).collect()
    by = {r["doc_id"]: (r["perplexity"], r["keep"]) for r in out}
    assert math.isclose(by[1][0], 256, rel_tol=1e-4) and by[1][1] and by[2] == (None, False)
    assert perplexity.classify(table(spark, documents, [], scratch + "/e"), none).collect() == []


def test_grams():
    data = np.frombuffer("abécd".encode(), np.uint8)
    code, first = perplexity.grams(data, np.array([0, 2, 2, 6]))
    want = []
    for t in ("ab", "", "écd"):
        b = b"\0" * 4 + t.encode()
        want += [int.from_bytes(b[i:i + 5], "big") for i in range(len(b) - 4)]
    assert code.tolist() == want and first.tolist() == [0, 2, 2, 6]

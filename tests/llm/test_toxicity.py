import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import text as tx
from tillroll.llm import toxicity

ORDINARY = ["the", "river", "over", "stone", "bridge", "light", "under", "table", "green", "market", "winter", "carry",
            "morning", "paper", "silver", "window", "garden", "letter", "summer", "number"]
BAD = ["scumbag", "worthless", "pathetic", "moronic"]


def make(n, seed):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = ["".join(rng.choices(["an", "er", "ti", "lo", "ma", "re"], k=rng.randint(1, 4))) for _ in range(60)]
        words += rng.choices(ORDINARY, k=60)
        bad = rng.random() < 0.3
        if bad:
            words += rng.choices(BAD, k=3)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    return rows, marks


@pytest.fixture(scope="module")
def labelled():
    return make(500, 2)


def test_held_out_accuracy(spark, documents, labelled):
    rows, marks = labelled
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = toxicity.classify(documents(rows), labels).collect()
    truth = {m[0]: m[2] for m in marks}
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_do_not_count(spark, documents, labelled):
    rows, marks = labelled
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in marks]
    some = documents(rows[:200])
    a, b = (toxicity.fit_tables(some, spark.createDataFrame(m[:200], "doc_id long, quality int, toxic int"))
            for m in (marks, turned))
    assert a.ordinary == b.ordinary and a.toxic == b.toxic and list(a.weights) == list(b.weights)


def test_edge_cases(spark, documents, labelled):
    rows, marks = labelled
    odd = [(1000, None), (1001, ""), (1002, "x" * 2_000_000), (1003, "moronic " * 200_000), (None, "fine"), (1001, "")]
    labels = spark.createDataFrame(marks[:250] + [(None, 1, 1), (3, None, None), (4, 1, 0), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = documents(rows[:250] + odd)
    out = toxicity.classify(docs, labels).collect()
    assert len(out) == 256
    by = {r["doc_id"]: r for r in out}
    assert by[1000]["score"] == by[1001]["score"] and by[1000]["predicted"] == 0
    assert by[1003]["predicted"] == 1 and by[None]["held_out"] in (True, False)
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id = 1003").count() == 0
    assert kept.where("doc_id = 1001").count() == 2


def test_without_labels_or_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.classify(documents([(1, "a"), (2, None)]), none).collect()
    assert [r["predicted"] for r in out] == [0, 0]
    assert toxicity.classify(documents([]), none).collect() == []


def test_copies_are_no_evidence():
    text = " ".join(f"rare{i}" for i in range(50))
    assert len(toxicity._words([text, text + " more", "other words"])) == 2


def test_memory_of_scoring_does_not_grow_with_the_batch(labelled):
    texts = pa.array([r[1] for r in labelled[0]] * 32, pa.string())
    assert texts.nbytes > 8 << 20
    model = toxicity.Model(b"the river " * 50, b"moronic " * 50, 2.0, np.ones(4))
    tx._powers.clear()
    gains = toxicity.Gains(model.ordinary, model.toxic)
    whole = model.features(texts.slice(0, 500), gains)
    tracemalloc.start()
    try:
        many = model.features(texts, gains)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 << 20 and sum(p.nbytes for p in tx._powers) < 20 << 20
    assert (many.reshape(32, 500, 3) == whole).all()

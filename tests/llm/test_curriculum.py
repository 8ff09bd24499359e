import random
import re
from collections import Counter, defaultdict

from tillroll.llm import curriculum


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def level(sizes):
    """Targets by raising until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    held, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in held]
        w = sum(weight[s] for s in free)
        share = {s: (total - sum(held.values())) * weight[s] / w for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return held | share
        held |= {s: 3.0 * sizes[s] for s in over}


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = rng.choice(["big", "big", "big", "big", "mid", "mid", "Small", "é", None])
        rows.append((i, " ".join(["word"] * rng.choice([1, 5, 40, 300])), source))
    return rows + [(400, None, "mid"), (401, "", "big"), (402, "  ", None), (None, "no id here", "big"), (3, rows[3][1], rows[3][2])]


def test_targets_and_taken(documents):
    rows = corpus()
    out = curriculum.mix(documents(rows)).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += size(r[1])
    want = level(sizes)
    source = {r[0]: r[2] for r in rows}
    taken = Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert abs(r["target"] - want[s]) < 1e-6 and r["source_size"] == sizes[s]
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert (r["position"] is None) == (r["taken"] == 0) and (r["position"] or 0) <= 1
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sorted(map(str, out)) == sorted(map(str, curriculum.mix(documents(rows)).collect()))


def test_mixed_rows(documents):
    rows = corpus(2)
    docs = documents(rows)
    out = curriculum.mixed(docs)
    assert out.columns == docs.columns
    planned = Counter()
    for r in curriculum.mix(docs).collect():
        planned[r["doc_id"]] += r["taken"]
    held = Counter()
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1])
    for r in out.collect():
        held[r["doc_id"]] += size(r["text"])
        assert any(t is not None and t.startswith(r["text"]) for t in texts[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])
    assert held == Counter({k: v for k, v in planned.items() if v})


def test_rising_sources_come_later(documents):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(3000)]
    out = curriculum.mix(documents(rows)).where("taken > 0").collect()
    place = defaultdict(list)
    for r in out:
        place[r["doc_id"] % 3].append(r["position"])
    mean = [sum(p) / len(p) for _, p in sorted(place.items())]
    assert mean[0] > 0.53 > mean[1] > 0.47 > mean[2]


def test_empty(documents):
    assert curriculum.mix(documents([])).collect() == [] and curriculum.mixed(documents([])).collect() == []
    out = curriculum.mix(documents([(1, None), (2, " ")])).collect()
    assert [(r["size"], r["taken"], r["target"], r["position"]) for r in out] == [(0, 0, 0.0, None)] * 2


def test_mixed_keeps_columns_named_like_its_own(spark):
    names = ["_id", "_source", "_tie", "_hash", "_position", "_words", "_size", "_text", "row", "n", "o", "p"]
    rows = [(i, "one two three " * (i % 5 + 1), "ab"[i % 2], *(f"{n}{i}" for n in names)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    out = curriculum.mixed(docs)
    assert out.columns == docs.columns
    held = out.collect()
    assert held and all(r[n] == f"{n}{r['doc_id']}" for r in held for n in names)
    taken = {r["doc_id"]: r["taken"] for r in curriculum.mix(docs).collect() if r["taken"]}
    got = Counter()
    for r in held:
        got[r["doc_id"]] += size(r["text"])
    assert got == taken


def test_mix_comes_in_training_order(documents):
    rows = corpus(3)
    out = [(r["position"], r["doc_id"], r["taken"]) for r in curriculum.mix(documents(rows)).collect()]
    taken = [(p, -1 if d is None else d) for p, d, _ in out if p is not None]
    assert len(out) == len(rows) and 0 < len(taken) < len(out)
    assert taken == sorted(taken)
    # untaken rows follow
    assert all(p is None and n == 0 for p, _, n in out[len(taken):])

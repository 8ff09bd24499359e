import random
import re

from tillroll.llm import common, minhash
from tillroll.llm.common import connected_components

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(n=150, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if i % 3 and rows:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, max(1, len(words) // 8))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i, " ".join(words).upper() if i % 2 else "  ".join(words)))
        else:
            rows.append((i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 10, 40, 120])))))
    return rows


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_equals_brute_force(documents):
    rows = corpus()
    assert got(minhash.near_duplicates(documents(rows), 2, 80)) == brute(rows, 2, 80)


def test_chains_and_hubs_within_one_bucket(documents):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for j in rng.sample(range(60), rng.randint(0, 5)):
            words[j] = f"x{i}-{j}"
        rows.append((i, " ".join(words)))
    assert got(minhash.near_duplicates(documents(rows), 2, 80)) == brute(rows, 2, 80)


def test_edge_cases(documents):
    long = " ".join(f"t{i}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, long), (7, long + " end"), (8, "x" * 3_000_000),
            (9, "a b"), (9, "a b"), (10, "A  B")]
    out = minhash.near_duplicates(documents(rows + [(None, "a b")]), 2, 80).collect()
    assert len(out) == 12
    by = {r["doc_id"]: tuple(r)[1:] for r in out}
    assert by[1] == by[1][:0] + (0, 1, True) and by[2] == (0, 2, True) and by[3] == (0, 3, True)
    assert by[4] == (1, 4, True) and by[5] == (1, 4, False)
    assert by[6] == (299_999, 6, True) and by[7] == (300_000, 6, False) and by[8] == (1, 8, True)
    assert by[9] == (1, 9, True) and by[10] == (1, 9, False)
    assert by[None] == (1, None, False)


def test_rows_of_one_id_join_their_groups(documents):
    a, b = ("alpha beta gamma delta", "one two three four")
    rows = [(5, a), (5, b), (7, a), (8, b), (9, "other words here now")]
    out = {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(documents(rows), 2, 80).collect()}
    assert out == {(5, 5), (7, 5), (8, 5), (9, 9)}


def test_empty_table_and_kept_columns(documents):
    assert minhash.near_duplicates(documents([]), 2, 80).collect() == []
    docs = documents([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "z"), (None, "a b c d e f g")])
    out = minhash.keep_first(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 3]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(5, 5), (7, 8), (None, 3)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: root(n) for n in up}


def test_open_buckets_close_in_one_pass_of_small_blocks(documents, monkeypatch):
    """Pairs that link with each other but with none of the smaller documents of their buckets."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]

    def changed(words, n):
        words = list(words)
        for i in rng.sample(range(120), n):
            words[i] = f"x{rng.randrange(10**9)}"
        return words

    rows = [(i, " ".join(changed(base, 4))) for i in range(80)]
    for i in range(10):
        one = changed(base, 4)
        rows += [(1000 + 2 * i, " ".join(one)), (1001 + 2 * i, " ".join(changed(one, 1)))]
    made = []

    def counted(df, purpose, write=minhash.written):
        out = write(df, purpose)
        made.append((purpose, out.count()))
        return out

    monkeypatch.setattr(minhash, "written", counted)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 9000)
    monkeypatch.setattr(minhash, "STREAMED", 5)
    assert got(minhash.near_duplicates(documents(rows), 2, 80)) == brute(rows, 2, 80)
    first, closing = (n for purpose, n in made if purpose == "links")  # with the smallest, then one pass for the rest
    assert closing > 0
    assert dict(made)["stored"] <= len(rows)  # a text is joined once, however many buckets its document is in


def test_links_to_the_smallest_close_in_one_round(spark, monkeypatch):
    made = []

    def counted(df, purpose, write=common.written):
        made.append(purpose)
        return write(df, purpose)

    monkeypatch.setattr(common, "written", counted)
    edges = [(7, i) for i in range(100, 400)] + [(8, i) for i in range(400, 500)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {**dict.fromkeys([7, *range(100, 400)], 7), **dict.fromkeys([8, *range(400, 500)], 8)}
    assert made.count("labels") == 2  # as they begin, and after one round

"""The trie against a plain dictionary of prefixes, for blocks of any size."""
import hashlib
import math
import random
import zlib

import pytest

from tillroll.llm import prefix_trie

OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(v, key=lambda t: (t[0], t[1] or 0, *t[2:]))] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    out = []
    for seq, members in nodes.items():
        below = [(s, m) for s, m in nodes.items() if s[:len(seq)] == seq]
        children = {s[:len(seq) + 1] for s, _ in below if len(s) > len(seq)}
        leaves = sum(1 for s, _ in below if not any(o[:len(s)] == s and len(o) > len(s) for o, _ in below))
        saved = sum((len(m) - 1) * len(s[-1][1].encode()) for s, m in below if s)
        ends = ",".join(str(c) for c, e in sorted(members) if e)
        parent = min(c for c, _ in nodes[seq[:-1]]) if seq else None
        out.append((min(c for c, _ in members), len(seq), parent, len(members), len(children), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    full = [(*r, "x", 1) for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, seq string, depth int")


def nodes(df):
    return sorted((tuple(r) for r in df.select(*OUT).collect()), key=str)


def conversations(seed, families, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(families):
        for t in range(rng.randrange(longest)):
            words = "abc"[rng.randrange(3)] * rng.randrange(1, 4) if rng.random() < 0.8 else str(c % 4) + "é"
            rows.append((c, t, rng.choice(["user", "assistant"][:1 + t % 2]), words))
    return rows


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_equals_brute_force_for_any_block_size(spark, block):
    rows = conversations(3, 60, 14)
    rows += [(1000 + 5 * i, t, "user", "same") for i in range(40) for t in range(3)]        # copies over many blocks
    rows += [(7000, None, None, None), (7000, 0, "user", None), (7001, 3, "b", "x"), (7001, 3, "a", "x"),
             (7001, 3, "a", "x"), (None, 0, "user", "nobody"), (-3, 0, "user", "negative"), (-5, 0, "user", "base")]
    assert nodes(prefix_trie.trie(table(spark, rows), block)) == brute(rows)


def test_empty_table_and_only_turnless(spark):
    assert nodes(prefix_trie.trie(table(spark, []))) == []
    # its own turns are all replaced by those of a base that is absent
    c = next(i for i in range(1, 99) if i % 5 and zlib.crc32(str(i).encode()) % 9 >= 1)
    rows = [(c, 0, "user", "gone")]
    assert nodes(prefix_trie.trie(table(spark, rows))) == brute(rows)
    assert brute(rows)[0][1:6] == (0, None, 1, 0, 1)


def test_long_conversation_and_text(spark):
    rows = [(c, t, "user", "x" * (200_000 if t == 5 else 1)) for c in (5, 10) for t in range(3000 + c)]
    got = nodes(prefix_trie.trie(table(spark, rows), 500))
    root = next(r for r in got if r[1] == 0)
    assert root[3:7] == (2, 1, 1, 200_000 + 3004)
    assert len(got) == 3011

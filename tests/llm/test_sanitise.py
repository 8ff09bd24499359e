import hashlib
import math
import random
import re

from tillroll.llm import sanitise

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        return 13 <= len(d) <= 19 and s % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def brute(text):
    found = {k: [m.span() for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PLAIN.items()}
    return found, ",".join(f"{k}:{a}:{z}" for k in PLAIN for a, z in found[k])


def check(out, rows):
    assert len(out) == len(rows)
    for r, (i, text) in zip(sorted(out, key=lambda r: r["doc_id"]), sorted(rows), strict=True):
        found, listed = brute(text)
        assert tuple(r)[1:5] == tuple(len(found[k]) for k in PLAIN), (text or "")[:80]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), (text or "")[:80]
        assert r["spans"].startswith(listed)


def test_equals_plain_patterns(documents):
    rng = random.Random(8)
    bits = ["a.b@c.d", "x@y", "@", ".", "_", "%", "-", "é", "😀", " ", "\n", "1.2.3.4", "256.1.1.1", "007.0.0.1", "4111 1111 1111 1111",
            "4111111111111112", "+1 (555) 123-4567", "+", "12", "0", "a", "b.c", "1-2 3"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(1, 25)))) for i in range(400)]
    rows += [(500, "x@y.z._a@b.c@d.e"), (501, "a@b@c.d"), (502, "1.2.3.4.5.6.7.8"), (503, "1" * 400 + ".1.1.1")]
    check(sanitise.report(documents(rows)).collect(), rows)


def long_rows(n):
    return [(1, "a" * n), (2, "a@" + "b." * (n // 2) + "c"), (3, "1 " * n), (4, "+1" + " 2" * (n // 2)),
            (5, "me@example.com 10.0.0.1 " * (n // 100)), (6, None), (7, ""), (8, "9" * n), (9, "a." * (n // 2) + "@x")]


def test_long_texts(documents):
    rows = long_rows(2_000)
    check(sanitise.report(documents(rows)).collect(), rows)
    # the plain patterns take quadratic time here
    out = {r["doc_id"]: tuple(r)[1:5] for r in sanitise.report(documents(long_rows(300_000))).collect()}
    assert out == {i: (0, 0, 0, 0) for i in (1, 3, 4, 6, 7, 8, 9)} | {2: (1, 0, 0, 0), 5: (3000, 3000, 0, 0)}


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


def test_revealing_terms_are_found_everywhere(documents):
    rng = random.Random(3)
    rows = [(i, words(rng, 40)) for i in range(60)]
    rows += [(100 + i, f"{words(rng, 20)} Zorblatt the wrote to boss@corp.example the {words(rng, 20)}") for i in range(6)]
    rows += [(200, f"{words(rng, 30)} zorblatt, {words(rng, 5)}")]
    rows += [(300 + i, f"the {words(rng, 20)}") for i in range(60)]
    copy = f"{words(rng, 8)} quixotic lone@corp.example {words(rng, 8)}"
    rows += [(400 + i, copy + " " + words(rng, 3 * i)) for i in range(5)]
    out = {r["doc_id"]: r["spans"] for r in sanitise.report(documents(rows)).collect()}
    text = dict(rows)
    for i in (100, 200):
        at = text[i].lower().index("zorblatt")
        assert f"term:{at}:{at + 8}" in out[i]
    assert all("term" not in out[i] for i in [*range(60), *range(300, 360)])
    assert "term" not in out[400]  # one context, however often copied
    clean = {r["doc_id"]: r["text"] for r in sanitise.sanitised(documents(rows)).collect()}
    assert "orblatt" not in clean[200] and "[EMAIL]" in clean[100] and clean[0] == text[0]


def test_sanitised_rows(documents):
    docs = documents([(1, "a me@x.yz b 4111 1111 1111 1111"), (1, "a me@x.yz b 4111 1111 1111 1111"), (2, None), (None, "call +1 555 123 4567!")])
    out = sanitise.sanitised(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["text"]) for r in out.collect()) == ["None", "a [EMAIL] b [CARD]", "a [EMAIL] b [CARD]", "call [PHONE]!"]
    assert sanitise.report(documents([])).collect() == [] and sanitise.sanitised(documents([])).collect() == []


def test_terms_with_digits_and_short_ones(documents):
    rng = random.Random(4)
    rows = [(i, words(rng, 40)) for i in range(80)]
    rows += [(100 + i, f"{words(rng, 20)} jdoe42 AB-7731 Ng to boss@corp.example 李明 4471 cc 10.0.0.9 {words(rng, 20)}") for i in range(6)]
    rows += [(200, f"{words(rng, 30)} JDOE42, {words(rng, 5)}"), (201, f"{words(rng, 9)} (ab-7731)"), (202, "ng 李明 4471 ngo jdoe421")]
    out = {r["doc_id"]: r["spans"] for r in sanitise.report(documents(rows)).collect()}
    text = dict(rows)
    for i, terms in ((100, ("jdoe42", "ab-7731", "ng", "李明", "4471")), (200, ("jdoe42",)), (201, ("ab-7731",)),
                     (202, ("ng", "李明", "4471"))):
        for t in terms:
            at = re.search(rf"(?<!\w){t}(?!\w)", text[i].lower()).start()
            assert f"term:{at}:{at + len(t)}" in out[i], (i, t)
    assert out[202].count("term") == 3 and "term" not in out[0]
    # the parts of a neighbouring address are no terms of their own
    spans = [tuple(map(int, x.split(":")[1:])) for x in out[100].split(",") if x.startswith("term")]
    assert not any(text[100][a:z].lower() in ("boss", "corp", "example", "10", "0", "9") for a, z in spans)


def plain_terms(rows):
    """Shares by plain counts: emails only, words of ASCII letters."""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    contexts, of, near = {}, {}, {}
    for i, text in rows:
        for m in email.finditer(text):
            hidden = email.sub(lambda x: "@" * len(x[0]), text)
            before, after = text[:m.start()].split(), text[m.end():].split()
            context = (tuple(before[-4:]), tuple(after[:4]))
            e = m[0].lower()
            contexts.setdefault(e, set()).add(context)
            of.setdefault(e, set()).add(i)
            for w in {w.lower() for w in hidden[:m.start()].split()[-10:] + hidden[m.end():].split()[:10] if "@" not in w}:
                near.setdefault((e, w), (set(), set()))
                near[e, w][0].add(context)
                near[e, w][1].add(i)
    share = {}
    for (e, w), (where, docs) in near.items():
        if len(contexts[e]) >= sanitise.SUPPORT and len(where) >= sanitise.SUPPORT:
            # a word of an address is a word of its document
            dt, dc = sum(w in re.split("[^a-z]+", t.lower()) for _, t in rows), len(of[e])
            share[w] = max(share.get(w, -9), math.log(len(docs) * len(rows) / dt / dc) / math.log(len(rows) / dc))
    return {w: x for w, x in share.items() if x >= sanitise.GENERALISE}


def test_terms_equal_plain_counts(documents):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(60)]
    rows = []
    for i in range(240):
        out = rng.choices(vocabulary, k=30)
        if i % 4 == 0:
            who = rng.randrange(4)
            out[15:15] = [f"secret{'wxyz'[who]}", f"boss{'wxyz'[who]}@corp.example"]
            out[rng.randrange(14)] = f"often{'wxyz'[who if rng.random() < .9 else 0]}"
        elif i % 16 == 1:
            out[3] = f"often{'wxyz'[i // 16 % 4]}"
        rows.append((i, " ".join(out)))
    want = plain_terms(rows)
    assert 4 <= len(want) < 60
    for r in sanitise.report(documents(rows)).collect():
        got = [x for x in r["spans"].split(",") if x.startswith("term")]
        text = rows[r["doc_id"]][1]
        taken = [m.span() for m in re.finditer("[a-z]+", text) if m[0] in want]
        assert got == [f"term:{a}:{z}" for a, z in taken], r["doc_id"]


def test_joined_words_and_their_parts(spark):
    docs = spark.createDataFrame([(1, "ab-7731, 7731 ab ab-7731-x 😀ab_c"), (1, "ab-7731, 7731 ab ab-7731-x 😀ab_c"),
                                  (None, "7731"), (3, None), (4, "none")], "doc_id long, text string")
    terms = spark.createDataFrame([("ab-7731", 1.0), ("7731", .8), ("ab_c", .7)], "term string, share double")
    out = {r["d"]: [tuple(s) for s in r["term"]] for r in sanitise._term_spans(docs, terms).collect()}
    assert out == {1: [(0, 7, True), (9, 13, False), (20, 24, False), (28, 32, False)], None: [(0, 4, False)]}


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a me@x.yz", "m", "d", "k", "r")], "doc_id long, text string, _m string, _d string, _k string, row string")
    out = sanitise.sanitised(docs)
    assert out.columns == docs.columns and tuple(out.first()) == (1, "a [EMAIL]", "m", "d", "k", "r")

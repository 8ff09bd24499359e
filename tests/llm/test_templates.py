import random

import numpy as np
import pyarrow as pa

from tillroll.llm import templates

VOCABULARY = ["train", "leaves", "station", "travels", "speed", "reach", "before", "second", "house", "carries", "apples",
              "every", "morning", "sells", "half", "remain", "baskets", "river", "across", "bridge", "paint", "wall"]
ITEM = "A train leaves Boston at 60 mph and a second train leaves Denver at 45 mph before Boston and Denver hear 60 bells."


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, h string, slots string")


def filler(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + str(rng.choice(["", "s", "ly"])) + chr(97 + rng.randrange(26)) for _ in range(n))


def pairs(df):
    return sorted((r["doc_id"], r["item_id"]) for r in df.collect())


def test_replaced_numbers_and_names_are_found_if_consistent(spark, documents):
    changed = ITEM.replace("60", "75").replace("45", "30").replace("Boston", "Madrid").replace("Denver", "Lisbon")
    mixed = "A train leaves Madrid at 75 mph and a second train leaves Lisbon at 30 mph before Oslo and Rome hear 12 bells."
    docs = documents([(1, filler(1) + ". " + ITEM + " " + filler(2)), (2, filler(3) + ". " + changed + " " + filler(4)),
                      (3, filler(5) + ". " + mixed + " " + filler(6)), (4, filler(7, 200)), (5, ITEM.lower().replace("boston", "Boston").replace("denver", "Denver"))])
    out = templates.contaminated(docs, items(spark, [(10, ITEM), (11, filler(8, 30))]))
    assert pairs(out) == [(1, 10), (2, 10), (5, 10)]


def test_tokens():
    def of(text):
        token, slot, _ = templates.tokens(np.frombuffer(text.encode(), np.uint8))
        names = {int(templates.NUMBER): "<num>", int(templates.NAME): "<name>", int(templates.UNIT): "<unit>"}
        return [names.get(int(t), "w") for t in token], [bool(s) for s in slot]
    assert of("Then Anna paid 3.50 euros. NASA sent Élodie 1,000 km, a km.")[0] == [
        "w", "<name>", "w", "<num>", "<unit>", "w", "w", "<name>", "<num>", "<unit>", "w", "w"]
    same = [templates.tokens(np.frombuffer(t.encode(), np.uint8))[0].tolist() for t in ("École une: été!", "école  UNE\nÉTÉ")]
    assert same[0] == same[1]


def test_edge_cases(spark, documents):
    long = filler(20, 200_000) + ". " + ITEM
    docs = documents([(1, None), (2, ""), (3, long), (3, long), (4, ITEM), (None, ITEM), (5, "1 2 3 4 5 6 7 8 9 10"), (6, "green apple pies")])
    bench = items(spark, [(10, ITEM), (10, ITEM), (None, ITEM), (11, None), (12, ""), (13, "1 2 3 4 5 6 7 8 9"), (14, "Green apple pies!")])
    out = templates.contaminated(docs, bench)
    assert pairs(out) == [(3, 10), (4, 10), (6, 14)]
    kept = templates.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5]
    assert pairs(templates.contaminated(documents([]), bench)) == []
    assert pairs(templates.contaminated(docs, items(spark, []))) == []


def test_bitmap_matches_its_places(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-(1 << 63), 1 << 63, 5000, dtype=np.int64)
    bits = np.unpackbits(templates._bitmap(spark.createDataFrame([(int(x),) for x in h], "h long")), bitorder="little")
    want = np.zeros(1 << templates.PLACE_BITS, np.uint8)
    want[(h.view(np.uint64) >> np.uint64(64 - templates.PLACE_BITS)).astype(np.int64)] = 1
    assert (bits == want).all()


def test_blocks_agree_with_single_texts():
    texts = [filler(i, 30) if i % 5 else "" for i in range(50)] + ["Ends with Name", "Starts 5 km"]
    whole = {i: t.tolist() for i, t, _ in templates._texts(pa.array(texts))}
    for i, t in enumerate(texts):
        assert whole[i] == templates.tokens(np.frombuffer(t.encode(), np.uint8))[0].tolist()


def test_short_number_heavy_lower_cased_and_mid_sentence_items(spark, documents):
    bench = {20: "Compute 12 + 30 * 7 - 5", 21: "Solve 3 x + 5 = 20", 22: "What is the capital of France?",
             23: "Who wrote Emma?", 24: "12 + 30 * 7 = ?", 25: "Anna buys 3 red apples and 4 pears",
             26: "Add 1 2 3 4 5 6 7 8 9 10 11 12 and then find the mean of all these numbers"}
    docs = {1: "compute 12 + 30 * 7 - 5", 2: f"{filler(1)} Solve 3 x + 5 = 20 {filler(2)}",
            3: f"{filler(3)} he asked What is the capital of France and left", 4: f"{filler(4)} what is the capital of france",
            5: f"{filler(5)} he asked What is the capital of Spain and left", 6: f"{filler(6)}. who wrote emma? {filler(7)}",
            7: "12 + 30 * 7 = ?", 8: "12 + 30 * 7 = 15", 9: f"{filler(8)} then Maria buys 5 red apples and 9 pears today",
            10: f"{filler(9)}. Maria buys 5 red apples and 9 pears", 11: "Compute 13 + 31 * 8 - 6",
            12: f"{filler(10)} 3 4 5 6 7 8 9 10 11 12 And then find the mean {filler(11)}",
            13: "Add 2 4 6 8 1 3 5 7 9 11 13 15 and then find the mean of all these numbers", 14: filler(12, 200),
            15: "Is it? What is the capital of Chad? Yes.", 16: f"{filler(13)} she said Solve 3 X + 5 = 20"}
    out = templates.contaminated(documents(list(docs.items())), items(spark, list(bench.items())))
    assert pairs(out) == [(1, 20), (2, 21), (3, 22), (4, 22), (5, 22), (6, 23), (7, 24), (9, 25), (10, 25),
                          (12, 26), (13, 26), (15, 22), (16, 21)]

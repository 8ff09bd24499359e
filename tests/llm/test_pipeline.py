import zlib

import numpy as np
import pytest

import corpus_pipeline
from tillroll.llm import curriculum, minhash, templates, token_files, toxicity
from tillroll.llm.common import read_table
from tillroll.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_every_stage_takes_effect_and_keeps_columns(spark, stages):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    assert all(s.columns == docs.columns for s in stages[:-1])
    toxic = {r["doc_id"] for r in toxicity.classify(docs, labels).where("predicted = 1").collect()}
    assert toxic and ids(stages[0]) == ids(docs) - toxic
    kept = {r["doc_id"] for r in minhash.near_duplicates(stages[0], 5, 80).where("kept").collect()}
    assert ids(stages[1]) == kept and stages[1].count() == len(kept)
    hit = ids(templates.contaminated(stages[1], read_table(spark, SF, "benchmark")))
    assert hit and ids(stages[2]) == kept - hit
    taken = {r["doc_id"]: r["taken"] for r in curriculum.mix(stages[2]).collect()}
    assert ids(stages[3]) == {i for i, n in taken.items() if n}


def test_run_equals_plain_encoding_of_the_mix(spark, stages):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    want = []
    for r in stages[3].collect():
        x = [*t.encode(r["text"], add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == sorted(want)
    start = 0
    for r in sorted(out, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], read_table(spark, SF, "documents").schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []

import zlib

import numpy as np
import pytest

from tillroll.llm import token_files
from tillroll.llm.queries import tokenizer_path

TEXTS = ["Plain words, and more words.", "a  b", "\n\na b", " a\n b\t c", "x\xa0y z", "<|endoftext|> a<|endoftext|>b", "I'm 'll don 't  ",
         "\u3000a b\x1c c \x1d d", "1 2,3 ... é ß’s", "a \u200b b", " ", "\n", "a\n\nb c\n", "a\r\nb \r\n c", "Ünï, çöde. Ωmega", "日本 語",
         "word, word. word,. ,word Word", "", None, "x" * 50_000, "long text " * 20_000, "a\u2028b c", "\x1f a"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_encoder_equals_the_tokenizer(plain):
    enc = token_files.Encoder(tokenizer_path(), 2)
    for _ in range(2):  # the second time from what is kept
        for text in TEXTS:
            assert np.frombuffer(enc.text(text), "<u2").tolist() == plain(text), text


def test_round_trip_in_order(documents, plain):
    rows = [(100 - i if i % 4 else i, t) for i, t in enumerate(TEXTS)] + [(-5, "minus five"), (100, "again"), (100, "again")]
    manifest = token_files.write_token_files(documents(rows + [(None, "no id")]), tokenizer_path(), 2)
    out = token_files.read_token_files(manifest).collect()
    out.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == [None, *sorted(i for i, _ in rows)]
    assert out[0]["start"] == 0
    for a, b in zip(out[:-1], out[1:], strict=True):
        assert b["start"] == a["start"] + a["n_tokens"]
    want = sorted((str(i), len(plain(t)), zlib.crc32(np.array(plain(t), "<u4").tobytes())) for i, t in [*rows, (None, "no id")])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in out) == want


def test_single_documents(documents, plain):
    manifest = token_files.write_token_files(documents([(i, t) for i, t in enumerate(TEXTS)]), tokenizer_path(), 2)
    for r in manifest.collect():
        with_dictionary = token_files.TokenFile(r["file"])
        for i in range(r["first_id"], r["last_id"] + 1):
            assert [x.tolist() for x in with_dictionary.find(i)] == [plain(TEXTS[i])]
        assert with_dictionary.find(10_000) == []
        with pytest.raises(ValueError):
            token_files.TokenFile(r["file"], b"another dictionary")


def test_empty_table(documents):
    assert token_files.read_token_files(token_files.write_token_files(documents([]), tokenizer_path(), 2)).collect() == []


def test_words_with_digits_and_signs_skip_the_whole_tokenizer(plain, monkeypatch):
    enc = token_files.Encoder(tokenizer_path(), 2)
    text = "les&&& ab12 x.., (word) ément### 3.14 a-b, Été*** [x] it's <|endoftext|>x ~"
    assert np.frombuffer(enc.text(text), "<u2").tolist() == plain(text)
    monkeypatch.setattr(enc, "encode", None)
    enc.text("mots%%% cd34 y.., (words) étés### 2.71 c-d, été*** [y] ~")


def test_long_documents_are_sampled_by_their_beginning(documents):
    docs = documents([(i, f"w{i} " * token_files.SAMPLE_CHARS) for i in range(3)])
    sample = token_files._sample(docs, tokenizer_path(), 2)
    assert len(sample) == 3

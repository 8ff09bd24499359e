"""Token-id files: each document's ids compressed by itself with a shared dictionary.

A zstandard dictionary is trained on the serialized id arrays of a bounded
sample of documents (``SAMPLE_DOCS`` by hash, the first ``SAMPLE_CHARS``
characters of each).  Documents are encoded, sorted by ``doc_id`` and written to
files; one frame per document, so that a short document is read by one small
range read.  A file is

    MAGIC, frames, index (zstd of int64 rows: doc_id, is_null, offset, length, n_tokens),
    footer: index offset, index length, documents (3 x int64), id width (int64),
    SHA-256 of the dictionary (32 bytes), MAGIC

and the dictionary lies beside the files under its hash.  Ids are unsigned
little-endian integers of two bytes if the vocabulary and the end id fit, else
four.  Tasks write under names drawn anew for each attempt; the manifest, a
Spark table, names the files that count, so a lost executor leaves nothing
wrong behind.

Texts are encoded line by line and word by word, with each worker keeping the
ids of words it has met: a byte-level tokenizer that splits like GPT-2's never joins
across a single blank or newline between two other characters.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import file_system, shared_dir, written

MAGIC = b"TILLTOK1"
FOOTER = "<4q32s8s"
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 8000
LEVEL = 3
#: Words of which a worker keeps the ids, after a blank and at a line's start, about 50 MB; longer words are encoded each time.
KEPT_WORDS, KEPT_STARTS, KEPT_LENGTH = 250_000, 50_000, 48

_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
_WORD = re.compile(r" (?<=\S )(?=\S)")
#: What is surely one piece for the tokenizer: Latin letters, digits or signs; an apostrophe may begin an English ending.
_PIECE = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]+|[!-&(-/:-@\\[-`{-~]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


class WordIds(dict):
    """Serialized ids of words, encoded when first met.

    A word of Latin letters, digits and signs is cut into pieces as the tokenizer
    does it, so its model is asked for each piece directly.
    """

    def __init__(self, encoder: Encoder, prefix: str, kept: int):
        super().__init__()
        self.encoder, self.prefix, self.kept = encoder, prefix, kept

    def __missing__(self, word: str) -> bytes:
        latin = word.isascii() or max(word) < "\u0250"
        if latin and len(word) > 1 and word[-1] in ",." and word[:-1].isalpha():
            return self[word[:-1]] + self.encoder.marks[word[-1]]
        if latin and word.isalpha():
            found = self.encoder.letters(self.prefix + word)
        else:
            found = self.encoder.pieces(self.prefix, word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= self.kept:
                self.clear()
            self[word] = found
        return found


class Encoder:
    """Whole texts to serialized ids, with the end id appended."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        largest = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id)
        self.width = 2 if largest < 1 << 16 else 4
        self.pack = [i.to_bytes(self.width, "little") for i in range(largest + 1)]
        self.end = self.pack[end_id]
        self.newline = self.encode("\n")
        self.alphabet = _byte_letters()
        self.blank = self.alphabet[32]
        self.marks = {c: self.encode(c) for c in ",."}
        self.whole = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first, self.later = WordIds(self, "", KEPT_STARTS), WordIds(self, " ", KEPT_WORDS)

    def letters(self, piece: str) -> bytes:
        spelt = piece.replace(" ", self.blank) if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([self.pack[t.id] for t in self.model.tokenize(spelt)])

    def pieces(self, prefix: str, word: str) -> bytes:
        found = _PIECE.findall(word)
        if sum(map(len, found)) != len(word) or any(t in word for t in self.whole):
            return self.encode(prefix + word)
        return self.letters(prefix + found[0]) + b"".join(map(self.letters, found[1:]))

    def encode(self, text: str) -> bytes:
        return b"".join([self.pack[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def line(self, line: str) -> bytes:
        words = line.split()
        if not words or " ".join(words) != line:
            words = _WORD.split(line)
        return self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:]))

    def text(self, text: str | None) -> bytes:
        if not text:
            return self.end
        return self.newline.join(map(self.line, _LINE.split(text))) + self.end


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def train_dictionary(samples: Iterable[bytes]) -> bytes:
    """A dictionary for the samples; their plain content if there is too little to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def _sample(docs: DataFrame, path: str, end_id: int) -> list[bytes]:
    picked = docs.where("doc_id is not null").select(F.col("doc_id").alias("picked")).distinct()
    picked = picked.orderBy(F.xxhash64("picked"), "picked").limit(SAMPLE_DOCS)
    rows = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("picked"), "left_semi")  # SAMPLE_DOCS ids
    rows = rows.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    enc = encoder(path, end_id)
    return [enc.text(r["text"]) for r in rows]


class TokenFile:
    """Random access to one file: ``ids(i)`` of the i-th document, ``find(doc_id)``."""

    def __init__(self, uri: str, dictionary: bytes | None = None):
        store, path = file_system(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        at, length, n, self.width, digest, magic = struct.unpack(FOOTER, 
            self.file.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        if dictionary is None:
            with store.open_input_file(f"{os.path.dirname(path)}/{digest.hex()}.dict") as f:
                dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{uri} needs another dictionary")
        index = zstandard.ZstdDecompressor().decompress(self.file.read_at(length, at), max_output_size=n * 40)
        self.doc_id, self.is_null, self.offset, self.length, self.n_tokens = np.frombuffer(
            index, dtype="<i8").reshape(5, n)
        self.frames = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def _decode(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.frames.decompress(frame), dtype=f"<u{self.width}").astype("<u4")

    def ids(self, i: int) -> np.ndarray:
        return self._decode(self.file.read_at(int(self.length[i]), int(self.offset[i])))

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of the documents with this id, by binary search in the index."""
        skip = int(self.is_null.sum())
        lo, hi = (skip + int(np.searchsorted(self.doc_id[skip:], doc_id, side=s)) for s in ("left", "right"))
        return [self.ids(i) for i in range(lo, hi)]

    def __iter__(self):
        """Every document's ids in order, by reads of several megabytes."""
        i, n = 0, len(self.offset)
        while i < n:
            stop = max(i + 1, int(np.searchsorted(self.offset, self.offset[i] + (4 << 20))))
            lo, hi = int(self.offset[i]), int(self.offset[stop - 1] + self.length[stop - 1])
            data = self.file.read_at(hi - lo, lo)
            for j in range(i, stop):
                a = int(self.offset[j]) - lo
                yield self._decode(data[a:a + int(self.length[j])])
            i = stop


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write every row of ``docs`` (``doc_id``, ``text``) in ascending ``doc_id`` order.

    Returns the manifest: ``part, file, n_docs, n_tokens, first_id, last_id``, in
    the order of ``part``.  A null text is empty (its end id only); null ids come
    first; rows of one id follow in the order of their compressed ids' hash;
    repeated rows are written as often as they come.  Other columns are left out.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "tokens")
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    content = train_dictionary(_sample(docs, tokenizer, end_id))
    digest = hashlib.sha256(content).digest()
    with store.open_output_stream(f"{path}/{digest.hex()}.dict") as f:
        f.write(content)
    shared = spark.sparkContext.broadcast(content)  # DICTIONARY_BYTES

    def encode(batches):
        enc = encoder(tokenizer, end_id)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        for batch in batches:
            ids = batch.column(0)
            for lo in range(0, batch.num_rows, 256):
                part = batch.column(1).slice(lo, 256)
                sizes, frames = [], []
                for text in part:
                    data = enc.text(text.as_py())
                    sizes.append(len(data) // enc.width)
                    frames.append(pack.compress(data))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, 256), pa.array(sizes, pa.int64()), pa.array(frames, pa.binary())],
                    names=["doc_id", "n_tokens", "frame"])

    encoded = written(docs.mapInArrow(encode, "doc_id long, n_tokens long, frame binary"), "encoded")
    width = encoder(tokenizer, end_id).width
    tie = F.xxhash64("frame")
    ordered = encoded.withColumn("tie", tie)
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").drop("tie")

    def write(batches):
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        out_store, out_path = file_system(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
        index, at = [], len(MAGIC)
        with out_store.open_output_stream(f"{out_path}/{name}") as f:
            f.write(MAGIC)
            for batch in (b for src in ([first], batches) for b in src):
                ids = batch.column(0)
                lengths = pa.compute.binary_length(batch.column(2)).to_numpy().astype("<i8")
                offsets = at + np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
                for frame in batch.column(2):
                    f.write(frame.as_buffer())
                at += int(lengths.sum())
                index.append(np.stack([
                    pa.compute.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                    offsets, lengths, batch.column(1).to_numpy()]).astype("<i8"))
            rows = np.concatenate(index, axis=1)
            packed = zstandard.ZstdCompressor(level=LEVEL).compress(rows.tobytes())
            f.write(packed)
            f.write(struct.pack(FOOTER, at, len(packed), rows.shape[1], width, digest, MAGIC))
        known = rows[0][rows[1] == 0].tolist()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int64()), "file": [f"{folder}/{name}"],
            "n_docs": pa.array([rows.shape[1]], pa.int64()), "n_tokens": pa.array([int(rows[4].sum())], pa.int64()),
            "first_id": pa.array(known[:1] or [None], pa.int64()), "last_id": pa.array(known[-1:] or [None], pa.int64())})

    return written(ordered.mapInArrow(
        write, "part long, file string, n_docs long, n_tokens long, first_id long, last_id long"), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    ``start`` counts the ids of all documents before it.  One task reads one file
    at a time; only the manifest, a row per file, is ordered in one place.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    files = files.repartition(max(1, manifest.count()))

    def read(batches):
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = TokenFile(uri)
                sizes, sums = [], []
                for ids in tokens:
                    sizes.append(len(ids))
                    sums.append(zlib.crc32(ids.tobytes()))
                sizes = np.array(sizes, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.doc_id, pa.int64(), mask=tokens.is_null.astype(bool)),
                     pa.array(base + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")

"""Token-id files: documents compressed one by one against a shared zstandard dictionary.

Layout of a file, all numbers little-endian:

    magic b"TGID0001" | sha256 of the dictionary (32 bytes) | bytes per id: u32 | frames | index | n: u64 | index offset: u64

A frame is one document's ids, compressed; the index has n entries of INDEX: document id, whether it
is null, frame offset, frame length, number of ids. A reader seeks to one document through the index
and reads nothing else. Files are listed, with the ids that come before each, in a Parquet manifest next
to them; a file that no manifest row names comes from a failed task and is never read.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import Memo, new_folder, pick, text_slices, utf8

MAGIC = b"TGID0001"
HEAD = len(MAGIC) + 32 + 4
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("length", "<u4"), ("count", "<u8")])
#: Training sample of the dictionary: documents of least hash, at most so many, none larger than this.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 32_768, 65_536
#: A task starts another file after so many bytes.
FILE_BYTES = 128 << 20
#: Text of one task, which learns the ids of its words anew: larger ranges look fewer words up.
RANGE_BYTES = 32 << 20
SLICE_BYTES = 4 << 20
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_signs() -> dict[int, int]:
    """The printable sign that byte-level tokenizers write for each byte: itself where it is printable
    Latin-1, else the next one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + n for n, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder in Spark's notation (s3a is s3 here)."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1)) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Encoder:
    """``ids(texts)``: the tokenizer's ids of whole texts as little-endian bytes of ``width``.

    The tokenizer drops white space and never joins text across it, so a text's ids are those of its
    ASCII-white-space-separated words; words are looked up in a bounded memo. New words go through the
    tokenizers library, in one call; a word that is letters only after normalizing is one pre-token, so the
    model is asked directly. A word with trailing punctuation is its stem's ids and the punctuation's, as letters
    and digits never join with what follows them there.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.code = Tokenizer.from_file(path), np.dtype(f"<u{width}"), {2: "H", 4: "I"}[width]
        self.memo = Memo(self._learn, 400_000)
        self.parts = Memo(self._encode, 200_000)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        texts = b"\n".join(words).decode().split("\n") if words else []  # words hold no white space
        strange = [i for i, w in enumerate(words) if not (w.isalpha() and w.islower())]
        alphabetic = [i for i in strange if texts[i].isalpha()]
        for i, letters in zip(alphabetic, self._signs([texts[i] for i in alphabetic]), strict=True):
            texts[i] = letters
        rest = sorted({*strange}.difference(i for i in alphabetic if texts[i]))
        other, tokenize, code = {*rest}, self.tokenizer.model.tokenize, self.code
        for i, letters in enumerate(texts):
            if i not in other:
                out[i] = array(code, [t.id for t in tokenize(letters)]).tobytes()
        if rest:
            found = self.tokenizer.encode([words[i].decode() for i in rest], is_pretokenized=True, add_special_tokens=False)
            ids, owner = np.array(found.ids, self.kind), np.array(found.word_ids, np.int64)
            ends = np.searchsorted(owner, np.arange(len(rest) + 1))
            for k, i in enumerate(rest):
                out[i] = ids[ends[k] : ends[k + 1]].tobytes()
        return out

    def _signs(self, words: list[str]) -> list[str]:
        """Normalized words in the signs of their bytes, empty where they aren't letters only. All go through in one text
        with blanks between them, unless the normalizer changes those."""
        normalize = self.tokenizer.normalizer.normalize_str
        found = normalize(" ".join(words)).split(" ") if words else []
        if len(found) != len(words):
            found = [normalize(w) for w in words]
        known = " ".join(x if x.isalpha() else "" for x in found)
        return known.encode().decode("latin-1").translate(BYTE_SIGNS).split(chr(BYTE_SIGNS[32])) if words else []

    @staticmethod
    def _split(word: bytes) -> tuple[bytes, bytes]:
        if b"<|" in word:  # may be a special token, which is looked for before lower-casing
            return word, b""
        low = word.lower()
        stem = low.rstrip(PUNCTUATION)
        if stem and len(stem) < len(low) and stem[-1:].isalnum():
            return stem, low[len(stem) :]
        return low, b""

    def _learn(self, words: list[bytes]) -> list[bytes]:
        split = [(w, b"") if w.isalpha() and w.islower() else self._split(w) for w in words]
        # only what stands before or in punctuation is kept for later words; whole words are kept by the memo itself
        known = self.parts.of({p for low, tail in split if tail for p in (low, tail)})
        whole = list({low for low, tail in split if not tail}.difference(known))
        found = dict(zip(whole, self._encode(whole), strict=True))
        return [known[low] + known[tail] if tail else found[low] if low in found else known[low] for low, tail in split]

    def ids(self, texts: list[bytes], end: bytes) -> list[bytes]:
        split = [t.split() if b"<|" in t else t.lower().split() for t in texts]
        known, out, unknown = self.memo.young, [], []
        for i, ws in enumerate(split):  # most texts have no word that is new
            try:
                out.append(b"".join(map(known.__getitem__, ws)) + end)
            except KeyError:
                out.append(b"")
                unknown.append(i)
        if unknown:
            known = self.memo.of(set().union(*(split[i] for i in unknown)))
            for i in unknown:
                out[i] = b"".join(map(known.__getitem__, split[i])) + end
        return out


def sample_texts(docs: DataFrame, n: int) -> list[bytes]:
    """Of ``n`` documents, the ``SAMPLE_DOCS`` texts of least hash, or fewer, among those of at most ``SAMPLE_BYTES``. Whatever the table's size, only
    texts below a hash threshold that keeps about twice as many rows meet; rows equal in id and length are one."""
    tagged = docs.where(F.octet_length("text").between(1, SAMPLE_BYTES)).select("text", F.xxhash64("doc_id", F.octet_length("text")).alias("h"))
    free = 63 - max(0, (n // (2 * SAMPLE_DOCS)).bit_length() - 1)  # bits of a hash below the threshold
    least = tagged.where(F.shiftrightunsigned("h", 1) < F.lit(1 << free)) if free < 63 else tagged
    rows = least.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(SAMPLE_DOCS).collect()
    return [r["text"].encode() for r in rows]


def train_dictionary(docs: DataFrame, n: int, tokenizer: str, end_id: int, width: int) -> bytes:
    """A zstandard dictionary trained on the serialized ids of a bounded sample of texts. Too few of them to
    train on give the sample itself as a raw-content dictionary, no documents an empty one."""
    samples = Encoder(tokenizer, width).ids(sample_texts(docs, n), np.array([end_id], f"<u{width}").tobytes())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


class _Writer:
    """One open file of a task."""

    def __init__(self, folder: str, digest: bytes, width: int):
        self.uri = f"{folder}/{uuid.uuid4().hex}.tgid"
        system, path = file_system(self.uri)
        self.out = system.open_output_stream(path)
        self.out.write(MAGIC + digest + np.uint32(width).tobytes())
        self.at, self.index, self.ids = HEAD, [], 0

    def add(self, doc_id: int | None, frame: bytes, count: int) -> None:
        self.out.write(frame)
        self.index.append((doc_id or 0, doc_id is None, self.at, len(frame), count))
        self.at, self.ids = self.at + len(frame), self.ids + count

    def close(self) -> tuple[str, int, int]:
        self.out.write(np.array(self.index, INDEX).tobytes() + np.array([len(self.index), self.at], "<u8").tobytes())
        self.out.close()
        return self.uri, len(self.index), self.ids


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, width: int = 2, level: int = 3, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write the ids below ``folder`` in
    ascending key order (null first; equal keys by text). ``width`` is the bytes per id.

    Rows are range-partitioned by key and hash of the text, and sorted within tasks, so files follow one
    another in order. Repeated rows are written as often as they come. An empty table gives an empty manifest.
    """
    plain = pick(docs, key, text).toDF("doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = plain.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    dictionary = train_dictionary(plain, size["n"], tokenizer, end_id, width)
    digest = hashlib.sha256(dictionary).digest()
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/dictionary") as out:
        out.write(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = Encoder(tokenizer, width), np.array([end_id], f"<u{width}").tobytes()
        squeeze = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        task, done, writer = TaskContext.get().partitionId(), [], None
        for batch in batches:
            for a, b in text_slices(batch, 1, SLICE_BYTES):
                part = batch.slice(a, b - a)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.ids(utf8(part.column(1)), end), strict=True):
                    writer = writer or _Writer(folder, digest, width)
                    writer.add(doc_id, squeeze.compress(ids), len(ids) // width)
                    if writer.at > FILE_BYTES:
                        done.append(writer.close())
                        writer = None
        if writer:
            done.append(writer.close())
        if done:
            files, docs_, ids_ = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(done), pa.int64()), pa.array(range(len(done)), pa.int64()), pa.array(files), pa.array(docs_, pa.int64()), pa.array(ids_, pa.int64())],
                names=["task", "nth", "file", "n_docs", "n_ids"],
            )

    order = ["doc_id", F.xxhash64("text"), "text"]
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, -(-(size["bytes"] or 0) // RANGE_BYTES))
    ranged = plain.repartitionByRange(ranges, "doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
    ranged.mapInArrow(run, "task long, nth long, file string, n_docs long, n_ids long").write.parquet(f"{folder}/manifest")


def read_token_files(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: ``start`` counts the ids of all documents before
    it. The manifest has one row per file, so its running sum is small; every file is read by one task."""
    order = Window.orderBy("task", "nth").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{folder}/manifest")
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).cast("long").alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        with system.open_input_stream(f"{path}/dictionary") as source:
            dictionary = source.read()
        expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            for file, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from _documents(file, before, expand, hashlib.sha256(dictionary).digest())

    per_file = files.repartition(spark.sparkContext.defaultParallelism * 4, "file")
    return per_file.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _open(uri: str, digest: bytes):
    """The open file, its index and bytes per id, after its mark and dictionary were checked."""
    system, path = file_system(uri)
    source = system.open_input_file(path)
    head = source.read(HEAD)
    if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) : HEAD - 4] != digest:
        raise ValueError(f"{uri} is no token file of this dictionary")
    size = source.size()
    source.seek(size - 16)
    n, at = (int(x) for x in np.frombuffer(source.read(16), "<u8"))
    source.seek(at)
    return source, np.frombuffer(source.read(n * INDEX.itemsize), INDEX), int(np.frombuffer(head[-4:], "<u4")[0])


def _documents(uri: str, before: int, expand, digest: bytes, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    source, index, width = _open(uri, digest)
    with source:
        start = before + np.concatenate([[0], np.cumsum(index["count"], dtype=np.int64)])
        source.seek(HEAD)
        a = 0
        while a < len(index):
            b, size = a, 0
            while b < len(index) and (b == a or size < most):
                size += int(index["count"][b]) * 4
                b += 1
            block = source.read(int(index["length"][a:b].sum()))
            ids, at = [], 0
            for length in index["length"][a:b]:
                raw = expand.decompress(block[at : at + int(length)])
                ids.append(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())
                at += int(length)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(index["doc_id"][a:b], mask=index["null"][a:b].astype(bool)), pa.array(start[a:b], pa.int64()),
                    pa.array(index["count"][a:b].astype(np.int64)), pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
            a = b


def read_document(folder: str, file: str, doc_id: int) -> list[int] | None:
    """One document's ids by a seek through the index of ``file``; null if the file doesn't have it."""
    system, path = file_system(folder)
    with system.open_input_stream(f"{path}/dictionary") as stream:
        dictionary = stream.read()
    source, index, width = _open(file, hashlib.sha256(dictionary).digest())
    with source:
        at = np.flatnonzero((index["doc_id"] == doc_id) & (index["null"] == 0))
        if not len(at):
            return None
        source.seek(int(index["offset"][at[0]]))
        frame = source.read(int(index["length"][at[0]]))
    raw = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress(frame)
    return np.frombuffer(raw, f"<u{width}").tolist()


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from files written for ``docs``."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    write_token_files(docs, folder, tokenizer)
    back = read_token_files(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

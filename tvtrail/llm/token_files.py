"""Token ids as flat binary files with 64-bit document offsets.

One file per range of the order column:

    token ids of all its documents     unsigned little-endian, 2 or 4 bytes each
    padding                            zero bytes up to a multiple of 8
    document offsets                   64 bits each: first token of each document in this file
    document ids                       64 bits each, signed; NO_ID where null
    footer                             5 x 64 bits: magic, id width, padding, documents, tokens

The ids start at byte 0, so a trainer maps the file and reads any slice in place.
Files are written by Spark's own committed text writer, which puts bytes through
as they are: every record ends with a zero byte (the high byte of the end token,
or of the token count) that is left out of the record and written as the line end.
Lost tasks therefore leave nothing behind, on any file system Spark can write to.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tvtrail.llm.common import bases, settle, text_bytes
from tvtrail.llm.wordpieces import Splitter, WordCache, byte_level

MAGIC = 0x0054564C4C4D0001
NO_ID = -(1 << 63)
FILE_TEXT_BYTES = 16 << 20


class Encoder:
    """Token ids of whole texts, by the tokenizers library word by word."""

    def __init__(self, path: str, width: int | None = None):
        self.splitter = Splitter(path)
        size = self.splitter.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype(f"<u{width or (2 if size <= 1 << 16 else 4)}")
        self._model = self.splitter.tokenizer.model
        self._kind = "H" if self.dtype.itemsize == 2 else "I"
        self._coded = WordCache(self._code)
        self._plain = WordCache(lambda word: self._code(word if word.isalpha() and word.isascii() else byte_level(word)))

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self._kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _code(self, word: str) -> bytes:
        return self._pack([t.id for t in self._model.tokenize(word)])

    def encode(self, text: str | None) -> bytes:
        """Packed ids; those of special strings in the text are the special tokens' ids."""
        if not text:
            return b""
        if self.splitter.plain(text):
            packed = b"".join(map(self._plain.__getitem__, self.splitter.plain_words(text)))
        else:
            packed = b"".join(
                self._pack([w]) if isinstance(w, int) else self._coded[w] for _, w in self.splitter.pieces(text))
        self._plain.trim()
        self._coded.trim()
        return packed


def write(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
    file_text_bytes: int = FILE_TEXT_BYTES,
) -> None:
    """Write all documents in ascending ``key`` order; null texts are empty documents.

    Documents are range partitioned by key into files of about ``file_text_bytes`` of
    text each.  Rows of equal key are ordered by their text; null keys come first.
    """
    total = docs.agg(F.sum(text_bytes(f"`{text}`"))).first()[0] or 0
    files = max(1, -(-total // file_text_bytes))

    def layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(tokenizer), None
        ids, offsets, tokens = [], [], 0
        width = encoder.dtype.itemsize
        end = encoder._pack([end_id])
        for batch in batches:
            records = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = encoder.encode(value) + end
                ids.append(NO_ID if doc is None else doc)
                offsets.append(tokens)
                tokens += len(packed) // width
                records.append(packed[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])
        if ids:
            pad = -tokens * width % 8
            tail = b"".join((
                bytes(pad), np.array(offsets, "<u8").tobytes(), np.array(ids, "<i8").tobytes(),
                np.array([MAGIC, width, pad, len(ids), tokens], "<u8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([tail[:-1]], pa.binary())], ["record"])

    if end_id >> (8 * Encoder(tokenizer).dtype.itemsize - 8):
        raise ValueError("the high byte of the end id must be zero")
    ordered = (
        docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
        .repartitionByRange(files, "key", F.xxhash64("text"))
        .sortWithinPartitions("key", F.xxhash64("text"))
    )
    (ordered.mapInArrow(layout, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\0").text(path))


@dataclass
class TokenFile:
    """One file's parts, as views of its bytes (mapped or read)."""

    tokens: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray

    @classmethod
    def view(cls, data) -> TokenFile:
        raw = np.frombuffer(data, np.uint8) if isinstance(data, (bytes, memoryview)) else data
        magic, width, pad, docs, tokens = (int(x) for x in raw[-40:].view("<u8"))
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = tokens * width + pad
        return cls(
            raw[:tokens * width].view(f"<u{width}"),
            raw[at:at + 8 * docs].view("<u8"),
            raw[at + 8 * docs:at + 16 * docs].view("<i8"))

    @classmethod
    def map(cls, path: str) -> TokenFile:
        """Map a local file; nothing is read before it is used."""
        return cls.view(np.asarray(np.memmap(path, np.uint8, "r")))

    def document(self, n: int) -> np.ndarray:
        end = self.offsets[n + 1] if n + 1 < len(self.offsets) else len(self.tokens)
        return self.tokens[int(self.offsets[n]):int(end)]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32.

    A file on a mounted file system is mapped by the task that has it; from other stores
    Spark's binary reader brings it as one row, viewed in place.  The store is that which the
    path leads to: one without a scheme belongs to the default file system.  A file's
    base is the prefix sum of the token totals of the files before it (one row per file).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    mounted = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, name in enumerate(batch.column("path").to_pylist()):
                if mounted:
                    file = TokenFile.map(unquote(urlparse(name).path))
                else:
                    file = TokenFile.view(memoryview(batch.column("content")[n].as_buffer()))
                part = int(name.rsplit("/", 1)[-1].split("-")[1])
                counts = np.diff(np.append(file.offsets, len(file.tokens)).astype(np.int64))
                sums = [zlib.crc32(file.document(d).astype("<u4").tobytes()) for d in range(len(counts))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(counts), part), pa.int32()),
                    pa.array(file.ids, pa.int64(), mask=file.ids == NO_ID),
                    pa.array(file.offsets.astype(np.int64)), pa.array(counts), pa.array(sums, pa.int64()),
                ], ["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    files = files.select("path") if mounted else files.select("path", "content")
    rows = settle(
        files.mapInArrow(parse, "part int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"),
        "token-index")
    base = bases(rows.groupBy("part").agg(F.sum("n_tokens").alias("total")), "part", "total")
    return rows.join(F.broadcast(base), "part").select(  # one row per file
        "doc_id", (F.col("_base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

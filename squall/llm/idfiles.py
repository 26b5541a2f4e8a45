"""Token-id files: concatenated id arrays with Elias-Fano encoded document boundaries.

Documents are ordered by ``doc_id`` over the whole table (nulls first; repeated ids by
a hash of the text) and split by ranges of ids into shards of about ``SHARD_BYTES`` of
text; each shard is one file. A file holds

* 8 bytes magic, then seven 64-bit numbers: documents, null ids among them, ids, bytes
  per id, smallest document id, and the low-bit widths of the two Elias-Fano lists;
* the boundaries (documents + 1 of them, from 0 to the number of ids) and the document
  ids less the smallest, each as an Elias-Fano list;
* the ids, little-endian, in 2 bytes each where the vocabulary allows, else 4.

An Elias-Fano list of n ascending numbers below u keeps the low ``log2(u / n)`` bits of
each in a packed array and the rest as a bit vector in which the i-th one stands at
(high part + i): about 2 + log2(u / n) bits a number, no table of 64-bit offsets. Every
``SAMPLE``-th one's position is kept in 32 bits, so that ``select`` reads a number from a
few bytes wherever it stands.

Files are written under a temporary name and renamed, so a task that is run twice
leaves one whole file. A manifest (one short row per shard) is written as Parquet in the
same folder; running totals over it give each shard's place in the whole stream.

Defined results: a null text counts as empty and gives the end id alone; repeated rows
are stored each; an empty table gives no shard and an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from squall.llm.encoding import encoder
from squall.llm.text import whole
from squall.llm.work import fresh_folder

MAGIC = b"EFIDS\x00\x00\x01"
HEADER = struct.Struct("<8s7q")
SHARD_BYTES = 16 << 20
SAMPLE = 256
MANIFEST = "shard int, file string, n_docs long, n_ids long"


class EliasFano:
    """An ascending list of numbers, read in place from its bytes."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        high_part = (values >> np.uint64(low_bits)).astype(np.int64)
        ones = high_part + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        places = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(places.astype(np.uint8).reshape(-1), bitorder="little")
        if n and ones[-1] >= 1 << 32:
            raise ValueError("a shard's list is too long for 32-bit samples")
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def tobytes(self) -> bytes:
        sizes = struct.pack("<3q", len(self.low), len(self.high), len(self.samples))
        return sizes + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int, n: int, low_bits: int) -> tuple[EliasFano, int]:
        """The list that begins at ``at``, and where it ends."""
        a, b, c = struct.unpack_from("<3q", data, at)
        at += 24
        low = np.frombuffer(data, np.uint8, a, at)
        high = np.frombuffer(data, np.uint8, b, at + a)
        samples = np.frombuffer(data, "<u4", c, at + a + b)
        return cls(n, low_bits, low, high, samples), at + a + b + 4 * c

    def select(self, i: int) -> int:
        """The i-th number: from the last sample before it, byte by byte to the i-th one."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        position = int(self.samples[i // SAMPLE])
        need = i % SAMPLE  # ones to pass after the sampled one
        byte = position >> 3
        current = int(self.high[byte]) >> (position & 7) << (position & 7)
        while (ones := current.bit_count()) <= need:
            need -= ones
            byte += 1
            current = int(self.high[byte])
        for _ in range(need):
            current &= current - 1
        position = 8 * byte + (current & -current).bit_length() - 1
        return (position - i) << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        chunk = int.from_bytes(self.low[first >> 3 : (last + 7) >> 3].tobytes(), "little")
        return chunk >> (first & 7) & (1 << self.low_bits) - 1

    def all(self) -> np.ndarray:
        """The whole list."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits]
        low = bits.reshape(self.n, self.low_bits).astype(np.uint64)
        low = (low << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | low


class Shard:
    """A shard's bytes, opened."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, self.n_docs, self.n_null, self.n_ids, width, self.least, a, b = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token-id shard")
        self.bounds, at = EliasFano.read(view, HEADER.size, self.n_docs + 1, a)
        self.doc_ids, at = EliasFano.read(view, at, self.n_docs - self.n_null, b)
        self.ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, found by two selects."""
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]

    def rows(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start within the shard, ids) of each document, its bounds found by select."""
        names = [None] * self.n_null + [self.least + int(x) for x in self.doc_ids.all()]
        begin = self.bounds.select(0)
        for i, name in enumerate(names):
            end = self.bounds.select(i + 1)
            yield name, begin, self.ids[begin:end]
            begin = end


def shard_parts(doc_ids: list[int | None], documents: list[np.ndarray], width: int) -> Iterator[bytes | memoryview]:
    """The bytes of a shard of documents in order, part by part; null document ids come first."""
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    bounds = EliasFano.encode(np.concatenate([[0], np.cumsum([len(x) for x in documents])]))
    names = EliasFano.encode(np.array([d - least for d in known], np.uint64))
    nulls, n_ids = len(doc_ids) - len(known), sum(map(len, documents))
    yield HEADER.pack(MAGIC, len(doc_ids), nulls, n_ids, width, least, bounds.low_bits, names.low_bits)
    yield bounds.tobytes()
    yield names.tobytes()
    for ids in documents:
        yield memoryview(ids.astype(f"<u{width}", copy=False)).cast("B") if len(ids) else b""


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shard_size: int = SHARD_BYTES) -> DataFrame:
    """Write the shards of ``docs`` and a manifest under ``folder``; return the manifest."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(whole("text"))), F.lit(0))).first()[0]
    shards = max(1, math.ceil(size / shard_size))
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange(shards, F.col("doc_id").asc(), F.col("tie").asc())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, names, documents = encoder(tokenizer), [], []
        for batch in batches:
            names += batch.column("doc_id").to_pylist()
            for ids in encode(batch.column("text")):
                documents.append(np.append(ids, np.uint32(end_id)).astype(encode.dtype))
        if not names:
            return
        shard = TaskContext.get().partitionId()
        store, path = _at(folder)
        store.create_dir(path, recursive=True)
        name, attempt = f"shard-{shard:06d}.ids", f"{path}/_{uuid.uuid4().hex}"
        with store.open_output_stream(attempt) as f:
            for part in shard_parts(names, documents, encode.dtype.itemsize):
                f.write(part)
        store.move(attempt, f"{path}/{name}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(names)]), pa.array([sum(map(len, documents))])],
            names=["shard", "file", "n_docs", "n_ids"],
        )

    ordered.select("doc_id", "text").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    manifest = read_manifest(spark, folder)
    # one short row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                store, path = _at(folder)
                with store.open_input_file(f"{path}/{file}") as f:
                    shard = Shard(f.read())
                rows = [(d, start + s, len(x), zlib.crc32(x.astype("<u4"))) for d, s, x in shard.rows()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )

    spread = placed.select("file", "start").repartition(max(1, manifest.count()), "file")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, shard_size: int = SHARD_BYTES) -> DataFrame:
    """Write the token ids of ``docs`` to files in the shared folder and read them back."""
    path = fresh_folder(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, end_id, shard_size)
    return read_ids(docs.sparkSession, path)

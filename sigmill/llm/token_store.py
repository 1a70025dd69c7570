"""A token store: concatenated ids with Elias-Fano encoded document boundaries.

A store is a folder of Parquet rows, one binary segment each, so any file system that Spark writes to will do. Segments
follow ascending doc_id. The segment format (little endian):

    magic "SGEF", version u16, id bytes u16 (2 or 4), documents u64, ids u64, first doc_id i64,
    documents without a doc_id u64, which come first
    for the boundaries, then for the doc_ids less the first one:
        low bits u16, words u32 of the upper bits
        lower bits         low bits of each value, packed
        upper bits         unary coded upper parts: bit (value >> low bits) + k is set for the k-th value
        select samples     u32 each: the place in `upper bits` of every 64th set bit
    ids                u16 or u32 each

The k-th boundary is the number of ids up to and with document k. A sequence of n values up to m takes 2 + log2(m / n)
bits a value about, so neither boundaries nor doc_ids need a table of whole numbers.

Nulls and empty texts have the end id alone. Rows with equal doc_ids stay separate, in order of text; rows with a null
doc_id come first and keep it. An empty table gives an empty store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import new_path
from .tokens import Encoder, default_tokenizer

HEADER, SEQUENCE = struct.Struct("<4sHHQQqQ"), struct.Struct("<HI")
MAGIC, VERSION = b"SGEF", 3
SEGMENT_IDS = 1 << 18
SAMPLE = 64
STORE = T.StructType([T.StructField("shard", T.LongType()), T.StructField("segment_no", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("n_ids", T.LongType()), T.StructField("first_doc_id", T.LongType()), T.StructField("last_doc_id", T.LongType()), T.StructField("segment", T.BinaryType())])


class EliasFano:
    """A non-decreasing sequence of unsigned integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        low = np.packbits((values[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little").view("<u8"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return b"".join((SEQUENCE.pack(self.low_bits, len(self.high)), self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()))

    @classmethod
    def read(cls, data: bytes, at: int, n: int) -> tuple[EliasFano, int]:
        """The sequence of n values at a place in data, nothing copied, and the place behind it."""
        (bits, words), at, parts = SEQUENCE.unpack_from(data, at), at + SEQUENCE.size, []
        for kind, count in (("u1", -(-n * bits // 8)), ("<u8", words), ("<u4", -(-n // SAMPLE))):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        return cls(n, bits, *parts), at

    def select(self, k: int) -> int:
        """The place of the k-th set bit of the upper bits (from 0): from the sample before it, word by word."""
        word, shift = divmod(int(self.samples[k // SAMPLE]), 64)
        need, mask = k % SAMPLE, int(self.high[word]) >> shift << shift
        while mask.bit_count() <= need:
            need -= mask.bit_count()
            word += 1
            mask = int(self.high[word])
        for _ in range(need):
            mask &= mask - 1
        return word * 64 + (mask & -mask).bit_length() - 1

    def __getitem__(self, k: int) -> int:
        low = 0
        for b in range(self.low_bits):
            at = k * self.low_bits + b
            low |= (int(self.low[at // 8]) >> at % 8 & 1) << b
        return (self.select(k) - k) << self.low_bits | low

    def all(self) -> np.ndarray:
        """All values as unsigned 64-bit numbers."""
        ones = np.flatnonzero(np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little"))
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.uint64)
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) + (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def first_at_least(self, value: int) -> int:
        """How many values are below value."""
        a, b = 0, self.n
        while a < b:
            k = (a + b) // 2
            a, b = (k + 1, b) if self[k] < value else (a, k)
        return a


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    flat, numbers = np.concatenate(ids), [d for d in doc_ids if d is not None]
    first = numbers[0] if numbers else 0
    ends = EliasFano.encode(np.cumsum([len(x) for x in ids]))
    names = EliasFano.encode(np.array([d - first for d in numbers], np.uint64))
    width = 2 if flat.max(initial=0) < 1 << 16 else 4
    head = HEADER.pack(MAGIC, VERSION, width, len(ids), len(flat), first, len(ids) - len(numbers))
    return b"".join((head, ends.to_bytes(), names.to_bytes(), flat.astype(f"<u{width}").tobytes()))


def open_segment(data: bytes) -> tuple[int, int, EliasFano, EliasFano, np.ndarray]:
    """(rows without a doc_id, first doc_id, the others less it, boundaries, ids) of a segment; nothing is copied."""
    magic, version, width, n, total, first, nameless = HEADER.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token segment")
    ends, at = EliasFano.read(data, HEADER.size, n)
    names, at = EliasFano.read(data, at, n - nameless)
    return nameless, first, names, ends, np.frombuffer(data, f"<u{width}", total, at)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Tokenize docs(doc_id, text) and write a store. One shuffle, by ranges of doc_id; each task writes one shard."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, number, start, held = Encoder.of(tokenizer), (), 0, 0, 0
        doc_ids: list[int] = []
        ids: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            first = next((d for d in doc_ids if d is not None), None)
            row = (*shard, number, start, held, first, doc_ids[-1], pack_segment(doc_ids, ids))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], STORE.names)

        for batch in batches:
            for doc_id, one in zip(batch.column(0).to_pylist(), encoder.documents(x.as_py() for x in batch.column(1)), strict=True):
                shard = shard or (doc_id,)
                doc_ids.append(doc_id)
                ids.append(one)
                held += len(one)
                if held >= SEGMENT_IDS:
                    yield segment()
                    number, start, held = number + 1, start + held, 0
                    doc_ids.clear()
                    ids.clear()
        if ids:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(run, STORE).write.option("parquet.block.size", 16 << 20).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """A store -> (doc_id, start, n_tokens, ids_crc32): start counts the ids of all documents before, over all shards."""
    store = spark.read.schema(STORE).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, segment in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                nameless, first, names, ends, ids = open_segment(segment.as_py())
                doc_ids = pa.concat_arrays([pa.nulls(nameless, pa.int64()), pa.array((names.all() + np.uint64(first % (1 << 64))).view(np.int64))])
                stops = ends.all().astype(np.int64)
                starts = np.r_[0, stops[:-1]]
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()).take(pa.array(np.zeros(len(stops), np.int32))), doc_ids, pa.array(start + starts), pa.array(stops - starts), pa.array(crc, pa.int64())], ["shard", "doc_id", "within", "n_tokens", "ids_crc32"])

    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task that wrote
    base = store.groupBy(F.col("shard").alias("_shard")).agg(F.sum("n_ids").alias("_n")).select("_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = store.select("shard", "start", "segment").mapInArrow(run, "shard long, doc_id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(base, rows["shard"].eqNullSafe(base["_shard"])).select("doc_id", (F.col("_base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def document_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row that has this doc_id), found by segment statistics and `select`."""
    found = []
    for row in spark.read.schema(STORE).parquet(path).where(F.lit(doc_id).between(F.col("first_doc_id"), F.col("last_doc_id"))).orderBy("shard", "segment_no").select("segment").toLocalIterator():
        nameless, first, names, ends, ids = open_segment(bytes(row[0]))
        for k in range(nameless + names.first_at_least(doc_id - first), nameless + names.first_at_least(doc_id + 1 - first)):
            found.append(ids[ends[k - 1] if k else 0 : ends[k]].astype("<u4"))
    return found


def tokenize_to_store(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write docs to a new store in the shared folder and return what its files say."""
    path = new_path(docs.sparkSession, "token-store")
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)

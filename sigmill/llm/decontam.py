"""Benchmark decontamination: containment search with size-partitioned MinHash, verified by exact shingle containment.

Items are short and documents long, so the Jaccard similarity of a leaked item and its document is near zero and banded
signatures of whole documents miss it. Each item instead keeps its k smallest shingle hashes (its bottom-k MinHash),
with k set for each partition of item sizes such that every document that contains `threshold` of the item must hold
at least one of them: k = n - ceil(threshold * n) + 1 at the partition's largest n. Candidates are exact in recall;
they are then verified on the shingles themselves.

A benchmark of up to `BLOCK_SHINGLES` shingles, counted first, comes to the executors as one index, and documents are
judged where they stand. A larger one never comes together anywhere: executors sketch its items, a bit filter of fixed
size (`FILTER_BITS`) made of all sketches goes to the documents, only shingles that pass it are shuffled to meet the
sketches, and candidate pairs are verified by joins with both texts. Both ways read the documents' words once, and both
have the same results.

Words: A-Z lower-cased, ASCII punctuation as space, split at ASCII white space. An item of fewer than five words is one
shingle of its own length; one without words matches nothing. Null texts count as empty. Repeated rows give repeated
results; repeated items (equal item_id) are told apart by text.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import LOWER, UPPER, fresh, materialize

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_SHINGLES = 500_000
#: Of the filter: a power of two, and the bits each sketch hash sets.
FILTER_BITS, PROBES = 1 << 28, 3
PIECE = 1 << 20
PLAIN = bytes.maketrans(UPPER.encode() + string.punctuation.encode(), LOWER.encode() + b" " * len(string.punctuation))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


def shingles_of(words: list[bytes], k: int = SHINGLE) -> list[bytes]:
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def needed(n: int, threshold: float) -> int:
    """The fewest of n shingles that make up the threshold."""
    return int(np.ceil(np.round(threshold * n, 9)))


def sketch_of(words: list[bytes], threshold: float) -> tuple[int, frozenset[bytes], np.ndarray]:
    """(shingle width, shingles, bottom-k hashes) of an item with words."""
    width = min(SHINGLE, len(words))
    shingles = frozenset(shingles_of(words, width))
    largest = (1 << len(shingles).bit_length()) - 1  # partitions: 1, 2-3, 4-7, 8-15, ...
    depth = min(len(shingles), largest - needed(largest, threshold) + 1)
    return width, shingles, np.sort(hashes_of(list(shingles)))[:depth]


def hashes_of(shingles: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(0)), np.uint64, len(shingles))


class ItemIndex:
    """A bounded set of items: MinHash sketches by size partition, and the shingles to verify with."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD):
        self.threshold, self.items, sketches = threshold, [], []
        for item_id, text in items:
            if words := words_of(text):
                width, shingles, hashes = sketch_of(words, threshold)
                sketches.append((width, hashes, len(self.items)))
                self.items.append((item_id, width, shingles))
        self.widths = sorted({w for w, _, _ in sketches})
        self.sketch = {}
        for width in self.widths:
            pairs = sorted((int(h), k) for w, hs, k in sketches if w == width for h in hs)
            self.sketch[width] = (np.array([h for h, _ in pairs], np.uint64), np.array([k for _, k in pairs]))

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, shared shingles, shingles of the item) for each item that the text contains."""
        words, found = words_of(text), []
        for width in self.widths:
            if len(words) < width:
                continue
            own = shingles_of(words, width)
            keys, items = self.sketch[width]
            hashes = hashes_of(own)
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hits = np.unique(hashes[keys[at] == hashes])
            if not len(hits):
                continue
            first, last = np.searchsorted(keys, hits, "left"), np.searchsorted(keys, hits, "right")
            candidates = {int(k) for a, b in zip(first, last, strict=True) for k in items[a:b]}
            own = frozenset(own)
            for k in sorted(candidates):
                item_id, _, shingles = self.items[k]
                shared = len(shingles & own)
                if shared >= needed(len(shingles), self.threshold):
                    found.append((item_id, shared, len(shingles)))
        return found


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long"), F.col("text").alias("item")).where("item is not null").distinct()


def _small_index(benchmark: DataFrame, threshold: float, most: int) -> ItemIndex | None:
    """The whole benchmark as one index, if its shingles, counted first, are most at most."""
    items = _items(benchmark)
    if (items.agg(F.sum(F.length("item")) / 4).first()[0] or 0) > most:
        return None
    return ItemIndex(sorted(((r["item_id"], r["item"]) for r in items.collect()), key=lambda x: (x[0] is not None, *x)), threshold)


def _probes(hashes: np.ndarray) -> np.ndarray:
    """(PROBES, n) places in the filter."""
    return np.stack([(hashes >> np.uint64(9 * k)) * np.uint64(2 * k + 1) & np.uint64(FILTER_BITS - 1) for k in range(PROBES)]).astype(np.int64)


def _bit_filter(sketches: DataFrame) -> bytes:
    """The filter of sketches(hash): tasks set bits in pieces, equal pieces are joined one at a time, FILTER_BITS / 8 bytes arrive."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            at = _probes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).ravel()
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        for k, piece in enumerate(np.split(bits, max(1, len(bits) // PIECE))):
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([piece.tobytes()])], ["piece", "bits"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                new = np.frombuffer(piece.as_py(), np.uint8)
                held[k] = held[k] | new if k in held else new
        for k, piece in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([piece.tobytes()])], ["piece", "bits"])

    out = bytearray(FILTER_BITS // 8)
    for k, piece in sketches.select("hash").mapInArrow(partial, "piece long, bits binary").repartition("piece").mapInArrow(joined, "piece long, bits binary").toLocalIterator():
        out[k * PIECE : k * PIECE + len(piece)] = piece
    return bytes(out)


def _by_joins(docs: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """docs(doc_id, text) -> as contaminated, and doc_key, for a benchmark of any size."""
    items = _items(benchmark).withColumn("item_key", F.xxhash64("item_id", "item"))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if words := words_of(text):
                    width, _, hashes = sketch_of(words, threshold)
                    rows += [(h, width, key) for h in hashes.view(np.int64).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], ["hash", "width", "item_key"])

    sketches = materialize(items.select("item_key", "item").mapInArrow(sketched, "hash long, width int, item_key long"), "sketches")
    shared = docs.sparkSession.sparkContext.broadcast(_bit_filter(sketches))
    widths = sorted(r["width"] for r in sketches.select("width").distinct().collect())

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                for width in widths:
                    hashes = np.unique(hashes_of(shingles_of(words, width)))
                    at = _probes(hashes)
                    hashes = hashes[(bits[at >> 3] >> (at & 7) & 1).all(axis=0)]
                    if len(hashes):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), key)), pa.array(hashes.view(np.int64)), pa.array(np.full(len(hashes), width, np.int32))], ["doc_key", "hash", "width"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, doc_id, text, item_id, item in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                width, shingles, _ = sketch_of(words_of(item), threshold)
                n = len(shingles & frozenset(shingles_of(words_of(text), width)))
                if n >= needed(len(shingles), threshold):
                    rows.append((doc_id, item_id, n, len(shingles), key))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], [*names, "doc_key"])

    names = ["doc_id", "item_id", "n_shared", "n_item"]
    keyed = docs.withColumn("doc_key", F.xxhash64("doc_id", "text"))
    found = keyed.select("doc_key", "text").mapInArrow(passed, "doc_key long, hash long, width int")
    pairs = materialize(found.join(sketches, ["hash", "width"]).select("doc_key", "item_key").distinct(), "pairs")
    both = keyed.join(pairs, "doc_key").join(items, "item_key").select("doc_key", "doc_id", "text", "item_id", "item")
    return both.mapInArrow(verified, "doc_id long, item_id long, n_shared long, n_item long, doc_key long")


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """docs(doc_id, text), benchmark(item_id, text) -> (doc_id, item_id, n_shared, n_item), a row for each containment."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    index = _small_index(benchmark, threshold, block_shingles)
    if index is None:
        return _by_joins(docs, benchmark, threshold).drop("doc_key")
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(d, *x) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for x in shared.value.search(t.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(4)], ["doc_id", "item_id", "n_shared", "n_item"])

    return docs.mapInArrow(run, "doc_id long, item_id long, n_shared long, n_item long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """docs without the rows that contain an item; a small benchmark filters them in place, without a shuffle."""
    index = _small_index(benchmark, threshold, block_shingles)
    if index is None:
        (key,) = fresh(docs, "doc_key")
        gone = _by_joins(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, threshold).select(F.col("doc_key").alias(key)).distinct()
        return docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text")).join(gone, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    shared, at = docs.sparkSession.sparkContext.broadcast(index), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not shared.value.search(t.as_py()) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_WORDS = "string_split(trim(regexp_replace(translate({0}, '" + UPPER + "', '" + LOWER + "'), '[\\x09-\\x0D\\x20-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]+', ' ', 'g'), ' '), ' ')"
#: The same in DuckDB, by counting shared shingles of each width that items have.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS place, doc_id, {_WORDS.format("text")} AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, w, least({SHINGLE}, len(w)) AS k FROM (SELECT DISTINCT item_id, text, {_WORDS.format("text")} AS w FROM benchmark) WHERE w <> ['']),
ds AS (SELECT DISTINCT place, doc_id, k, array_to_string(w[pos:pos + k - 1], ' ') AS shingle FROM (SELECT place, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM d CROSS JOIN (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
bs AS (SELECT DISTINCT item, item_id, k, array_to_string(w[pos:pos + k - 1], ' ') AS shingle FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS pos FROM b)),
n AS (SELECT item, count(*) AS n_item FROM bs GROUP BY item)
SELECT doc_id, item_id, count(*) AS n_shared, n_item FROM ds JOIN bs USING (k, shingle) JOIN n USING (item)
GROUP BY place, doc_id, item, item_id, n_item HAVING count(*) >= ceil(round({THRESHOLD}::DOUBLE * n_item, 9))
"""

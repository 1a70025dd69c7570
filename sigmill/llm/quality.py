"""Quality classifier: a byte-level convolutional network, trained on labelled rows, over whole texts.

Only labelled rows outside the held-out fold (crc32 of the doc_id's digits mod 5 = 0) are learned from: those with the
smallest hash of doc_id, `TRAIN_ROWS` at most, less those whose whole texts no longer fit in `TRAIN_BYTES`. Every
byte of a kept row's text is trained on, and every byte of every text is scored; scoring uses nothing else. Null and
empty texts get the score of an empty text. Without labelled rows every score is 0.5. Of rows with one doc_id the
smallest text is learned from; a doc_id with both labels counts for both. Repeated rows are scored each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import slices, trimmed
from .byteconv import ByteConvNet

TRAIN_ROWS = 2_400
TRAIN_BYTES = 16_000_000
CHUNK, STRIDE = 512, 448
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(doc_id, quality, text as bytes) of the rows to learn from: the first by hash, less those that do not fit in most_bytes.

    A text that does not fit beside those before it is left out, and the next is tried; `rows` lengths come to the driver.
    """
    some = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))).distinct()
    some = some.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id", "quality").limit(rows)
    texts = docs.select(F.col("doc_id").alias("_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    found = texts.join(F.broadcast(some), F.col("_id") == F.col("doc_id")).groupBy("place", "doc_id", "quality").agg(F.min("text").alias("text"))
    kept, left = [], most_bytes
    for r in found.select("place", "doc_id", "quality", F.octet_length("text").alias("n")).orderBy("place", "doc_id", "quality").collect():
        if r["n"] <= left:
            kept.append((r["doc_id"], r["quality"]))
            left -= r["n"]
    kept = docs.sparkSession.createDataFrame(kept, T.StructType([found.schema["doc_id"], found.schema["quality"]]))
    return found.join(F.broadcast(kept), ["doc_id", "quality"]).select("doc_id", "quality", "text")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> ByteConvNet:
    """At most most_bytes bytes of text come to the driver."""
    got = training_rows(docs, labels, rows, most_bytes).collect()
    got.sort(key=lambda r: (r["doc_id"], r["quality"]))
    return ByteConvNet(CHUNK, STRIDE).fit([bytes(r["text"]) for r in got], np.array([r["quality"] for r in got]))


def _scores(net: ByteConvNet, texts: pa.Array) -> np.ndarray:
    raw = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts]
    return np.concatenate([np.zeros(0), *(net.probability(raw[a:b]) for a, b in slices([len(x) for x in raw], 500_000))])


def score(docs: DataFrame, net: ByteConvNet, threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, held_out, score, predicted)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _scores(shared.value, batch.column(1))
            fold = [None if d is None else zlib.crc32(str(d).encode()) % 5 == 0 for d in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fold, pa.bool_()), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, net: ByteConvNet, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose score is below the threshold."""
    shared, at = docs.sparkSession.sparkContext.broadcast(net), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column(at)) >= threshold))

    return docs.mapInArrow(trimmed(run), docs.schema)

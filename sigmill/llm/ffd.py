"""Packing by first-fit decreasing with a tournament tree, in randomised groups of documents.

1. Executors tokenize whole texts; the ids are written once, with a row number that no two rows share.
2. The row number's hash deals the rows to groups of about `GROUP_TOKENS` ids. Every group is packed by itself, so what
   a task holds is bounded by a group (or by one document, where that is larger), however hot a key is.
3. Within a group documents are cut every `capacity` ids; whole pieces are sequences of their own. The rests go, the
   longest first, to the first sequence that has room: the root-to-leaf path of a tree whose nodes hold the most room
   below them.
4. What room is left is filled by cutting: the emptiest sequences, as many as the group has beyond its ids / capacity,
   give their documents in order to all others, and the ids that remain make sequences of powers of two, the largest
   first. Sequences are padded to the capacity unless their length is a power of two, so no padding is left at all.

Nulls and empty texts are documents of the end id alone. Repeated rows are packed as often as they occur. A null doc_id
stays null. An empty table gives an empty result. The grouping depends on how the table is split into tasks; whatever it
is, every id lies in exactly one piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize
from .tokens import Encoder

CAPACITY = 2048
END_ID = 1
#: Ids in a group, about: 8 MB at two bytes.
GROUP_TOKENS = 4_000_000
CACHE_WORDS = 600_000
#: Rows that a task encodes before it hands them on.
ROWS = 256

Piece = tuple[int, int, int]  # document, start, length


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Tournament:
    """Room of bins, leftmost first: each node of a binary tree knows the largest room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """The first bin with room for size, which it takes from it."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        out = at - self.leaves
        room[at] -= size
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
        return out


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """The items of each sequence; items of one size in order."""
    tree, bins = Tournament(len(sizes), capacity), []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        at = tree.first_fit(sizes[k])
        if at == len(bins):
            bins.append([])
        bins[at].append(k)
    return bins


def pack_group(lengths: list[int], capacity: int = CAPACITY) -> list[list[Piece]]:
    """Sequences of pieces that hold every id of documents of these lengths (1 at least) once, without padding."""
    whole = [[(k, a, capacity)] for k, n in enumerate(lengths) for a in range(0, n - capacity + 1, capacity)]
    rests = [(k, n - n % capacity, n % capacity) for k, n in enumerate(lengths) if n % capacity]
    bins = [[rests[j] for j in b] for b in first_fit_decreasing([r[2] for r in rests], capacity)]
    used = [sum(p[2] for p in b) for b in bins]
    keep = sum(used) // capacity
    order = sorted(range(len(bins)), key=lambda j: (-used[j], j))
    ids = [list(p) for j in order[keep:] for p in bins[j]][::-1]  # the next to give stands last

    def take(n: int) -> list[Piece]:
        out = []
        while n:
            doc, start, length = ids[-1]
            part = min(n, length)
            out.append((doc, start, part))
            n -= part
            if part == length:
                ids.pop()
            else:
                ids[-1][1:] = start + part, length - part
        return out

    filled = [bins[j] + take(capacity - used[j]) for j in order[:keep]]
    left = sum(p[2] for p in ids)
    tails = [take(1 << b) for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    return whole + filled + tails


def encoded(docs: DataFrame, tokenizer: str, end_id: int, cache_words: int) -> DataFrame:
    """docs(doc_id, text) -> (row, doc_id, n_tokens, ids), ids in as few bytes as the vocabulary needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, cache_words)
        width = "<u2" if max(encoder.library.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else "<u4"
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = list(encoder.documents((x.as_py() for x in batch.column(1)), end_id))
                rows, row = np.arange(row, row + len(ids)), row + len(ids)
                sizes, raw = pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype(width).tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(rows), batch.column(0), sizes, raw], ["row", "doc_id", "n_tokens", "ids"])
        encoder.release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "row long, doc_id long, n_tokens long, ids binary")


def _packed(group: int, docs: list[int | None], raw: list[bytes], lengths: list[int], capacity: int) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for number, pieces in enumerate(pack_group(lengths, capacity)):
        offset = 0
        for k, start, n in pieces:
            width = len(raw[k]) // lengths[k]
            ids = np.frombuffer(raw[k], f"<u{width}", n, start * width).astype("<u4")
            rows.append((docs[k], start, n, zlib.crc32(ids), lengths[k], (group << 32) + number, offset))
            offset += n
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for k in range(0, len(rows), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k : k + 10_000], strict=True)], names)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS, cache_words: int = CACHE_WORDS) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row for each piece."""
    ids = materialize(encoded(docs, tokenizer or default_tokenizer(), end_id, cache_words), "ids")
    groups = max(1, -(-(ids.agg(F.sum("n_tokens")).first()[0] or 0) // group_tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, docs, raw, lengths = None, [], [], []
        for batch in batches:
            for g, doc_id, n, x in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if g != group and docs:
                    yield from _packed(group, docs, raw, lengths, capacity)
                    docs, raw, lengths = [], [], []
                group = g
                docs.append(doc_id)
                raw.append(x)
                lengths.append(n)
        if docs:
            yield from _packed(group, docs, raw, lengths, capacity)

    dealt = ids.select(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"), "doc_id", "n_tokens", "ids", "row")
    dealt = dealt.repartition("group").sortWithinPartitions("group", "row").drop("row")
    return dealt.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

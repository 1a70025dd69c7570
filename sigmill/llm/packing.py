"""Best-fit packing of token sequences by bin completion.

Executors tokenize and cut the documents. Only the histogram of piece lengths (at most `capacity` counts, however many
documents) reaches the driver, where branch and bound finds filling patterns. Executors then rank the pieces within
each length and look up the place that the patterns give to a rank. A hot length is ranked in parts.

Nulls and empty texts are documents of the end id alone. Repeated rows are packed as often as they occur; ties in rank
are broken by (doc_id, piece, start, crc). An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize, trimmed
from .tokens import Encoder, default_tokenizer

CAPACITY = 1024
#: Words in a generation of the tokenizer's cache.
CACHE_WORDS = 600_000
#: Steps after which branch and bound keeps the best packing found (None: never); whatever it is, every packing is whole.
NODES = 6_000
#: Rows of one length that are ranked together, about.
RANK_ROWS = 100_000

Pattern = tuple[tuple[int, int], ...]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: no packing has fewer sequences."""
    sizes = sorted(counts)
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for k in [0, *(s for s in sizes if 2 * s <= capacity)]:
        large = sum(n for s, n in counts.items() if s > capacity - k)
        middle = [(s, n) for s, n in counts.items() if capacity - k >= s and 2 * s > capacity]
        small = sum(s * n for s, n in counts.items() if k <= s and 2 * s <= capacity)
        m = sum(n for _, n in middle)
        room = m * capacity - sum(s * n for s, n in middle)
        best = max(best, large + m + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on the histogram: the first incumbent."""
    open_: Counter[tuple[int, Pattern]] = Counter()
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room, held = min(((r, p) for r, p in open_ if r >= size), default=(capacity, ()))
            bins = open_[room, held] if held else left
            fit = room // size
            full = min(bins, left // fit)
            put, n = (fit, full) if full else (left, 1)
            if held:
                open_[room, held] -= n
                if not open_[room, held]:
                    del open_[room, held]
            open_[room - put * size, (*held, (size, put))] += n
            left -= put * n
    return [(p, n) for (_, p), n in open_.items()]


def fillings(counts: dict[int, int], room: int, least: int, most: int) -> Iterator[tuple[int, Pattern]]:
    """(waste, filling) of the undominated fillings of `room` that waste `least` to `most`, those of large items first.

    Dominated: another item still fits, or one item can be exchanged for a larger one that fits.
    """
    most = min(most, room)
    if least > most:
        return
    sizes = sorted((s for s, n in counts.items() if n and s <= room), reverse=True)
    mask = (1 << room + 1) - 1
    reach = [1] * (len(sizes) + 1)  # bit t of reach[k]: sizes[k:] can add up to t
    for k in range(len(sizes) - 1, -1, -1):
        s, n, r, step = sizes[k], min(counts[sizes[k]], room // sizes[k]), reach[k + 1], 1
        while n:
            step = min(step, n)
            r |= r << s * step & mask
            n, step = n - step, step * 2
        reach[k] = r

    def possible(k: int, left: int) -> bool:
        """Whether sizes[k:] can bring what is left of the room down to least..most."""
        low = max(0, left - most)
        return left >= least and bool(reach[k] >> low & (1 << left - least - low + 1) - 1)

    def of(left: int, k: int) -> Iterator[tuple[int, Pattern]]:
        if k == len(sizes) or left < sizes[-1]:
            if least <= left <= most:
                yield left, ()
            return
        s = sizes[k]
        for m in range(min(counts[s], left // s), -1, -1):
            if possible(k + 1, left - m * s):
                for slack, rest in of(left - m * s, k + 1):
                    yield slack, (((s, m), *rest) if m else rest)

    for slack, filling in of(room, 0) if possible(0, room) else ():
        used = dict(filling)
        spare = [s for s in sizes if counts[s] > used.get(s, 0)] if slack else []
        if not any(t <= slack or any(s < t <= s + slack for s in used) for t in spare):
            yield slack, filling


class Search:
    """Depth first over counts: each step fills around the largest item left and takes as many sequences alike as there are.

    A sequence that wastes `slack` at most counts as full, and of such ones those of few large items come first; the
    rest follow by waste. Departing from the first choice of a step costs one of a path's `departures`. With as many
    departures as steps the search is complete: every number of copies down to one is tried.
    """

    def __init__(self, counts: dict[int, int], capacity: int, nodes: int | None):
        self.counts, self.capacity, self.nodes = counts, capacity, nodes
        self.total, self.bound = sum(s * n for s, n in counts.items()), lower_bound(counts, capacity)
        self.best = best_fit(counts, capacity)
        self.fewest = sum(n for _, n in self.best)

    @property
    def allowed(self) -> int:
        """What a packing that beats the best may waste in all."""
        return (self.fewest - 1) * self.capacity - self.total

    @property
    def over(self) -> bool:
        return self.fewest <= self.bound or self.nodes is not None and self.nodes <= 0

    def _branches(self, left: dict[int, int], wasted: int, slack: int) -> Iterator[tuple[Pattern, int, int]]:
        size = max(left)
        own = left | {size: left[size] - 1}
        low, high, room = 0, slack, self.capacity - size
        while low <= min(room, self.allowed - wasted):
            for waste, filling in fillings(own, room, low, min(high, self.allowed - wasted)):
                pattern = tuple((Counter(dict(filling)) + Counter({size: 1})).items())
                for copies in range(min(left[s] // m for s, m in pattern), 0, -1):
                    yield pattern, copies, waste * copies
            low, high = high + 1, 2 * high + 1

    def run(self, slack: int, departures: int) -> bool:
        """Search all paths of so many departures; True if none was left out for want of departures or nodes."""
        whole, chosen = True, []
        stack: list = [(dict(self.counts), 0, 0, departures, self._branches(self.counts, 0, slack), True)] if self.counts else []
        while stack:
            if self.over:
                return False
            left, wasted, bins, spare, todo, first = stack[-1]
            step = next(todo, None)
            if step is not None and not first and not spare:
                whole, step = False, None
            if step is None:
                stack.pop()
                chosen = chosen[: max(0, len(stack) - 1)]
                continue
            stack[-1] = (left, wasted, bins, spare, todo, False)
            if self.nodes is not None:
                self.nodes -= 1
            pattern, copies, more = step
            if wasted + more > self.allowed:
                continue
            rest = dict(left)
            for s, m in pattern:
                rest[s] -= m * copies
                if not rest[s]:
                    del rest[s]
            chosen = [*chosen[: len(stack) - 1], (pattern, copies)]
            if rest:
                stack.append((rest, wasted + more, bins + copies, spare - (not first), self._branches(rest, wasted + more, slack), True))
            elif bins + copies < self.fewest:
                self.fewest, self.best = bins + copies, chosen
        return whole


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int | None = NODES) -> list[tuple[Pattern, int]]:
    """Patterns ((size, times), ...) and how many sequences have each; they hold all items of counts {size: n}.

    Best fit gives the first incumbent. Branch and bound dives once for each slack up to a 64th of the capacity, then
    searches with 1, 2, 4, ... departures from the first choices. It ends with the lower bound met, with nothing left to
    search (both: no packing has fewer sequences), or after `nodes` steps; nodes=None sets no limit: the exact way.
    """
    search = Search({s: n for s, n in counts.items() if n}, capacity, nodes)
    found = {}
    for slack in range(capacity // 64 + 1):
        if search.over:
            break
        before = search.fewest
        search.run(slack, 0)
        found[slack] = search.fewest < before
    best, departures = max((k for k, better in found.items() if better), default=0), 1
    while not search.over and not search.run(best, departures):
        departures *= 2
    return search.best


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, cache_words: int = CACHE_WORDS) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, piece, start, length, ids_crc32); whole documents where they fit."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, cache_words)
        for batch in batches:
            rows: list[tuple] = []
            ids_of = encoder.documents(x.as_py() for x in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), ids_of, strict=True):
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        encoder.release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


def places(packing: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For ranks within a length: where each run of ranks begins, how many share a sequence, and where they lie."""
    rows, rank, sequence = [], Counter(), 0
    for pattern, copies in packing:
        at = 0
        for size, times in pattern:
            rows.append((size, rank[size], times, sequence, at))
            rank[size] += times * copies
            at += size * times
        sequence += copies
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "times", "sequence", "offset"), table.T, strict=True))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, cache_words: int = CACHE_WORDS, nodes: int | None = NODES) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece."""
    cut = materialize(pieces(docs, tokenizer, capacity, cache_words), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(bin_completion(counts, capacity, nodes))
    parts = 32 + max(counts.values(), default=0) // RANK_ROWS

    cut = cut.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = cut.groupBy("length", "_part").agg(F.count("*").alias("_n")).select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("_rank", F.row_number().over(own)).join(base, ["length", "_part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_base") + F.col("_rank") - 1).alias("_rank"))
    keys = (table["length"] << 44) + table["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            row = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            copy, slot = np.divmod(rank - table["rank"][row], table["times"][row])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(table["sequence"][row] + copy), pa.array(table["offset"][row] + slot * length)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

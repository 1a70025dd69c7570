"""Links between texts by the exact Jaccard similarity of their shingle sets, within candidate groups.

A set is a sorted array of distinct 64-bit hashes. Within a task the search starts at any set and goes on from each set
it reaches, always to those not reached yet whose size allows the similarity; every pair that could link two parts of
what is there is compared, and only a spanning forest leaves the task.

Groups of more than `MAX_SETS` sets or `MAX_HASHES` hashes are cut into parts. First each part is searched together with
the group's hubs, the few sets of each part whose fingerprints are nearest to the part's majority: in a group of copies
these are what the copies were made from, and connect nearly all of it. Then only pairs of different components are
left; every one of them has a set outside the largest component, and those minor sets meet all parts, in parts of their
own. So a group of copies is moved about twice, and no pair is missed in any group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import forget, materialize, trimmed
from .components import connected_components

MAX_SETS = 2048
MAX_HASHES = 250_000
#: Sets of each part of a cut group that meet all its parts.
HUBS = 4
#: Rows that are Python objects at a time.
ROWS = 256
#: Numerator and denominator of the least similarity that links.
SIMILARITY = (4, 5)


def linked(sets: list[np.ndarray], similarity: tuple[int, int] = SIMILARITY) -> np.ndarray:
    """For each set the index of one set of its component under similarity; empty sets stand alone."""
    p, q = similarity
    label, sizes = np.arange(len(sets)), np.array([len(s) for s in sets], np.int64)
    rows = np.argsort(sizes, kind="stable")
    rows = rows[sizes[rows] > 0]
    if len(rows) < 2:
        return label
    words, tokens = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
    n, mark = sizes[rows], np.zeros(len(words), np.uint8)
    start = np.r_[0, np.cumsum(n)]
    own = [tokens[a:b] for a, b in zip(start, start[1:], strict=False)]
    place, waiting = np.arange(len(rows)), np.ones(len(rows), bool)  # place: rows in `tokens`; waiting: not reached
    for first in range(len(rows)):
        if not waiting[first]:
            continue
        waiting[first], todo = False, [first]
        while todo:
            u = todo.pop()
            a, b = np.searchsorted(n[place], [-(-n[u] * p // q), n[u] * q // p + 1])
            if waiting[place[a:b]].any():
                mark[own[u]] = 1
                common = np.add.reduceat(mark[tokens[start[a] : start[b]]], start[a:b] - start[a], dtype=np.int64)
                mark[own[u]] = 0
                found = place[a:b][(q * common >= p * (n[u] + n[place[a:b]] - common)) & waiting[place[a:b]]]
                waiting[found], label[rows[found]] = False, rows[first]
                todo += found.tolist()
            if 2 * np.count_nonzero(left := waiting[place]) < len(place):
                place = place[left]
                tokens = np.concatenate([own[x] for x in place]) if len(place) else tokens[:0]
                start = np.r_[0, np.cumsum(n[place])]
    return label


def _edges(nodes: list[int], sets: list[bytes]) -> pa.RecordBatch:
    node = np.array(nodes, np.int64)
    root = linked([np.frombuffer(s, "<u8") for s in sets])
    least = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(least, root, node)
    keep = least[root] != node
    return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(least[root][keep])], ["a", "b"])


def parts(members: DataFrame) -> DataFrame:
    """members(grp, n_hashes) -> (grp, parts)."""
    pieces = F.greatest(F.ceil(F.count("*") / MAX_SETS), F.ceil(F.sum("n_hashes") / MAX_HASHES), F.lit(1))
    return members.groupBy("grp").agg(pieces.alias("parts"))


def hubs(members: DataFrame, words: int) -> DataFrame:
    """members(grp, part, node, f0, ...) -> (grp, node): of each part the `HUBS` nodes nearest to its majority fingerprint."""
    names = [f"f{j}" for j in range(words)]

    def nearest(rows: list[np.ndarray]) -> pa.RecordBatch:
        f = np.stack([c.view(np.uint64) for c in rows[3:]], axis=1)
        bits = np.unpackbits(np.ascontiguousarray(f).view(np.uint8), axis=1)
        far = np.abs(bits - (2 * bits.sum(axis=0, dtype=np.int64) > len(bits))).sum(axis=1)
        best = np.lexsort((rows[2], far))[:HUBS]
        return pa.RecordBatch.from_arrays([pa.array(rows[0][best]), pa.array(rows[2][best])], ["grp", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new, strict=True)]
            cuts = np.flatnonzero((kept[0][1:] != kept[0][:-1]) | (kept[1][1:] != kept[1][:-1])) + 1
            for a, b in zip(np.r_[0, cuts[:-1]], cuts, strict=True) if len(cuts) else ():
                yield nearest([c[a:b] for c in kept])
            if len(cuts):
                kept = [c[cuts[-1] :] for c in kept]
        if kept is not None and len(kept[0]):
            yield nearest(kept)

    rows = members.select("grp", "part", "node", *names)
    return rows.repartition("grp", "part").sortWithinPartitions("grp", "part").mapInArrow(run, "grp long, node long")


def links(sets: DataFrame) -> DataFrame:
    """sets(grp, lo, hi, node, hashes) -> edges (a, b) that connect all pairs of equal (grp, lo, hi) at the similarity or above."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []
        for rows in (batch.slice(k, ROWS) for batch in batches for k in range(0, batch.num_rows, ROWS)):
            for *at, node, hashes in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if at != key:
                    if len(nodes) > 1:
                        yield _edges(nodes, sets)
                    key, nodes, sets = at, [], []
                nodes.append(node)
                sets.append(hashes)
        if len(nodes) > 1:
            yield _edges(nodes, sets)

    keys = ["grp", "lo", "hi"]
    return sets.select(*keys, "node", "hashes").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(trimmed(compared), "a long, b long")


def components(members: DataFrame, words: int, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """members(grp, node, n_hashes, f0, ...) -> (node, root) under the similarity within groups.

    sets_of: rows (node, keys) -> (keys, node, hashes), keys as an array of places (grp, lo, hi) where the set is needed.
    """
    place = lambda lo, hi: F.struct("grp", lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)

    def linked_at(rows: DataFrame) -> DataFrame:
        sets = sets_of(rows).select(F.explode("keys").alias("k"), "node", "hashes")
        return links(sets.select("k.*", "node", "hashes"))

    cut = members.join(parts(members), "grp").withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    cut = materialize(cut, "jaccard-parts")
    shared = hubs(cut.where("parts > 1"), words).select(F.col("node").alias("hub")).distinct()
    both = cut.join(shared, cut["node"] == shared["hub"], "left")
    keys = F.when(F.col("hub").isNull(), F.array(place(F.col("part"), F.lit(0)))).otherwise(F.transform(numbers(F.col("parts")), lambda p: place(p, F.lit(0))))
    edges = materialize(linked_at(both.select("node", keys.alias("keys"))), "jaccard-edges")
    found = connected_components(edges)
    roots = found.select(F.col("node").alias("_n"), "root")
    big = cut.where("parts > 1").join(roots, F.col("node") == F.col("_n"), "left").withColumn("comp", F.coalesce("root", "node"))
    counts = big.groupBy("grp", "comp").agg(F.count("*").alias("n"), F.sum("n_hashes").alias("h"))
    major = counts.groupBy("grp").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.sum("n").alias("all_n"), F.sum("h").alias("all_h"), F.max(F.struct("n", "comp", "h")).alias("top"))
    left_n, left_h = F.col("all_n") - F.col("top.n"), F.col("all_h") - F.col("top.h")
    rest = major.where(left_n > 0).select("grp", "major", F.greatest(F.ceil(left_n / MAX_SETS), F.ceil(left_h / MAX_HASHES), F.lit(1)).alias("minors"))
    open_ = materialize(big.join(rest, "grp").select("grp", "node", "parts", "part", "minors", (F.col("comp") != F.col("major")).alias("minor")), "jaccard-open")
    if not open_.isEmpty():
        own = F.transform(numbers(F.col("minors")), lambda j: place(F.col("part"), j))
        met = F.transform(numbers(F.col("parts")), lambda p: place(p, F.pmod(F.xxhash64("node", F.lit(1)), "minors")))
        keys = F.when(F.col("minor"), F.array_union(own, met)).otherwise(own)
        more = materialize(linked_at(open_.select("node", keys.alias("keys"))), "jaccard-edges")
        forget(found)
        found = connected_components(edges.unionByName(more))
        forget(more)
    forget(edges, open_, cut)
    return found

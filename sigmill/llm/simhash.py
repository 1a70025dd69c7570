"""SimHash near-duplicate groups with bit-sliced Hamming comparison.

1. Executors fingerprint whole texts: each shingle's XXH64 votes on every bit.
2. Equal fingerprints collapse to one node (partial aggregation), with a number of its own and its smallest doc_id.
3. A 64-bit fingerprint is cut into six blocks, and a node enters a bucket for each three of them (20 buckets, keys of
   31 to 33 bits). Three differing bits leave three blocks whole, so two fingerprints within that radius share a
   bucket: the search is exact, and buckets of unrelated ones stay small up to billions of nodes. Wider fingerprints
   take 64 blocks of 16 bits and a larger radius; recall is then a probability, stated at `WIDE`.
4. Within a bucket, bit planes stand vertically (64 rows a word). One pass for each row distance d updates all
   distances row(i) - row(i+d) with carry-save counters and abandons words whose 64 lanes all exceed the radius.
   Rows that are connected already are switched off, and only a spanning forest leaves the task.
5. Buckets of more than `MAX_BUCKET` nodes are cut into parts; every pair of parts is a group of its own, so no task
   gathers a hot bucket and no pair is missed.
6. The forests are merged by `connected_components`.

`drop_near_duplicates` takes the groups of this search as candidates and keeps what `jaccard` verifies. Texts stay where
they are while the ids that select among them are few enough to broadcast; else ids and texts meet by a join.

Nulls: a null text counts as empty; a text without words has fingerprint zero and is linked like any other. Rows with
a null doc_id keep their row, linked through their fingerprint; a component without any doc_id is null.
Repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard
from ._shared import LOWER, UPPER, forget, materialize, slices, small, trimmed
from .components import connected_components

MAX_BUCKET = 4096
BROADCAST_ROWS = 20_000
CHUNK_ROWS = 16_384
#: Bytes of text that are Python objects, with their shingles, at a time.
TEXT_CHARS = 500_000
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
LANES = np.uint64(0x0101010101010101)
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Plan:
    """shingle: words; words: 64-bit words of a fingerprint; radius: differing bits that still link."""

    shingle: int
    words: int
    radius: int
    #: Each shingle of a text votes once, however often it occurs.
    distinct: bool = False


#: Three-word shingles and three bits: exact.
NARROW = Plan(3, 1, 3)
#: Five-word shingles, 512 bits, 64 blocks. Two texts of Jaccard similarity 0.8 differ in 78 bits on average (standard
#: deviation 8) and share a block with probability 0.99 (0.9: over 0.9999). Unrelated texts differ in about 256.
WIDE = Plan(5, 8, 92)
#: Candidates for exact verification at similarity 0.8: as WIDE, over shingle sets, with a radius four standard deviations
#: above the mean there.
CANDIDATES = Plan(5, 8, 110, distinct=True)


def shingles(text: str | None, k: int) -> list[bytes]:
    """Lower-cased (A-Z) words, k at a time, repeats included; fewer words: the whole sequence; none: nothing."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(TO_LOWER).split()
    if len(words) < k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def _mixed(h: np.ndarray, j: int) -> np.ndarray:
    """The j-th derived 64-bit hash of each shingle; j = 0 is XXH64 itself."""
    if not j:
        return h
    x = h + np.uint64((j * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, plan: Plan) -> np.ndarray:
    """XXH64 of a text's shingles; sorted and distinct where the plan says so."""
    s = shingles(text, plan.shingle)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, s, repeat(42)), np.uint64, len(s))
    return np.unique(hashes) if plan.distinct else hashes


def fingerprints(texts: list[str | None], plan: Plan) -> np.ndarray:
    """(len(texts), plan.words) uint64; a bit is set if it is set in over half of the text's shingle hashes."""
    return _votes([shingle_hashes(t, plan) for t in texts], plan)


def _votes(hashes: list[np.ndarray], plan: Plan) -> np.ndarray:
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros((len(hashes), plan.words), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    flat, n = np.concatenate(hashes), counts[some]
    blocks = (n + 254) // 255  # byte lanes count up to 255
    first = np.cumsum(blocks) - blocks
    starts = np.repeat(np.cumsum(n) - n, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    for j in range(plan.words):
        h = _mixed(flat, j)
        word = np.zeros(len(some), np.uint64)
        for b in range(8):
            lanes = np.add.reduceat((h >> np.uint64(b)) & LANES, starts).view(np.uint8).reshape(-1, 8)
            votes = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
            for lane in range(8):
                word |= (2 * votes[:, lane] > n).astype(np.uint64) << np.uint64(8 * lane + b)
        out[some, j] = word
    return out


def _text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts (column 1) hold about TEXT_CHARS bytes; one row at least."""
    for a, b in slices(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), TEXT_CHARS):
        yield batch.slice(a, b - a)


def with_fingerprints(docs: DataFrame, plan: Plan) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, f0, f1, ...), one row for each input row."""
    names = [f"f{j}" for j in range(plan.words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text_slices(batch):
                f = fingerprints(part.column(1).to_pylist(), plan).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(f[:, j]) for j in range(plan.words))], ["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{x} long" for x in names))


def block_keys(f: np.ndarray) -> np.ndarray:
    """(n, words) fingerprints -> (n, buckets) bucket numbers.

    One word: three of six blocks at a time. More: the 16-bit blocks, and as many strided ones.
    """
    n, words = f.shape
    if words == 1:
        starts = (0, 11, 22, 33, 44, 54, 64)
        block = [f[:, 0] >> np.uint64(a) & np.uint64((1 << b - a) - 1) for a, b in zip(starts, starts[1:], strict=False)]
        sets = list(combinations(range(6), 3))
        keys = [np.uint64(k << 33) | block[a] << np.uint64(22) | block[b] << np.uint64(11) | block[c] for k, (a, b, c) in enumerate(sets)]
        return np.stack(keys, axis=1).astype(np.int64)
    lanes = np.ascontiguousarray(f).view(np.uint16).reshape(n, -1).astype(np.int64)
    bits = np.unpackbits(np.ascontiguousarray(f).view(np.uint8).reshape(n, -1), axis=1, bitorder="little")
    strided = bits.reshape(n, 16, -1).transpose(0, 2, 1)  # bits i, i + 4 * words, ... make one block
    lanes = np.hstack([lanes, np.ascontiguousarray(np.packbits(strided, axis=2, bitorder="little")).view(np.uint16).reshape(n, -1).astype(np.int64)])
    return lanes + (np.arange(lanes.shape[1]) << 16)


def bit_planes(f: np.ndarray) -> np.ndarray:
    """(n, words) -> (64 * words, n / 64 + 1): plane b holds bit b of all rows, 64 rows a word; the last word is zero."""
    bits = np.unpackbits(np.ascontiguousarray(f).view(np.uint8).reshape(len(f), -1), axis=1, bitorder="little")
    return _packed(np.ascontiguousarray(bits.T))


def _packed(bits: np.ndarray) -> np.ndarray:
    wide = np.zeros((*bits.shape[:-1], (-(-bits.shape[-1] // 64) + 1) * 64), np.uint8)
    wide[..., : bits.shape[-1]] = bits
    return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)


def lanes_within(planes: np.ndarray, lanes: np.ndarray, d: int, radius: int) -> np.ndarray:
    """Rows i with lanes[i] whose distance to row i + d is radius at most.

    The counters start so that the first difference beyond the radius carries out of the top one.
    """
    idx = np.flatnonzero(active := _packed(lanes))
    top = planes.shape[1] - 1
    q, r = divmod(d, 64)
    over = ~active[idx]
    width = max(2, (radius + 1).bit_length() if (radius + 1) & radius else radius.bit_length())
    start = (1 << width) - 1 - radius
    count = [np.full(len(idx), FULL if start >> k & 1 else 0, np.uint64) for k in range(width)]

    def differing(b: int) -> np.ndarray:
        p = planes[b]
        other = p[np.minimum(idx + q, top)] >> np.uint64(r)
        if r:
            other |= p[np.minimum(idx + q + 1, top)] << np.uint64(64 - r)
        return p[idx] ^ other

    def add(a: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = a ^ x
        return u ^ y, (a & x) | (u & y)

    for b in range(0, len(planes), 4):
        if not len(idx):
            break
        count[0], t = add(count[0], differing(b), differing(b + 1))
        count[0], u = add(count[0], differing(b + 2), differing(b + 3))
        count[1], carry = add(count[1], t, u)
        for k in range(2, width):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        if b % 16 == 12:
            alive = over != FULL
            if 2 * np.count_nonzero(alive) < len(idx):
                idx, over, count = idx[alive], over[alive], [c[alive] for c in count]
    hit = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, lane = np.nonzero(hit)
    return idx[word] * 64 + lane


def forest(f: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """Rows sorted by group -> for each row the first row of its component under links within the same group."""
    n, parent = len(f), np.arange(len(f))
    planes = bit_planes(f)
    longest = int(np.diff(np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])).max(initial=1))
    for d in range(1, longest):
        rows = lanes_within(planes, (group[:-d] == group[d:]) & (parent[:-d] != parent[d:]), d, radius)
        if not len(rows):
            continue
        for i, j in zip(rows.tolist(), (rows + d).tolist(), strict=True):
            while parent[i] != i:
                i = parent[i]
            while parent[j] != j:
                j = parent[j]
            parent[max(i, j)] = min(i, j)
        while (up := parent[parent]).tolist() != parent.tolist():
            parent = up
    return parent


def _edges(columns: list[np.ndarray], radius: int) -> pa.RecordBatch:
    node, f = columns[3], np.stack([c.view(np.uint64) for c in columns[4:]], axis=1)
    change = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
    root = forest(f, np.r_[0, np.cumsum(change)], radius)
    least = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(least, root, node)
    to = least[root]
    keep = to != node
    return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(to[keep])], ["a", "b"])


def _links(nodes: DataFrame, plan: Plan) -> DataFrame:
    """nodes(node, f0, ...) -> edges (a, b) that connect all pairs within the radius that share a block."""
    names = [f"f{j}" for j in range(plan.words)]

    def bucketed(only: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for k in range(0, whole.num_rows, 2048):
                    batch = whole.slice(k, 2048)
                    f = np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in names], axis=1)
                    keys = block_keys(f.view(np.uint64))
                    bucket = pa.array(keys.ravel())
                    if only:
                        yield pa.RecordBatch.from_arrays([bucket], ["bucket"])
                    else:
                        back = pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1]))
                        yield pa.RecordBatch.from_arrays([bucket, *(batch.column(x).take(back) for x in ("node", *names))], ["bucket", "node", *names])

        return run

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new, strict=True)]
            if len(kept[0]) >= CHUNK_ROWS:
                change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in kept[:3]], axis=0))
                if len(change):
                    cut = change[-1] + 1
                    yield _edges([c[:cut] for c in kept], plan.radius)
                    kept = [c[cut:] for c in kept]
        if kept is not None and len(kept[0]):
            yield _edges(kept, plan.radius)

    hot = nodes.mapInArrow(bucketed(True), "bucket long").groupBy("bucket").count().where(F.col("count") > MAX_BUCKET)
    hot = materialize(hot.select(F.col("bucket").alias("hot"), F.ceil(F.col("count") / MAX_BUCKET).alias("parts")), "hot-buckets")
    n_hot = hot.count()
    rows = nodes.mapInArrow(bucketed(False), "bucket long, node long, " + ", ".join(f"{x} long" for x in names))
    if n_hot:
        rows = rows.join(F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot, F.col("bucket") == F.col("hot"), "left")
        part = F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1)))
        rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)))
        rows = rows.withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")})
    else:
        rows = rows.withColumns({"lo": F.lit(0).cast("long"), "hi": F.lit(0).cast("long")})
    keys = ["bucket", "lo", "hi"]
    # A fingerprint's rows, one a bucket, go to as many partitions at least: tasks stay small where the session's default
    # is low, and what is shuffled grows with the rows alone, not with how many of them share a compressed block.
    partitions = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), block_keys(np.zeros((1, plan.words), np.uint64)).shape[1])
    rows = rows.select(*keys, "node", *names).repartition(partitions, *keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(trimmed(compared), "a long, b long")


def near_duplicates(docs: DataFrame, plan: Plan = NARROW) -> DataFrame:
    """docs with doc_id and text -> (doc_id, f0, ..., component_id), one row for each row of docs."""
    names = [f"f{j}" for j in range(plan.words)]
    prints = materialize(with_fingerprints(docs, plan), "fingerprints")
    # A node has a number of its own, fixed once the table is written, as its documents may all be without an id.
    nodes = prints.groupBy(*names).agg(F.min("doc_id").alias("least")).withColumn("node", F.monotonically_increasing_id())
    nodes = materialize(nodes, "nodes")
    found = connected_components(_links(nodes.select("node", *names), plan))
    rooted = materialize(nodes.join(found.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select(*names, "least", "root"), "rooted")
    least = rooted.where("root is not null").groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("_least"))
    named = rooted.join(least, F.col("root") == F.col("_root"), "left").select(*names, F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("_least")).alias("component_id"))
    named = materialize(named, "components")
    forget(found, nodes, rooted)
    return prints.join(named, names, "left").select("doc_id", *names, "component_id")


def _set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes())


def with_set_prints(docs: DataFrame, plan: Plan) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, digest, n_hashes, f0, f1, ...): a digest of the shingle set beside its fingerprint."""
    names = [f"f{j}" for j in range(plan.words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text_slices(batch):
                hashes = [shingle_hashes(t, plan) for t in part.column(1).to_pylist()]
                f = _votes(hashes, plan).view(np.int64)
                head = [part.column(0), pa.array(list(map(_set_digest, hashes)), pa.binary()), pa.array(list(map(len, hashes)), pa.int64())]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array(f[:, j]) for j in range(plan.words))], ["doc_id", "digest", "n_hashes", *names])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), "doc_id long, digest binary, n_hashes long, " + ", ".join(f"{x} long" for x in names))


def _with_sets(members: DataFrame, plan: Plan) -> DataFrame:
    """members(keys, node, digest, text) -> (keys, node, hashes) of the texts that have the digest."""
    kind = members.schema["keys"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, jaccard.ROWS):
                part = batch.slice(a, jaccard.ROWS)
                hashes = [shingle_hashes(t, plan) for t in part.column(3).to_pylist()]
                keep = [k for k, (h, d) in enumerate(zip(hashes, part.column(2).to_pylist(), strict=True)) if _set_digest(h) == d]
                sets = pa.array([hashes[k].astype("<u8").tobytes() for k in keep], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(keep, pa.int64())) for c in range(2)), sets], ["keys", "node", "hashes"])

    return members.select("keys", "node", "digest", "text").mapInArrow(trimmed(run), f"keys {kind}, node long, hashes binary")


def verified_duplicates(docs: DataFrame, plan: Plan = CANDIDATES) -> DataFrame:
    """docs with doc_id and text -> (doc_id, component_id): groups chained by pairs of similarity 0.8 or more.

    Equal shingle sets are one node. The bit-sliced search only proposes groups; `jaccard` compares the shingle sets
    within each, so no pair below the similarity links, and a pair is missed only if its two texts share no group.
    Texts are fetched by doc_id, so a text that no row with an id has is nobody's copy here.
    """
    names = [f"f{j}" for j in range(plan.words)]
    prints = materialize(with_set_prints(docs, plan), "set-prints")
    nodes = prints.groupBy("digest", "n_hashes", *names).agg(F.min("doc_id").alias("node")).where("node is not null")
    nodes = materialize(nodes, "set-nodes")
    near = connected_components(_links(nodes.select("node", *names), plan))
    grouped = near.select(F.col("node").alias("_n"), F.col("root").alias("grp"))
    members = materialize(nodes.join(grouped, nodes["node"] == grouped["_n"]).select("grp", "node", "digest", "n_hashes", *names), "members")
    forget(near)
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")

    def sets_of(rows: DataFrame) -> DataFrame:
        wanted = rows.join(members.select(F.col("node").alias("_m"), "digest"), F.col("node") == F.col("_m")).select("node", "keys", "digest")
        wanted = materialize(wanted, "wanted")
        few = texts.join(small(wanted.select(F.col("node").alias("_w"))), F.col("_doc") == F.col("_w"), "left_semi")
        return _with_sets(few.join(wanted, F.col("_doc") == F.col("node")), plan)

    found = jaccard.components(members, plan.words, sets_of)
    roots = found.select(F.col("node").alias("_n"), "root")
    named = materialize(nodes.join(roots, nodes["node"] == roots["_n"], "left").select("digest", F.coalesce("root", "node").alias("component_id")), "components")
    forget(found, members, nodes)
    return prints.join(named, "digest", "left").select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame, plan: Plan = CANDIDATES) -> DataFrame:
    """docs without the rows whose group has a smaller doc_id. Equal doc_ids all stay; so do null ones."""
    gone = materialize(verified_duplicates(docs, plan).where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(small(gone), "doc_id", "left_anti")

"""Source divergence audit: how far the word use of each source of a language lies from the others' and the language's.

1. Tasks count terms within texts and hand on a row for each (language, source, term) and flush; the rows meet by language
   and term, so that a term's sources are summed, its documents counted and kept terms told apart in one shuffle.
2. Terms of a language with the same sparse vector of (source, count) share a column. Vectors are compared by 128 bits
   that add up over their entries, so no vector is gathered, however many sources use a term; its first term stands for it.
3. Sources are dealt to blocks of about `BLOCK` by hash. For each pair of blocks, tasks take the distinct vectors with an
   entry in either, evaluate every pair of their sources once for each vector, and multiply by the vector's multiplicity.
   Vectors without an entry in either block all have the same value for a pair, which is added by their number. A hot
   pair of blocks is cut by vector; partial sums are added.
4. Original terms are ranked by what they add to the divergence of a group from its language.

A null text, language or source counts as ''. Every (language, source) that occurs is a group, with terms or without;
empty tables give no rows. Repeated rows count as often as they occur. Ties in value are ranked by item in byte order.
Probabilities are exact integers in decimals of 38 digits; values are longs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import LOWER, UPPER, forget, materialize, small

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Sources in a block, about; the pairs of two blocks are evaluated together.
BLOCK = 32
#: Distinct vectors of a pair of blocks in a task, about.
VECTORS = 20_000
#: Vectors evaluated at a time, and counts that a task holds before it hands them on.
ROWS, HELD = 256, 500_000
_LETTERS = (UPPER + LOWER).encode()
#: A-Z to a-z; a-z and all bytes of other scripts stay; the rest to spaces.
TABLE = bytes(ord(chr(b).lower()) if b in _LETTERS else b if b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """docs(lang, source, text) -> (lang, source, term, n, docs) of parts of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}
        entries = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in counts.items():
                k = len(n)
                if k:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * k), pa.array([source] * k), pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array([in_docs[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if not (found := terms(text.as_py())):
                    continue
                n, in_docs = counts.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                n.update(found)
                in_docs.update(set(found))
                entries += len(n) - before
                if entries > held:
                    yield from flush()
                    entries = 0
        yield from flush()

    return docs.select("lang", "source", F.encode("text", "UTF-8").alias("text")).mapInArrow(run, "lang string, source string, term binary, n long, docs long").withColumn("term", F.col("term").cast("string"))


def probability(n: str, total: str, kept: str) -> Column:
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * (cast({n} as decimal(20, 0)) + 2)) div (cast(greatest({total} + 2 * {kept}, 1) as decimal(20, 0)))")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(sources: list[tuple[str, int, int]], i: int, j: int, vectors: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[list[int], list[int], np.ndarray, int]:
    """sources (name, block, p of count 0) and vectors in parts (row, source, p; multiplicity of each row) -> the sources of
    blocks i and j, the sum of every pair of them, and how many vectors there were."""
    left, right = ([k for k, x in enumerate(sources) if x[1] == b] for b in (i, j))
    zero = np.array([x[2] for x in sources], np.int64)
    sums, seen = np.zeros((len(left), len(right)), np.int64), 0
    for row, source, p, times in vectors:
        table = np.repeat(zero[None], len(times), axis=0)
        table[row, source] = p
        a, b = table[:, left, None], table[:, None, right]
        sums += ((a - b) ** 2 // (a + b) * times[:, None, None]).sum(axis=0)
        seen += int(times.sum())
    return left, right, sums, seen


def pair_values(entries: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every unordered pair of sources of a language.

    entries(lang, source, term, p, times): the entries of distinct vectors, each named by a term. groups(lang, source,
    zero): all sources with their p of a count of 0. langs(lang, kept, blocks, parts).
    """
    layout = small(langs.select("lang", "blocks", "parts"))
    block = F.pmod(F.xxhash64("source"), "blocks").cast("int")
    numbers = lambda n: F.sequence(F.lit(0), (n - 1).cast("int"))

    def met(rows: DataFrame) -> DataFrame:
        """Rows of a source, once for each block that its block meets."""
        rows = rows.join(layout, "lang").withColumn("block", block).withColumn("other", F.explode(numbers(F.col("blocks"))))
        return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})

    heads = met(groups).withColumn("part", F.explode(numbers(F.col("parts"))))
    heads = heads.select("lang", "i", "j", "part", F.lit(None).cast("string").alias("term"), "source", "block", F.col("zero").alias("p"), F.lit(0).cast("long").alias("times"))
    rows = met(entries).withColumn("part", F.pmod(F.xxhash64("term"), "parts").cast("int"))
    rows = heads.unionByName(rows.select("lang", "i", "j", "part", "term", "source", "block", "p", "times"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        rows = stream()
        row = next(rows, None)
        while row is not None:
            key, sources = row[:4], []
            while row is not None and row[:4] == key and row[4] is None:
                sources.append((row[5], row[6], row[7]))
                row = next(rows, None)
            place = {x[0]: k for k, x in enumerate(sources)}

            def vectors() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
                nonlocal row
                at, source, p, times, term = [], [], [], [], None
                while row is not None and row[:4] == key:
                    if row[4] != term:
                        if len(times) == ROWS:
                            yield np.array(at), np.array(source), np.array(p, np.int64), np.array(times, np.int64)
                            at, source, p, times = [], [], [], []
                        term = row[4]
                        times.append(row[8])
                    at.append(len(times) - 1)
                    source.append(place[row[5]])
                    p.append(row[7])
                    row = next(rows, None)
                if times:
                    yield np.array(at), np.array(source), np.array(p, np.int64), np.array(times, np.int64)

            left, right, sums, seen = _pair_sums(sources, key[1], key[2], vectors())
            out = [(key[0], sources[x][0], sources[y][0], int(sums[m, n]), seen) for m, x in enumerate(left) for n, y in enumerate(right) if key[1] < key[2] or x < y]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["lang", "a", "b", "value", "seen"])

    keys = ["lang", "i", "j", "part"]
    sums = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("term").asc_nulls_first(), "source").mapInArrow(run, "lang string, a string, b string, value long, seen long")
    # Blocks meet in the order of their numbers, sources in that of their names: no pair comes both ways round.
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    zero = small(groups.select("lang", "source", "zero"))
    for side in ("a", "b"):
        sums = sums.join(zero.select("lang", F.col("source").alias(side), F.col("zero").alias(f"zero_{side}")), ["lang", side])
    rest = F.col("kept") - F.col("seen")
    return sums.join(small(langs.select("lang", "kept")), "lang").select("lang", "a", "b", (F.col("value") + rest * divergence("zero_a", "zero_b")).alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block: int = BLOCK, vectors: int = VECTORS) -> DataFrame:
    """docs(lang, source, text) -> (lang, source, part, item, value, rank)."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    # All rows of a term meet; what is summed, counted and joined by it needs no other shuffle.
    met = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    names = [F.xxhash64("source", "n"), F.xxhash64(F.lit("other"), "n", "source")]
    of_term = Window.partitionBy("lang", "term")
    columns = met.withColumns({"total": F.sum("n").over(of_term), "docs": F.sum("docs").over(of_term), **{f"v{k}": F.bit_xor(x).over(of_term) for k, x in enumerate(names)}})
    kept = materialize(columns.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")

    by_vector = materialize(kept.groupBy("lang", "term", "v0", "v1").agg(F.first("total").alias("total")).groupBy("lang", "v0", "v1").agg(F.min("term").alias("term"), F.count("*").alias("times"), F.sum("total").alias("total")), "vectors")
    of_lang = by_vector.groupBy("lang").agg(F.sum("times").alias("kept"), F.sum("total").alias("lang_total"), F.count("*").alias("n_vectors"))
    groups = docs.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    n_sources = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    langs = n_sources.join(of_lang, "lang", "left").select("lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"), F.ceil(F.col("n_sources") / block).alias("blocks"), F.ceil(F.greatest(F.col("n_vectors"), F.lit(1)) / vectors).alias("parts"))
    langs = materialize(langs.fillna({"parts": 1}), "languages")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(own, ["lang", "source"], "left").fillna({"total": 0}).join(small(langs.select("lang", "kept", "lang_total")), "lang")
    groups = materialize(groups.withColumn("zero", probability("0", "total", "kept")), "groups")
    some = small(groups.select("lang", "source", F.col("total").alias("own_total"), "kept", "lang_total"))

    first = by_vector.select("lang", "term", "times")
    entries = kept.select("lang", "source", "term", "n").join(first, ["lang", "term"]).join(some, ["lang", "source"]).select("lang", "source", "term", probability("n", "own_total", "kept").alias("p"), "times")
    pairs = materialize(pair_values(entries, groups.select("lang", "source", "zero"), langs), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))

    rated = kept.join(some, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), probability("n", "own_total", "kept").alias("p"), probability("total", "lang_total", "kept").alias("q"))
    rated = rated.where("p > q").select("lang", "source", "item", divergence("p", "q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = rated.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    out = both.withColumn("rank", rank).withColumn("part", F.lit("pair")).unionByName(best.withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")


#: The same in DuckDB, every pair by every term.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
words AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT d.lang, source, coalesce(v, 0)::HUGEINT AS v FROM d LEFT JOIN v ON v.lang = d.lang),
n AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept ON words.lang = kept.lang AND words.term = kept.term GROUP BY lang, source, term),
own AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY lang, source),
lang_n AS (SELECT lang, term, sum(n) AS n FROM n GROUP BY lang, term),
lang_own AS (SELECT lang, sum(n) AS total FROM lang_n GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, (1 + ({SCALE}::HUGEINT * (coalesce(n.n, 0) + 2)) // (coalesce(own.total, 0) + 2 * g.v))::BIGINT AS p
    FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term LEFT JOIN own ON own.lang = g.lang AND own.source = g.source),
q AS (SELECT k.lang, k.term, (1 + ({SCALE}::HUGEINT * (k.n + 2)) // (o.total + 2 * v.v))::BIGINT AS q FROM lang_n k JOIN lang_own o ON o.lang = k.lang JOIN v ON v.lang = k.lang),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q) * (p.p - q.q) // (p.p + q.q) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= {TOP_TERMS}
"""

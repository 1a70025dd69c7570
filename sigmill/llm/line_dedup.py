"""Site-relative line deduplication, in DataFrame functions only.

A line is boilerplate at a host if it stands in more than `max_ratio` of the host's pages (one page in twenty) and in
`min_pages` of them at least. Such lines are dropped from every page of that host; all other text stays as it is, and every page stays.

Lines are compared without surrounding spaces, by 64-bit hash; blank lines are never counted or dropped. A line counts
once a page. A null host is a host of its own, with the empty one. A null text stays null and counts as a page.
Repeated rows count as often as they occur. Other columns pass through unchanged, whatever their names; a column
n_dropped is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import fresh, materialize

MAX_RATIO = 0.05
MIN_PAGES = 3
#: Parts into which a host's distinct lines are dealt when they meet the host's page total.
SALTS = 32
#: The longest list of (host, line) hashes that is broadcast: 16 bytes each.
BROADCAST_LINES = 200_000
#: The longest list of one host that each of its lines is compared with where it stands.
LISTED_LINES = 200


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_keys(text: Column) -> Column:
    """Hashes of the distinct lines that are not blank."""
    # F.trim by its name would take an element's place as the characters to trim
    trimmed = F.filter(F.transform(_lines(text), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_distinct(F.transform(trimmed, lambda x: F.xxhash64(x)))


def boilerplate_lines(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_key, pages, host_pages) of the lines to drop. Both counts are summed on the map side first."""
    named = docs.select(F.coalesce(F.col(host), F.lit("")).alias("host"), "text")
    lines = named.select("host", F.explode(_line_keys(F.col("text"))).alias("line_key"))
    counts = lines.groupBy("host", "line_key").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    totals = named.groupBy("host").agg(F.count("*").alias("host_pages")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    counts = counts.withColumn("salt", F.pmod("line_key", F.lit(SALTS)).cast("int"))
    return counts.join(totals, ["host", "salt"]).where(F.col("pages") > F.col("host_pages") * F.lit(max_ratio)).select("host", "line_key", "pages", "host_pages")


def drop_boilerplate(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, broadcast_lines: int = BROADCAST_LINES, listed_lines: int = LISTED_LINES) -> DataFrame:
    """docs with text, and n_chars where there is one, of the kept lines, and n_dropped, the number of dropped ones.

    Where no host has more than `listed_lines` boilerplate lines, counted first, their lists go to the texts, which then
    stay where they are. Longer lists are joined to the texts' lines, by a broadcast of up to `broadcast_lines` lines in
    all; the places of the hits go back to the texts by doc_id, host and the text's hash. Work is linear in the lines.
    """
    drop = materialize(boilerplate_lines(docs, host, max_ratio, min_pages).select("host", "line_key"), "boilerplate")
    docs = docs.drop("n_dropped")
    doc, site, sig, gone = fresh(docs, "doc", "site", "sig", "gone")
    key, lines = F.coalesce(F.col(host), F.lit("")), _lines(F.col("text"))
    size = drop.groupBy("host").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.coalesce(F.max("n"), F.lit(0)).alias("longest")).first()
    if size["all"] <= broadcast_lines and size["longest"] <= listed_lines:
        by_host = drop.groupBy(F.col("host").alias(site)).agg(F.collect_set("line_key").alias(gone))
        joined = docs.join(F.broadcast(by_host), key == F.col(site), "left")
        flags = F.transform(lines, lambda x: F.array_contains(gone, F.xxhash64(F.trim(x))))
    else:
        each = docs.select(F.col("doc_id").alias("doc"), key.alias("site"), F.xxhash64("text").alias("sig"), F.posexplode(lines).alias("at", "line"))
        each = each.select("doc", "site", "sig", "at", F.trim("line").alias("line")).where("line <> ''").withColumn("line", F.xxhash64("line"))
        known = F.broadcast(drop) if size["all"] <= broadcast_lines else drop
        hits = each.join(known, (F.col("site") == F.col("host")) & (F.col("line") == F.col("line_key")), "left_semi")
        hits = hits.groupBy(F.col("doc").alias(doc), F.col("site").alias(site), F.col("sig").alias(sig)).agg(F.sort_array(F.collect_set("at")).alias(gone))
        joined = docs.join(hits, F.col("doc_id").eqNullSafe(F.col(doc)) & (key == F.col(site)) & (F.xxhash64("text") == F.col(sig)), "left")
        # false for the lines between one hit and the next, then true; lines behind the last hit have no flag
        back = lambda k: F.when(k == 0, -1).otherwise(F.get(F.col(gone), k - 1))
        flags = F.flatten(F.transform(gone, lambda at, k: F.concat(F.array_repeat(F.lit(False), (at - back(k) - 1).cast("int")), F.array(F.lit(True)))))
    joined = joined.withColumn(gone, F.when(F.col(gone).isNotNull() & F.col("text").isNotNull(), flags))
    n = F.when(F.col(gone).isNull(), 0).otherwise(F.size(F.filter(gone, lambda x: x)))
    changed = F.col("n_dropped") > 0
    kept = F.filter(lines, lambda x, k: ~F.coalesce(F.get(F.col(gone), k), F.lit(False)))
    text = F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("text"))
    out = joined.withColumn("n_dropped", n.cast("int")).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns), "n_dropped")


#: The same in DuckDB. btrim of spaces only, as above.
SQL = f"""
WITH numbered AS (SELECT doc_id, lang, n_chars, source, text, coalesce(source, '') AS host FROM documents),
lines AS (SELECT DISTINCT doc_id, host, trim(line, ' ') AS line FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM numbered) WHERE trim(line, ' ') <> ''),
totals AS (SELECT host, count(*) AS host_pages FROM numbered GROUP BY host),
boilerplate AS (SELECT host, line FROM lines JOIN totals USING (host) GROUP BY host, line, host_pages HAVING count(*) >= {MIN_PAGES} AND count(*) > host_pages * {MAX_RATIO}::DOUBLE),
placed AS (SELECT doc_id, host, pos, string_split(text, chr(10))[pos] AS line FROM (SELECT doc_id, host, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM numbered)),
marked AS (SELECT p.doc_id, p.pos, p.line, b.line IS NOT NULL AS gone FROM placed p LEFT JOIN boilerplate b ON p.host = b.host AND trim(p.line, ' ') = b.line),
rebuilt AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text FROM marked GROUP BY doc_id)
SELECT n.doc_id, CASE WHEN coalesce(r.n_dropped, 0) > 0 THEN r.text ELSE n.text END AS text, n.lang, n.source,
       CASE WHEN coalesce(r.n_dropped, 0) > 0 THEN length(r.text) ELSE n.n_chars END AS n_chars, coalesce(r.n_dropped, 0)::INTEGER AS n_dropped
FROM numbered n LEFT JOIN rebuilt r USING (doc_id)
"""

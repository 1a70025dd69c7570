"""Chat formatting after the collapse of cumulative snapshots, in DataFrame functions only.

A logged conversation that is a prefix of a longer one is a snapshot of it. Every turn has two 64-bit hashes of its
place, role and text's digest; their running sums are rolling hashes of the turn prefix. A conversation goes if its
whole hash is a proper prefix hash of another (anti-join); of conversations that are equal throughout, the smallest
conv_id stays. All this is done on digests; texts are shuffled once, those of conversations that stay, to be rendered.

Turns stand in the order of (turn, role, MD5 of the text); repeated equal turns count once. A null role or text reads as
the empty string; rows without conv_id or turn are left out. An empty table gives an empty result. Turns are gathered by
conversation only to render it, as its row is the result; prefixes, of which one may begin a third of all
conversations, are reduced on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize

START, END = "<|", "|>"


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest), nulls read as empty."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.where("conv_id is not null and turn is not null").withColumn("digest", F.unhex(F.md5("text")))


def rolling_prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, n_turns, hash_a, hash_b): the hashes are of the turns up to and with this one."""
    turns = _turns(conversations).select("conv_id", "turn", "role", "digest").repartition("conv_id").distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "digest")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumns({"place": F.row_number().over(order), "n_turns": F.count("*").over(Window.partitionBy("conv_id"))})
    # sums of decimals cannot overflow; the place is part of what is hashed, so the order counts
    sums = {name: F.sum(F.xxhash64(F.lit(seed), "place", "role", F.length("role"), "digest").cast("decimal(20,0)")).over(so_far) for name, seed in (("hash_a", "a"), ("hash_b", "b"))}
    return turns.withColumns(sums).select("conv_id", "place", "n_turns", *sums)


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no longer or equal one contains as a prefix."""
    key = ["place", "hash_a", "hash_b"]
    whole = prefixes.where("place = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    proper = prefixes.where("place < n_turns").select(*key).distinct()
    return whole.join(proper, key, "left_anti").select("conv_id", F.col("place").alias("n_turns"))


def render_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text): one row for each maximal conversation."""
    kept = maximal_conversations(materialize(rolling_prefixes(conversations), "prefixes"))
    turns = _turns(conversations).join(kept.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id")
    turns = turns.agg(F.sort_array(F.collect_set(F.struct("turn", "role", "digest", "text"))).alias("turns"))
    line = lambda t: F.concat(F.lit(START), t["role"], F.lit(END + "\n"), t["text"], F.lit("\n"))
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", line), "").alias("text"))


#: The same in DuckDB, by comparing the turns themselves.
SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
p AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, md5(text)) AS place, count(*) OVER (PARTITION BY conv_id) AS n FROM t),
s AS (SELECT conv_id, place, n, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix FROM p),
whole AS (SELECT prefix, place, min(conv_id) AS conv_id FROM s WHERE place = n GROUP BY prefix, place),
proper AS (SELECT DISTINCT prefix FROM s WHERE place < n),
kept AS (SELECT conv_id, place AS n_turns FROM whole WHERE prefix NOT IN (SELECT prefix FROM proper))
SELECT k.conv_id, k.n_turns::BIGINT AS n_turns, string_agg('{START}' || role || '{END}' || chr(10) || text || chr(10), '' ORDER BY p.place) AS text
FROM kept k JOIN p ON k.conv_id = p.conv_id GROUP BY k.conv_id, k.n_turns
"""

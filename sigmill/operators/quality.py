"""Channel quality of sample streams {s}(file_id, chunk_id, n, i, q)."""

from __future__ import annotations

FINITE = "NOT isnan({x}) AND abs({x}) < CAST('Infinity' AS DOUBLE)"
CLIP_LEVEL = 0.999


def _channel(x: str, name: str) -> str:
    """Statistics of the finite samples of one channel; NaN and infinite ones are counted."""
    ok = FINITE.format(x=x)
    v = f"CASE WHEN {ok} THEN {x} END"
    return f"""count(CASE WHEN isnan({x}) THEN 1 END) AS {name}_nan, count(CASE WHEN abs({x}) = CAST('Infinity' AS DOUBLE) THEN 1 END) AS {name}_inf,
    round(avg({v}), 6) + 0.0D AS {name}_mean, round(stddev_pop({v}), 6) AS {name}_std, min({v}) AS {name}_min, max({v}) AS {name}_max, max(abs({v})) AS {name}_peak_abs,
    round(sqrt(avg(({v}) * ({v}))), 6) AS {name}_rms, round(100.0D * count(CASE WHEN {ok} AND abs({x}) > {CLIP_LEVEL}D THEN 1 END) / greatest(count({v}), 1), 6) AS {name}_clip_pct"""


def channel_stats(by: str = "file_id") -> str:
    """Partial and final aggregation only; one row for each value of `by`."""
    return f"SELECT {by}, count(*) AS frames, {_channel('i', 'i')}, {_channel('q', 'q')} FROM {{s}} GROUP BY {by}"


#: Envelope kurtosis (not excess) after DC removal, by file and by chunk.
ENVELOPE_KURTOSIS = f"""
WITH finite AS (SELECT * FROM {{s}} WHERE {FINITE.format(x="i")} AND {FINITE.format(x="q")}),
dc AS (SELECT file_id, chunk_id, avg(i) AS mi, avg(q) AS mq FROM finite GROUP BY file_id, chunk_id),
e AS (SELECT f.file_id, f.chunk_id, sqrt((i - mi) * (i - mi) + (q - mq) * (q - mq)) AS env FROM finite f JOIN dc ON f.file_id = dc.file_id AND f.chunk_id = dc.chunk_id)
SELECT file_id, chunk_id, count(*) AS n, round(CASE WHEN stddev_pop(env) < 1e-12 THEN 0.0D ELSE kurtosis(env) + 3 END, 6) AS envelope_kurtosis FROM e GROUP BY file_id, chunk_id"""



def strided_scan(step: int) -> str:
    """Every step-th sample; what is left over at the end (total modulo step) gives none."""
    return f"""SELECT x.file_id, n div {step} AS n, i, q FROM {{s}} x JOIN (SELECT file_id, max(n) + 1 AS total FROM {{s}} GROUP BY file_id) t ON x.file_id = t.file_id
WHERE n % {step} = 0 AND n div {step} < total div {step}"""


def chunk_strided_scan(step: int, chunk: int = 4096) -> str:
    """Every step-th sample of each chunk, from its first one on."""
    return f"SELECT file_id, chunk_id, n, i, q FROM {{s}} WHERE (n - chunk_id * {chunk}) % {step} = 0"


def head_scan(samples: int) -> str:
    return f"SELECT file_id, n, i, q FROM {{s}} WHERE n < {samples}"


def time_window(start_s: float, end_s: float, fs: float) -> str:
    """Samples from start_s to end_s, at least one."""
    first, last = int(start_s * fs), max(int(end_s * fs), int(start_s * fs) + 1)
    return f"SELECT file_id, n, i, q FROM {{s}} WHERE n >= {first} AND n < {last}"


CONVENTIONS = """
SELECT conv, round(avg(re), 6) + 0.0D AS mean_re, round(avg(im), 6) + 0.0D AS mean_im, round(avg(re * re + im * im), 6) AS power FROM (
    SELECT 'I+Q' AS conv, i AS re, q AS im FROM {s} UNION ALL SELECT 'I-Q', i, -q FROM {s} UNION ALL SELECT 'Q+I', q, i FROM {s} UNION ALL SELECT 'Q-I', q, -i FROM {s}) x GROUP BY conv"""

TARGET_S, FS = 1.5, 1000.0
#: Decimation factors to try for a long recording: odd ones first, then powers of two from 8, then nearness to the target.
SAMPLING_CANDIDATES = f"""
WITH t AS (SELECT file_id, count(*) AS frames, CAST(ceil(count(*) / {FS}D / {TARGET_S}D) AS BIGINT) AS base FROM {{s}} GROUP BY file_id),
c AS (SELECT file_id, base, k AS factor, CASE WHEN k % 2 = 1 THEN 10 WHEN k IN (8, 16) THEN 5 ELSE 0 END AS priority FROM t CROSS JOIN (SELECT k FROM {{bins}} WHERE k BETWEEN 2 AND 20) b WHERE frames / {FS}D > {TARGET_S}D AND k >= greatest(2, base div 2) AND k <= least(20, base * 2)),
o AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY priority DESC, abs(factor - base), factor) AS place FROM c)
SELECT file_id, base, factor, CAST(priority AS BIGINT) AS priority, CAST(place AS BIGINT) AS place FROM o WHERE place <= 8"""

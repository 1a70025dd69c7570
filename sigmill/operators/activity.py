"""Sequential scans of short sample streams as windows: running RMS, activity slices, frames, hysteresis segments, bursts.

Running sums are differenced instead of sliding a frame, and every window is partitioned by file and chunk. Each text is
made by a function of its parameters, in samples and dB; long captures take `captures`, `intervals` and `inference`.
"""

from __future__ import annotations

#: Of the registered queries and tests; at 1000 samples a second a sample is a millisecond.
RMS_WIN, THRESH_DB, MIN_DUR, GAP, PAD = 5, -4.0, 5, 3, 2
FRAME, STRIDE = 64, 32


def _rms(w: int) -> str:
    return f"""
p AS (SELECT file_id, chunk_id, n, row_number() OVER (PARTITION BY file_id, chunk_id ORDER BY n) - 1 AS k, sum(i * i + q * q) OVER (PARTITION BY file_id, chunk_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs FROM {{s}}),
r AS (SELECT file_id, chunk_id, n, k, sqrt(greatest(0.0D, cs - coalesce(lag(cs, {w}) OVER (PARTITION BY file_id, chunk_id ORDER BY n), 0.0D)) / least(k + 1, {w})) AS rms FROM p)"""


def rms_dbfs(win: int) -> str:
    return f"WITH {_rms(win).strip()} SELECT file_id, n, round(20 * log10(greatest(rms, 1e-12)), 6) AS dbfs FROM r"


def slices(win: int, thresh_db: float = -60.0, min_dur: int = 5, gap: int = 3, pad: int = 2, fs: float = 1000.0) -> str:
    """Runs above the threshold, gaps closed, padded and clamped within the chunk, short ones dropped, touching ones joined."""
    return f"""
WITH {_rms(win).strip()},
a AS (SELECT file_id, chunk_id, n, k, min(n) OVER (PARTITION BY file_id, chunk_id) AS lo, max(n) OVER (PARTITION BY file_id, chunk_id) + 1 AS hi, rms FROM r),
g AS (SELECT *, CASE WHEN n - lag(n) OVER (PARTITION BY file_id, chunk_id ORDER BY n) - 1 <= {gap} THEN 0 ELSE 1 END AS opens FROM a WHERE 20 * log10(greatest(rms, 1e-12)) > {thresh_db}D),
h AS (SELECT *, sum(opens) OVER (PARTITION BY file_id, chunk_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM g),
w AS (SELECT file_id, greatest(min(n) - {pad}, min(lo)) AS s0, least(max(n) + 1 + {pad}, max(hi)) AS e0 FROM h GROUP BY file_id, chunk_id, island),
f AS (SELECT * FROM w WHERE e0 - s0 >= {min_dur}),
m AS (SELECT *, CASE WHEN s0 <= max(e0) OVER (PARTITION BY file_id ORDER BY s0, e0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM f),
u AS (SELECT *, sum(opens) OVER (PARTITION BY file_id ORDER BY s0, e0 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM m),
o AS (SELECT file_id, min(s0) AS start_sample, max(e0) AS end_sample FROM u GROUP BY file_id, island),
x AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY start_sample) - 1 AS slice_idx FROM o)
SELECT file_id, CAST(slice_idx AS BIGINT) AS slice_idx, start_sample, end_sample, round(start_sample / {fs}D, 6) AS start_s, round(end_sample / {fs}D, 6) AS end_s, round((end_sample - start_sample) * 1000.0D / {fs}D, 6) AS duration_ms FROM x"""

#: The registered queries' parameters.
RMS_DBFS, SLICES = rms_dbfs(RMS_WIN), slices(RMS_WIN, THRESH_DB, MIN_DUR, GAP, PAD)

_ENERGY = f"""
f AS (SELECT file_id, n div {STRIDE} AS half, sum(i * i + q * q) AS p, count(*) AS c FROM {{s}} GROUP BY file_id, n div {STRIDE}),
fr AS (SELECT file_id, half * {STRIDE} AS start_sample, p + lead(p) OVER (PARTITION BY file_id ORDER BY half) AS p2, c + lead(c) OVER (PARTITION BY file_id ORDER BY half) AS c2 FROM f),
e AS (SELECT file_id, start_sample, 10 * log10(greatest(p2 / (2 * c2), 1e-12)) AS db FROM fr WHERE c2 = {FRAME})"""
#: Frame energy over both channels; a frame is two neighbouring half frames, so samples are summed once.
FRAME_ENERGY = f"WITH {_ENERGY.strip()} SELECT file_id, start_sample, round(db, 6) AS energy_db FROM e"

START_DB, HANG_DB, MIN_SEGMENT, MERGE_GAP = -7.6, 0.4, 96, 64
#: Hysteresis: on at START_DB, off at START_DB - HANG_DB; short segments dropped, then neighbours merged.
VAD_SEGMENTS = f"""
WITH {_ENERGY.strip()},
st AS (SELECT *, CASE WHEN db >= {START_DB}D THEN 1 WHEN db <= {START_DB}D - {HANG_DB}D THEN 0 END AS mark FROM e),
ff AS (SELECT *, coalesce(last_value(mark) IGNORE NULLS OVER (PARTITION BY file_id ORDER BY start_sample ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS state FROM st),
fl AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY file_id ORDER BY start_sample), 0) AS before FROM ff),
ed AS (SELECT file_id, start_sample, state, lead(start_sample) OVER (PARTITION BY file_id ORDER BY start_sample) AS stop FROM fl WHERE state <> before),
total AS (SELECT file_id, max(n) + 1 AS n_all FROM {{s}} GROUP BY file_id),
sg AS (SELECT ed.file_id, start_sample, coalesce(stop + {FRAME}, n_all) AS end_sample FROM ed JOIN total ON ed.file_id = total.file_id WHERE state = 1),
kept AS (SELECT * FROM sg WHERE end_sample - start_sample >= {MIN_SEGMENT}),
op AS (SELECT *, CASE WHEN start_sample - lag(end_sample) OVER (PARTITION BY file_id ORDER BY start_sample) <= {MERGE_GAP} THEN 0 ELSE 1 END AS opens FROM kept),
gr AS (SELECT *, sum(opens) OVER (PARTITION BY file_id ORDER BY start_sample ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM op)
SELECT file_id, CAST(island - 1 AS BIGINT) AS segment_id, min(start_sample) AS start_sample, max_by(end_sample, start_sample) AS end_sample FROM gr GROUP BY file_id, island"""

GROUP_GAP = 0.06
#: Segments of one label with small gaps become a burst; an unknown one stands alone.
BURSTS = f"""
WITH l AS (SELECT *, CASE WHEN pred_label = lag(pred_label) OVER (PARTITION BY file_id ORDER BY start_s, segment_id) AND pred_label <> 'UNKNOWN' THEN 0 ELSE 1 END AS turns FROM {{segments}}),
r AS (SELECT *, sum(turns) OVER (PARTITION BY file_id ORDER BY start_s, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM l),
m AS (SELECT *, max(end_s) OVER (PARTITION BY file_id, run ORDER BY start_s, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
o AS (SELECT *, CASE WHEN reach IS NULL OR start_s - reach > {GROUP_GAP}D THEN 1 ELSE 0 END AS opens FROM m),
b AS (SELECT *, sum(opens) OVER (PARTITION BY file_id ORDER BY start_s, segment_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS burst FROM o)
SELECT file_id, CAST(burst - 1 AS BIGINT) AS burst_id, min(pred_label) AS pred_label, round(avg(prob), 6) AS avg_prob, round(min(start_s), 6) AS start_s, round(max(end_s), 6) AS end_s,
    round(CASE WHEN count(*) = 1 THEN max(offset_hz) ELSE sum(offset_hz * (end_s - start_s)) / greatest(sum(end_s - start_s), 1e-12) END, 4) AS offset_hz, round(433e6 + CASE WHEN count(*) = 1 THEN max(offset_hz) ELSE sum(offset_hz * (end_s - start_s)) / greatest(sum(end_s - start_s), 1e-12) END, 1) AS center_hz_abs,
    max(bw_hz) AS bandwidth_hz, round(percentile(snr_db, 0.5D), 6) AS snr_db, count(*) AS n_segments FROM b GROUP BY file_id, burst"""

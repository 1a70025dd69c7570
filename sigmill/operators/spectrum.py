"""Spectra of short sample streams {s} by transforms written out as sums: what block operators are compared with.

Captures take `captures` (Welch, carriers, waterfall) and `wideband` (CFAR and what follows), which the registered queries
run; these texts are their oracle.
"""

from __future__ import annotations

FS, NPERSEG, HOP = 1000, 64, 32
COLS = 32
TAU = "6.283185307179586D"


def _dft(n: int, table: str, place: str, value: str) -> str:
    """Windowed (periodic Hann) DFT sums of frames in {table}(file_id, frame, m, i, q)."""
    w = f"(0.5D - 0.5D * cos({TAU} * m / {n}))"
    return f"""{place} AS (SELECT file_id, frame, k, sum({w} * (i * cos({TAU} * k * m / {n}) + q * sin({TAU} * k * m / {n}))) AS re, sum({w} * (q * cos({TAU} * k * m / {n}) - i * sin({TAU} * k * m / {n}))) AS im
    FROM {table} CROSS JOIN (SELECT k FROM {{bins}} WHERE k < {n}) b GROUP BY file_id, frame, k HAVING count(*) = {n})"""


_PSD = f"""
fr AS (SELECT file_id, n div {HOP} AS frame, n % {HOP} AS m, i, q FROM {{s}} UNION ALL SELECT file_id, n div {HOP} - 1 AS frame, n % {HOP} + {HOP} AS m, i, q FROM {{s}} WHERE n >= {HOP}),
{_dft(NPERSEG, "fr", "x", "psd")},
psd AS (SELECT file_id, (k + {NPERSEG // 2}) % {NPERSEG} AS bin, avg(re * re + im * im) / ({FS} * {NPERSEG * 0.375}D) AS p FROM x GROUP BY file_id, k),
d AS (SELECT file_id, bin, (bin - {NPERSEG // 2}) * {FS / NPERSEG}D AS f_hz, p, 10 * log10(greatest(p, 1e-20)) AS db FROM psd)"""
PSD = f"WITH {_PSD.strip()} SELECT file_id, bin, f_hz, round(p, 9) AS p, round(db, 6) AS p_db FROM d"
NOISE_FLOOR = f"WITH {_PSD.strip()} SELECT file_id, round(percentile(db, 0.5D), 6) AS noise_floor_db FROM d GROUP BY file_id"

PROMINENCE = 0.5
#: Local maxima by prominence (lowest point up to the nearest higher bin on each side), with their -6 dB widths.
CARRIERS = f"""
WITH {_PSD.strip()},
nb AS (SELECT *, lag(db) OVER (PARTITION BY file_id ORDER BY bin) AS l1, lead(db) OVER (PARTITION BY file_id ORDER BY bin) AS r1 FROM d),
pk AS (SELECT file_id, bin, f_hz, db FROM nb WHERE db > l1 AND db > r1),
hi AS (SELECT pk.file_id, pk.bin, max(CASE WHEN d.bin < pk.bin AND d.db > pk.db THEN d.bin ELSE -1 END) AS lh, min(CASE WHEN d.bin > pk.bin AND d.db > pk.db THEN d.bin ELSE {NPERSEG} END) AS rh,
    max(CASE WHEN d.bin < pk.bin AND d.db <= pk.db - 6 THEN d.bin ELSE 0 END) AS l, min(CASE WHEN d.bin > pk.bin AND d.db <= pk.db - 6 THEN d.bin ELSE {NPERSEG - 1} END) AS r FROM pk JOIN d ON pk.file_id = d.file_id GROUP BY pk.file_id, pk.bin),
ba AS (SELECT hi.file_id, hi.bin, min(CASE WHEN d.bin <= hi.bin THEN d.db END) AS lb, min(CASE WHEN d.bin >= hi.bin THEN d.db END) AS rb FROM hi JOIN d ON hi.file_id = d.file_id AND d.bin > lh AND d.bin < rh GROUP BY hi.file_id, hi.bin),
md AS (SELECT file_id, percentile(db, 0.5D) AS fl FROM d GROUP BY file_id)
SELECT pk.file_id, pk.f_hz AS f_center_hz, round(pk.db, 6) AS p_db, (r - l) * {FS / NPERSEG}D AS bw_hz_est, round(pk.db - fl, 6) AS snr_db_est
FROM pk JOIN hi ON pk.file_id = hi.file_id AND pk.bin = hi.bin JOIN ba ON pk.file_id = ba.file_id AND pk.bin = ba.bin JOIN md ON pk.file_id = md.file_id WHERE pk.db - greatest(lb, rb) >= {PROMINENCE}D AND r - l >= 3"""

_GRID = f"""
fr AS (SELECT file_id, n div {COLS} AS frame, n % {COLS} AS m, i, q FROM {{s}}),
{_dft(COLS, "fr", "x", "grid")},
grid AS (SELECT file_id, frame AS t, (k + {COLS // 2}) % {COLS} AS f, 20 * log10(greatest(sqrt(re * re + im * im) / {COLS // 2}, 1e-12)) AS db FROM x)"""
WATERFALL = f"WITH {_GRID.strip()} SELECT file_id, t, f, round(db, 6) AS s_db FROM grid"
THUMBNAIL = f"WITH {_GRID.strip()} SELECT file_id, t div 8 AS t, f div 4 AS f, round(max(db), 6) AS max_db, round(avg(db), 6) AS mean_db FROM grid GROUP BY file_id, t div 8, f div 4"

K, GUARD, TRAIN = 2.0, 1, 6


def _axis(a: str, b: str) -> str:
    """Cells that stand out along axis a: above median + K * 1.4826 * MAD of the training cells on both sides."""
    return f"""
o_{a} AS (SELECT file_id, {b}, {a}, db, {a} + k - {GUARD + TRAIN} AS other FROM grid CROSS JOIN (SELECT k FROM {{bins}} WHERE k <= {2 * (GUARD + TRAIN)} AND abs(k - {GUARD + TRAIN}) > {GUARD}) b),
j_{a} AS (SELECT o.file_id, o.{b}, o.{a}, o.db, g.db AS ref FROM o_{a} o JOIN grid g ON o.file_id = g.file_id AND o.{b} = g.{b} AND o.other = g.{a}),
m_{a} AS (SELECT file_id, {b}, {a}, percentile(ref, 0.5D) AS med FROM j_{a} GROUP BY file_id, {b}, {a}),
c_{a} AS (SELECT j.file_id, j.{b}, j.{a}, max(j.db) > max(med) + {K}D * 1.4826D * (percentile(abs(ref - med), 0.5D) + 1e-12) AS mark FROM j_{a} j JOIN m_{a} m ON j.file_id = m.file_id AND j.{b} = m.{b} AND j.{a} = m.{a} GROUP BY j.file_id, j.{b}, j.{a})"""


_MASK = f"""{_GRID.strip()}, {_axis("t", "f").strip()}, {_axis("f", "t").strip()},
mask AS (SELECT ct.file_id, ct.t, ct.f, ct.mark AND cf.mark AS active FROM c_t ct JOIN c_f cf ON ct.file_id = cf.file_id AND ct.t = cf.t AND ct.f = cf.f)"""
CFAR_MASK = f"WITH {_MASK} SELECT file_id, t, f, active FROM mask"
OCCUPANCY = f"WITH {_MASK} SELECT file_id, f, round(avg(CASE WHEN active THEN 1.0D ELSE 0.0D END), 6) AS occupancy FROM mask GROUP BY file_id, f"
TIME_ACTIVITY = f"WITH {_MASK} SELECT file_id, t, round(t * {COLS / FS}D, 6) AS time_s, round(avg(CASE WHEN active THEN 1.0D ELSE 0.0D END), 6) AS activity FROM mask GROUP BY file_id, t"
#: Spans of columns with activity within a band; the end is the last active column.
ACTIVE_SPANS = f"""
WITH {_MASK},
an AS (SELECT file_id, k AS band, t FROM mask JOIN (SELECT k FROM {{bins}} WHERE k < 4) b ON f div 8 = k WHERE active GROUP BY file_id, k, t),
op AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY file_id, band ORDER BY t) = 1 THEN 0 ELSE 1 END AS opens FROM an),
gr AS (SELECT *, sum(opens) OVER (PARTITION BY file_id, band ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM op)
SELECT file_id, band, min(t) AS t_first, max(t) AS t_last FROM gr GROUP BY file_id, band, island"""

"""DuckDB texts for queries that Spark answers with block operators: written apart, from the definitions.

They are rendered by `dialect.duck` from the short-stream SQL where that exists, and stand here in full where it does not.
"""

from __future__ import annotations

from ..operators import activity, spectrum
from . import dialect

PI2 = 6.283185307179586


def quality(by: str, short_s: float | None) -> str:
    """Statistics by direct aggregates, image rejection by a direct transform of each chunk of 4096 samples."""
    key = "CAST(chunk_id AS VARCHAR)" if by == "chunk" else "file_id"
    late = f"CASE WHEN frames / 1000.0 < {short_s} THEN 'Very short recording (' || printf('%.3f', frames / 1000.0::DOUBLE) || 's) - may not be sufficient for analysis' END" if short_s is not None else "NULL"
    return f"""
WITH v AS (SELECT {key} AS file_id, chunk_id, n, i, q FROM v_s),
st AS (SELECT file_id, count(*) AS frames, count_if(isnan(i)) + count_if(isnan(q)) AS nan_count, count_if(isinf(i)) + count_if(isinf(q)) AS inf_count,
    greatest(100.0::DOUBLE * count_if(isfinite(i) AND abs(i) > 0.999) / greatest(count_if(isfinite(i)), 1), 100.0::DOUBLE * count_if(isfinite(q) AND abs(q) > 0.999) / greatest(count_if(isfinite(q)), 1)) AS clip_pct FROM v GROUP BY file_id),
dc AS (SELECT file_id, chunk_id, avg(i) AS mi, avg(q) AS mq FROM v GROUP BY file_id, chunk_id),
e AS (SELECT v.file_id, sqrt(pow(i - mi, 2) + pow(q - mq, 2)) AS env FROM v JOIN dc USING (file_id, chunk_id)),
em AS (SELECT file_id, avg(env) AS m, stddev_pop(env) AS s FROM e GROUP BY file_id),
ku AS (SELECT e.file_id, CASE WHEN min(s) < 1e-12 THEN 0.0 ELSE avg(pow((env - m) / s, 4)) END AS kurt FROM e JOIN em USING (file_id) GROUP BY e.file_id),
x AS (SELECT v.file_id, v.chunk_id, k, sum((i - mi) * cos({PI2} * k * (n % 4096) / 4096) + (q - mq) * sin({PI2} * k * (n % 4096) / 4096)) AS re, sum((q - mq) * cos({PI2} * k * (n % 4096) / 4096) - (i - mi) * sin({PI2} * k * (n % 4096) / 4096)) AS im
    FROM v JOIN dc USING (file_id, chunk_id) CROSS JOIN (SELECT range AS k FROM range(4096)) GROUP BY v.file_id, v.chunk_id, k),
b AS (SELECT file_id, sum(CASE WHEN k BETWEEN 1 AND 2047 THEN re * re + im * im ELSE 0 END) AS pos, sum(CASE WHEN k >= 2048 THEN re * re + im * im ELSE 0 END) AS neg, sum(CASE WHEN k > 2048 THEN re * re + im * im ELSE 0 END) AS cpos, sum(CASE WHEN k BETWEEN 1 AND 2048 THEN re * re + im * im ELSE 0 END) AS cneg FROM x GROUP BY file_id),
r AS (SELECT file_id, CASE WHEN pos / neg >= cpos / cneg THEN 'I+jQ' ELSE 'I-jQ' END AS best_convention, abs(10 * log10(greatest(pos / neg, cpos / cneg))) AS irr FROM b),
a AS (SELECT *, (CASE WHEN nan_count > 0 THEN 20 ELSE 0 END) + (CASE WHEN inf_count > 0 THEN 20 ELSE 0 END) + (CASE WHEN clip_pct > 5 THEN 25 WHEN clip_pct > 1 THEN 10 WHEN clip_pct > 0.1 THEN 5 ELSE 0 END) + (CASE WHEN irr < 10 THEN 15 WHEN irr < 20 THEN 5 ELSE 0 END) AS lost
    FROM st JOIN r USING (file_id) JOIN ku USING (file_id))
SELECT file_id, frames, CAST(nan_count AS BIGINT) AS nan_count, CAST(inf_count AS BIGINT) AS inf_count, round(clip_pct, 6) AS clip_pct, best_convention, round(irr, 4) AS best_irr_db, round(kurt, 6) AS envelope_kurtosis, greatest(0, 100 - lost)::DOUBLE AS quality_score,
    CASE WHEN 100 - lost >= 80 THEN 'good' WHEN 100 - lost >= 60 THEN 'marginal' ELSE 'poor' END AS verdict,
    concat_ws('; ', CASE WHEN nan_count > 0 THEN 'Found ' || nan_count || ' NaN values' END, CASE WHEN inf_count > 0 THEN 'Found ' || inf_count || ' infinite values' END, CASE WHEN clip_pct > 5 THEN 'Severe clipping detected: ' || printf('%.1f', clip_pct) || '%' END, CASE WHEN irr < 10 THEN 'Poor I/Q balance (IRR: ' || printf('%.1f', irr) || ' dB)' END) AS issues,
    concat_ws('; ', CASE WHEN clip_pct > 5 THEN NULL WHEN clip_pct > 1 THEN 'Moderate clipping detected: ' || printf('%.1f', clip_pct) || '%' WHEN clip_pct > 0.1 THEN 'Minor clipping detected: ' || printf('%.1f', clip_pct) || '%' END, CASE WHEN irr >= 10 AND irr < 20 THEN 'Suboptimal I/Q balance (IRR: ' || printf('%.1f', irr) || ' dB)' END,
        CASE WHEN kurt < 1.5 THEN 'Very constant envelope detected - may indicate CW or unmodulated carrier' WHEN kurt > 10 THEN 'Highly variable envelope detected - check for intermittent signals or interference' END, {late}) AS warnings,
    CASE WHEN best_convention <> 'I+jQ' THEN 'Consider using --conv I -Q in downstream processing' ELSE '' END AS recommendations FROM a"""


SWEEP = f"""
WITH h AS (SELECT file_id, f AS factor, n // f AS m, i, q FROM v_s CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 8, 10, 16]) AS f) WHERE n % f = 0),
dc AS (SELECT file_id, factor, avg(i) AS mi, avg(q) AS mq FROM h GROUP BY file_id, factor),
fr AS (SELECT h.file_id, h.factor, m // 64 AS frame, m % 64 AS m, i - mi AS i, q - mq AS q FROM h JOIN dc USING (file_id, factor)),
x AS (SELECT file_id, factor, frame, k, sum(i * cos({PI2} * k * m / 64) + q * sin({PI2} * k * m / 64)) AS re, sum(q * cos({PI2} * k * m / 64) - i * sin({PI2} * k * m / 64)) AS im FROM fr CROSS JOIN (SELECT range AS k FROM range(64)) GROUP BY file_id, factor, frame, k HAVING count(*) = 64),
b AS (SELECT file_id, factor, sum(CASE WHEN k BETWEEN 1 AND 31 THEN re * re + im * im ELSE 0 END) AS pos, sum(CASE WHEN k >= 32 THEN re * re + im * im ELSE 0 END) AS neg, sum(CASE WHEN k > 32 THEN re * re + im * im ELSE 0 END) AS cpos, sum(CASE WHEN k BETWEEN 1 AND 32 THEN re * re + im * im ELSE 0 END) AS cneg FROM x GROUP BY file_id, factor),
d AS (SELECT file_id, factor, 10 * log10(pos / neg) AS plain, 10 * log10(cpos / cneg) AS mirrored FROM b),
z AS (SELECT file_id, plain >= mirrored AS direct, greatest(plain, mirrored) AS base FROM d WHERE factor = 1)
SELECT file_id, factor, round(1000.0::DOUBLE / factor, 5) AS fs_hz, CASE WHEN direct THEN 'I+jQ' ELSE 'I-jQ' END AS best_convention, round(CASE WHEN direct THEN plain ELSE mirrored END, 5) AS irr_db, round(base, 5) AS baseline_db, round(CASE WHEN direct THEN plain ELSE mirrored END - base, 5) AS difference_db FROM d JOIN z USING (file_id)"""

def _bands(rows: str, keys: str) -> str:
    """CTEs x and b: powers of the transform of 4096 places of rows(keys, m, i, q); places that no row has are zero."""
    return f"""
x AS (SELECT {keys}, k, sum(i * cos({PI2} * ((k * m) % 4096) / 4096) + q * sin({PI2} * ((k * m) % 4096) / 4096)) AS re, sum(q * cos({PI2} * ((k * m) % 4096) / 4096) - i * sin({PI2} * ((k * m) % 4096) / 4096)) AS im FROM {rows} CROSS JOIN (SELECT range AS k FROM range(4096)) GROUP BY {keys}, k),
b AS (SELECT {keys}, sum(CASE WHEN k BETWEEN 1 AND 2047 THEN re * re + im * im ELSE 0 END) AS pos, sum(CASE WHEN k >= 2048 THEN re * re + im * im ELSE 0 END) AS neg, sum(CASE WHEN k > 2048 THEN re * re + im * im ELSE 0 END) AS cpos, sum(CASE WHEN k BETWEEN 1 AND 2048 THEN re * re + im * im ELSE 0 END) AS cneg FROM x GROUP BY {keys})"""


#: One transform of 4096 places for each factor, of the middle of its samples or with zeros on both sides.
SAMPLING_EFFECTS = f"""
WITH h AS (SELECT file_id, f AS factor, n // f AS m, i, q FROM v_s CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 8, 10, 16]) AS f) WHERE n % f = 0),
dc AS (SELECT file_id, factor, count(*) AS n, avg(i) AS mi, avg(q) AS mq FROM h GROUP BY file_id, factor),
c AS (SELECT h.file_id, h.factor, m - greatest(0, (n - 4096) // 2) + greatest(0, (4096 - n) // 2) AS m, i - mi AS i, q - mq AS q FROM h JOIN dc USING (file_id, factor) WHERE m >= greatest(0, (n - 4096) // 2) AND m < greatest(0, (n - 4096) // 2) + 4096),{_bands("c", "file_id, factor")},
d AS (SELECT file_id, factor, 10 * log10(pos / neg) AS plain, 10 * log10(cpos / cneg) AS mirrored FROM b),
z AS (SELECT file_id, plain >= mirrored AS direct, greatest(plain, mirrored) AS base FROM d WHERE factor = 1)
SELECT file_id, factor::BIGINT AS factor, round(1000.0::DOUBLE / factor, 4) AS fs_hz, CASE WHEN direct THEN 'I+jQ' ELSE 'I-jQ' END AS best_convention, round(CASE WHEN direct THEN plain ELSE mirrored END, 4) AS irr_db, round(base, 4) AS baseline_db, round(CASE WHEN direct THEN plain ELSE mirrored END - base, 4) AS difference_db FROM d JOIN z USING (file_id)"""

#: Ten segments of 500 samples, each less its own mean, in four conventions.
IRR_SEGMENTS = f"""
WITH t AS (SELECT file_id, count(*) AS frames FROM v_s GROUP BY file_id),
seg AS (SELECT file_id, interval_id, least(interval_id * greatest(1, (frames - 500) // 9), frames - 500) AS a FROM (SELECT *, unnest(range(10)) AS interval_id FROM t WHERE frames >= 500)),
r AS (SELECT s.file_id, interval_id, n - a AS m, i, q FROM v_s s JOIN seg ON s.file_id = seg.file_id AND n >= a AND n < a + 500),
dc AS (SELECT file_id, interval_id, avg(i) AS mi, avg(q) AS mq FROM r GROUP BY file_id, interval_id),
c AS (SELECT r.file_id, r.interval_id, m, i - mi AS i, q - mq AS q FROM r JOIN dc USING (file_id, interval_id)),{_bands("c", "file_id, interval_id")},
d AS (SELECT file_id, interval_id, 10 * log10(pos / neg) AS p, 10 * log10(cpos / cneg) AS m FROM b)
SELECT file_id, interval_id, CASE WHEN p >= m THEN 'I+jQ' ELSE 'I-jQ' END AS best_convention, round(greatest(p, m), 5) AS best_irr_db, round(p, 5) AS irr_i_q, round(m, 5) AS irr_i_neg_q, round(m, 5) AS irr_q_i, round(p, 5) AS irr_q_neg_i, CASE WHEN p >= m THEN 'I+Q' ELSE 'I-Q' END AS conv, 'IQ' AS channel_order FROM d"""

#: Statistics across chunks as if each were a recording.
IRR_FILES = f"""
WITH dc AS (SELECT file_id, chunk_id, avg(i) AS mi, avg(q) AS mq FROM v_s GROUP BY file_id, chunk_id),
c AS (SELECT s.file_id || '-' || s.chunk_id AS file_id, n % 4096 AS m, i - mi AS i, q - mq AS q FROM v_s s JOIN dc ON s.file_id = dc.file_id AND s.chunk_id = dc.chunk_id),{_bands("c", "file_id")},
d AS (SELECT file_id, CASE WHEN pos / neg >= cpos / cneg THEN 'I+jQ' ELSE 'I-jQ' END AS conv, abs(10 * log10(greatest(pos / neg, cpos / cneg))) AS irr FROM b),
k AS (SELECT conv, count(*) AS n FROM d GROUP BY conv),
a AS (SELECT count(*) AS n, avg(irr) AS mean_irr, stddev_pop(irr) AS std_irr, min(irr) AS min_irr, max(irr) AS max_irr, arg_min(conv, file_id) AS first FROM d)
SELECT n, round(mean_irr, 4) AS mean_irr, round(std_irr, 4) AS std_irr, round(min_irr, 4) AS min_irr, round(max_irr, 4) AS max_irr, round(max_irr - min_irr, 4) AS range_irr,
    (SELECT conv FROM k ORDER BY k.n DESC, conv LIMIT 1) AS most_common_convention, (SELECT '{{' || string_agg('"' || conv || '":' || k.n, ',' ORDER BY conv) || '}}' FROM k) AS distribution,
    round((SELECT k.n FROM k WHERE conv = first) / n::DOUBLE, 4) AS consistency, CASE WHEN max_irr - min_irr < 5 THEN 'LOW' WHEN max_irr - min_irr < 20 THEN 'MODERATE' ELSE 'HIGH' END AS variability FROM a"""


def chosen_factor() -> str:
    """The candidate with the best rejection in the sweep, the earlier one of equals; the base factor where none is in it."""
    from ..operators import quality as texts

    return f"""
SELECT file_id, coalesce(factor, base) AS factor, irr_db, CASE WHEN irr_db > 10 THEN 'GOOD' WHEN irr_db > 0 THEN 'OK' ELSE 'POOR' END AS grade FROM (
    SELECT c.file_id, base, CASE WHEN irr_db IS NOT NULL THEN c.factor END AS factor, irr_db, row_number() OVER (PARTITION BY c.file_id ORDER BY irr_db DESC NULLS LAST, place) AS rank
    FROM ({dialect.duck(texts.SAMPLING_CANDIDATES)}) c LEFT JOIN ({over_samples(SWEEP)}) s ON s.file_id = c.file_id AND s.factor = c.factor) WHERE rank = 1"""


AUTO_THRESHOLD = """
WITH b AS (SELECT file_id, sum(i * i + q * q) OVER (PARTITION BY file_id ORDER BY n ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4 AS y FROM v_s)
SELECT file_id, round(10 * log10(greatest(quantile_cont(y, 0.98), 1e-12) * pow(10, 0.6) + 1e-12), 4) AS threshold_db FROM b GROUP BY file_id"""

CHUNK_PLAN = """
WITH t AS (SELECT CAST(c_custkey AS VARCHAR) AS file_id, CAST(floor(abs(c_acctbal) * 40 + 1000) AS BIGINT) AS frames FROM customer),
c AS (SELECT file_id, frames, unnest(range(CAST(least(20, ceil(greatest(0, frames - 5000 - 30000) / 25000.0) + 1) AS BIGINT))) AS interval_id FROM t WHERE frames > 5000)
SELECT file_id, interval_id, 5000 + interval_id * 25000 AS start_sample, least(5000 + interval_id * 25000 + 30000, frames) AS end_sample FROM c"""

EVENLY_SPACED = """
WITH t AS (SELECT CAST(c_custkey AS VARCHAR) AS file_id, CAST(floor(abs(c_acctbal) * 40 + 1000) AS BIGINT) AS frames FROM customer),
c AS (SELECT *, unnest(range(10)) AS interval_id FROM t WHERE frames >= 5000)
SELECT file_id, interval_id, least(interval_id * greatest(1, (frames - 5000) // 9), frames - 5000) AS start_sample, least(interval_id * greatest(1, (frames - 5000) // 9), frames - 5000) + 5000 AS end_sample FROM c"""

SAMPLING_DECISION = """
WITH t AS (SELECT CAST(c_custkey AS VARCHAR) AS file_id, CAST(floor(abs(c_acctbal) * 40 + 1000) AS BIGINT) AS frames FROM customer),
d AS (SELECT *, frames / 1000.0 > 60 AND frames > 100000 AS sampled FROM t)
SELECT file_id, sampled, CAST(CASE WHEN sampled THEN ceil(frames / 1000.0 / 60) ELSE 1 END AS BIGINT) AS factor, round(1000.0::DOUBLE / CASE WHEN sampled THEN ceil(frames / 1000.0 / 60) ELSE 1 END, 6) AS fs_hz FROM d"""

#: The last column of a waterfall stands for what is missing of its thumbnail block.
THUMBNAIL = dialect.duck(f"""WITH {spectrum._GRID.strip()}, w AS (SELECT *, max(t) OVER (PARTITION BY file_id) AS last FROM grid),
g AS (SELECT file_id, t div 8 AS t, f div 4 AS f, db, CASE WHEN t = last THEN 8 - t % 8 ELSE 1 END AS weight FROM w)
SELECT file_id, t, f, round(max(db), 6) AS max_db, round(sum(db * weight) / sum(weight), 6) AS mean_db FROM g GROUP BY file_id, t, f""")

PREDICTIONS = dialect.duck(f"""
WITH b AS ({activity.BURSTS.strip()})
SELECT CAST(file_id AS STRING) AS file, CAST(file_id AS STRING) AS file_id, burst_id, pred_label, avg_prob AS avg_prob_top1, start_s AS start_time_s, end_s AS end_time_s, round(end_s - start_s, 6) AS duration_s,
    regexp_replace(strftime(TIMESTAMP '2024-05-01 12:00:00' + to_microseconds(CAST(round(start_s * 1e6) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%f'), '[.]000000$', '') || '+00:00' AS start_time_abs,
    regexp_replace(strftime(TIMESTAMP '2024-05-01 12:00:00' + to_microseconds(CAST(round(end_s * 1e6) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%f'), '[.]000000$', '') || '+00:00' AS end_time_abs,
    offset_hz AS rf_offset_hz, center_hz_abs AS rf_center_hz_abs, bandwidth_hz, snr_db FROM b""")

BURSTS = dialect.duck(f"WITH b AS ({activity.BURSTS.strip()}) SELECT file_id, burst_id, pred_label, avg_prob AS avg_prob_top1, start_s AS start_time_s, end_s AS end_time_s, offset_hz AS rf_offset_hz, bandwidth_hz, snr_db FROM b")

SEGMENT_SPANS = dialect.duck(f"""
WITH u AS (SELECT file_id, CAST(round(start_s * 1e6) AS BIGINT) AS a, CAST(round(end_s * 1e6) AS BIGINT) AS b FROM {{segments}} WHERE end_s >= start_s),
o AS (SELECT *, CASE WHEN a - max(b) OVER (PARTITION BY file_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {round(activity.GROUP_GAP * 1e6)} THEN 0 ELSE 1 END AS opens FROM u),
g AS (SELECT *, sum(opens) OVER (PARTITION BY file_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM o)
SELECT file_id, min(a) / 1e6 AS start_s, max(b) / 1e6 AS end_s, count(*) AS n_segments FROM g GROUP BY file_id, island""")

CLIP_RATES = """
SELECT vec_id AS clip_index, CASE WHEN vec_id % 3 = 0 THEN 32.0 + label WHEN vec_id % 3 = 1 THEN 48.0 ELSE 48.0 END::DOUBLE AS fs_hz FROM embeddings"""


def over_samples(sql: str) -> str:
    """A text over v_s, the sample view."""
    from ..sources.tables import DUCK

    return f"WITH v_s AS ({DUCK['s']}), {sql.strip().removeprefix('WITH ')}"


_QA = """
WITH k AS (SELECT coalesce(carrier_index, -1) AS carrier, * FROM v_d),
per AS (SELECT carrier, count(*) AS n_clips, median(f_center_hz_rel) AS f0, median(bw_hz_est) AS bw, avg(confidence) AS conf, count(DISTINCT pred_name) AS classes FROM k GROUP BY carrier),
cls AS (SELECT carrier, pred_name, count(*) AS c, avg(confidence) AS conf, min(clip_index) AS seen FROM k GROUP BY carrier, pred_name),
dom AS (SELECT carrier, arg_max(pred_name, c * 1000000000 - seen) AS dominant, max(c) AS c FROM cls GROUP BY carrier),
j AS (SELECT per.*, dominant, dom.c / n_clips AS share, cls.conf AS dominant_conf FROM per JOIN dom USING (carrier) JOIN cls ON cls.carrier = per.carrier AND cls.pred_name = dominant),
q AS (SELECT *, share < 0.75 OR conf < 0.70 AS review, concat_ws('; ', CASE WHEN share < 0.75 THEN printf('low_dominance:%.2f', floor(share * 100 + 0.5) / 100) END, CASE WHEN conf < 0.70 THEN printf('low_conf_mean:%.2f', floor(conf * 100 + 0.5) / 100) END) AS reason FROM j)"""


def qa(select: str) -> str:
    from ..sources.tables import DUCK

    return f"WITH v_d AS ({DUCK['detections']}), {_QA.strip().removeprefix('WITH ')} {select}"


_ROW = "SELECT carrier, f0, bw, n_clips, dominant, printf('%.2f', floor(share * 100 + 0.5) / 100) AS share, printf('%.2f', floor(dominant_conf * 100 + 0.5) / 100) AS dominant_conf, CASE WHEN review THEN 'review' ELSE 'clean' END AS status, reason FROM q WHERE"
QA = {
    "q_qa_clean": qa(f"{_ROW} NOT review"),
    "q_qa_review": qa(f"{_ROW} review"),
    "q_qa_conflicts": qa("SELECT q.carrier, f0, bw, n_clips, (SELECT string_agg(pred_name || ':' || c, '; ' ORDER BY c DESC, seen) FROM cls WHERE cls.carrier = q.carrier) AS breakdown, printf('%.2f', floor(share * 100 + 0.5) / 100) AS share, printf('%.2f', floor(dominant_conf * 100 + 0.5) / 100) AS dominant_conf FROM q WHERE classes > 1"),
    "q_qa_summary": qa("SELECT (SELECT count(*) FROM k) AS clips, (SELECT count(*) FROM k WHERE confidence < 0.70) AS low_conf, count(*) AS carriers, count_if(review) AS to_review, count_if(classes > 1) AS conflicts FROM q"),
}

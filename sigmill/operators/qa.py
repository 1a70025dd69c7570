"""Quality assurance of {detections} by carrier, batch progress: plain relational plans.

A missing carrier is -1. Of equally frequent classes the one seen first (smallest clip_index) dominates. Shares and
confidences are reported with two decimals, halves up.
"""

from __future__ import annotations

CONF, DOMINANCE = 0.70, 0.75


def _two(x: str) -> str:
    return f"format_string('%.2f', floor(({x}) * 100 + 0.5D) / 100.0D)"


def _carriers(conf: float, dominance: float) -> str:
    return f"""
k AS (SELECT coalesce(carrier_index, -1) AS carrier, pred_name, confidence, clip_index, f_center_hz_rel, bw_hz_est FROM {{detections}}),
h AS (SELECT carrier, pred_name, count(*) AS c, min(clip_index) AS seen, sum(confidence) AS conf FROM k GROUP BY carrier, pred_name),
d AS (SELECT *, row_number() OVER (PARTITION BY carrier ORDER BY c DESC, seen) AS rk, sum(c) OVER (PARTITION BY carrier) AS total, sum(conf) OVER (PARTITION BY carrier) AS all_conf, count(*) OVER (PARTITION BY carrier) AS classes FROM h),
md AS (SELECT carrier, percentile(f_center_hz_rel, 0.5D) AS f0, percentile(bw_hz_est, 0.5D) AS bw FROM k GROUP BY carrier),
q AS (SELECT d.carrier, pred_name AS dominant, total AS n_clips, classes, f0, bw, {_two("c * 1.0D / total")} AS share, {_two("conf / c")} AS dominant_conf,
    CASE WHEN c * 1.0D / total < {dominance}D THEN concat('low_dominance:', {_two("c * 1.0D / total")}) END AS r1, CASE WHEN all_conf / total < {conf}D THEN concat('low_conf_mean:', {_two("all_conf / total")}) END AS r2
    FROM d JOIN md ON d.carrier = md.carrier WHERE rk = 1)""".strip()


def carriers(review: bool, conf: float = CONF, dominance: float = DOMINANCE) -> str:
    """The carriers to review, or the clean ones, by number."""
    status = "(r1 IS NOT NULL OR r2 IS NOT NULL)"
    return f"WITH {_carriers(conf, dominance)} SELECT carrier, f0, bw, CAST(n_clips AS BIGINT) AS n_clips, dominant, share, dominant_conf, '{'review' if review else 'clean'}' AS status, concat_ws('; ', r1, r2) AS reason FROM q WHERE {status if review else 'NOT ' + status} ORDER BY carrier"


def conflicts(conf: float = CONF, dominance: float = DOMINANCE) -> str:
    """Carriers of more than one class, with all classes by count."""
    return f"""WITH {_carriers(conf, dominance)},
b AS (SELECT carrier, concat_ws('; ', transform(array_sort(collect_list(named_struct('a', -c, 'b', seen, 't', concat(pred_name, ':', c)))), x -> x.t)) AS breakdown FROM h GROUP BY carrier)
SELECT q.carrier, f0, bw, CAST(n_clips AS BIGINT) AS n_clips, breakdown, share, dominant_conf FROM q JOIN b ON q.carrier = b.carrier WHERE classes > 1 ORDER BY carrier"""


def low_confidence(conf: float = CONF) -> str:
    """Clips under the confidence, with the SNR of {features}(clip_index, snr_db, row_no): of repeated rows the last one's."""
    return f"""
SELECT d.clip_index, d.pred_name, {_two("d.confidence")} AS confidence, f.snr_db, d.carrier_index, d.f_center_hz_rel, d.bw_hz_est FROM {{detections}} d
LEFT JOIN (SELECT clip_index, max_by(snr_db, row_no) AS snr_db FROM {{features}} GROUP BY clip_index) f ON d.clip_index = f.clip_index WHERE d.confidence < {conf}D"""


def summary(conf: float = CONF, dominance: float = DOMINANCE) -> str:
    return f"WITH {_carriers(conf, dominance)} SELECT CAST(sum(n_clips) AS BIGINT) AS clips, (SELECT count(*) FROM k WHERE confidence < {conf}D) AS low_conf, count(*) AS carriers, count(CASE WHEN r1 IS NOT NULL OR r2 IS NOT NULL THEN 1 END) AS to_review, count(CASE WHEN classes > 1 THEN 1 END) AS conflicts FROM q"


BATCH_SUMMARY = "SELECT count(CASE WHEN status = 'completed' THEN 1 END) AS completed, count(CASE WHEN status = 'failed' THEN 1 END) AS failed, round(count(CASE WHEN status = 'completed' THEN 1 END) * 1.0D / greatest(count(CASE WHEN status <> 'pending' THEN 1 END), 1), 6) AS success_rate, round(avg(CASE WHEN status = 'completed' THEN seconds END), 4) AS avg_seconds FROM {progress}"
PENDING_FILES = "SELECT a.file_id FROM (SELECT DISTINCT file_id FROM {progress}) a LEFT ANTI JOIN (SELECT file_id FROM {progress} WHERE status = 'completed') b ON a.file_id = b.file_id"


def file_success(least: float = 0.8) -> str:
    """Files of which so large a share of chunks is complete; here a file is the orders of one remainder."""
    return f"SELECT file_id % 100 AS file_id, count(*) AS chunks, round(count(CASE WHEN status = 'completed' THEN 1 END) * 1.0D / count(*), 6) AS share FROM {{progress}} GROUP BY file_id % 100 HAVING count(CASE WHEN status = 'completed' THEN 1 END) >= {least}D * count(*)"

"""Features of short clips {clips}(clip_index, carrier_index, n, i, q) at FS samples a second; N samples each.

Clips of any length, as arrays, take `features`; its queries have the spectra here as their oracle.
"""

from __future__ import annotations

FS, N = 32, 32
TAU = "6.283185307179586D"

CLIP_ENERGY = "SELECT clip_index, count(*) AS n, round(10 * log10(greatest(avg((i * i + q * q) / 2), 1e-12)), 6) AS energy_db FROM {clips} GROUP BY clip_index"
CLIP_KURTOSIS = """
WITH e AS (SELECT clip_index, sqrt(i * i + q * q) AS a FROM {clips}), m AS (SELECT clip_index, avg(a) AS mu, stddev_pop(a) + 1e-12 AS sd FROM e GROUP BY clip_index)
SELECT e.clip_index, round(avg(pow((a - mu) / sd, 4)), 6) AS env_kurt FROM e JOIN m ON e.clip_index = m.clip_index GROUP BY e.clip_index"""

#: Power of each of the N unshifted DFT bins.
_POWER = f"""
w AS (SELECT clip_index, carrier_index, k, sum(i * cos({TAU} * k * n / {N}) + q * sin({TAU} * k * n / {N})) AS re, sum(q * cos({TAU} * k * n / {N}) - i * sin({TAU} * k * n / {N})) AS im
    FROM {{clips}} CROSS JOIN (SELECT k FROM {{bins}} WHERE k < {N}) b GROUP BY clip_index, carrier_index, k),
p AS (SELECT clip_index, carrier_index, k, (k + {N // 2}) % {N} AS bin, (re * re + im * im) / ({FS} * {N}.0D) AS power FROM w)"""
#: The same of Hann windowed samples, as a density.
_DENSITY = f"""
w AS (SELECT clip_index, k, sum((0.5D - 0.5D * cos({TAU} * n / {N})) * (i * cos({TAU} * k * n / {N}) + q * sin({TAU} * k * n / {N}))) AS re, sum((0.5D - 0.5D * cos({TAU} * n / {N})) * (q * cos({TAU} * k * n / {N}) - i * sin({TAU} * k * n / {N}))) AS im
    FROM {{clips}} CROSS JOIN (SELECT k FROM {{bins}} WHERE k < {N}) b GROUP BY clip_index, k),
p AS (SELECT clip_index, (k + {N // 2}) % {N} AS bin, (re * re + im * im) / ({FS} * {0.375 * N}D) AS power FROM w)"""
CLIP_PSD = f"WITH {_DENSITY.strip()} SELECT clip_index, bin, (bin - {N // 2}) * {FS / N}D AS f_hz, round(power, 6) AS power FROM p"
CLIP_FLATNESS = f"WITH {_DENSITY.strip()} SELECT clip_index, round(exp(avg(ln(power + 1e-20))) / (avg(power) + 1e-20), 6) AS sfm FROM p GROUP BY clip_index"
#: The strongest bin, the nearest bins 6 dB below it on both sides, and its height over the median.
CLIP_SNR_BW = f"""
WITH {_DENSITY.strip()},
d AS (SELECT clip_index, bin, 10 * log10(greatest(power, 1e-20)) AS db FROM p),
t AS (SELECT clip_index, max(db) AS top, percentile(db, 0.5D) AS floor_db FROM d GROUP BY clip_index),
k AS (SELECT d.clip_index, min(bin) AS peak FROM d JOIN t ON d.clip_index = t.clip_index AND d.db = t.top GROUP BY d.clip_index),
s AS (SELECT d.clip_index, max(CASE WHEN bin < peak AND db <= top - 6 THEN bin ELSE 0 END) AS l, min(CASE WHEN bin > peak AND db <= top - 6 THEN bin ELSE {N - 1} END) AS r, max(top - floor_db) AS snr FROM d JOIN t ON d.clip_index = t.clip_index JOIN k ON d.clip_index = k.clip_index GROUP BY d.clip_index)
SELECT clip_index, round(snr, 6) AS snr_db, (r - l) * {FS / N}D AS bw_hz FROM s"""

#: C20, C40, C41, C42 after mean removal, normalised by power. x^2 = a + jb, x^4 = (a^2 - b^2) + 2jab.
CLIP_CUMULANTS = """
WITH m AS (SELECT clip_index, avg(i) AS mi, avg(q) AS mq FROM {clips} GROUP BY clip_index),
x AS (SELECT c.clip_index, i - mi AS u, q - mq AS v FROM {clips} c JOIN m ON c.clip_index = m.clip_index),
y AS (SELECT clip_index, u * u - v * v AS a, 2 * u * v AS b, u * u + v * v AS p FROM x),
e AS (SELECT clip_index, avg(a) AS a, avg(b) AS b, avg(p) AS p, avg(p) + 1e-12 AS pn, avg(a * a - b * b) AS a4, avg(2 * a * b) AS b4, avg(a * p) AS a3, avg(b * p) AS b3 FROM y GROUP BY clip_index)
SELECT clip_index, round(a / pn, 6) + 0.0D AS c20_r, round(b / pn, 6) + 0.0D AS c20_i, round((a4 - 3 * (a * a - b * b)) / (pn * pn), 6) + 0.0D AS c40_r, round((b4 - 6 * a * b) / (pn * pn), 6) + 0.0D AS c40_i,
    round((a3 - 3 * a * p) / (pn * pn), 6) + 0.0D AS c41_r, round((b3 - 3 * b * p) / (pn * pn), 6) + 0.0D AS c41_i, round((a4 - (a * a + b * b) - 2 * p * p) / (pn * pn), 6) + 0.0D AS c42_r, round(b4 / (pn * pn), 6) + 0.0D AS c42_i FROM e"""
CLIP_CFO = f"""
WITH l AS (SELECT clip_index, i, q, lead(i) OVER (PARTITION BY clip_index ORDER BY n) AS i1, lead(q) OVER (PARTITION BY clip_index ORDER BY n) AS q1 FROM {{clips}})
SELECT clip_index, round(atan2(sum(i * q1 - q * i1), sum(i * i1 + q * q1)) / {TAU} * {FS}, 6) AS cfo_hz FROM l GROUP BY clip_index"""

_LAGS = "PARTITION BY clip_index ORDER BY n"
#: Amplitude, wrapped and unwrapped phase and their differences; first differences begin with 0.
CLIP_CHANNELS = f"""
WITH a AS (SELECT clip_index, n, sqrt(i * i + q * q) AS amp, atan2(q, i) AS phase FROM {{clips}}),
d AS (SELECT *, coalesce(phase - lag(phase) OVER ({_LAGS}), 0.0D) AS step FROM a),
u AS (SELECT *, phase + sum(CASE WHEN abs(step) < 3.141592653589793D THEN 0.0D WHEN step > 0 THEN -{TAU} ELSE {TAU} END) OVER ({_LAGS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS unwrapped FROM d)
SELECT clip_index, n, round(amp, 6) AS amp, round(cos(phase), 6) + 0.0D AS cosphi, round(sin(phase), 6) + 0.0D AS sinphi, round(unwrapped, 6) + 0.0D AS phase, round(unwrapped - coalesce(lag(unwrapped) OVER ({_LAGS}), unwrapped), 6) + 0.0D AS dfreq,
    round(amp - coalesce(lag(amp) OVER ({_LAGS}), amp), 6) + 0.0D AS d_amp, round(coalesce(lead(unwrapped) OVER ({_LAGS}), unwrapped) - 2 * unwrapped + coalesce(lag(unwrapped) OVER ({_LAGS}), unwrapped), 6) + 0.0D AS d2phase FROM u"""
CLIP_NORMALISED = """
WITH s AS (SELECT clip_index, percentile(greatest(abs(i), abs(q)), 0.999D) AS p, max(greatest(abs(i), abs(q))) AS top FROM {clips} GROUP BY clip_index),
c AS (SELECT clip_index, CASE WHEN p >= 1e-6 THEN p WHEN top > 0 THEN top ELSE 1.0D END AS scale FROM s)
SELECT x.clip_index, n, round(greatest(-4.0D, least(4.0D, i / scale)), 6) + 0.0D AS i, round(greatest(-4.0D, least(4.0D, q / scale)), 6) + 0.0D AS q FROM {clips} x JOIN c ON x.clip_index = c.clip_index"""

#: Image rejection of the three conventions from one transform: I-Q and Q+I mirror the spectrum of I+Q.
_IRR = f"""
{_POWER.strip()},
b AS (SELECT clip_index, carrier_index, sum(CASE WHEN k BETWEEN 1 AND {N // 2 - 1} THEN power ELSE 0.0D END) + 1e-12 AS pos, sum(CASE WHEN k >= {N // 2} THEN power ELSE 0.0D END) + 1e-12 AS neg,
    sum(CASE WHEN k > {N // 2} THEN power ELSE 0.0D END) + 1e-12 AS mpos, sum(CASE WHEN k BETWEEN 1 AND {N // 2} THEN power ELSE 0.0D END) + 1e-12 AS mneg FROM p GROUP BY clip_index, carrier_index),
r AS (SELECT clip_index, carrier_index, 10 * log10(pos / neg) AS plain, 10 * log10(mpos / mneg) AS mirrored FROM b)"""
IRR_CONVENTIONS = f"WITH {_IRR.strip()} SELECT clip_index, 'I_Q' AS conv, round(plain, 6) AS irr_db FROM r UNION ALL SELECT clip_index, 'I_neg_Q', round(mirrored, 6) FROM r UNION ALL SELECT clip_index, 'Q_I', round(mirrored, 6) FROM r"
BEST_CONVENTION = f"WITH {_IRR.strip()} SELECT clip_index, CASE WHEN plain >= mirrored THEN 'I_Q' ELSE 'I_neg_Q' END AS best, round(abs(greatest(plain, mirrored)), 6) AS irr_db FROM r"
IRR_VARIABILITY = f"""
WITH {_IRR.strip()},
v AS (SELECT carrier_index, clip_index, greatest(plain, mirrored) AS irr, CASE WHEN plain >= mirrored THEN 'I_Q' ELSE 'I_neg_Q' END AS conv FROM r),
f AS (SELECT carrier_index, min_by(conv, clip_index) AS first_conv FROM v GROUP BY carrier_index),
st AS (SELECT v.carrier_index, count(*) AS n, avg(irr) AS mean_irr, stddev_pop(irr) AS std_irr, min(irr) AS min_irr, max(irr) AS max_irr, avg(CASE WHEN conv = first_conv THEN 1.0D ELSE 0.0D END) AS consistency FROM v JOIN f ON v.carrier_index = f.carrier_index GROUP BY v.carrier_index)
SELECT carrier_index, n, round(mean_irr, 6) AS mean_irr, round(std_irr, 6) AS std_irr, round(min_irr, 6) AS min_irr, round(max_irr, 6) AS max_irr, round(max_irr - min_irr, 6) AS range_irr, round(consistency, 6) AS consistency,
    CASE WHEN max_irr - min_irr < 2 THEN 'LOW' WHEN max_irr - min_irr < 10 THEN 'MODERATE' ELSE 'HIGH' END AS variability FROM st"""

#: A fixed linear scorer of five classes stands for a trained model; softmax, best label, unknown below a confidence.
SOFTMAX_LABELS = """
WITH a AS (SELECT clip_index, avg(i) AS mi, avg(q) AS mq, avg(i * i + q * q) AS p FROM {clips} GROUP BY clip_index),
l AS (SELECT clip_index, k, 4 * (mi * cos(k * 1.0D) + mq * sin(k * 1.0D)) + p * k / 100.0D AS z FROM a CROSS JOIN (SELECT k FROM {bins} WHERE k < 5) b),
e AS (SELECT clip_index, k, exp(z - max(z) OVER (PARTITION BY clip_index)) AS x FROM l),
s AS (SELECT clip_index, k, x / sum(x) OVER (PARTITION BY clip_index) AS p, row_number() OVER (PARTITION BY clip_index ORDER BY x DESC, k) AS rk FROM e)
SELECT clip_index, k AS pred_idx, CASE WHEN p < 0.25 THEN 'UNKNOWN' WHEN k = 0 THEN 'am' WHEN k = 1 THEN 'fm' ELSE concat('class_', CAST(k AS STRING)) END AS pred_label, round(p, 6) AS prob_top1 FROM s WHERE rk = 1"""

#: A model's input: amplitude, phase and its difference beside the normalised samples, tiled to CHANNELS channels.
CHANNELS = 14
ENRICHED = f"""
WITH x AS ({CLIP_NORMALISED.strip()}),
a AS (SELECT clip_index, n, i, q, sqrt(i * i + q * q) AS amp, atan2(q, i) AS phase FROM x),
d AS (SELECT *, coalesce(phase - lag(phase) OVER ({_LAGS}), 0.0D) AS dphase FROM a)
SELECT clip_index, n, k AS channel, round(CASE k % 5 WHEN 0 THEN i WHEN 1 THEN q WHEN 2 THEN amp WHEN 3 THEN phase ELSE dphase END, 6) + 0.0D AS x FROM d CROSS JOIN (SELECT k FROM {{bins}} WHERE k < {CHANNELS}) t"""

WIN, HOP = 16, 8
#: Whole frames of WIN samples, HOP apart: a sample belongs to the frames that begin in its own step and the one before.
_FRAMES = f"""
fr AS (SELECT clip_index, n div {HOP} - k AS frame, n - (n div {HOP} - k) * {HOP} AS m, i, q FROM {{clips}} CROSS JOIN (SELECT k FROM {{bins}} WHERE k < {WIN // HOP}) h WHERE n div {HOP} - k BETWEEN 0 AND {(N - WIN) // HOP})"""
FRAMES_STANDARDISED = f"""
WITH {_FRAMES.strip()},
st AS (SELECT clip_index, frame, avg(i) AS mi, greatest(stddev_samp(i), 1e-6) AS si, avg(q) AS mq, greatest(stddev_samp(q), 1e-6) AS sq FROM fr GROUP BY clip_index, frame)
SELECT fr.clip_index, fr.frame, m, round((i - mi) / si, 6) + 0.0D AS i, round((q - mq) / sq, 6) + 0.0D AS q FROM fr JOIN st ON fr.clip_index = st.clip_index AND fr.frame = st.frame"""
#: Log power below and above a quarter of the one-sided bins of a short Hann spectrum, and its flatness.
BAND_ENERGY = f"""
WITH {_FRAMES.strip()},
wd AS (SELECT clip_index, frame, m, i * (0.5D - 0.5D * cos({TAU} * m / {WIN})) AS u, q * (0.5D - 0.5D * cos({TAU} * m / {WIN})) AS v FROM fr),
sp AS (SELECT clip_index, frame, k, sum(u * cos({TAU} * k * m / {WIN}) + v * sin({TAU} * k * m / {WIN})) AS re, sum(v * cos({TAU} * k * m / {WIN}) - u * sin({TAU} * k * m / {WIN})) AS im
    FROM wd CROSS JOIN (SELECT k FROM {{bins}} WHERE k <= {WIN // 2}) b GROUP BY clip_index, frame, k),
p AS (SELECT clip_index, k, avg(re * re + im * im) AS power FROM sp GROUP BY clip_index, k)
SELECT clip_index, round(ln(avg(CASE WHEN k < {(WIN // 2 + 1) // 4} THEN power END) + 1e-12), 6) AS band_lo, round(ln(avg(CASE WHEN k >= {(WIN // 2 + 1) // 4} THEN power END) + 1e-12), 6) AS band_hi,
    round(exp(avg(ln(power + 1e-12))) / (avg(power) + 1e-12), 6) AS spec_flat FROM p GROUP BY clip_index"""

SHIFT_HZ, TAPS, CUTOFF, FACTOR = 4, 7, 0.2, 2
#: SHIFT_HZ mixed to DC, a Hamming low-pass of unit gain, every FACTOR-th sample.
RETUNED = f"""
WITH t AS (SELECT k, CASE WHEN k = {TAPS // 2} THEN 2 * {CUTOFF}D ELSE sin({TAU} * {CUTOFF}D * (k - {TAPS // 2})) / ({TAU} / 2 * (k - {TAPS // 2})) END * (0.54D - 0.46D * cos({TAU} * k / {TAPS - 1})) AS h FROM {{bins}} WHERE k < {TAPS}),
g AS (SELECT sum(h) AS gain FROM t),
x AS (SELECT clip_index, n, i * cos({TAU} * {SHIFT_HZ} * n / {FS}) + q * sin({TAU} * {SHIFT_HZ} * n / {FS}) AS u, q * cos({TAU} * {SHIFT_HZ} * n / {FS}) - i * sin({TAU} * {SHIFT_HZ} * n / {FS}) AS v FROM {{clips}}),
y AS (SELECT clip_index, n + k - {TAPS // 2} AS j, u * h / gain AS u, v * h / gain AS v FROM x CROSS JOIN t CROSS JOIN g WHERE n + k - {TAPS // 2} BETWEEN 0 AND {N - 1})
SELECT clip_index, j div {FACTOR} AS n, round(sum(u), 6) + 0.0D AS i, round(sum(v), 6) + 0.0D AS q FROM y WHERE j % {FACTOR} = 0 GROUP BY clip_index, j div {FACTOR}"""

#: Rejection as recorded beside that of the mirrored convention: the gain's verdict and the band of the better one.
IRR_VERDICT = f"""
WITH {_IRR.strip()}
SELECT clip_index, round(plain, 6) AS recorded_db, round(mirrored, 6) AS corrected_db, round(mirrored - plain, 6) AS gain_db,
    CASE WHEN mirrored - plain > 5 THEN 'significant' WHEN mirrored - plain > 1 THEN 'moderate' WHEN mirrored - plain > -1 THEN 'minimal' ELSE 'degraded' END AS verdict,
    CASE WHEN greatest(plain, mirrored) > 30 THEN 'excellent' WHEN greatest(plain, mirrored) >= 20 THEN 'good' WHEN greatest(plain, mirrored) >= 10 THEN 'marginal' WHEN greatest(plain, mirrored) >= 5 THEN 'poor' ELSE 'very_poor' END AS band FROM r"""
#: Two measurements of a carrier (its first and last clip) agree if the names correspond and the values lie within 3 dB.
VERIFY_CONVENTION = f"""
WITH {_IRR.strip()},
v AS (SELECT carrier_index, clip_index, greatest(plain, mirrored) AS irr, plain >= mirrored AS direct FROM r),
e AS (SELECT carrier_index, min_by(irr, clip_index) AS irr1, max_by(irr, clip_index) AS irr2, CASE WHEN min_by(direct, clip_index) THEN 'I+jQ' ELSE 'I-jQ' END AS best1, CASE WHEN max_by(direct, clip_index) THEN 'I+Q' ELSE 'I-Q' END AS best2 FROM v GROUP BY carrier_index),
names AS (SELECT 'I+jQ' AS was, 'I+Q' AS becomes UNION ALL SELECT 'I-jQ', 'I-Q' UNION ALL SELECT 'Q+jI', 'Q+I' UNION ALL SELECT 'Q-jI', 'Q-I')
SELECT carrier_index, best1, best2, becomes AS expected, round(irr2 - irr1, 6) AS diff_db, becomes = best2 AND abs(irr2 - irr1) < 3 AS verified, CASE WHEN becomes <> best2 THEN 'mapping' WHEN abs(irr2 - irr1) >= 3 THEN 'level' ELSE 'ok' END AS outcome
FROM e LEFT JOIN names ON e.best1 = names.was"""

#: Cumulants as channels: the real part of each, the same for all samples of a clip.
CUMULANT_CHANNELS = f"""
WITH u AS ({CLIP_CUMULANTS.strip()})
SELECT c.clip_index, c.n, u.c20_r AS cum20, u.c40_r AS cum40, u.c41_r AS cum41, u.c42_r AS cum42 FROM {{clips}} c JOIN u ON c.clip_index = u.clip_index"""
#: All features of a clip in one row.
FEATURES = f"""
WITH a AS ({CLIP_SNR_BW.strip()}), b AS ({CLIP_FLATNESS.strip()}), k AS ({CLIP_KURTOSIS.strip()}), u AS ({CLIP_CUMULANTS.strip()}), o AS ({CLIP_CFO.strip()})
SELECT a.clip_index, {FS}.0D AS fs_hz, {N} AS t, snr_db, bw_hz, sfm, env_kurt, c20_r, c20_i, c40_r, c40_i, c41_r, c41_i, c42_r, c42_i, cfo_hz
FROM a JOIN b ON a.clip_index = b.clip_index JOIN k ON a.clip_index = k.clip_index JOIN u ON a.clip_index = u.clip_index JOIN o ON a.clip_index = o.clip_index"""


def channel_list(extras: str, also: tuple[str, ...] = ("i", "q")) -> list[str]:
    """The channels asked for by a comma list, after the samples themselves: trimmed, lower case, unknown ones left out, cumulants last."""
    known = ("amp", "phase", "dfreq", "cosphi", "sinphi", "d_amp", "d2phase")
    asked = [w.strip().lower() for w in extras.split(",") if w.strip()]
    return [*also, *(w for w in asked if w in known), *(w for w in ("cum20", "cum40", "cum41", "cum42") if w in asked)]


def engineered(extras: str = "amp,phase,dfreq,cosphi,sinphi,d_amp,d2phase") -> str:
    """Rows (clip_index, n, the channels of the list), by sample."""
    names = channel_list(extras, ())
    columns = "".join(f", {'m' if w.startswith('cum') else 'h'}.{w}" for w in names)
    return f"""WITH h AS ({CLIP_CHANNELS.strip()}), m AS ({CUMULANT_CHANNELS.strip()})
SELECT c.clip_index, c.n, c.i, c.q{columns} FROM {{clips}} c JOIN h ON c.clip_index = h.clip_index AND c.n = h.n JOIN m ON c.clip_index = m.clip_index AND c.n = m.n"""

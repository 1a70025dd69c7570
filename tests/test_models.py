"""Operators against sequential or NumPy models written from their definitions, on random input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigmill.functions import kernels
from sigmill.operators import activity, assessment, clips, extraction, inference, irr, qa, quality, wideband
from sigmill.operators import captures as ops
from sigmill.operators import intervals as iv
from sigmill.plans import catalogue, dialect, outputs
from sigmill.sources import files as tables

SAMPLES = "file_id string, chunk_id long, n long, i double, q double"
BLOCK = "file_id string, chunk_id long, block_id long, start_sample long, n int, fs_hz double, i array<double>, q array<double>"


def blocks_of(spark, x, frames, fs=1000.0, chunk=10**9, name="f"):
    rows = [(name, a // chunk, b, a, len(x[a : a + frames]), fs, x[a : a + frames].real.tolist(), x[a : a + frames].imag.tolist()) for b, a in enumerate(range(0, len(x), frames))]
    return spark.createDataFrame(rows, BLOCK)


def samples_of(spark, x, chunk=4096, name="f"):
    return spark.createDataFrame([(name, k // chunk, k, float(v.real), float(v.imag)) for k, v in enumerate(x)], SAMPLES)


def noise(n, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=n) + 1j * rng.normal(size=n)


# scans


def test_strided_scans(spark):
    for total, step in ((50, 7), (49, 7), (48, 7), (5, 7), (10, 1)):
        s = samples_of(spark, np.arange(total) + 0j, 16)
        got = sorted(r["i"] for r in dialect.run(quality.strided_scan(step), s=s).collect())
        assert got == list(range(0, total // step * step, step))
        chunked = sorted(r["n"] for r in dialect.run(quality.chunk_strided_scan(step, 16), s=s).collect())
        assert chunked == [k for k in range(total) if k % 16 % step == 0]
    s = samples_of(spark, np.arange(100) + 0j)
    assert dialect.run(quality.time_window(0.02, 0.02, 1000), s=s).count() == 1 and dialect.run(quality.head_scan(7), s=s).count() == 7


# quality


STATS = {"file_id": "f", "frames": 1000, "fs_hz": 1000.0, "duration_s": 1.0, "nan_count": 0, "inf_count": 0, "i_clip_pct": 0.0, "q_clip_pct": 0.0, "best_convention": "I+jQ", "best_irr_db": 30.0, "envelope_kurtosis": 3.0}
#: By hand: what changes from a clean capture, the score, and the words that must appear.
CASES = [
    ({}, 100, []), ({"nan_count": 3}, 80, ["Found 3 NaN values"]), ({"inf_count": 1, "nan_count": 1}, 60, ["Found 1 infinite values"]), ({"q_clip_pct": 5.1}, 75, ["Severe clipping detected: 5.1%"]), ({"i_clip_pct": 5.0}, 90, ["Moderate clipping detected: 5.0%"]),
    ({"i_clip_pct": 1.0}, 95, ["Minor clipping detected: 1.0%"]), ({"i_clip_pct": 0.1}, 100, []), ({"best_irr_db": 9.9}, 85, ["Poor I/Q balance (IRR: 9.9 dB)"]), ({"best_irr_db": 10.0}, 95, ["Suboptimal I/Q balance (IRR: 10.0 dB)"]), ({"best_irr_db": 20.0}, 100, []),
    ({"best_convention": "I-jQ"}, 100, ["Consider using --conv I -Q in downstream processing"]), ({"envelope_kurtosis": 1.4}, 100, ["Very constant envelope"]), ({"envelope_kurtosis": 10.1}, 100, ["Highly variable envelope"]), ({"duration_s": 0.05}, 100, ["Very short recording (0.050s)"]),
    ({"nan_count": 1, "inf_count": 1, "i_clip_pct": 50.0, "best_irr_db": 1.0}, 20, []),
]


def test_quality_scores_by_hand(spark):
    rows = [{**STATS, **change, "file_id": str(k)} for k, (change, _, _) in enumerate(CASES)]
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for k, v in STATS.items())
    got = {r["file_id"]: r for r in assessment.assess(spark.createDataFrame([tuple(r.values()) for r in rows], schema), 0.1).collect()}
    for k, (_, score, words) in enumerate(CASES):
        r = got[str(k)]
        said = r["issues"] + r["warnings"] + r["recommendations"]
        assert r["quality_score"] == score and len(said) >= len(words) and all(any(w in s for s in said) for w in words), CASES[k]
        assert r["verdict"] == ("good" if score >= 80 else "marginal" if score >= 60 else "poor")
    assert not any("short" in s for r in assessment.assess(spark.createDataFrame([tuple({**STATS, "duration_s": 0.01}.values())], schema)).collect() for s in r["warnings"])


def test_statistics_under_a_large_offset(spark):
    x = 1000 + 1e-3 * noise(5000, 1)
    x[7] = np.nan
    x[9] = np.inf + 0j
    for frames in (512, 5000):
        blocks = blocks_of(spark, x, frames, chunk=frames)
        r = ops.channel_moments(blocks).first()
        ok = x.real[np.isfinite(x.real)]
        assert np.isclose(r["i_std"], ok.std(), rtol=1e-6) and np.isclose(r["i_mean"], ok.mean()) and r["i_peak_abs"] == np.abs(ok).max() and r["i_nan"] == 1 and r["i_inf"] == 1
        env = []
        for a in range(0, 5000, frames):
            i, q = x[a : a + frames].real, x[a : a + frames].imag
            e = np.hypot(i - i[np.isfinite(i)].mean(), q - q[np.isfinite(q)].mean())
            env.append(e[np.isfinite(e)])
        env = np.concatenate(env)
        want = ((env - env.mean()) ** 4).mean() / env.var() ** 2
        assert np.isclose(ops.envelope_kurtosis(blocks).first()["envelope_kurtosis"], want, rtol=1e-6)


# sequential scans


def model_slices(power, chunk, w, thresh, least, gap, pad):
    out = []
    for lo in range(0, len(power), chunk):
        p = power[lo : lo + chunk]
        hi, runs = lo + len(p), []
        for k in range(len(p)):
            part = p[max(0, k - w + 1) : k + 1]
            if 20 * np.log10(max(np.sqrt(part.mean()), 1e-12)) > thresh:
                if runs and lo + k - runs[-1][1] <= gap:
                    runs[-1][1] = lo + k + 1
                else:
                    runs.append([lo + k, lo + k + 1])
        out += [(max(lo, s - pad), min(hi, e + pad)) for s, e in runs]
    merged = []
    for s, e in sorted(x for x in out if x[1] - x[0] >= least):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return merged


def test_slices_against_a_loop(spark):
    rng = np.random.default_rng(3)
    for w, gap, pad, least in ((5, 3, 2, 5), (1, 0, 0, 1), (9, 5, 7, 30)):
        loud = np.repeat(rng.random(120) < 0.3, rng.integers(1, 40, 120))
        x = noise(len(loud), w) * np.where(loud, 0.7, 0.1)
        want = model_slices(np.abs(x) ** 2, 512, w, -4.0, least, gap, pad)
        got = dialect.run(activity.slices(w, -4.0, least, gap, pad), s=samples_of(spark, x, 512)).orderBy("start_sample").collect()
        assert want and [[r["start_sample"], r["end_sample"]] for r in got] == want
        block = ops.activity_slices(blocks_of(spark, x, 256, chunk=512), w, -4.0, least, gap, pad).orderBy("start_sample").collect()
        assert [[r["start_sample"], r["end_sample"]] for r in block] == want


def model_frames(n, size, hop):
    return list(range(0, max(0, n - size) + 1, hop)) if n else []


def model_energies(x, size, hop):
    return [(s, 10 * np.log10(max((np.abs(x[s : s + size]) ** 2).mean() / 2, 1e-12))) for s in model_frames(len(x), size, hop)]


def model_vad(energies, n, size, thr, hang, least, merge):
    found, on = [], None
    for s, e in energies:
        if on is None and e >= thr:
            on = s
        elif on is not None and e <= thr - hang:
            found.append((on, s + size))
            on = None
    if on is not None:
        found.append((on, n))
    out = []
    for s, e in (x for x in found if x[1] - x[0] >= least):
        if out and s - out[-1][1] <= merge:
            out[-1][1] = e
        else:
            out.append([s, e])
    return out


def test_energies_voice_and_thresholds(spark):
    rng = np.random.default_rng(4)
    loud = np.repeat(rng.random(60) < 0.4, rng.integers(20, 200, 60))
    x = noise(len(loud), 4) * np.where(loud, 1.0, 0.2)
    blocks = blocks_of(spark, x, 512)
    for spans in ([(0, 0, len(x))], [(0, 0, 1000), (1, 700, 2500), (2, 2500, 2540), (3, 2600, len(x))]):
        table = spark.createDataFrame([("f", *s) for s in spans], "file_id string, interval_id long, start_sample long, end_sample long")
        energies = iv.frame_energies(blocks, table, 64, 32, 512)
        rows = {(r["interval_id"], r["at"]): r["energy_db"] for r in energies.collect()}
        want = {(k, s): e for k, a, b in spans for s, e in model_energies(x[a:b], 64, 32)}
        assert rows.keys() == want.keys() and all(np.isclose(rows[k], want[k]) for k in want)
        got = sorted((r["interval_id"], r["start"], r["stop"]) for r in iv.voice_segments(energies, -6.0, 3.0, 100, 80, 64).collect())
        assert got == sorted((k, *s) for k, a, b in spans for s in model_vad(model_energies(x[a:b], 64, 32), b - a, 64, -6.0, 3.0, 100, 80)) and got
        for down, smooth, envelope in ((1, 0.54, False), (3, 5.0, False), (1, 7.0, True)):
            thr = {r["interval_id"]: r["threshold_db"] for r in iv.auto_threshold(blocks, table, 1000.0, down, smooth, 0.9, 6.0, envelope, 512).collect()}
            for k, a, b in spans:
                y = np.abs(x[a:b])[::down] ** (1 if envelope else 2)
                win = max(4, int(1000 / down * smooth / 1000))
                y = np.convolve(y, np.ones(win) / win, mode="same") if len(y) >= win else y
                assert np.isclose(thr[k], 10 * np.log10(max(np.quantile(y, 0.9), 1e-12) * 10**0.6 + 1e-12), atol=1e-4), (k, down, smooth)
        scale = {r["interval_id"]: r["scale"] for r in iv.robust_scale(blocks, table, 512).collect()}
        assert all(np.isclose(scale[k], np.percentile(np.maximum(np.abs(x[a:b].real), np.abs(x[a:b].imag)), 99.9), rtol=1e-5) for k, a, b in spans)


@pytest.mark.parametrize("q", [0.0, 0.5, 0.98, 1.0])
def test_exact_quantiles(spark, q):
    rng = np.random.default_rng(int(q * 100))
    parts = {k: [rng.exponential(size=rng.integers(1, 60)).astype(np.float32) for _ in range(5)] for k in range(3)} | {3: [np.zeros(4, np.float32)], 4: [np.float32([2.5])]}
    df = spark.createDataFrame([(k, y.tolist()) for k, ys in parts.items() for y in ys], "key long, y array<float>")
    got = {r["key"]: r for r in iv.exact_quantile(df, ("key",), q).collect()}
    for k, ys in parts.items():
        y = np.concatenate(ys).astype(np.float64)
        assert np.isclose(got[k]["value"], np.quantile(y, q)) and got[k]["n"] == len(y) and got[k]["top"] == y.max()


def model_bursts(rows, gap):
    """rows: (start, segment, end, label, prob, offset, width, snr)"""
    out = []
    for r in sorted(rows):
        if out and r[3] == out[-1][-1][3] and r[3] != "UNKNOWN" and r[0] - max(x[2] for x in out[-1]) <= gap:
            out[-1].append(r)
        else:
            out.append([r])
    return [(b[0][3], round(np.mean([x[4] for x in b]), 6), b[0][0], max(x[2] for x in b), np.average([x[5] for x in b], weights=[x[2] - x[0] for x in b]), max(x[6] for x in b), np.median([x[7] for x in b])) for b in out]


def test_bursts_and_predictions(spark):
    rng = np.random.default_rng(6)
    start = np.cumsum(rng.exponential(0.05, 200)).round(6)
    rows = [(float(s), k, float(round(s + rng.exponential(0.1) + 0.001, 6)), str(rng.choice(["am", "fm", "UNKNOWN"], p=[0.6, 0.3, 0.1])), round(float(rng.random()), 6), float(rng.normal()), float(rng.random()), float(rng.random())) for k, s in enumerate(start)]
    table = spark.createDataFrame([("dir/a b.wav", r[1], r[0], *r[2:]) for r in rows], "file_id string, segment_id long, start_time_s double, end_time_s double, pred_label string, prob_top1 double, rf_offset_hz double, bandwidth_hz double, snr_db double")
    found = inference.bursts(table)
    got = found.orderBy("burst_id").collect()
    for r, w in zip(got, model_bursts(rows, 0.06), strict=True):
        assert r["pred_label"] == w[0] and np.allclose([r["avg_prob_top1"], r["start_time_s"], r["end_time_s"], r["rf_offset_hz"], r["bandwidth_hz"], r["snr_db"]], w[1:])
    from datetime import datetime, timedelta

    for text, begin in (("2024-02-29T23:59:59.5Z", datetime.fromisoformat("2024-02-29T23:59:59.500000+00:00")), ("2024-05-01T12:00:00-03:30", datetime.fromisoformat("2024-05-01T12:00:00-03:30")), ("2024-05-01 12:00", datetime.fromisoformat("2024-05-01 12:00"))):
        for r in inference.predictions(found, 433e6, text).collect():
            assert r["file"] == "a b.wav" and r["rf_center_hz_abs"] == round(433e6 + r["rf_offset_hz"], 1)
            assert r["start_time_abs"] == (begin + timedelta(microseconds=round(r["start_time_s"] * 1e6))).isoformat() and r["end_time_abs"] == (begin + timedelta(microseconds=round(r["end_time_s"] * 1e6))).isoformat()
    for r in inference.predictions(found, None, "yesterday").limit(2).collect():
        assert r["start_time_abs"] is None and r["rf_center_hz_abs"] is None


# spectra


def model_cfar(s, guard, train, k, both=False):
    def line(x):
        out = []
        for p in range(len(x)):
            left, right = x[max(0, p - train - guard) : max(0, p - guard)], x[p + guard + 1 : p + guard + 1 + train]
            ref = np.concatenate([left, right])
            if not len(ref) or both and not (len(left) and len(right)):
                out.append(False)
                continue
            mid = np.median(ref)
            out.append(x[p] > mid + k * 1.4826 * (np.median(np.abs(ref - mid)) + 1e-12))
        return np.array(out, bool)

    return np.stack([line(c) for c in s.T]).T & np.stack([line(r) for r in s])


def test_cfar_and_what_follows(spark, monkeypatch):
    monkeypatch.setattr(wideband, "SPAN", 16)
    rng = np.random.default_rng(9)
    s = rng.normal(size=(70, 20))  # time, frequency
    s[20:30, 7] += 9
    s[50:52, 3:6] += 9
    grid = spark.createDataFrame([("f", t, t * 0.5, s[t].tolist()) for t in range(70)], "file_id string, t_idx long, time_s double, s_db array<double>")
    for chunk in (None, 30, 1000):
        mask = wideband.cfar_mask(grid, 2.0, 1, 6, chunk)
        got = np.stack([r["mask"] for r in mask.orderBy("t_idx").collect()])
        want = model_cfar(s, 1, 6, 2.0, chunk is not None)
        if chunk == 30:  # 70 columns are two chunks of 35, 20 bins one of 20
            assert want.any()
        assert (got == want).all()
    seven = wideband.cfar_mask(grid.where("t_idx < 67"), 2.0, 1, 6, 30)  # two chunks of 33: the last column is left over
    got = np.stack([r["mask"] for r in seven.orderBy("t_idx").collect()])
    want = model_cfar(s[:67], 1, 6, 2.0, True)
    want[66:] = False
    assert (got == want).all()
    mask = wideband.cfar_mask(grid, 2.0)
    m = model_cfar(s, 1, 6, 2.0)
    assert np.allclose([r["occupancy"] for r in wideband.occupancy(mask).orderBy("f_idx").collect()], m.mean(axis=0)) and np.allclose([r["activity"] for r in wideband.time_activity(mask).orderBy("t_idx").collect()], m.mean(axis=1))
    carriers = spark.createDataFrame([("f", 0, (7 - 10) * 5.0, 4.0, 100.0), ("f", 1, (4 - 10) * 5.0, 8.0, 100.0), ("f", 2, 1e6, 1.0, 100.0)], "file_id string, carrier_index long, f_center_hz double, bw_hz double, fs_hz double")
    got = sorted((r["carrier_index"], r["t_first"], r["t_last"], r["t0_s"], r["t1_s"]) for r in wideband.active_spans(mask, carriers).collect())
    want = []
    for c, (f0, bw) in enumerate((((7 - 10) * 5.0, 4.0), ((4 - 10) * 5.0, 8.0))):
        band = np.abs((np.arange(20) - 10) * 5.0 - f0) <= 1.25 * bw / 2
        on = np.flatnonzero(m[:, band].any(axis=1))
        for run in np.split(on, np.flatnonzero(np.diff(on) > 1) + 1):
            want.append((c, run[0], run[-1], run[0] * 0.5, run[-1] * 0.5))
    assert got == sorted(want)
    thumb = {(r["t"], r["f"]): (r["max_db"], r["mean_db"]) for r in wideband.thumbnail(grid, 8, 6).collect()}
    wide = np.pad(s, ((0, 2), (0, 4)), mode="edge")
    for (t, f), (top, mean) in thumb.items():
        cell = wide[t * 8 : t * 8 + 8, f * 6 : f * 6 + 6]
        assert np.isclose(top, cell.max()) and np.isclose(mean, cell.mean())
    assert len(thumb) == 9 * 4


def test_welch_and_waterfall_of_short_and_capped_files(spark):
    x = noise(3000, 11)
    short = ops.welch(blocks_of(spark, x[:40], 512), 64, 32).orderBy("bin").collect()
    w = kernels.hann(40)
    assert np.allclose([r["p"] for r in short], np.fft.fftshift(np.abs(np.fft.fft(x[:40] * w)) ** 2 / (1000 * (w**2).sum()))) and len(short) == 40
    for cap in (None, 10, 7):
        rows = ops.waterfall(blocks_of(spark, x, 512), 64, 16, cap).orderBy("t_idx").collect()
        frames = 1 + (3000 - 64) // 16
        skip = max(1, -(-frames // cap)) if cap else 1
        assert [r["t_idx"] for r in rows] == list(range(-(-frames // skip)))
        for r in rows:
            a = r["t_idx"] * skip * 16
            mag = np.fft.fftshift(np.abs(np.fft.fft(x[a : a + 64] * kernels.hann(64))))
            assert np.isclose(r["time_s"], a / 1000) and np.allclose(r["s_db"], 20 * np.log10(np.maximum(mag, 1e-12)), atol=1e-3)


def test_interval_spectra(spark):
    x = noise(4000, 12) * 0.1 + np.exp(2j * np.pi * 0.2 * np.arange(4000))
    spans = [(0, 0, 4000), (1, 500, 900), (2, 1000, 1030), (3, 510, 515)]
    table = spark.createDataFrame([("f", *s) for s in spans], "file_id string, interval_id long, start_sample long, end_sample long")
    for cap, step in ((None, 1), (7, 1), (8192, 3)):
        got = iv.spectra(blocks_of(spark, x, 512), table, 64, 16, cap, step, 512)
        rows = {r["interval_id"]: r for r in got.collect()}
        metrics = {r["interval_id"]: r for r in iv.radio_metrics(got).collect()}
        for k, a, b in spans:
            y = x[a:b:step]
            y = np.pad(y, (0, max(0, 64 - len(y))))
            frames = 1 + (len(y) - 64) // 16
            skip = max(1, frames // cap) if cap and frames > cap else 1
            p = np.mean([np.abs(np.fft.fft(y[s : s + 64] * np.hanning(64))) ** 2 for s in range(0, len(y) - 63, 16 * skip)], axis=0) / (np.hanning(64) ** 2).sum()
            db = 10 * np.log10(np.maximum(np.fft.fftshift(p), 1e-20))
            assert np.allclose(rows[k]["p_db"], db, atol=1e-6) and rows[k]["fs_hz"] == 1000.0 / step, (k, cap, step)
            f, strong = np.fft.fftshift(np.fft.fftfreq(64)), np.flatnonzero(db >= db.max() - 20)
            trimmed = np.median(np.sort(db)[12:-12])
            assert np.allclose([metrics[k][c] for c in ("rf_offset_hz", "bandwidth_hz", "snr_db")], [(f[strong[0]] + f[strong[-1]]) / 2 * 1000 / step, (f[strong[-1]] - f[strong[0]]) * 1000 / step, db.max() - trimmed])


# inference


def model_scale(x):
    a = np.maximum(np.abs(x.real), np.abs(x.imag))
    s = np.percentile(a, 99.9) if len(a) else 1.0
    return s if s >= 1e-6 else a.max() if a.max() >= 1e-6 else 1.0


def test_the_whole_plan_against_a_loop(spark):
    rng = np.random.default_rng(13)
    loud = np.repeat(rng.random(40) < 0.5, rng.integers(50, 300, 40))
    x = noise(len(loud), 13) * np.where(loud, 1.0, 0.05) * np.exp(2j * np.pi * 0.1 * np.arange(len(loud)))
    s = inference.Settings(seg_s=2.0, overlap_s=0.25, start_s=0.1, channels=7, crop=256, stride=128, vad_size=64, vad_stride=32, vad_db=-12.0, min_ms=100, merge_ms=64, nfft=64, hop=16, max_frames=20, preview_hz=None, unknown=0.4, block_frames=512)
    result = inference.infer(blocks_of(spark, x, 512), catalogue.linear_classifier, ["one"], 1000.0, s)
    got = [r.asDict() for r in result.segments.orderBy("segment_id").collect()]
    frames = {(r["segment_id"], r["frame_start_sample"]): r for r in result.frames.collect()}
    want, seen = [], set()
    total, seg, hop = len(x), 2000, 1750
    for c in range(int(np.ceil(max(0, total - 100 - seg) / hop)) + 1):
        lo, hi = 100 + c * hop, min(total, 100 + c * hop + seg)
        part = x[lo:hi]
        scale = model_scale(part)
        y = np.clip(part.real / scale, -4, 4) + 1j * np.clip(part.imag / scale, -4, 4)
        for a, b in model_vad(model_energies(y, 64, 32), hi - lo, 64, -12.0, 3.0, 100, 64):
            z = part[a:b]
            own = model_scale(z)
            z = np.clip(z.real / own, -4, 4) + 1j * np.clip(z.imag / own, -4, 4)
            base = np.stack([z.real, z.imag, np.abs(z), np.angle(z), np.diff(np.angle(z), prepend=np.angle(z[:1]))]).astype(np.float32)
            chan = np.tile(base, (2, 1))[:7]
            chan = np.pad(chan, ((0, 0), (0, max(0, 256 - chan.shape[1]))))
            logits = []
            for f in model_frames(chan.shape[1], 256, 128):
                fr = chan[None, :, f : f + 256].astype(np.float64)
                fr = (fr - fr.mean(axis=2, keepdims=True)) / np.maximum(fr.std(axis=2, ddof=1, keepdims=True), 1e-6)
                logits.append(catalogue.linear_classifier(fr)[0])
                p = np.exp(logits[-1] - logits[-1].max())
                row = frames[len(want), lo + a + f]
                seen.add((len(want), lo + a + f))
                assert row["top1_idx"] == logits[-1].argmax() and np.isclose(row["top1_prob"], (p / p.sum()).max(), atol=1e-5) and np.isclose(row["frame_start_time_s"], (lo + a + f) / 1000)
            mean = np.mean(logits, axis=0)
            p = np.exp(mean - mean.max()) / np.exp(mean - mean.max()).sum()
            label = "UNKNOWN" if p.max() < 0.4 else "one" if p.argmax() == 0 else f"class_{p.argmax()}"
            want.append((lo + a, lo + b, int(p.argmax()), label, p.max()))
    assert seen == frames.keys() and len(got) == len(want) > 5
    for r, w in zip(got, want, strict=True):
        assert (r["start_sample"], r["end_sample"], r["pred_idx"], r["pred_label"]) == w[:4] and np.isclose(r["prob_top1"], w[4], atol=1e-5)
        assert r["start_time_s"] == round(w[0] / 1000, 6) and r["duration_s"] == round((w[1] - w[0]) / 1000, 6)
    assert result.bursts.agg(F.min("start_time_s")).first()[0] == got[0]["start_time_s"]
    result.release()


def test_chunk_plans(spark):
    files = spark.createDataFrame([("a", 1000, 100.0), ("b", 40, 100.0), ("c", 10, 100.0)], "file_id string, frames long, fs_hz double")
    plan = lambda *a: sorted(tuple(r) for r in iv.chunk_plan(files, *a).collect())
    assert plan(3.0, 1.0, 0.2)[:6] == [("a", 0, 20, 320), ("a", 1, 220, 520), ("a", 2, 420, 720), ("a", 3, 620, 920), ("a", 4, 820, 1000), ("b", 0, 20, 40)] and len(plan(3.0, 1.0, 0.2)) == 6
    assert len(plan(3.0, 3.0)) == 6 and len(plan(3.0, 0.0, 0.0, 1)) == 3  # an overlap as long as the segment is none
    spaced = sorted(tuple(r) for r in iv.evenly_spaced(files, 3, 1.0).collect())
    assert spaced == [("a", 0, 0, 100), ("a", 1, 450, 550), ("a", 2, 900, 1000)]


# clips


def test_downmix_and_clips(spark):
    fs, n = 1000.0, 6000
    x = noise(n, 14) + np.exp(2j * np.pi * 0.1 * np.arange(n))
    carriers = spark.createDataFrame([("f", 0, 100.0, 30.0, n / fs), ("f", 1, -200.0, 5.0, n / fs)], "file_id string, carrier_index long, f_center_hz double, bw_hz double, duration_s double")
    streams = {}
    for frames in (1500, 2048):
        out = extraction.downmix(blocks_of(spark, x, frames), carriers, fs, 4.0, 10.0, 101)
        rows = out.orderBy("carrier_index", "block_id").collect()
        for c, (f0, bw) in enumerate(((100.0, 30.0), (-200.0, 5.0))):
            factor = max(1, int(fs // (max(bw, 10.0) * 4)))
            cutoff = min(0.45 * fs, 1.2 * max(bw, 10.0)) / (fs / 2)
            k = np.arange(101) - 50
            h = cutoff * np.sinc(cutoff * k) * np.hanning(101)
            y = np.convolve(x * np.exp(-2j * np.pi * f0 / fs * np.arange(n)), h / h.sum())[:n]
            fir = kernels.kaiser_fir(factor)
            whole = np.convolve(np.pad(y, 10 * factor), fir, mode="valid")[::factor]
            got = np.concatenate([np.array(r["i"]) + 1j * np.array(r["q"]) for r in rows if r["carrier_index"] == c])
            assert np.allclose(got, whole, atol=1e-5) and {r["decim"] for r in rows if r["carrier_index"] == c} == {factor}
            streams[c] = (whole, factor)
    files = spark.createDataFrame([("f", fs, n)], "file_id string, fs_hz double, frames long")
    spans = spark.createDataFrame([("f", 0, 0.0, 6.0), ("f", 1, 1.0, 5.0), ("f", 1, 5.5, 5.503), ("f", 1, 5.5, 5.6)], "file_id string, carrier_index long, t0_s double, t1_s double")
    found = extraction.numbered(extraction.clips(out, spans, files, 64, 0.5))
    rows = found.orderBy("clip_index").collect()
    want = []
    for c, t0, t1 in ((0, 0.0, 6.0), (1, 1.0, 5.0)):
        y, factor = streams[c]
        d0, d1 = int(t0 * fs) // factor, min(n, int(np.ceil(t1 * fs))) // factor
        want += [(c, s, y[s : s + 64]) for s in range(d0, d1 - 63, 32)]
    assert [(r["clip_index"], r["carrier_index"], r["place"]) for r in rows] == [(k, c, s) for k, (c, s, _) in enumerate(want)]
    assert all(np.allclose(np.array(r["i"]) + 1j * np.array(r["q"]), w[2], atol=1e-5) for r, w in zip(rows, want, strict=True))
    assert {r["carrier_index"]: r["n_clips"] for r in extraction.clips_per_carrier(found).collect()} == {c: sum(w[0] == c for w in want) for c in (0, 1)}
    psd = outputs.carrier_spectra(out, 64).where("carrier_index = 0").orderBy("bin").collect()
    total, m = kernels.welch_sums(streams[0][0], 64, 32, fs / streams[0][1])
    assert np.allclose([r["p"] for r in psd], total / m, rtol=1e-3)


def clip_table(spark, x):
    return spark.createDataFrame([(c, c % 3, k, float(v.real), float(v.imag)) for c, row in enumerate(x) for k, v in enumerate(row)], "clip_index long, carrier_index long, n long, i double, q double")


def test_clip_features_against_numpy(spark):
    x = noise(6 * 32, 15).reshape(6, 32)
    bins = spark.range(catalogue.BINS).toDF("k")
    run = lambda sql: dialect.run(sql, clips=clip_table(spark, x), bins=bins)
    by = lambda df: {r["clip_index"]: r for r in df.collect()}
    rows, names = by(run(clips.FEATURES)), ("c20", "c40", "c41", "c42")
    for c, z in enumerate(x):
        y = z - z.mean()
        p = (np.abs(y) ** 2).mean() + 1e-12
        m = lambda v: v.mean()
        want = (m(y**2) / p, (m(y**4) - 3 * m(y**2) ** 2) / p**2, (m(y**3 * y.conj()) - 3 * m(y**2) * m(y * y.conj())) / p**2, (m(y**4) - abs(m(y**2)) ** 2 - 2 * m(y * y.conj()) ** 2) / p**2)
        assert np.allclose([rows[c][f"{k}_r"] + 1j * rows[c][f"{k}_i"] for k in names], want, atol=1e-5)
        assert np.isclose(rows[c]["cfo_hz"], np.angle((z[:-1].conj() * z[1:]).sum()) / (2 * np.pi) * 32, atol=1e-5)
        a = np.abs(z)
        assert np.isclose(rows[c]["env_kurt"], (((a - a.mean()) / (a.std() + 1e-12)) ** 4).mean(), atol=1e-5)
        w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(32) / 32)
        power = np.fft.fftshift(np.abs(np.fft.fft(z * w)) ** 2) / (32 * (w**2).sum())
        db = 10 * np.log10(power)
        k = db.argmax()
        low = np.flatnonzero(db <= db[k] - 6)
        left, right = low[low < k].max(initial=0), low[low > k].min(initial=31)
        assert np.isclose(rows[c]["snr_db"], db[k] - np.median(db), atol=1e-5) and np.isclose(rows[c]["bw_hz"], right - left) and np.isclose(rows[c]["sfm"], np.exp(np.log(power + 1e-20).mean()) / power.mean(), atol=1e-5)
    table = run(clips.engineered("amp, PHASE,dfreq,cosphi,sinphi,d_amp,d2phase,cum40")).orderBy("clip_index", "n").collect()
    for c, z in enumerate(x):
        own = [r for r in table if r["clip_index"] == c]
        phase = np.unwrap(np.angle(z))
        want = {"amp": np.abs(z), "phase": phase, "dfreq": np.diff(phase, prepend=phase[0]), "cosphi": np.cos(phase), "sinphi": np.sin(phase), "d_amp": np.diff(np.abs(z), prepend=abs(z[0])), "d2phase": np.diff(phase, n=2, prepend=phase[0], append=phase[-1]), "cum40": np.full(32, rows[c]["c40_r"])}
        assert all(np.allclose([r[k] for r in own], v, atol=1e-5) for k, v in want.items())
    assert clips.channel_list(" Amp,,nothing, cum42,cum20") == ["i", "q", "amp", "cum20", "cum42"]
    best = by(run(clips.BEST_CONVENTION))
    for c, z in enumerate(x):
        p = np.abs(np.fft.fft(z)) ** 2
        plain, mirrored = 10 * np.log10(p[1:16].sum() / p[16:].sum()), 10 * np.log10(p[17:].sum() / p[1:17].sum())
        assert best[c]["best"] == ("I_Q" if plain >= mirrored else "I_neg_Q") and np.isclose(best[c]["irr_db"], abs(max(plain, mirrored)), atol=1e-5)


def test_clip_tables_against_numpy(spark):
    x = noise(5 * 32, 21).reshape(5, 32)
    bins = spark.range(catalogue.BINS).toDF("k")
    run = lambda sql: dialect.run(sql, clips=clip_table(spark, x), bins=bins).collect()
    scale = [model_scale(z) for z in x]
    norm = [np.clip(z.real / s, -4, 4) + 1j * np.clip(z.imag / s, -4, 4) for z, s in zip(x, scale, strict=True)]
    assert all(abs(complex(r["i"], r["q"]) - norm[r["clip_index"]][r["n"]]) < 2e-6 for r in run(clips.CLIP_NORMALISED))
    for r in run(clips.ENRICHED):
        z, n = norm[r["clip_index"]], r["n"]
        base = (z[n].real, z[n].imag, abs(z[n]), np.angle(z[n]), np.angle(z[n]) - np.angle(z[n - 1]) if n else 0.0)
        assert abs(r["x"] - base[r["channel"] % 5]) < 1e-4  # of samples that are rounded before
    frames = run(clips.FRAMES_STANDARDISED)
    for r in frames:
        f = x[r["clip_index"]][r["frame"] * 8 : r["frame"] * 8 + 16]
        assert abs(r["i"] - (f.real[r["m"]] - f.real.mean()) / f.real.std(ddof=1)) < 2e-6 and abs(r["q"] - (f.imag[r["m"]] - f.imag.mean()) / f.imag.std(ddof=1)) < 2e-6
    assert len(frames) == 5 * 3 * 16
    for r in run(clips.BAND_ENERGY):
        w = kernels.hann(16)
        p = np.mean([np.abs(np.fft.fft(x[r["clip_index"]][a : a + 16] * w))[:9] ** 2 for a in (0, 8, 16)], axis=0)
        assert np.allclose([r["band_lo"], r["band_hi"], r["spec_flat"]], [np.log(p[:2].mean()), np.log(p[2:].mean()), np.exp(np.log(p).mean()) / p.mean()], atol=2e-6)
    retuned = {(r["clip_index"], r["n"]): complex(r["i"], r["q"]) for r in run(clips.RETUNED)}
    for c, z in enumerate(x):
        y = np.convolve(kernels.mix(z, 0, 4, 32), kernels.lowpass(7, 0.2), mode="same")[::2]
        assert np.allclose([retuned[c, k] for k in range(16)], y, atol=2e-6)
    for r in run(clips.SOFTMAX_LABELS):
        z = x[r["clip_index"]]
        k = np.arange(5)
        logit = 4 * (z.real.mean() * np.cos(k) + z.imag.mean() * np.sin(k)) + (np.abs(z) ** 2).mean() * k / 100
        p = np.exp(logit - logit.max()) / np.exp(logit - logit.max()).sum()
        label = "UNKNOWN" if p.max() < 0.25 else ("am", "fm", "class_2", "class_3", "class_4")[p.argmax()]
        assert (r["pred_idx"], r["pred_label"]) == (p.argmax(), label) and abs(r["prob_top1"] - p.max()) < 2e-6
    power = [np.abs(np.fft.fft(z)) ** 2 for z in x]
    plain = [10 * np.log10(p[1:16].sum() / p[16:].sum()) for p in power]
    mirrored = [10 * np.log10(p[17:].sum() / p[1:17].sum()) for p in power]
    got = {(r["clip_index"], r["conv"]): r["irr_db"] for r in run(clips.IRR_CONVENTIONS)}
    assert all(np.allclose([got[c, "I_Q"], got[c, "I_neg_Q"], got[c, "Q_I"]], [plain[c], mirrored[c], mirrored[c]], atol=2e-6) for c in range(5))
    for r in run(clips.IRR_VERDICT):
        gain, best = mirrored[r["clip_index"]] - plain[r["clip_index"]], max(mirrored[r["clip_index"]], plain[r["clip_index"]])
        assert r["verdict"] == ("significant" if gain > 5 else "moderate" if gain > 1 else "minimal" if gain > -1 else "degraded") and r["band"] == ("excellent" if best > 30 else "good" if best >= 20 else "marginal" if best >= 10 else "poor" if best >= 5 else "very_poor")
    best = [max(a, b) for a, b in zip(plain, mirrored, strict=True)]
    for r in run(clips.IRR_VARIABILITY):
        own = [c for c in range(5) if c % 3 == r["carrier_index"]]
        v = [best[c] for c in own]
        direct = [plain[c] >= mirrored[c] for c in own]
        assert np.allclose([r["mean_irr"], r["std_irr"], r["range_irr"], r["consistency"]], [np.mean(v), np.std(v), max(v) - min(v), direct.count(direct[0]) / len(own)], atol=2e-6)
        assert r["variability"] == ("LOW" if max(v) - min(v) < 2 else "MODERATE" if max(v) - min(v) < 10 else "HIGH")


def test_features_of_long_clips(spark):
    from sigmill.operators import features

    x = [noise(5000, 22) + 3 * np.exp(2j * np.pi * 0.1 * np.arange(5000)), noise(100, 23), np.zeros(0, complex)]
    table = spark.createDataFrame([(k, 1000.0, z.real.tolist(), z.imag.tolist()) for k, z in enumerate(x)], "clip_index long, fs_hz double, i array<double>, q array<double>")
    got = {r["clip_index"]: r for r in features.clip_features(table, 256).collect()}
    total, n = kernels.welch_sums(x[0], 256, 128, 1000.0)
    p = total / n
    assert got[0]["T"] == 5000 and np.isclose(got[0]["snr_db"], 10 * np.log10(p.max() / np.median(p)), atol=1e-3) and np.isclose(got[0]["sfm"], np.exp(np.log(p).mean()) / p.mean()) and abs(got[0]["cfo_hz"] - 100) < 5
    assert got[2]["T"] == 0 and got[2]["snr_db"] is None and got[1]["bw_hz"] > 0
    made = {r["clip_index"]: {c["name"]: np.array(c["values"]) for c in r["channels"]} for r in features.engineered(table, " Amp,bandE_lo, SPEC_FLAT,cum42,nothing,").collect()}
    assert list(made[0]) == ["I", "Q", "amp", "cum42", "bandE_lo", "spec_flat"] and list(made[1]) == ["I", "Q", "amp", "cum42"] and made[2] == {}
    rows = np.lib.stride_tricks.sliding_window_view(x[0], 128)[::64]
    q = (np.abs(np.fft.fft(rows * kernels.hann(128), axis=1)[:, :65]) ** 2).mean(axis=0)
    assert np.allclose(made[0]["bandE_lo"], np.log(q[:16].mean()), atol=1e-4) and np.allclose(made[0]["amp"], np.abs(x[0]), atol=1e-4) and len(set(made[0]["cum42"])) == 1


# image rejection studies


def test_rejection_of_intervals_and_its_spread(spark):
    x = noise(9000, 16) * 0.1 + np.exp(2j * np.pi * 0.1 * np.arange(9000)) * np.repeat([1, 3, 0.01], 3000) + 2
    x[3000:6000] = x[3000:6000].conj()
    spans = [(0, 0, 3000), (1, 3000, 6000), (2, 6000, 6100), (3, 1000, 8000)]
    table = spark.createDataFrame([("f", *s) for s in spans], "file_id string, interval_id long, start_sample long, end_sample long")
    rows = irr.channel_order(irr.by_interval(blocks_of(spark, x, 512), table, 4096, 512))
    got = {r["interval_id"]: r for r in rows.collect()}
    for k, a, b in spans:
        y = x[a:b] - x[a:b].mean()
        size = 4096
        y = y[(len(y) - size) // 2 :][:size] if len(y) >= size else np.pad(y, (0, size - len(y)))
        p = np.abs(np.fft.fft(y)) ** 2
        plain = 10 * np.log10(p[1 : size // 2].sum() / p[size // 2 :].sum())
        assert np.isclose(got[k]["irr_i_q"], plain, atol=1e-6) and got[k]["best_convention"] == ("I+jQ" if plain > 0 else "I-jQ") and got[k]["conv"] == ("I+Q" if plain > 0 else "I-Q")
    old = {r["interval_id"]: r for r in irr.by_interval(blocks_of(spark, x, 512), table, 4096, 512, legacy=True).collect()}
    y = x[6000:6100] - x[6000:6100].mean()
    p = np.abs(np.fft.fft(y)) ** 2
    assert np.isclose(old[2]["irr_i_q"], abs(10 * np.log10(p[1:50].sum() / p[50:].sum())), atol=1e-6) and all(r["best_irr_db"] >= 0 for r in old.values())
    stats = irr.variability(rows).first()
    best = [got[k]["best_irr_db"] for k in range(4)]
    assert np.allclose([stats[c] for c in ("mean_irr", "std_irr", "min_irr", "max_irr", "range_irr")], [np.mean(best), np.std(best), min(best), max(best), max(best) - min(best)])
    names = [got[k]["best_convention"] for k in range(4)]
    assert stats["most_common_convention"] == max(irr.CONVENTIONS, key=names.count) and stats["consistency"] == names.count(names[0]) / 4 and stats["variability"] == ("LOW" if stats["range_irr"] < 2 else "MODERATE" if stats["range_irr"] < 10 else "HIGH")


def test_sampling_sweep_and_choice(spark):
    x = noise(20_000, 17) * 0.3 + np.exp(2j * np.pi * 0.3 * np.arange(20_000))
    sweep = irr.sampling_sweep(blocks_of(spark, x, 4096), frame=128)
    rows = {r["factor"]: r for r in sweep.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 8, 10, 16]
    for f, r in rows.items():
        y = x[::f] - x[::f].mean()
        p = sum(np.abs(np.fft.fft(y[k : k + 128])) ** 2 for k in range(0, len(y) - 127, 128))
        plain = 10 * np.log10(p[1:64].sum() / p[64:].sum())
        assert r["best_convention"] == "I+jQ" and np.isclose(r["irr_db"], plain, atol=1e-6) and np.isclose(r["difference_db"], plain - rows[1]["irr_db"], atol=1e-6) and r["fs_hz"] == 1000 / f
    worst = irr.worst_degradation(sweep).first()
    assert worst["difference_db"] == min(r["difference_db"] for r in rows.values()) and rows[worst["factor"]]["difference_db"] == worst["difference_db"]
    candidates = spark.createDataFrame([("f", k, 5, j) for j, k in enumerate((3, 5, 7, 8))], "file_id string, factor int, base int, place int")
    chosen = irr.chosen_factor(candidates, sweep).first()
    assert chosen["factor"] == max((3, 5, 8), key=lambda k: rows[k]["irr_db"])


# detections and files


def test_qa_by_hand(spark, tmp_path):
    rows = [(0, "am", 0.9, 1, 10.0, 2.0), (1, "am", 0.8, 1, 20.0, None), (2, "fm", 0.2, 1, None, 4.0), (3, "am", 0.95, 2, 5.0, 1.0), (4, "fm", 0.6, None, None, None), (5, "am", 0.9, None, None, None), (6, "fm", 0.5, 3, 1.0, 1.0)]
    table = spark.createDataFrame(rows, tables.DETECTIONS)
    features = spark.createDataFrame([(4, 3.0, 1), (4, 7.0, 2), (0, 1.0, 3)], "clip_index long, snr_db double, row_no long")
    run = lambda sql: [tuple(r) for r in dialect.run(sql, detections=table, features=features).collect()]
    assert run(qa.carriers(False)) == [(2, 5.0, 1.0, 1, "am", "1.00", "0.95", "clean", "")]
    assert run(qa.carriers(True)) == [(-1, None, None, 2, "fm", "0.50", "0.60", "review", "low_dominance:0.50"), (1, 15.0, 3.0, 3, "am", "0.67", "0.85", "review", "low_dominance:0.67; low_conf_mean:0.63"), (3, 1.0, 1.0, 1, "fm", "1.00", "0.50", "review", "low_conf_mean:0.50")]
    assert run(qa.conflicts()) == [(-1, None, None, 2, "fm:1; am:1", "0.50", "0.60"), (1, 15.0, 3.0, 3, "am:2; fm:1", "0.67", "0.85")]
    assert sorted(run(qa.low_confidence())) == [(2, "fm", "0.20", None, 1, None, 4.0), (4, "fm", "0.60", 7.0, None, None, None), (6, "fm", "0.50", None, 3, 1.0, 1.0)]
    assert run(qa.summary()) == [(7, 3, 4, 3, 2)]
    outputs.qa_tables(table, features, str(tmp_path / "qa"))
    assert "Total carriers: 4\nCarriers to review: 3" in spark.read.text(f"{tmp_path}/qa/qa_summary", wholetext=True).first()[0]
    back = spark.read.csv(f"{tmp_path}/qa/carriers_review", header=True)
    assert back.columns == ["carrier_index", "f_center_hz_rel_med", "bw_hz_med", "clips", "dominant_mod", "dominant_share", "dominant_conf_mean", "status", "reason"] and back.count() == 3
    assert spark.read.csv(f"{tmp_path}/qa/carrier_conflicts", header=True).columns[4] == "class_breakdown"


def test_success_of_files(spark):
    rows = [(100 * k + f, "completed" if k < good else "failed") for f, good in ((1, 10), (2, 8), (3, 7), (4, 0)) for k in range(10)]
    got = dialect.run(qa.file_success(), progress=spark.createDataFrame(rows, "file_id long, status string"))
    assert {(r["file_id"], r["share"]) for r in got.collect()} == {(1, 1.0), (2, 0.8)}


def test_tables_beside_captures(spark, tmp_path):
    import json

    (tmp_path / "meta.json").write_text(json.dumps({"file": "a.wav", "fs_used_hz": 50.0, "duration_s": 1.5, "clips": [{"clip_index": 0, "fs_dec_hz": 10.0, "source_span_dec": [0, 5]}, {"clip_index": 2, "fs_dec_hz": None}]}, indent=1))
    meta = tables.clip_meta(spark, str(tmp_path / "meta.json"))
    clips_ = spark.createDataFrame([(k, 0, [0.0], [0.0], 0) for k in range(3)], tables.CLIPS)
    rates = lambda *a: {r["clip_index"]: r["fs_hz"] for r in tables.clip_rates(clips_, meta, *a).collect()}
    assert meta.count() == 2 and rates() == {0: 10.0, 1: 50.0, 2: 50.0} and set(rates(7.0).values()) == {7.0}
    assert {r["fs_hz"] for r in tables.clip_rates(clips_, meta.where("false")).collect()} == {1.0}
    (tmp_path / "carriers.csv").write_text("f_center_hz,p_db,bw_hz_est,snr_db_est\n1.5,,2,3\n")
    assert tuple(tables.carriers(spark, str(tmp_path / "carriers.csv")).first()) == (1.5, 0.0, 2.0, 3.0)
    (tmp_path / "d.csv").write_text("clip_index,pred_name,confidence,carrier_index,f_center_hz_rel,bw_hz_est\n3,am,0.5,,,\n")
    assert tuple(tables.detections(spark, str(tmp_path / "d.csv")).first()) == (3, "am", 0.5, None, None, None)
    for name, text in (("l1.json", '["am", "fm"]'), ("l2.json", '{"labels": ["am", "fm"]}'), ("l3.json", '{"kept_class_names": ["am", "fm"], "labels": []}')):
        (tmp_path / name).write_text(text)
        assert [tuple(r) for r in tables.labels(spark, str(tmp_path / name)).orderBy("idx").collect()] == [(0, "am"), (1, "fm")]
    import os

    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x_stats.json").write_text("1")
    (tmp_path / "y_stats.json").write_text("2")
    os.utime(tmp_path / "y_stats.json", (1e9, 1e9))
    assert tables.latest(spark, str(tmp_path), "*_stats.json").endswith("sub/x_stats.json") and tables.latest(spark, str(tmp_path), "*.none") is None


def test_synthetic_captures_do_not_depend_on_partitions(spark):
    a, b = (tables.synthetic(spark, 0.02, 1e6, 3, 5, block_frames=4096).repartition(n).orderBy("block_id").collect() for n in (1, 7))
    assert a == b and sum(r["n"] for r in a) == 20_000
    x = np.concatenate([np.array(r["i"]) + 1j * np.array(r["q"]) for r in a])
    power = np.abs(np.fft.fft(x)) ** 2
    peaks = sorted(np.fft.fftfreq(20_000, 1e-6)[np.argsort(power)[-3:]].tolist())
    assert np.allclose(peaks, [-2e5, 0, 2e5], atol=60)
    assert not np.allclose(a[0]["i"], tables.synthetic(spark, 0.02, 1e6, 3, 6, block_frames=4096).where("block_id = 0").first()["i"])


def test_short_intervals_take_one_pass_and_no_shuffle_of_blocks(spark):
    x = noise(3000, 31)
    plain = blocks_of(spark, x, 512)
    spans = [(0, 0, 3000), (1, 500, 900), (2, 511, 513), (3, 40, 40), (4, 512, 1024)]
    table = spark.createDataFrame([("f", *v, 1.5) for v in spans], "file_id string, interval_id long, start_sample long, end_sample long, scale double")
    known = iv.extent(table, 512)
    assert known == iv.Extent(3000, 6 + 2 + 2 + 1) and iv.extent(table.limit(0), 512) == iv.Extent(0, 0)
    blocks = ops.haloed(plain, 3, 255)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    steps = {
        "scale": lambda b, k: iv.robust_scale(b, table.drop("scale"), 512, k), "energy": lambda b, k: iv.frame_energies(b, table, 64, 32, 512, k), "threshold": lambda b, k: iv.auto_threshold(b, table, 1000.0, 1, 7.0, 0.5, block_frames=512, known=k),
        "spectra": lambda b, k: iv.spectra(b, table, 64, 32, 50, 1, 512, k), "frames": lambda b, k: iv.model_frames(b, table, 5, 256, 128, 512, k),
    }
    for name, step in steps.items():
        got, want = step(blocks, known), step(plain, None)
        assert plan(got).count("Join ") == plan(blocks).count("Join ") + 1 and "broadcast" in plan(got), name  # the lists of intervals alone
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() >= 4, name


def test_inference_is_the_same_by_either_way_of_quantiles_and_joins(spark, monkeypatch):
    rng = np.random.default_rng(32)
    loud = np.repeat(rng.random(40) < 0.5, rng.integers(50, 300, 40))
    x = noise(len(loud), 32) * np.where(loud, 1.0, 0.05) * np.exp(2j * np.pi * 0.1 * np.arange(len(loud)))
    s = inference.Settings(seg_s=2.0, channels=5, crop=256, stride=128, vad_size=64, vad_stride=32, vad_db=None, quantile=0.5, margin_db=-2.6, hang_db=0.4, min_ms=96, merge_ms=64, smooth_ms=9.0, nfft=64, hop=32, preview_hz=None, block_frames=512)
    assert inference.halo(1000.0, s) == (4, 255) and inference.halo(1000.0, inference.PRESETS["standard"]) == (1, 16_383)
    plain, found = blocks_of(spark, x, 512), []
    for blocks, limit in ((plain, 1 << 20), (ops.haloed(plain, *inference.halo(1000.0, s)), 1 << 20), (plain, -1)):
        monkeypatch.setattr(iv, "ROW_VALUES", limit)
        monkeypatch.setattr(iv, "BROADCAST_TOUCHED", limit)
        monkeypatch.setattr(iv, "BATCH_BYTES", abs(limit))
        result = inference.infer(blocks, catalogue.linear_classifier, ["up", "side"], 1000.0, s)
        found.append([sorted(map(str, df.collect())) for df in (result.segments, result.frames)])
        result.release()
    assert found[0] == found[1] == found[2] and all(len(rows) > 5 for rows in found[0])


def test_result_files_of_inference(spark, tmp_path):
    x = noise(3000, 19)
    s = inference.Settings(seg_s=2.0, channels=5, crop=256, stride=128, vad_size=64, vad_stride=32, vad_db=-100.0, min_ms=0, nfft=64, hop=32, preview_hz=None, block_frames=512)
    blocks = blocks_of(spark, x, 512, name="d/a.r64")
    result = inference.infer(blocks, catalogue.linear_classifier, ["up"], 1000.0, s)
    files = spark.createDataFrame([("d/a.r64", 3000, 1000.0)], "file_id string, frames long, fs_hz double")
    out = str(tmp_path / "out")
    for _ in range(2):  # writing again replaces
        outputs.inference_tables(result, files, out, s, ["up"], 1e6, "2024-01-01T00:00:00")
    frames, rows = (spark.read.csv(f"{out}/{t}", header=True) for t in ("frames", "predictions"))
    assert frames.count() == result.frames.count() > 0 and rows.columns[:-1] == inference.PREDICTION and rows.count() == result.bursts.count()
    both = spark.read.csv(f"{out}/consolidated_predictions", header=True)
    assert both.columns == ["file", *inference.PREDICTION] and both.first()["file"] == "a.r64"
    import json

    info = json.loads(spark.read.text(f"{out}/run_info").first()[0])
    assert info["chunks"] == 2 and info["duration_s"] == 3.0 and info["settings"]["crop"] == 256
    image = outputs.burst_spectrograms(blocks, spark.createDataFrame([("d/a.r64", 0, 100, 900)], "file_id string, interval_id long, start_sample long, end_sample long"), 128, 32, 512).orderBy("at").collect()
    want = kernels.spectrogram_db(x.real[100:900], 128, 32)
    assert len(image) == len(want) and np.allclose([r["db"] for r in image], want, atol=1e-3)

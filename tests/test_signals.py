"""Reading without samples, integer widths, filters, order statistics, long windows and single transforms, against NumPy models."""

import json
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigmill.functions import kernels
from sigmill.operators import captures as ops
from sigmill.operators import extraction, features, irr
from sigmill.plans import outputs
from sigmill.sources import captures as src
from sigmill.sources import files
from tests.test_models import blocks_of, noise

FS = 8000


def wav_file(raw, tag, bits, channels=2, extensible=False):
    width = bits // 8
    fmt = struct.pack("<HHIIHH", 0xFFFE if extensible else tag, channels, FS, FS * channels * width, channels * width, bits)
    if extensible:
        fmt += struct.pack("<HHI", 22, bits, 3) + struct.pack("<H", tag) + bytes.fromhex("000000001000800000aa00389b71")
    head = struct.pack("<4sI", b"fmt ", len(fmt)) + fmt
    return struct.pack("<4sI4s", b"RIFF", 4 + len(head) + 8 + len(raw), b"WAVE") + head + struct.pack("<4sI", b"data", len(raw)) + raw


@pytest.fixture(scope="module")
def signal():
    return (0.5 * np.exp(2j * np.pi * 0.05 * np.arange(5000))).astype(np.complex64)


def test_four_byte_samples_go_by_the_format_tag(spark, tmp_path, signal):
    x = np.stack([signal.real, signal.imag], axis=1).ravel()
    s32, f32, f64 = np.round(x.astype(float) * 2**31).astype("<i4").tobytes(), x.astype("<f4").tobytes(), x.astype("<f8").tobytes()
    for name, raw, tag, bits, ext in (("s32", s32, 1, 32, False), ("e32", s32, 1, 32, True), ("f32", f32, 3, 32, False), ("ef32", f32, 3, 32, True), ("f64", f64, 3, 64, False)):
        (tmp_path / f"{name}.wav").write_bytes(wav_file(raw, tag, bits, extensible=ext))
    src.register(spark)
    for r in spark.read.format("iqcapture").options(path=str(tmp_path), blockFrames=8192).load().collect():
        assert np.allclose(r["i"], signal.real, atol=1e-6) and np.allclose(r["q"], signal.imag, atol=1e-6), r["file_id"]
    for tag, bits in ((2, 16), (1, 64), (3, 16), (6, 8)):
        (tmp_path / "odd.x").write_bytes(wav_file(bytes(64), tag, bits))
        with pytest.raises(ValueError):
            src.probe(str(tmp_path / "odd.x"))


def test_headers_alone(spark, tmp_path, signal, monkeypatch):
    x = np.stack([signal.real, signal.imag], axis=1).ravel()
    (tmp_path / "b.wav").write_bytes(wav_file(np.round(x * 32767).astype("<i2").tobytes(), 1, 16))
    (tmp_path / "a,c.wav").write_bytes(wav_file(x.astype("<f4").tobytes(), 3, 32))
    (tmp_path / "bad.WAV").write_bytes(b"RIFF0000WAVEdata")
    monkeypatch.setattr(src, "_frames", None)  # in this process; what follows reads no sample there
    src.register(spark)
    meta = spark.read.format("iqmeta").options(path=str(tmp_path), tolerant=True).load()
    want = {("a,c.wav", 5000, 2, 32, True, 8000.0, 0.625), ("b.wav", 5000, 2, 16, False, 8000.0, 0.625)}
    row = lambda r: (r["file_id"].rpartition("/")[2], r["frames"], r["channels"], r["bits"], r["floating"], r["fs_hz"], r["duration_s"])
    for rows in (meta.collect(), src.metadata(spark, [str(tmp_path)], tolerant=True).collect()):
        assert {row(r) for r in rows if r["message"] is None} == want and [r["file_id"].endswith("bad.WAV") for r in rows if r["message"]] == [True]
    light = spark.read.format("iqcapture").options(path=str(tmp_path / "b.wav"), blockFrames=512, samples=False, haloAfter=5).load()
    assert light.columns == ["file_id", "chunk_id", "block_id", "start_sample", "n", "fs_hz"]
    assert light.agg(F.sum("n"), F.count("*"), F.max("start_sample")).first()[:] == (5000, 10, 4608)
    reader = src.CaptureReader({"path": str(tmp_path / "b.wav"), "samples": "false", "blockFrames": 512})
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 10


def test_blocks_of_a_table_of_files(spark, tmp_path, signal):
    raw = np.stack([signal.real, signal.imag], axis=1).astype("<f4").tobytes()
    for name in ("a,b.r64", "c.r64"):
        (tmp_path / name).write_bytes(raw)
    (tmp_path / "empty.r64").write_bytes(b"")
    found = src.listed(spark, [str(tmp_path), str(tmp_path / "c.r64")])
    assert sorted((r["file_id"].rpartition("/")[2], r["bytes"]) for r in found.collect()) == [("a,b.r64", 40_000), ("c.r64", 40_000), ("empty.r64", 0)]
    blocks = src.read_blocks(found, blockFrames=512, fsHint=FS, partitionBytes=10_000, haloBefore=700, haloAfter=9)
    assert blocks.schema["block_id"].metadata == {"frames": 512} and blocks.schema["head_i"].metadata["frames"] == 700
    for name in ("a,b.r64", "c.r64"):
        rows = blocks.where(F.endswith("file_id", F.lit(name))).orderBy("block_id").collect()
        assert np.allclose(np.concatenate([r["i"] for r in rows]), signal.real) and [r["n"] for r in rows] == [512] * 9 + [392]
        assert [len(r["head_i"]) for r in rows[:3]] == [0, 512, 700] and len(rows[-1]["tail_q"]) == 0


@pytest.mark.parametrize("frames", [64, 100, 5000])
def test_halos_reach_over_many_blocks(spark, frames):
    x = noise(1000, 3)
    blocks = blocks_of(spark, x, frames)
    for r in ops.with_halo(blocks, "start_sample", "n", "i", "q", before=250, after=333).collect():
        got, left = ops.samples_of(r, 250, 333)
        low, high = max(0, r["start_sample"] - 250), min(1000, r["start_sample"] + r["n"] + 333)
        assert left == r["start_sample"] - low and np.allclose(got, x[low:high])


def test_windows_and_filters_longer_than_a_block(spark):
    x = noise(3000, 8) * np.repeat([1e-3, 1.0, 1e-3, 1.0, 1e-3], 600)
    bounds = lambda blocks: [tuple(r) for r in ops.activity_slices(blocks, 250.0, -20.0).select("start_sample", "end_sample").orderBy("start_sample").collect()]
    assert bounds(blocks_of(spark, x, 64, chunk=1280)) == bounds(blocks_of(spark, x, 1280, chunk=1280)) != []
    carriers = spark.createDataFrame([("f", 0, 100.0, 3.0), ("f", 1, -200.0, 30.0)], "file_id string, carrier_index long, f_center_hz double, bw_hz double")

    def whole(rows, k):
        return np.concatenate([np.array(r["i"]) + 1j * np.array(r["q"]) for r in rows if r["carrier_index"] == k])

    for run in (lambda b: ops.retune(b, carriers, 250.0, 401), lambda b: extraction.downmix(b, carriers, 1000.0, 4.0, 3.0, 301)):
        short, long = (run(blocks_of(spark, x, n)).orderBy("carrier_index", "block_id").collect() for n in (64, 3000))
        for k in (0, 1):
            assert np.allclose(whole(short, k), whole(long, k), atol=1e-6)


def test_filters_take_the_wanted_places_alone():
    rng = np.random.default_rng(1)
    for taps in (1, 31, 801):
        h, x = rng.normal(size=taps), rng.normal(size=5000) + 1j * rng.normal(size=5000)
        full = np.convolve(x, h)
        assert np.allclose(full, kernels.overlap_save(x, h))
        for step in (1, 3, 10, 100):
            for first in (-50, 0, 7, 4990, 6000):
                at = first + step * np.arange(40)
                want = np.where((at >= 0) & (at < len(full)), full[np.clip(at, 0, len(full) - 1)], 0)
                assert np.allclose(kernels.fir_at(x, h, first, step, 40), want)
    assert len(kernels.fir_at(x[:0], h, 0, 1, 3)) == 3 and len(kernels.overlap_save(x[:0], h)) == 0


def test_medians_by_a_network():
    rng = np.random.default_rng(2)
    for n in range(1, 17):
        cells = [rng.integers(0, 5, 50).astype(float) for _ in range(n)]
        assert np.array_equal(kernels._median(list(cells)), np.median(np.stack(cells), axis=0))


def test_order_statistics_with_gaps_and_ends():
    rng = np.random.default_rng(4)
    for n in (1, 5, 13, 14, 15, 40, 300):
        x = rng.normal(size=(9, n))
        x[rng.random(x.shape) < 0.02] = np.nan
        x[2] = np.nan
        for both in (False, True):
            want = np.zeros(x.shape, bool)
            for r in range(len(x)):
                for p in range(n):
                    left, right = x[r, max(0, p - 7) : max(0, p - 1)], x[r, p + 2 : p + 8]
                    left, right = left[~np.isnan(left)], right[~np.isnan(right)]
                    ref = np.concatenate([left, right])
                    if len(ref) and (not both or len(left) and len(right)):
                        mid = np.median(ref)
                        want[r, p] = x[r, p] > mid + 1.4826 * (np.median(np.abs(ref - mid)) + 1e-12)
            assert np.array_equal(kernels.cfar_line(x, 1, 6, 1.0, both), want)


def test_peaks_in_one_pass():
    rng = np.random.default_rng(6)

    def model(db, prominence):
        out, k = [], 1
        while k < len(db) - 1:
            end = k
            while end < len(db) - 1 and db[end + 1] == db[k]:
                end += 1
            if db[k - 1] < db[k] and end < len(db) - 1 and db[end + 1] < db[k]:
                p = (k + end) // 2
                higher = np.flatnonzero(db > db[p])
                low, high = higher[higher < p].max(initial=-1), higher[higher > p].min(initial=len(db))
                if db[p] - max(db[low + 1 : p + 1].min(), db[p:high].min()) >= prominence:
                    out.append(p)
            k = end + 1
        return out

    for _ in range(200):
        db = rng.integers(0, 8, rng.integers(0, 60)).astype(float)
        assert kernels.peaks(db, 2.0).tolist() == model(db, 2.0)
        for p in range(len(db)):
            low = np.flatnonzero(db <= db[p] - 3)
            assert kernels.walk_down(db, p, db[p] - 3) == (low[low < p].max(initial=0), low[low > p].min(initial=len(db) - 1))
    began = time.process_time()
    kernels.peaks(rng.normal(size=1 << 18), 3.0)
    assert time.process_time() - began < 5


def test_one_transform_a_factor(spark):
    n = 30_000
    x = noise(n, 5) * 0.2 + np.exp(2j * np.pi * 0.07 * np.arange(n)) + 0.3 * np.exp(-2j * np.pi * 0.07 * np.arange(n)) + (0.4 - 0.1j)
    for most in (None, 25_000):
        y = x[:most]

        def power(z):
            z = z - z.mean()
            size = max(4096, min(1 << 20, 1 << (min(1 << 13, len(z)).bit_length() - 1)))
            if len(z) < size:
                z = np.pad(z, ((size - len(z)) // 2, size - len(z) - (size - len(z)) // 2))
            else:
                start = (len(z) - size) // 2
                z = z[start : start + size]
            p = np.fft.fftshift(np.abs(np.fft.fft(z)) ** 2)
            return 10 * np.log10(p[size // 2 + 1 :].sum() / p[: size // 2].sum())

        lengths = spark.createDataFrame([("f", n, 1000.0)], "file_id string, frames long, fs_hz double")
        got = {r["factor"]: r for r in irr.single_transform_sweep(blocks_of(spark, x, 4096), lengths, target=1 << 13, most_frames=most).collect()}
        assert sorted(got) == [1, 2, 3, 4, 5, 8, 10, 16]
        direct = power(y) >= power(np.conj(y))
        base = max(power(y), power(np.conj(y)))
        for f, r in got.items():
            z = y[::f]
            want = power(z if direct else np.conj(z))
            assert np.isclose(r["irr_db"], want, atol=1e-6) and np.isclose(r["difference_db"], want - base, atol=1e-6) and r["fs_hz"] == 1000 / f
            assert r["best_convention"] == ("I+jQ" if direct else "I-jQ")


def test_rates_of_clips_of_two_recordings(spark):
    clips = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 1), ("c", 0)], "file string, clip_index long")
    meta = spark.createDataFrame([("a", 100.0, 0, 10.0), ("a", 100.0, 1, None), ("b", 200.0, 0, 20.0), ("b", 200.0, None, None)], "file string, fs_used_hz double, clip_index long, fs_dec_hz double")
    rates = {(r["file"], r["clip_index"]): r["fs_hz"] for r in files.clip_rates(clips, meta).collect()}
    assert rates == {("a", 0): 10.0, ("a", 1): 100.0, ("b", 0): 20.0, ("b", 1): 200.0, ("c", 0): 1.0}


def test_rejection_before_and_after_by_hand(spark):
    """Signed rejection of each convention, the verdict's and the bands' borders, files without step one."""
    direct, mirrored = {"I+Q", "Q-I"}, {"I-Q", "Q+I"}
    rows = [("a", "I+jQ", 12.0, 12.0, -12.0), ("b", "I-jQ", 3.0, -3.0, 3.0), ("c", None, None, None, None), ("d", "I+jQ", 31.0, 31.0, -31.0)]
    table = spark.createDataFrame(rows, "file_id string, best_convention string, best_irr_db double, direct_db double, mirrored_db double")
    for conv in (None, *sorted(direct | mirrored)):
        got = {r["file_id"]: r for r in irr.comparison(table, conv).collect()}
        for name, best, best_db, plain, mirror in rows:
            r, used = got[name], conv or {"I+jQ": "I+Q", "I-jQ": "I-Q", None: "I+Q"}[best]
            want = plain if used in direct else mirror
            assert (r["conv_applied"], r["corrected_irr_db"], r["step1_irr_db"], r["step1_convention"]) == (used, want, best_db, best or "Unknown")
            gain = None if want is None else want - best_db
            assert r["irr_improvement_db"] == gain and r["verdict"] == (None if gain is None else "minimal" if gain > -1 else "degraded")
    with pytest.raises(ValueError):
        irr.comparison(table, "I*Q")
    gains = spark.createDataFrame([(str(g), "I+jQ", 0.0, g, 0.0) for g in (5.01, 5.0, 1.0, -1.0)], table.schema)
    assert {r["file_id"]: r["verdict"] for r in irr.comparison(gains, "I+Q").collect()} == {"5.01": "significant", "5.0": "moderate", "1.0": "minimal", "-1.0": "degraded"}
    values = spark.createDataFrame([(v,) for v in (30.1, 30.0, 20.0, 19.9, 10.0, 5.0, 4.9, None)], "v double")
    assert [r[0] for r in values.select(irr.band(values["v"])).collect()] == ["excellent", "good", "good", "marginal", "marginal", "poor", "very_poor", None]
    assert [r["band"] for r in irr.bands(spark).orderBy("accuracy_low").collect()] == ["very_poor", "poor", "marginal", "good", "excellent"]


def test_feature_files_by_capture(spark, tmp_path):
    """Features and engineered channels of one capture are replaced, those of others stay."""
    wave = lambda k: [float(np.cos(0.1 * k * n)) for n in range(64)]
    table = lambda *names: spark.createDataFrame([(f"d/{f}.wav", c, 1000.0, wave(c + 1), wave(c + 2)) for f in names for c in range(2)], "file_id string, clip_index long, fs_hz double, i array<double>, q array<double>")
    out = str(tmp_path / "out")
    for names in (("a", "b"), ("b",)):
        outputs.features(features.clip_features(table(*names), 32), f"{out}/features")
        outputs.engineered(features.engineered(table(*names), "amp,phase"), f"{out}/engineered")
    back = spark.read.csv(f"{out}/features", header=True, inferSchema=True)
    assert back.columns[:-1] == features.NAMES and back.count() == 4 and {r["T"] for r in back.collect()} == {64}
    made = spark.read.parquet(f"{out}/engineered/x")
    assert made.count() == 4 and all(len(r["X"]) == 4 and np.allclose(r["X"][2], np.hypot(r["X"][0], r["X"][1]), atol=1e-6) for r in made.collect())
    names = [json.loads(r["value"]) for r in spark.read.text(f"{out}/engineered/channels").collect()]
    assert names == [{"channels": ["I", "Q", "amp", "phase"], "clips": 2}] * 2


def test_chunks_of_a_memory_budget():
    for mb, channels, least in ((1, 2, 1 << 18), (64, 2, 4096), (100, 2, 3000), (64, 1, 1 << 25), (4096, 2, 1 << 18)):
        n = src.chunk_frames(mb, channels, least)
        fit = max(mb, 64) * 2**20 / (4 * channels)
        assert n == min(1 << 24, max(least, fit // least * least))

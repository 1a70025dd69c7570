"""Capture files, block operators and kernels: generated signals with known answers, independent of the block length."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigmill.functions import kernels
from sigmill.operators import activity
from sigmill.operators import captures as ops
from sigmill.plans import dialect, report
from sigmill.sources import captures as src
from sigmill.sources import slices

FS, N = 8000.0, 50_000


@pytest.fixture(scope="module")
def tone():
    rng = np.random.default_rng(0)
    x = 0.5 * np.exp(2j * np.pi * 1000 / FS * np.arange(N)) + 0.001 * (rng.normal(size=N) + 1j * rng.normal(size=N))
    return x.real.astype("<f4"), x.imag.astype("<f4")


def wav(i, q, width, code=1, rf64=False):
    x = np.stack([i, q], axis=1).ravel()
    raw = {1: lambda: np.round(x * 127.5 + 128).astype("u1").tobytes(), 2: lambda: np.round(x * 32768).astype("<i2").tobytes(), 3: lambda: np.round(x * 8388608).astype("<i4").view("u1").reshape(-1, 4)[:, :3].tobytes(), 4: lambda: x.astype("<f4").tobytes()}[width]()
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, code, 2, int(FS), int(FS) * 2 * width, 2 * width, 8 * width)
    if rf64:
        ds64 = struct.pack("<4sIQQQI", b"ds64", 28, 0, len(raw), len(x) // 2, 0)
        return struct.pack("<4sI4s", b"RF64", 0xFFFFFFFF, b"WAVE") + ds64 + fmt + struct.pack("<4sI", b"data", 0xFFFFFFFF) + raw
    return struct.pack("<4sI4s", b"RIFF", 28 + len(raw), b"WAVE") + fmt + struct.pack("<4sI", b"data", len(raw)) + raw


@pytest.fixture(scope="module")
def folder(tmp_path_factory, tone):
    d = tmp_path_factory.mktemp("captures")
    i, q = tone
    for width in (1, 2, 3, 4):
        (d / f"w{width}.WAV").write_bytes(wav(i, q, width, 3 if width == 4 else 1))
    (d / "big.wav").write_bytes(wav(i, q, 2, rf64=True))
    (d / "raw.r64").write_bytes(np.stack([i, q], axis=1).ravel().tobytes())
    (d / "notes.txt").write_text("no capture")
    return d


def load(spark, path, **options):
    src.register(spark)
    return spark.read.format("iqcapture").options(path=str(path), blockFrames=8192, chunkFrames=16384, fsHint=FS, **options).load()


def test_formats_decode_alike(spark, folder, tone):
    blocks = load(spark, folder)
    assert blocks.select("file_id").distinct().count() == 6
    for r in blocks.where("block_id = 2").collect():
        step = 2e-2 if "w1" in r["file_id"] else 1e-4
        assert np.allclose(r["i"], tone[0][16384:24576], atol=step) and np.allclose(r["q"], tone[1][16384:24576], atol=step)
        assert (r["n"], r["chunk_id"], r["start_sample"], r["fs_hz"]) == (8192, 1, 16384, FS)
    swapped = load(spark, folder / "raw.r64", channelOrder="QI").where("block_id = 0").first()
    assert np.array_equal(np.float32(swapped["i"]), tone[1][:8192])


def test_filters_skip_blocks(spark, folder):
    for size in (1 << 30, 100_000):  # one range of bytes, and several
        reader = src.CaptureReader({"path": str(folder / "raw.r64"), "blockFrames": "8192", "fsHint": str(FS), "partitionBytes": str(size)})
        list(reader.pushFilters([src.GreaterThanOrEqual(("start_sample",), 16384), src.LessThan(("start_sample",), 30000)]))
        assert [b for p in reader.partitions() for b in reader.blocks_of(p)[1]] == [2, 3]
    assert load(spark, folder / "raw.r64").where("start_sample >= 16384 AND start_sample < 30000").count() == 2


def test_ranges_of_bytes_hold_each_block_once(folder):
    for name in ("w1.WAV", "w3.WAV", "big.wav", "raw.r64"):
        for size in (1000, 12_345, 1 << 20):
            reader = src.CaptureReader({"path": str(folder / name), "blockFrames": "8192", "fsHint": str(FS), "partitionBytes": str(size)})
            assert [b for p in reader.partitions() for b in reader.blocks_of(p)[1]] == list(range(-(-N // 8192)))


def test_headers_and_fallback(spark, folder, tmp_path):
    rows = {r["file_id"].rpartition("/")[2]: r for r in src.metadata(spark, str(folder), fs_hint=FS).collect()}
    assert len(rows) == 6 and all((r["frames"], r["fs_hz"], r["duration_s"]) == (N, FS, N / FS) for r in rows.values())
    assert (rows["w3.WAV"]["bits"], rows["w1.WAV"]["channels"]) == (24, 2)
    (tmp_path / "broken.wav").write_bytes(b"RIFF" + bytes(60))
    (tmp_path / "short.r64").write_bytes(b"")
    with pytest.raises(ValueError):
        src.probe(str(tmp_path / "broken.wav"), fs_hint=FS)
    assert src.probe(str(tmp_path / "broken.wav"), fs_hint=FS, fallback_raw=True).frames == 8
    assert src.probe(str(folder / "w2.WAV"), "raw", FS).frames == (44 + 4 * N) // 8
    with pytest.raises(ValueError):
        src.probe(str(folder / "raw.r64"))
    messages = {r["file_id"].rpartition("/")[2]: r["message"] for r in src.metadata(spark, str(tmp_path), fs_hint=FS, tolerant=True).collect()}
    assert messages["short.r64"] is None and messages["broken.wav"]
    assert load(spark, tmp_path, fallbackRaw="true").count() == 1


def test_mono_and_wide_samples(spark, tone, tmp_path):
    x = np.stack([tone[0][:1000], tone[1][:1000]], axis=1).ravel()
    head = lambda code, channels, bits, size: struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + size, b"WAVE", b"fmt ", 16, code, channels, int(FS), 0, 0, bits, b"data", size)
    (tmp_path / "mono.wav").write_bytes(head(1, 1, 16, 4000) + np.round(x * 32768).astype("<i2").tobytes())
    (tmp_path / "wide.wav").write_bytes(head(3, 2, 64, 16_000) + x.astype("<f8").tobytes())
    for name in ("mono.wav", "wide.wav"):
        r = load(spark, tmp_path / name).first()
        assert r["n"] == 1000 and np.allclose(r["i"], tone[0][:1000], atol=1e-4) and np.allclose(r["q"], tone[1][:1000], atol=1e-4)


def test_wav_headers_of_any_length(tmp_path):
    assert src.wav_header(5, FS)[:4] == b"RIFF"
    head = src.wav_header(1 << 31, FS)
    assert head[:4] == b"RF64" and struct.unpack_from("<QQ", head, 20) == (80 + (1 << 33) - 8, 1 << 33)
    (tmp_path / "a.wav").write_bytes(head + bytes(400))
    c = src.probe(str(tmp_path / "a.wav"))
    assert (c.offset, c.frames, c.width, c.fs_hz) == (80, 100, 2, FS)


def test_halo_from_the_source_equals_the_join_and_shuffles_no_samples(spark, folder):
    path = folder / "raw.r64"
    plain, near = load(spark, path), load(spark, path, haloBefore=100, haloAfter=900, haloBeforeMs=5)
    assert near.columns == [*plain.columns, "head_i", "head_q", "tail_i", "tail_q"]
    carriers = spark.createDataFrame([(str(path), 0, 1000.0)], "file_id string, carrier_index long, f_center_hz double")
    ways = {
        "welch": lambda b: ops.welch(b, 1024, 512), "waterfall": lambda b: ops.waterfall(b, 1024, 256), "retune": lambda b: ops.retune(b, carriers, 2000.0, 63),
        "slices": lambda b: ops.activity_slices(b, thresh_dbfs=-6.02), "capped": lambda b: ops.waterfall(b, 1024, 256, 40),
    }

    def plain_row(x):
        return [plain_row(v) for v in x] if isinstance(x, (list, tuple)) else round(x, 4) + 0.0 if isinstance(x, float) else x

    for name, way in ways.items():
        a, b = (sorted((plain_row(list(r)) for r in way(x).collect()), key=str) for x in (plain, near))
        assert len(a) == len(b) and all(np.allclose(np.hstack(x[1:]).astype(float), np.hstack(y[1:]).astype(float), atol=1e-3) for x, y in zip(a, b, strict=True)), name
        plan = way(near)._jdf.queryExecution().executedPlan().toString()
        assert name in ("retune", "capped") or "Join" not in plan, name
    assert ops.waterfall(near, 1024, 256, 40).count() <= 40


def test_moments_rejection_and_spectrum(spark, folder, tone):
    i, q = (x.astype(float) for x in tone)
    for frames in (8192, 16384):
        src.register(spark)
        blocks = spark.read.format("iqcapture").options(path=str(folder / "raw.r64"), blockFrames=frames, fsHint=FS).load()
        m = ops.channel_moments(blocks).first()
        assert m["frames"] == N and np.isclose(m["i_mean"], i.mean()) and np.isclose(m["q_std"], q.std()) and np.isclose(m["i_rms"], np.sqrt((i**2).mean()))
        irr = ops.image_rejection(blocks).first()
        assert irr["best"] == "I+Q" and irr["irr_db"] > 30
        psd = ops.welch(blocks, 1024, 512).orderBy("bin").collect()
        total, n = kernels.welch_sums(i + 1j * q, 1024, 512, FS)
        assert np.allclose([r["p"] for r in psd], total / n) and max(psd, key=lambda r: r["p"])["f_hz"] == 1000
        grid = ops.waterfall(blocks, 1024, 512).orderBy("t_idx").collect()
        assert [r["t_idx"] for r in grid] == list(range(n))
        assert np.allclose([r["s_db"] for r in grid], kernels.stft_db(i + 1j * q, 1024, 512), atol=1e-3)


def test_cut_intervals(spark, folder, tone):
    intervals = spark.createDataFrame([(str(folder / "raw.r64"), 0, 100, 20_000), (str(folder / "raw.r64"), 1, 8192, 16384), (str(folder / "raw.r64"), 2, 5, 5)], "file_id string, slice_idx long, start_sample long, end_sample long")
    rows = ops.cut(load(spark, folder / "raw.r64"), intervals, 8192).orderBy("slice_idx", "at").collect()
    for k, (a, b) in ((0, (100, 20_000)), (1, (8192, 16384))):
        assert np.array_equal(np.concatenate([np.float32(r["i"]) for r in rows if r["slice_idx"] == k]), tone[0][a:b])
    assert {r["slice_idx"] for r in rows} == {0, 1}
    data = src.wav_bytes(tone[0][:50], tone[1][:50], FS)
    assert np.allclose(src.decode(data[44:], 2, False)[::2], tone[0][:50], atol=1e-4)


def test_exported_slices(spark, folder, tone, tmp_path):
    path = str(folder / "raw.r64")
    wanted = {0: (100, 20_000), 1: (8192, 16384), 2: (49_990, 60_000)}
    intervals = spark.createDataFrame([(path, k, a, b) for k, (a, b) in wanted.items()] + [(path, 3, 7, 7)], "file_id string, slice_idx long, start_sample long, end_sample long")
    slices.register(spark)
    for _ in range(2):  # a second run replaces the files
        slices.export(load(spark, path), intervals, str(tmp_path / "out"), 8192)
    files = sorted((tmp_path / "out").iterdir())
    assert [f.name.rpartition("_")[2] for f in files] == ["00000.wav", "00001.wav", "00002.wav"]
    for f, (a, b) in zip(files, wanted.values(), strict=True):
        c = src.probe(str(f))
        i, q = src.read_block(c, 0, c.frames)
        assert c.fs_hz == FS and len(i) == min(b, N) - a
        assert np.allclose(i, tone[0][a:b], atol=1e-4) and np.allclose(q, tone[1][a:b], atol=1e-4)


def test_a_long_slice_in_parts(spark, folder, tone, tmp_path):
    path = str(folder / "raw.r64")
    intervals = spark.createDataFrame([(path, 0, 100, 45_000), (path, 1, 5, 900)], "file_id string, slice_idx long, start_sample long, end_sample long")
    slices.register(spark)
    slices.export(load(spark, path), intervals, str(tmp_path / "out"), 8192, part_frames=16_384)
    files = sorted((tmp_path / "out").iterdir())
    assert [f.name.partition("_")[2].partition("_")[2] for f in files] == ["00000.part00000.wav", "00000.part00001.wav", "00000.part00002.wav", "00001.wav"]
    parts = [src.read_block(src.probe(str(f)), 0, src.probe(str(f)).frames)[0] for f in files]
    assert np.allclose(np.concatenate(parts[:3]), tone[0][100:45_000], atol=1e-4) and np.allclose(parts[3], tone[0][5:900], atol=1e-4)


def test_a_job_that_fails_leaves_no_slices(spark, folder, tmp_path):
    """Some files are written whole before a task fails: the names that were there keep their bytes, nothing is added."""
    path, out = str(folder / "raw.r64"), tmp_path / "out"
    kind = "file_id string, slice_idx long, start_sample long, end_sample long"
    slices.register(spark)
    slices.export(load(spark, path), spark.createDataFrame([(path, 0, 0, 500)], kind), str(out), 8192)
    before = {f.name: f.read_bytes() for f in out.iterdir()}
    rows = [(next(iter(before)), 2, FS, 0, [0.5, 0.5], [0.0, 0.0]), ("a.wav", 1, FS, 0, [0.5], [0.5]), ("b.wav", 1, FS, 0, [0.5], None)]
    with pytest.raises(Exception, match="same shape"):
        spark.createDataFrame(rows, slices.PIECES).repartition(3, "name").sortWithinPartitions("name", "at").write.format("iqslices").mode("append").save(str(out))
    assert {f.name: f.read_bytes() for f in out.iterdir()} == before


def test_slices_of_blocks_equal_the_sample_query(spark, tmp_path):
    rng = np.random.default_rng(3)
    for k in range(2):
        loud = np.repeat(rng.random(500) < 0.3, rng.integers(1, 60, 500))
        x = (rng.normal(size=(len(loud), 2)) * np.where(loud, 0.7, 0.1)[:, None]).astype("<f4")
        x[17] = np.nan
        (tmp_path / f"{k}.r64").write_bytes(x.tobytes())
    src.register(spark)
    for frames in (512, 4096):
        blocks = spark.read.format("iqcapture").options(path=str(tmp_path), blockFrames=frames, chunkFrames=4096, fsHint=1000).load()
        clean = ops.samples(blocks).withColumns({c: F.nanvl(c, F.lit(0.0)) for c in "iq"})
        want = dialect.run(activity.SLICES, s=clean).orderBy("file_id", "slice_idx").collect()
        near = spark.read.format("iqcapture").options(path=str(tmp_path), blockFrames=frames, chunkFrames=4096, fsHint=1000, haloBeforeMs=5).load()
        for some in (blocks, near):
            got = ops.activity_slices(some, thresh_dbfs=activity.THRESH_DB).orderBy("file_id", "slice_idx").collect()
            assert len(want) > 50 and [tuple(r)[:4] for r in got] == [tuple(r)[:4] for r in want]
    assert ops.activity_slices(blocks, thresh_dbfs=40).count() == 0
    assert ops.activity_slices(blocks.where("n < 0")).count() == 0


def test_all_slices_of_a_busy_capture(spark, tmp_path):
    loud = np.tile(np.repeat([1.0, 0.0], 30), 1100)
    (tmp_path / "busy.r64").write_bytes(np.stack([loud, loud], axis=1).astype("<f4").tobytes())
    src.register(spark)
    blocks = spark.read.format("iqcapture").options(path=str(tmp_path), blockFrames=4096, fsHint=1000).load()
    assert ops.activity_slices(blocks, thresh_dbfs=activity.THRESH_DB).count() == 1100
    assert ops.activity_slices(blocks, thresh_dbfs=activity.THRESH_DB, max_slices=10).count() == 10
    assert dialect.run(activity.SLICES, s=ops.samples(blocks)).count() == 1100


def test_retune_brings_the_tone_to_dc(spark, folder, tone):
    carriers = spark.createDataFrame([(str(folder / "raw.r64"), 0, 1000.0), (str(folder / "raw.r64"), 1, -2000.0)], "file_id string, carrier_index long, f_center_hz double")
    h = kernels.lowpass(63, 0.1)
    for frames in (8192, 10_000):
        src.register(spark)
        blocks = spark.read.format("iqcapture").options(path=str(folder / "raw.r64"), blockFrames=frames, fsHint=FS).load()
        rows = ops.retune(blocks, carriers, 2000.0, 63).orderBy("carrier_index", "block_id").collect()
        for k, f0 in enumerate((1000.0, -2000.0)):
            y = np.concatenate([np.array(r["i"]) + 1j * np.array(r["q"]) for r in rows if r["carrier_index"] == k])
            whole = np.convolve(kernels.mix(tone[0] + 1j * tone[1], 0, f0, FS), h, mode="same")[::4]
            assert np.allclose(y, whole, atol=1e-5) and {r["fs_hz"] for r in rows} == {2000.0}
            assert np.isclose(np.abs(y[100:-100].mean()), 0.5, atol=1e-3) == (k == 0)


def test_block_filter_equals_whole_filter():
    rng = np.random.default_rng(1)
    x, h = rng.normal(size=1000) + 1j * rng.normal(size=1000), kernels.lowpass(31, 0.1)
    whole = np.convolve(np.r_[np.zeros(15), x, np.zeros(15)], h, mode="valid")[::3]
    got = []
    for a in range(0, 1000, 128):
        b, left = min(1000, a + 128), min(15, a)
        got.append(kernels.decimate(x[a - left : b + 15], h, 3, a, left, b - a))
    assert np.allclose(np.concatenate(got), whole)
    mixed = np.concatenate([kernels.mix(x[a : a + 100], a, 5.0, 100.0) for a in range(0, 1000, 100)])
    assert np.allclose(mixed, kernels.mix(x, 0, 5.0, 100.0))


def test_peaks():
    assert kernels.peaks(np.array([0, 3, 3, 3, 0, 1, 0, 5, 4, 4.5, 0]), 1.0).tolist() == [2, 5, 7]


def test_classifier(spark):
    rows = [(s, [float(k * (s + 1)) for k in range(8)], [float(-k) for k in range(8)]) for s in range(3) for _ in range(4)]
    frames = spark.createDataFrame(rows, "segment_id long, i array<float>, q array<float>")
    out = ops.classify(frames, lambda x: np.stack([x[:, 0, -1], x[:, 1, -1]], axis=1), ["up"], 0.1).collect()
    assert len(out) == 3 and all(r["pred_label"] == "up" and r["prob_top1"] > 0.5 for r in out)


def test_samples_view(spark, folder):
    assert ops.samples(load(spark, folder / "raw.r64")).agg(F.count("*"), F.max("n")).first()[:] == (N, N - 1)


def test_report(spark, tone, tmp_path):
    (tmp_path / "in").mkdir()
    i, q = tone
    x = (i + 1j * q) * (1 + np.exp(2j * np.pi * 2 * FS / 1024 / FS * np.arange(N))) / 2  # two bins apart: a pure tone is too narrow for a carrier
    (tmp_path / "in" / "a.r64").write_bytes(np.stack([x.real, x.imag], axis=1).astype("<f4").tobytes())
    out, run = str(tmp_path / "out"), lambda **kw: report.analyse(spark, str(tmp_path / "in"), str(tmp_path / "out"), "hybrid", 8192, audio=True, fsHint=FS, **kw)
    assert report.progress(spark, out).count() == 0
    run(resume=True)  # nothing is there yet
    run()  # a run that is repeated replaces its rows
    (tmp_path / "in" / "b.wav").write_bytes(wav(x.real, x.imag, 2))
    (tmp_path / "in" / "c.wav").write_bytes(b"RIFF" + bytes(50))
    run(resume=True)
    stats = [json.loads(r["value"]) for r in spark.read.text(f"{out}/stats").collect()]
    assert len(stats) == 2 and all(s["best_convention"] == "I+jQ" and s["frames"] == N and s["quality_assessment"]["quality_score"] == 100 for s in stats)
    assert all(list(s) == sorted(s) for s in stats)
    reports = [r[0] for r in spark.read.text(f"{out}/report", wholetext=True).select("value").collect()]
    assert len(reports) == 2 and all("Quality Score: 100.0/100" in r and "Best convention: I+jQ" in r and "Samples analyzed: 50,000" in r for r in reports)
    found = spark.read.csv(f"{out}/carriers", header=True, inferSchema=True)
    assert found.count() == 2 and {r["f_center_hz"] for r in found.collect()} <= {1000.0, 1015.625}
    assert spark.read.csv(f"{out}/slices", header=True).count() == 2 and len(list((tmp_path / "out" / "audio").iterdir())) == 2
    assert {(r["num_slices"], r["params"]["thresh_dbfs"]) for r in (json.loads(v[0]) for v in spark.read.text(f"{out}/slices_meta").select("value").collect())} == {(1, -60.0)}
    activity_ = spark.read.csv(f"{out}/time_activity", header=True, inferSchema=True)
    assert activity_.columns[:2] == ["time_s", "activity"] and activity_.count() == 2 * (1 + (N - 1024) // 256)
    summaries = {s["wav"].rpartition("/")[2]: s for s in (json.loads(v[0]) for v in spark.read.text(f"{out}/summary").select("value").collect())}
    assert {s["num_carriers"] for s in summaries.values()} == {1} and {s["fs_used_hz"] for s in summaries.values()} == {FS}
    by_name = {s["input_file"].rpartition("/")[2]: s for s in stats}
    assert by_name["a.r64"]["fs_header_hz"] is None and by_name["b.wav"]["fs_header_hz"] == summaries["b.wav"]["fs_header_hz"] > 0 and by_name["b.wav"]["channels"] == 2
    assert by_name["b.wav"]["analysis_params"] == {"block_frames": 8192, "chunk_frames": src.CHUNK_FRAMES, "fft_size": ops.IRR_FFT, "passes": 2} and by_name["b.wav"]["covered_duration_s"] == N / FS
    for name, s in summaries.items():
        assert s["cfar"] == {"guard": 1, "k": 2.5, "train": 6} and s["optimization"]["waterfall_shape"] == [1024, 1 + (N - 1024) // 256]
        assert s["irr_analysis"]["conv_applied"] == "I+Q" and s["irr_analysis"]["step1_irr_db"] == by_name[name]["best_irr_db"] and s["irr_analysis"]["verdict"] == "minimal" and abs(s["irr_analysis"]["irr_improvement_db"]) < 1e-9
    batch = json.loads(spark.read.text(f"{out}/batch_summary").first()[0])
    assert (batch["completed_files"], batch["failed_files"], batch["total_processed"]) == (2, 1, 3) and np.isclose(batch["success_rate"], 2 / 3) and np.isclose(batch["avg_time_per_file_hours"], batch["elapsed_hours"] / 3)
    assert [r[0].rpartition("/")[2] for r in spark.read.text(f"{out}/failed_list").collect()] == ["c.wav"]
    run(steps=("spectrum",), conv="I-Q")  # step one's values come from the earlier run
    again = [json.loads(v[0])["irr_analysis"] for v in spark.read.text(f"{out}/summary").select("value").collect()]
    assert {(a["conv_applied"], a["verdict"], a["band"]) for a in again} == {("I-Q", "degraded", "very_poor")} and {a["step1_convention"] for a in again} == {"I+jQ"}
    status = {r["file_id"].rpartition("/")[2]: r["status"] for r in report.progress(spark, out).collect()}
    assert status == {"a.r64": "completed", "b.wav": "completed", "c.wav": "failed"}
    assert "b.wav</td><td>completed" in spark.read.text(f"{out}/index", wholetext=True).first()[0]

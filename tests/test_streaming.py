"""Streams give what the batch operators give, in whatever order files arrive within the delay."""

import numpy as np
from pyspark.sql import functions as F

from sigmill.operators import activity
from sigmill.operators import captures as ops
from sigmill.plans import dialect
from sigmill.streaming import bursts
from sigmill.streaming import slices as stream_slices

SEGMENT = "file_id long, segment_id long, start_s double, end_s double, pred_label string, prob double, offset_hz double, bw_hz double, snr_db double, noise string"


def drained(stream, mode, name, spark):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    return spark.table(name)


def test_bursts_equal_the_batch_query(spark, tmp_path):
    rng = np.random.default_rng(5)
    start = np.cumsum(rng.exponential(0.1, 300))
    start[0] = 0.0
    rows = [(int(rng.integers(3)), k, float(s), float(s + rng.exponential(0.2)), str(rng.choice(["am", "fm", "UNKNOWN"], p=[0.6, 0.3, 0.1])), float(rng.random()), float(rng.normal()), float(rng.random()), None if k % 7 == 0 else round(float(rng.random()) * 30, 2), "x") for k, s in enumerate(start)]
    rows.append((1, 300, rows[-1][2], rows[-1][3], None, None, None, None, None, None))
    rows.append((1, 301, None, 1.0, "am", 0.5, 0.0, 1.0, 1.0, None))
    last = (9, 302, 1e4, 1e4 + 1, "am", 0.5, 0.0, 1.0, 1.0, None)
    batch = dialect.run(activity.BURSTS, segments=spark.createDataFrame([r for r in rows if r[2] is not None], SEGMENT))
    for k in range(0, len(rows), 60):  # each file's rows in random order; the watermark stays behind them
        part = [rows[j] for j in rng.permutation(np.arange(k, min(k + 60, len(rows))))]
        spark.createDataFrame(part, SEGMENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([last], SEGMENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SEGMENT).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    out = drained(bursts.bursts(stream, activity.GROUP_GAP, "60 seconds"), "append", "stream_bursts", spark)
    numbers = ["start_s", "end_s", "avg_prob", "offset_hz", "bandwidth_hz", "snr_db"]
    got, want = (df.select("file_id", "pred_label", "n_segments", *numbers).orderBy("file_id", F.round("start_s", 5), F.isnull("pred_label")).collect() for df in (out.where("file_id < 9"), batch))
    assert len(want) > 50 and [r[:3] for r in got] == [r[:3] for r in want]
    for r, w in zip(got, want, strict=True):  # the batch query rounds
        assert all((r[c] is None) == (w[c] is None) and (r[c] is None or abs(r[c] - w[c]) < 1e-4) for c in numbers)


def test_an_empty_stream_has_no_bursts(spark, tmp_path):
    spark.createDataFrame([], SEGMENT).write.parquet(str(tmp_path / "none"))
    stream = spark.readStream.schema(SEGMENT).parquet(str(tmp_path / "none"))
    assert drained(bursts.bursts(stream), "append", "stream_none", spark).count() == 0


def test_moments_of_a_stream(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(f"f{k % 2}", rng.normal(size=50).tolist(), rng.normal(size=50).tolist()) for k in range(6)]
    blocks = spark.createDataFrame(rows, "file_id string, i array<float>, q array<float>")
    blocks.repartition(3).write.parquet(str(tmp_path / "blocks"))
    stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "blocks"))
    got, want = (df.orderBy("file_id").select("frames", *(F.round(c, 6) for c in ("i_mean", "i_std", "q_rms", "q_max"))).collect() for df in (drained(ops.channel_moments(stream), "complete", "stream_moments", spark), ops.channel_moments(blocks)))
    assert got == want and len(got) == 2


def test_rejection_of_a_stream(spark, tmp_path):
    rng = np.random.default_rng(7)
    rows = [(f"f{k % 2}", rng.normal(size=64).tolist(), rng.normal(size=64).tolist()) for k in range(6)]
    blocks = spark.createDataFrame(rows, "file_id string, i array<float>, q array<float>")
    blocks.repartition(3).write.parquet(str(tmp_path / "blocks"))
    stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "blocks"))
    got, want = (df.orderBy("file_id").select("file_id", "best", F.round("irr_db", 6)).collect() for df in (drained(ops.image_rejection(stream), "complete", "stream_irr", spark), ops.image_rejection(blocks)))
    assert got == want and len(got) == 2


def test_slices_of_a_stream_equal_the_batch_operator(spark, tmp_path):
    rng, rows = np.random.default_rng(8), []
    for f in range(2):
        loud = np.repeat(rng.random(400) < 0.4, rng.integers(1, 60, 400))
        x = rng.normal(size=(len(loud), 2)) * np.where(loud, 0.7, 0.05)[:, None]
        for b in range(0, len(x) // 512):
            rows.append((f"f{f}", b * 512 // 2048, b, b * 512, 512, 1000.0, x[b * 512 : b * 512 + 512, 0].tolist(), x[b * 512 : b * 512 + 512, 1].tolist()))
    schema = "file_id string, chunk_id long, block_id long, start_sample long, n int, fs_hz double, i array<float>, q array<float>"
    blocks = spark.createDataFrame(rows, schema)
    want = ops.activity_slices(blocks, thresh_dbfs=-6).orderBy("file_id", "start_sample").collect()
    runs = ops.activity_runs(blocks, thresh_dbfs=-6).collect()
    last = [(f"f{f}", 99, 1000.0, 10**6, 10**6 + 1, None, None) for f in range(2)]
    kind = "file_id string, chunk_id long, fs_hz double, lo long, hi long, s long, e long"
    order = sorted(map(tuple, runs), key=lambda r: r[3])
    for k in range(0, len(order), 150):  # whole stretches of time, each in random order
        part = order[k : k + 150]
        spark.createDataFrame([part[j] for j in rng.permutation(len(part))], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "runs"))
    spark.createDataFrame(last, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "runs"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "runs"))
    got = drained(stream_slices.activity_slices(stream, delay="30 seconds"), "append", "stream_slices", spark).orderBy("file_id", "start_sample").collect()
    assert len(want) > 40 and [(r["file_id"], r["start_sample"], r["end_sample"], r["duration_ms"]) for r in got] == [(r["file_id"], r["start_sample"], r["end_sample"], r["duration_ms"]) for r in want]


def test_a_fixed_chunk_plan_of_a_stream(spark, tmp_path):
    rows = [("f", b, b * 512, 1000.0) for b in range(20)]
    blocks = spark.createDataFrame(rows, "file_id string, block_id long, start_sample long, fs_hz double")
    blocks.write.parquet(str(tmp_path / "blocks"))
    stream = spark.readStream.schema(blocks.schema).parquet(str(tmp_path / "blocks"))
    count = lambda df: {(r["s"], r["n"]) for r in df.groupBy(F.unix_millis("chunk.start").alias("s")).agg(F.count("*").alias("n")).collect()}
    assert count(stream_slices.chunks(blocks, 2.0)) == {(0, 4), (2000, 4), (4000, 4), (6000, 4), (8000, 4)}
    assert drained(stream_slices.chunks(stream, 2.0, 1.0).groupBy("chunk").count(), "complete", "stream_chunks", spark).count() == 11


def test_bursts_go_on_after_a_restart(spark, tmp_path):
    """Stopped with open state and started again from its checkpoint, the query gives each burst once, as the batch does."""
    rng = np.random.default_rng(9)
    start = np.cumsum(rng.exponential(0.1, 200))
    rows = [(int(rng.integers(2)), k, float(s), float(s + rng.exponential(0.2)), str(rng.choice(["am", "fm"])), 0.5, 1.0, 2.0, round(float(rng.random()) * 30, 2), "x") for k, s in enumerate(start)]
    want = dialect.run(activity.BURSTS, segments=spark.createDataFrame(rows, SEGMENT))
    parts = [rows[:90], rows[90:170], rows[170:], [(9, 900, 1e4, 1e4 + 1, "am", 0.5, 0.0, 1.0, 1.0, "x")]]
    for part in parts:
        spark.createDataFrame([part[j] for j in rng.permutation(len(part))], SEGMENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = bursts.bursts(spark.readStream.schema(SEGMENT).parquet(str(tmp_path / "in")), activity.GROUP_GAP, "5 seconds")
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        assert query.awaitTermination(240)
    got, want = (df.select("file_id", "n_segments", "start_s", "end_s", "snr_db").orderBy("file_id", "start_s").collect() for df in (spark.read.parquet(str(tmp_path / "out")).where("file_id < 9"), want))
    assert [r[:2] for r in got] == [r[:2] for r in want] and np.allclose([r[2:] for r in got], [r[2:] for r in want], atol=1e-5)


def islands(rows, gap_us):
    """The definition: by file in order of start, a segment joins while it starts within the gap of all ends so far."""
    out = []
    for f, a, b in sorted((r[0], round(r[1] * 1e6), round(r[2] * 1e6)) for r in rows if None not in r[1:] and r[2] >= r[1]):
        if out and out[-1][0] == f and a - out[-1][2] <= gap_us:
            out[-1] = (f, out[-1][1], max(out[-1][2], b), out[-1][3] + 1)
        else:
            out.append((f, a, b, 1))
    return out


def test_spans_of_any_label(spark, tmp_path):
    rng = np.random.default_rng(10)
    start = np.cumsum(rng.exponential(0.1, 300)).round(3)
    rows = [(f"f{int(rng.integers(3))}", float(s), float(s) + round(float(rng.exponential(0.15)), 3)) for s in start]
    rows += [("g", 0.0, 1.0), ("g", 1.06, 1.5), ("g", 1.560001, 1.7), ("g", 0.2, 0.3), ("h", None, 1.0), ("h", 2.0, None), ("h", 3.0, 2.0), ("h", 4.0, 4.0), ("h", 4.0, 4.0)]
    kind = "file_id string, start_s double, end_s double"
    key = lambda df: sorted((r["file_id"], round(r["start_s"] * 1e6), round(r["end_s"] * 1e6), r["n_segments"]) for r in df.collect())
    assert key(bursts.spans(spark.createDataFrame(rows, kind))) == islands(rows, 60_000)
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("z", 1e4, 1e4)], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = bursts.spans(spark.readStream.schema(kind).parquet(str(tmp_path / "in")))
    assert key(drained(stream, "append", "stream_spans", spark).where("file_id <> 'z'")) == islands(rows, 60_000)
    assert bursts.spans(spark.createDataFrame([], kind)).count() == 0

"""The registered queries of the capture operators, and the SQL that DuckDB must agree with.

`TEXTS` are relational plans, one text for both engines; tests/test_models.py checks them against sequential models. All
others run block operators in Spark and have an oracle written apart (`oracles`), or none where SQL cannot say it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import activity, assessment, clips, extraction, features, inference, irr, qa, quality, spectrum, wideband
from ..operators import captures as ops
from ..operators import intervals as iv
from ..sources import files, tables
from ..streaming.bursts import spans
from . import dialect, oracles

BINS = 512
TEXTS: dict[str, str] = {
    "q_chunk_stats": quality.channel_stats("chunk_id"), "q_envelope_kurtosis": quality.ENVELOPE_KURTOSIS,
    "q_strided_scan": quality.strided_scan(7), "q_chunk_strided_scan": quality.chunk_strided_scan(7), "q_head_scan": quality.head_scan(500), "q_time_window": quality.time_window(0.25, 0.75, 1000), "q_conventions": quality.CONVENTIONS,
    "q_rms_dbfs": activity.RMS_DBFS,
    "q_clip_energy": clips.CLIP_ENERGY, "q_clip_kurtosis": clips.CLIP_KURTOSIS, "q_clip_psd": clips.CLIP_PSD, "q_clip_cumulants": clips.CLIP_CUMULANTS, "q_clip_cfo": clips.CLIP_CFO,
    "q_clip_channels": clips.CLIP_CHANNELS, "q_clip_normalised": clips.CLIP_NORMALISED, "q_irr_conventions": clips.IRR_CONVENTIONS, "q_best_convention": clips.BEST_CONVENTION, "q_irr_variability": clips.IRR_VARIABILITY, "q_softmax_labels": clips.SOFTMAX_LABELS,
    "q_enriched": clips.ENRICHED, "q_frames_standardised": clips.FRAMES_STANDARDISED, "q_band_energy": clips.BAND_ENERGY, "q_retuned": clips.RETUNED, "q_irr_verdict": clips.IRR_VERDICT, "q_verify_convention": clips.VERIFY_CONVENTION,
    "q_cumulant_channels": clips.CUMULANT_CHANNELS, "q_engineered": clips.engineered(" Amp, phase,,cum42,other ,D2PHASE"),
    "q_sampling_candidates": quality.SAMPLING_CANDIDATES, "q_qa_low_conf": qa.low_confidence(),
    "q_batch_summary": qa.BATCH_SUMMARY, "q_pending_files": qa.PENDING_FILES, "q_file_success": qa.file_success(),
}
QA = {"q_qa_clean": qa.carriers(False), "q_qa_review": qa.carriers(True), "q_qa_conflicts": qa.conflicts(), "q_qa_summary": qa.summary()}


def _query(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = {name: tables.view(spark, sf_dir, name) for name in tables.VIEWS if "{" + name + "}" in sql}
        return dialect.run(sql, **views, bins=spark.range(BINS).toDF("k"))

    return query


def _rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    return df.select(*(F.round(c, other.get(c, digits)).alias(c) + F.lit(0.0) if t == "double" else F.col(c) for c, t in df.dtypes)).toDF(*df.columns)


def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ops.channel_moments(tables.blocks(spark, sf_dir))
    return out.select("file_id", "frames", *(F.round(f"{c}_{k}", 6).alias(f"{c}_{k}") if k in ("mean", "std", "rms", "clip_pct") else F.col(f"{c}_{k}") for c in "iq" for k in ("nan", "inf", "mean", "std", "min", "max", "peak_abs", "rms", "clip_pct")))


def _assessed(stats: DataFrame, short_s: float | None) -> DataFrame:
    clip = F.round(F.greatest("i_clip_pct", "q_clip_pct"), 6).alias("clip_pct")
    texts = (F.array_join(c, "; ").alias(c) for c in ("issues", "warnings", "recommendations"))
    return assessment.assess(stats, short_s).select("file_id", "frames", "nan_count", "inf_count", clip, "best_convention", F.round("best_irr_db", 4).alias("best_irr_db"), F.round("envelope_kurtosis", 6).alias("envelope_kurtosis"), "quality_score", "verdict", *texts)


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assessed(assessment.statistics(tables.blocks(spark, sf_dir)), None)


def chunk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk as a recording of its own."""
    blocks = tables.blocks(spark, sf_dir).withColumn("file_id", F.col("chunk_id").cast("string"))
    return _assessed(assessment.statistics(blocks), 0.1)


def _psd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.welch(tables.blocks(spark, sf_dir), spectrum.NPERSEG, spectrum.HOP)


def psd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_psd(spark, sf_dir), p=9)


def noise_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ops.noise_floor(_psd(spark, sf_dir)))


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.carriers(_psd(spark, sf_dir), spectrum.PROMINENCE)
    return _rounded(found.select("file_id", "f_center_hz", "p_db", F.col("bw_hz").alias("bw_hz_est"), F.col("snr_db").alias("snr_db_est")))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.waterfall(tables.blocks(spark, sf_dir), spectrum.COLS, spectrum.COLS, scaling="spectrum", kind="double")


def waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("file_id", F.col("t_idx").alias("t"), F.posexplode("s_db").alias("f", "s_db")).select("file_id", "t", F.col("f").cast("long").alias("f"), F.round("s_db", 6).alias("s_db"))


def thumbnail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(wideband.thumbnail(_grid(spark, sf_dir)))


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wideband.cfar_mask(_grid(spark, sf_dir), spectrum.K, spectrum.GUARD, spectrum.TRAIN)


def cfar_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mask(spark, sf_dir).select("file_id", F.col("t_idx").alias("t"), F.posexplode("mask").alias("f", "active")).withColumn("f", F.col("f").cast("long"))


def occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(wideband.occupancy(_mask(spark, sf_dir)).withColumnRenamed("f_idx", "f"))


def time_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(wideband.time_activity(_mask(spark, sf_dir)).withColumnRenamed("t_idx", "t"))


def active_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four bands of eight bins each as carriers; the pad is taken off their width."""
    step = spectrum.FS / spectrum.COLS
    bands = [("events", k, (8 * k + 3.5 - spectrum.COLS / 2) * step, 7.5 * step / 1.25, float(spectrum.FS)) for k in range(4)]
    table = spark.createDataFrame(bands, "file_id string, carrier_index long, f_center_hz double, bw_hz double, fs_hz double")
    return wideband.active_spans(_mask(spark, sf_dir), table).select("file_id", F.col("carrier_index").alias("band"), "t_first", "t_last")


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ops.activity_slices(tables.blocks(spark, sf_dir), activity.RMS_WIN, activity.THRESH_DB, activity.MIN_DUR, activity.GAP, activity.PAD))


def _whole(blocks: DataFrame) -> DataFrame:
    """Each file as one interval."""
    return blocks.groupBy("file_id").agg(F.lit(0).cast("long").alias("interval_id"), F.lit(0).cast("long").alias("start_sample"), F.max(F.col("start_sample") + F.col("n")).alias("end_sample"))


def _energies(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tables.blocks(spark, sf_dir)
    return iv.frame_energies(blocks, _whole(blocks), activity.FRAME, activity.STRIDE, tables.CHUNK_FRAMES)


def frame_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_energies(spark, sf_dir).select("file_id", F.col("at").alias("start_sample"), "energy_db"))


def vad_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = iv.voice_segments(_energies(spark, sf_dir), activity.START_DB, activity.HANG_DB, activity.MIN_SEGMENT, activity.MERGE_GAP, activity.FRAME)
    order = inference.Window.partitionBy("file_id").orderBy("start")
    return found.select("file_id", (F.row_number().over(order) - 1).cast("long").alias("segment_id"), F.col("start").alias("start_sample"), F.col("stop").cast("long").alias("end_sample"))


def auto_vad_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tables.blocks(spark, sf_dir)
    return iv.auto_threshold(blocks, _whole(blocks), 1000.0, block_frames=tables.CHUNK_FRAMES).select("file_id", F.round("threshold_db", 4).alias("threshold_db"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"start_s": "start_time_s", "end_s": "end_time_s", "prob": "prob_top1", "offset_hz": "rf_offset_hz", "bw_hz": "bandwidth_hz"}
    return tables.view(spark, sf_dir, "segments").withColumnsRenamed(names)


def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = inference.bursts(_segments(spark, sf_dir), activity.GROUP_GAP)
    return _rounded(out.drop("duration_s"), rf_offset_hz=4)


def segment_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(tables.view(spark, sf_dir, "segments"), activity.GROUP_GAP)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inference.bursts(_segments(spark, sf_dir).withColumn("file_id", F.col("file_id").cast("string")), activity.GROUP_GAP)
    return _rounded(inference.predictions(rows, 433e6, "2024-05-01T12:00:00Z"), rf_offset_hz=4)


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.chunk_plan(tables.recordings(spark, sf_dir), 30.0, 5.0, 5.0, 20)


def evenly_spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.evenly_spaced(tables.recordings(spark, sf_dir))


def sampling_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(irr.sampling_decision(tables.recordings(spark, sf_dir), 60.0, 100_000))


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return irr.sampling_sweep(tables.blocks(spark, sf_dir), frame=64)


def sampling_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_sweep(spark, sf_dir), 5).withColumn("factor", F.col("factor").cast("long"))


def sampling_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transform of 4096 places for each factor."""
    blocks = tables.blocks(spark, sf_dir)
    return _rounded(irr.single_transform_sweep(blocks, ops.lengths(blocks), target=4096), 4).withColumn("factor", F.col("factor").cast("long"))


def worst_degradation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(irr.worst_degradation(_sweep(spark, sf_dir)), 5).withColumn("factor", F.col("factor").cast("long"))


def chosen_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(irr.chosen_factor(_query(quality.SAMPLING_CANDIDATES)(spark, sf_dir), _sweep(spark, sf_dir)), 5)


def irr_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten segments of 0.5 s spread over the stream, each in four conventions."""
    blocks = tables.blocks(spark, sf_dir)
    files_ = ops.lengths(blocks)
    return _rounded(irr.channel_order(irr.by_interval(blocks, iv.evenly_spaced(files_, 10, 0.5), 512, tables.CHUNK_FRAMES)), 5)


def irr_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics across recordings: here each chunk is one."""
    blocks = tables.blocks(spark, sf_dir).withColumn("file_id", F.concat("file_id", F.lit("-"), "chunk_id"))
    found = ops.image_rejection(blocks).select("file_id", F.when(F.col("best") == "I+Q", "I+jQ").otherwise("I-jQ").alias("best_convention"), F.col("irr_db").alias("best_irr_db"))
    out = irr.variability(found, None, "file_id", 5.0, 20.0)
    return _rounded(out.withColumn("distribution", F.to_json("distribution")), 4)


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as a clip: I and Q in turn."""
    part = lambda odd: F.transform(F.filter("embedding", lambda _, k: k % 2 == odd), lambda x: x.cast("double"))
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("clip_index"), F.lit(float(clips.FS)).alias("fs_hz"), part(0).alias("i"), part(1).alias("q"))


def clip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.clip_features(_clips(spark, sf_dir))).withColumnRenamed("T", "t")


def clip_flatness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.clip_features(_clips(spark, sf_dir)).select("clip_index", "sfm"))


def clip_snr_bw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.clip_features(_clips(spark, sf_dir)).select("clip_index", "snr_db", "bw_hz"))


def carrier_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 64 samples around the carriers found, each with its mean power."""
    blocks = tables.blocks(spark, sf_dir)
    found = ops.carriers(_psd(spark, sf_dir), spectrum.PROMINENCE)
    files_ = ops.lengths(blocks)
    wanted = found.join(files_.select("file_id", (F.col("frames") / F.col("fs_hz")).alias("duration_s")), "file_id")
    streams = extraction.downmix(blocks, wanted, 1000.0, 4.0, 20.0, 101)
    cut = extraction.numbered(extraction.clips(streams, extraction.clip_spans(wanted), files_, 64, 0.5))
    power = F.aggregate(F.zip_with("i", "q", lambda a, b: (a * a + b * b).cast("double")), F.lit(0.0), lambda a, x: a + x) / 64
    return _rounded(cut.select("file_id", "clip_index", "carrier_index", "place", "decim", power.alias("power")), 4)


def clip_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the clips have a rate of their own, the others the recording's."""
    clips_ = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("clip_index"), "label")
    meta = clips_.where("clip_index % 3 = 0").select("clip_index", (F.lit(32.0) + F.col("label")).alias("fs_dec_hz"), F.lit(48.0).alias("fs_used_hz"))
    return files.clip_rates(clips_, meta).select("clip_index", "fs_hz")


def _settings() -> inference.Settings:
    return inference.Settings(seg_s=2.0, channels=5, crop=256, stride=128, vad_size=64, vad_stride=32, vad_db=None, quantile=0.5, margin_db=-2.6, hang_db=0.4, min_ms=96, merge_ms=64, nfft=64, hop=32, max_frames=50, preview_hz=None, block_frames=tables.CHUNK_FRAMES)


def linear_classifier(x: np.ndarray) -> np.ndarray:
    """A fixed scorer that stands for a trained model: three classes by products of neighbouring samples."""
    z = x[:, 0] + 1j * x[:, 1]
    lag = (z[:, 1:] * z[:, :-1].conj()).mean(axis=1)
    return np.stack([4 * lag.real, 4 * lag.imag, -4 * lag.real], axis=1)


def _inferred(spark: SparkSession, sf_dir: str) -> inference.Result:
    """The table's rows are grouped to blocks once, and get their halo once; captures are read from their files by each step."""
    s = _settings()
    blocks = ops.haloed(tables.blocks(spark, sf_dir).persist(), *inference.halo(1000.0, s)).persist()
    return inference.infer(blocks, linear_classifier, ["up", "side"], 1000.0, s)


def inference_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inferred(spark, sf_dir).segments


def inference_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_inferred(spark, sf_dir).frames)


def inference_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.predictions(_inferred(spark, sf_dir).bursts, 433e6, "2024-05-01T12:00:00+02:00")


#: Queries with block operators: the function, and its oracle.
BLOCKS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "q_channel_stats": (channel_stats, dialect.duck(quality.channel_stats("file_id"))),
    "q_quality_score": (quality_score, oracles.over_samples(oracles.quality("file", None))),
    "q_chunk_report": (chunk_report, oracles.over_samples(oracles.quality("chunk", 0.1))),
    "q_psd": (psd, dialect.duck(spectrum.PSD)),
    "q_noise_floor": (noise_floor, dialect.duck(spectrum.NOISE_FLOOR)),
    "q_carriers": (carriers, dialect.duck(spectrum.CARRIERS)),
    "q_waterfall": (waterfall, dialect.duck(spectrum.WATERFALL)),
    "q_thumbnail": (thumbnail, oracles.THUMBNAIL),
    "q_cfar_mask": (cfar_mask, dialect.duck(spectrum.CFAR_MASK)),
    "q_occupancy": (occupancy, dialect.duck(spectrum.OCCUPANCY)),
    "q_time_activity": (time_activity, dialect.duck(spectrum.TIME_ACTIVITY)),
    "q_active_spans": (active_spans, dialect.duck(spectrum.ACTIVE_SPANS)),
    "q_slices": (slices, dialect.duck(activity.SLICES)),
    "q_frame_energy": (frame_energy, dialect.duck(activity.FRAME_ENERGY)),
    "q_vad_segments": (vad_segments, dialect.duck(activity.VAD_SEGMENTS)),
    "q_auto_vad_threshold": (auto_vad_threshold, oracles.over_samples(oracles.AUTO_THRESHOLD)),
    "q_bursts": (bursts, oracles.BURSTS),
    "q_segment_spans": (segment_spans, oracles.SEGMENT_SPANS),
    "q_predictions": (predictions, oracles.PREDICTIONS),
    "q_chunk_plan": (chunk_plan, oracles.CHUNK_PLAN),
    "q_evenly_spaced": (evenly_spaced, oracles.EVENLY_SPACED),
    "q_sampling_decision": (sampling_decision, oracles.SAMPLING_DECISION),
    "q_sampling_sweep": (sampling_sweep, oracles.over_samples(oracles.SWEEP)),
    "q_worst_degradation": (worst_degradation, f"SELECT file_id, arg_min(factor, difference_db) AS factor, min(difference_db) AS difference_db FROM ({oracles.over_samples(oracles.SWEEP)}) GROUP BY file_id"),
    "q_sampling_effects": (sampling_effects, oracles.over_samples(oracles.SAMPLING_EFFECTS)),
    "q_chosen_factor": (chosen_factor, oracles.chosen_factor()),
    "q_irr_segments": (irr_segments, oracles.over_samples(oracles.IRR_SEGMENTS)),
    "q_irr_files": (irr_files, oracles.over_samples(oracles.IRR_FILES)),
    "q_features": (clip_features, dialect.duck(clips.FEATURES)),
    "q_clip_flatness": (clip_flatness, dialect.duck(clips.CLIP_FLATNESS)),
    "q_clip_snr_bw": (clip_snr_bw, dialect.duck(clips.CLIP_SNR_BW)),
    "q_carrier_clips": (carrier_clips, None),
    "q_clip_rates": (clip_rates, oracles.CLIP_RATES),
    "q_inference_segments": (inference_segments, None),
    "q_inference_frames": (inference_frames, None),
    "q_inference_bursts": (inference_bursts, None),
}
QUERIES = {name: _query(sql) for name, sql in {**TEXTS, **QA}.items()} | {name: f for name, (f, _) in BLOCKS.items()}
ORACLE_SQL = {name: dialect.duck(sql) for name, sql in TEXTS.items()} | oracles.QA | {name: sql for name, (_, sql) in BLOCKS.items() if sql}
